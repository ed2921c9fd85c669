"""Toxicity by a subsequence string-kernel machine with Nyström landmarks.

Two words are alike by the runs of four characters that both have, also with another
character between any two of them, each gap weighing less; so an insult with characters
put in or left out still resembles itself.  Signs inside words are read both as nothing
and as ends, and letters that stand apart are read as one word.  Long words are also read
piece by piece.  A word's edges count as characters.  The kernel is approximated by its values at
landmark words, a linear support vector machine is trained on them, and, since the kernel
is linear in its runs, the machine folds into one table of weights of runs.  Scoring a
text is then a pass over its characters, and no word is too rare for it.

Labels belong to texts, and an insult to one of its sentences.  The words that speak for a
toxic text's sentences are those that labelled toxic texts have much oftener than clean
ones; words of clean texts stand against them, above all those that the machine took for
insults in the round before.  Toxic texts without such a word are explained by windows of
two or three words, whose runs go across the edges between them; if there are such
phrases, a second machine learns them against clean windows.  A text's score is the chance
that goes with its worst word, piece or window.
"""

from __future__ import annotations

import itertools
import pickle
import re
import zlib
from collections import Counter
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamsync.llm.common import bounded_sample, free_name, give_back, remainder, small_batches
from streamsync.llm.linear import fit_logistic, train_svm

#: Toxic and clean texts to learn from at most, and their greatest length in characters.
PER_TOXIC, PER_CLEAN, LONGEST_SAMPLE = 1500, 5000, 40_000
#: Landmarks, characters of a run, most steps from one to the next, weight of a step more.
LANDMARKS, ORDER, STEPS, DECAY = 800, 4, 2, 0.8
#: Codes of characters (as bits), and of runs once hashed.
CODE_BITS, RUN_BITS = 6, 21
#: Words of more than LONG characters are also read as pieces of PIECES characters.
LONG, PIECES = 12, range(4, 13)
#: Words of a window, and clean pieces and windows from which a machine's examples are taken.
WINDOWS, POOL = (2, 3), 30_000
#: Characters scored at once; a word longer than this is cut.
SLICE = 1 << 18
PENALTY = 300.0
THRESHOLD = 0.7


def _alphabet() -> np.ndarray:
    """1-26 letters, 27 digits, 29-60 letters of Latin-1, 61-62 any other letter; 0 white
    space, SIGN for signs, also those of U+2000 to U+206F."""
    codes = np.zeros(0x3001, np.uint8)
    for c in range(0x3001):
        text = chr(c)
        if "a" <= text <= "z":
            codes[c] = c - 96
        elif text.isdigit() and c < 0x250:
            codes[c] = 27
        elif 0xDF <= c <= 0xFF and text.isalpha():
            codes[c] = 29 + c - 0xDF
        elif text.isalpha() or 0x250 <= c and not text.isspace() and not 0x2000 <= c < 0x2070:
            codes[c] = 61 + c % 2
        elif not text.isspace():
            codes[c] = SIGN
    return codes


#: Tokens whose values a worker remembers at least before it starts anew.
REMEMBERED = 300_000

SIGN, EDGE = 255, 63
_CODES = _alphabet()
_SIGNS = re.compile(f"[{re.escape(''.join(map(chr, np.flatnonzero(_CODES == SIGN))))}]+")
#: The places of each kind of run after its first character, and its weight.
_KINDS = [
    (tuple(itertools.accumulate(steps)), DECAY ** (sum(steps) - len(steps)))
    for steps in itertools.product(range(1, STEPS + 1), repeat=ORDER - 1)
]
_WIDEST = STEPS * (ORDER - 1)
#: Squared weights of all runs that begin so many characters before a word's last one.
_NORMS = np.array(
    [sum(w * w for at, w in _KINDS if at[-1] <= left) for left in range(_WIDEST + 1)], np.float32
)


def _raw(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(code <= 0x3000, _CODES[np.minimum(code, 0x3000)], 61 + code % 2)


def encode(text: str) -> np.ndarray:
    code = _raw(text.lower())
    return edged(code[code != SIGN])


def parted(text: str) -> np.ndarray:
    """The words that have a sign within, with signs as ends."""
    code = _raw(text.lower())
    letter = (code > 0) & (code != SIGN)
    begins, ends = spans(code)
    if not len(begins):
        return edged(code)
    pieces = np.add.reduceat(letter & ~np.append(False, letter[:-1]), begins, dtype=np.int64)
    letter[code > 0] &= np.repeat(pieces > 1, ends - begins)
    return edged(np.where(letter, code, 0))


def coded(units: list[str]) -> np.ndarray:
    """Words or windows (words with a space between) as ``encode`` has words."""
    text = "\n".join(units).lower()
    code = _raw(text)
    code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") == 32] = EDGE
    return edged(code[code != SIGN])


def edged(code: np.ndarray) -> np.ndarray:
    """The same words, each between two edges, with one space around each."""
    code = np.concatenate([[0], code, [0]]).astype(np.uint32)
    code = code[(code > 0) | (np.append(1, code[:-1]) > 0)]
    code = np.repeat(code, np.where(code > 0, 1, 3))
    spaces = np.flatnonzero(code == 0)
    code[spaces[2:-3:3]] = code[spaces[3::3]] = EDGE
    return code


def spans(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The beginnings and ends of a text's words."""
    edge = np.diff(np.concatenate([[0], (code > 0).astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def joined_letters(code: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words of three or more characters spelled apart, joined: codes with spaces between."""
    single = np.concatenate([[0], (ends - begins == 3).astype(np.int8), [0]])
    edge = np.diff(single)
    found = [
        np.concatenate([[EDGE], code[begins[a:b] + 1], [EDGE, 0]])
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))
        if b - a >= 3
    ]
    return np.concatenate(found).astype(np.uint32) if found else np.empty(0, np.uint32)


def runs(code: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Of each kind: where its runs begin, what they are, and their weight."""
    places = np.flatnonzero(code > 0)
    left = np.repeat(ends, ends - begins) - places - 1  # characters of the word after each one
    for steps, weight in _KINDS:
        at = places[left >= steps[-1]]
        run = code[at]
        for step in steps:
            run = (run << np.uint32(CODE_BITS)) | code[at + step]
        yield at, (run * np.uint32(0x9E3779B1)) >> np.uint32(32 - RUN_BITS), weight


def decisions(code: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """The machine's value for each word of a text."""
    begins, ends = spans(code)
    if not len(begins):
        return np.empty(0)
    sums = np.zeros(len(code), np.float32)
    for at, what, weight in runs(code, begins, ends):
        sums[at] += table[what] * np.float32(weight)
    total = np.add.reduceat(sums, begins)
    size = np.add.reduceat(_ends_norm(code, ends - begins, ends), begins)
    return total / np.sqrt(np.maximum(size, 1.0)) + bias


def _hashed(*codes: np.ndarray) -> np.ndarray:
    run = codes[0]
    for code in codes[1:]:
        run = (run << np.uint32(CODE_BITS)) | code
    return (run * np.uint32(0x9E3779B1)) >> np.uint32(32 - RUN_BITS)


def long_words(code: np.ndarray) -> np.ndarray:
    """The characters of words longer than LONG, a zero after each word."""
    begins, ends = spans(code)
    inside = np.zeros(len(code), bool)
    inside[code > 0] = np.repeat(ends - begins - 2 > LONG, ends - begins)
    inside[begins] = False
    return np.where(code == EDGE, 0, code)[inside].astype(np.uint32)


def pieces_worst(chars: np.ndarray, table: np.ndarray, bias: float) -> float:
    """The highest value of any piece of long words."""
    return float(piece_values(chars, table, bias).max(initial=-np.inf))


def piece_values(chars: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """The highest value of any piece of each long word, each piece as a word of its own.

    A piece's runs within come from running sums; those with its first or last edge
    depend on one end only, or on both for the shortest pieces.
    """
    n, most = len(chars), np.full(np.count_nonzero(chars == 0), -np.inf)
    if not n:
        return most
    tail = np.append(chars, np.zeros(_WIDEST + 1, np.uint32))
    inner, first, last, both = np.zeros((4, _WIDEST + 1, n + 1))
    edge = np.uint32(EDGE)
    for (a, b, c), weight in _KINDS:
        at = np.arange(n)
        within = np.float32(weight) * table[_hashed(chars, tail[at + a], tail[at + b], tail[at + c])]
        inner[c, 1:] += within  # after their running sum: the sum before each place
        first[c, :n] += weight * table[_hashed(np.full(n, edge), tail[at + a - 1], tail[at + b - 1], tail[at + c - 1])]
        if n >= c:
            last[c, c:] += weight * table[_hashed(tail[: n - c + 1], tail[a : n - c + 1 + a], tail[b : n - c + 1 + b], np.full(n - c + 1, edge))]
        both[c, :n] += weight * table[_hashed(np.full(n, edge), tail[at + a - 1], tail[at + b - 1], np.full(n, edge))]
    inner = np.cumsum(inner, axis=1)
    gaps = np.append(0, np.cumsum(chars == 0))
    for size in PIECES:
        m = n - size + 1
        if m < 1:
            break
        whole = gaps[size : size + m] == gaps[:m]
        if not whole.any():
            continue
        total = np.zeros(m)
        for c in range(ORDER - 1, _WIDEST + 1):
            if c < size:
                total += inner[c, size - c : size - c + m] - inner[c, :m]
            if c <= size:
                total += first[c, :m] + last[c, size : size + m]
            if c == size + 1:
                total += both[c, :m]
        norm = _NORMS[np.minimum(np.arange(size + 2), _WIDEST)].sum()
        np.maximum.at(most, gaps[:m][whole], total[whole] / np.sqrt(max(norm, 1.0)))
    return most + bias


def windows_worst(code: np.ndarray, table: np.ndarray, bias: float) -> float:
    """The highest value of any window of WINDOWS words; one edge stands between two words."""
    line = code[code > 0].astype(np.uint32)
    line = line[(line != EDGE) | (np.append(0, line[:-1]) != EDGE)]
    words = np.count_nonzero(line == EDGE) - 1
    if words < WINDOWS[0]:
        return -np.inf
    here = np.cumsum(line == EDGE) - 1  # the word of a run that begins here
    there = here - (line == EDGE)  # and of one that ends here
    sums, sizes = np.zeros((2, WINDOWS[-1], words + 1))
    for last in range(ORDER - 1, min(_WIDEST, len(line) - 1) + 1):
        n, value, square = len(line) - last, 0.0, 0.0
        for steps, weight in _KINDS:
            if steps[-1] == last:
                value = value + weight * table[_hashed(line[:n], *(line[step : n + step] for step in steps))]
                square += weight * weight
        over = there[last:] - here[:n]  # edges between the run's ends
        for k in range(WINDOWS[-1]):
            sums[k] += np.bincount(here[:n][over == k], value[over == k], words + 1)
            sizes[k] += square * np.bincount(here[:n][over == k], minlength=words + 1)
    before_sums, before_sizes = (np.append(np.zeros((WINDOWS[-1], 1)), np.cumsum(x, axis=1), axis=1) for x in (sums, sizes))
    most = -np.inf
    for size in WINDOWS:
        m = words - size + 1
        if m > 0:
            total, norm = (
                sum(x[k, size - k : size - k + m] - x[k, :m] for k in range(size)) for x in (before_sums, before_sizes)
            )
            most = max(most, float((total / np.sqrt(np.maximum(norm, 1.0))).max()))
    return most + bias


class Model:
    """A table of weights of runs, a bias, and the scale and shift of chances; of windows,
    if any are toxic, another table and bias."""

    def __init__(self, table: np.ndarray, bias: float, scale: float, shift: float, windows: tuple | None = None):
        self.table, self.bias, self.scale, self.shift, self.windows = table, bias, scale, shift, windows
        self.known: dict[str, tuple[float, int, bytes]] = {}

    def worsts(self, texts: list[str]) -> list[float]:
        """The highest value of any word of each text; the bias alone without words.

        Tokens are valued once and remembered, a bounded number of them.
        """
        found, group, size = [], [], 0
        for text in texts:
            most = len(found)
            found.append(self.bias)
            for begin in range(0, len(text), SLICE):
                # words and spelled-apart runs that a slice's end cuts are seen whole once
                part = text[max(0, begin - 64) : begin + SLICE]
                group.append((most, part, part.lower().split()))
                size += len(part)
                if size > SLICE:
                    self._read(group, found)
                    group, size = [], 0
        self._read(group, found)
        return found

    def _read(self, group: list[tuple], found: list[float]) -> None:
        """Raise the values of the texts (by number) to those of these parts of them."""
        known = self.known
        new = list(set().union(*(tokens for *_, tokens in group)) - known.keys())
        self._remember(new)
        for text, part, tokens in group:
            most = max((known[t][0] for t in set(tokens)), default=-np.inf)
            whole = bytes(known[t][1] for t in tokens).replace(b"\0", b"")
            pieces = b"".join(known[t][2] for t in tokens)
            for code, sizes in ((encode, whole), (parted, pieces)):
                if not sizes or not self.windows and b"\1\1\1" not in sizes:
                    continue
                line = code(part)
                apart = joined_letters(line, *spans(line))
                if len(apart):
                    most = max(most, float(decisions(apart, self.table, self.bias).max()))
                if self.windows:
                    most = max(most, windows_worst(line, *self.windows))
            found[text] = max(found[text], most)
        if len(known) > REMEMBERED:
            known.clear()
        for token in new:
            if len(token) > 40:
                known.pop(token, None)

    def _remember(self, tokens: list[str]) -> None:
        """Of each token: its highest value, and the sizes (0, 1, 2 for more) of its word and
        of the pieces between its signs if there are several."""
        words = [t if t.isalpha() else _SIGNS.sub("", t) for t in tokens]
        pieces = [p if w != t and len(p := _SIGNS.sub(" ", t).split()) > 1 else () for w, t in zip(words, tokens)]
        every = list({w for w in words if w}.union(*pieces))
        value = dict(zip(every, self._values(every)))
        value[""] = -np.inf
        for token, word, parts in zip(tokens, words, pieces):
            most, sizes = value[word], b""
            if parts:
                most, sizes = max(most, *map(value.get, parts)), bytes(min(len(w), 2) for w in parts)
            self.known[token] = most, min(len(word), 2), sizes

    def _values(self, words: list[str]) -> list[float]:
        """The value of each word, as it is or of its pieces."""
        if not words:
            return []
        code = edged(_raw("\n".join(words)))
        values = decisions(code, self.table, self.bias)
        begins, ends = spans(code)
        long = ends - begins - 2 > LONG
        values[long] = np.maximum(values[long], piece_values(long_words(code), self.table, self.bias))
        return values.tolist()

    def worst(self, text: str) -> float:
        return self.worsts([text])[0]

    def scores(self, texts: list[str | None]) -> list[float]:
        values = self.scale * np.array(self.worsts([t or "" for t in texts])) + self.shift
        return (1 / (1 + np.exp(-np.clip(values, -30, 30)))).tolist()

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]


def _sparse(words: list[str], known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised runs of words, by rising word: (word, column, value); ``known`` has the
    column of each run, -1 for none."""
    code = coded(words)
    begins, ends = spans(code)
    found = []
    for at, what, weight in runs(code, begins, ends):
        have = known[what] >= 0
        word = np.searchsorted(begins, at[have], side="right") - 1
        found.append((word, known[what[have]], np.full(len(word), weight, np.float32)))
    word, column, value = map(np.concatenate, zip(*found))
    order = np.argsort(word, kind="stable")
    size = np.add.reduceat(_ends_norm(code, ends - begins, ends), begins)
    return word[order], column[order], (value / np.sqrt(np.maximum(size, 1.0))[word])[order]


def _kernel(words: list[str], known: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel values of words (rows) and landmarks; ``marks`` has a row for each column."""
    out = np.zeros((len(words), marks.shape[1]), np.float32)
    for begin in range(0, len(words), 32):  # a row of ``marks`` for each run of so many words
        word, column, value = _sparse(words[begin : begin + 32], known)
        if len(word):
            rows, first = np.unique(word, return_index=True)
            some = marks[column]
            some *= value[:, None]
            out[begin + rows] = np.add.reduceat(some, first)
    return out


def _ends_norm(code: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Squared weights of the runs that begin at each character."""
    norm, places = np.zeros(len(code), np.float32), np.flatnonzero(code > 0)
    norm[places] = _NORMS[np.minimum(np.repeat(ends, lengths) - places - 1, _WIDEST)]
    return norm


def _columns(words: list[str]) -> np.ndarray:
    """A column for each run that the words have."""
    code = coded(words)
    found = np.unique(np.concatenate([what for _, what, _ in runs(code, *spans(code))]))
    known = np.full(1 << RUN_BITS, -1, np.int32)
    known[found] = np.arange(len(found))
    return known


def _marks(landmarks: list[str], known: np.ndarray) -> np.ndarray:
    """The landmarks' runs: a row for each column of a run, a column for each landmark."""
    marks = np.zeros((known.max() + 1, len(landmarks)), np.float32)
    word, column, value = _sparse(landmarks, known)
    np.add.at(marks, (column, word), value)
    return marks


class _Machine:
    """Nyström features at the landmarks, and the machine trained on them."""

    def __init__(self, good: list[str], bad: list[str], weights: list[float], landmarks: list[str]):
        known = _columns(landmarks)
        marks = _marks(landmarks, known)
        values, vectors = np.linalg.eigh((marks.T @ marks).astype(np.float64))
        keep = values > 1e-4 * values.max(initial=1e-9)
        whiten = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)
        words = bad + good
        kernel = _kernel(words, known, marks)
        del marks  # the largest table, filled again for the machine's weights
        kernel = kernel @ whiten
        labels = np.arange(len(words)) < len(bad)
        each = np.array([*weights, *[1.0] * len(good)])
        machine, self.bias = train_svm(kernel, labels, PENALTY, each)
        del kernel
        self.table = np.zeros(1 << RUN_BITS, np.float32)
        self.table[known >= 0] = _marks(landmarks, known) @ (whiten @ machine)

    def values(self, words: list[str]) -> np.ndarray:
        return decisions(coded(words), self.table, self.bias)


def learn(texts: list[str], labels: list[int], rounds: int = 4, seed: int = 11) -> Model:
    """Train on labelled texts; without both labels every score is the label there is, or 0.

    Where no word, beginning or window is in toxic texts more often than chance allows, every
    score is the share of toxic texts, at most a half."""
    order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
    seen: dict[str, int] = {}
    for i in order:  # equal texts count once; the higher label stands
        seen[texts[i]] = max(seen.get(texts[i], 0), labels[i])
    same: dict[str, str] = {}
    words = [sorted({same.setdefault(w, w) for w in _words(t) if 3 <= len(w) <= 64}) for t in seen]
    toxic = np.array(list(seen.values())) == 1
    if toxic.all() or not toxic.any():
        always = 10.0 if len(toxic) and toxic.all() else -10.0
        return Model(np.zeros(1 << RUN_BITS, np.float32), 0.0, 0.0, always)
    random = np.random.Generator(np.random.PCG64(seed))
    # a quarter of the texts is left for the chances
    held = random.permutation(len(words)) % 4 == 0
    bad_texts = [w for w, t, h in zip(words, toxic, held) if t and not h]
    good_texts = [w for w, t, h in zip(words, toxic, held) if not t and not h]
    in_bad = Counter(w for t in bad_texts for w in t)
    chosen = _telling(bad_texts, good_texts)
    telling = {w for w in in_bad if not chosen.isdisjoint(_units([w]))}
    good_words = sorted({w for t in good_texts for w in t})
    random.shuffle(good_words)
    pieces = sorted({w[i : i + n] for w in good_words if len(w) > LONG for n in PIECES for i in range(len(w) - n + 1)})
    pieces = [pieces[i] for i in random.permutation(len(pieces))[:POOL]]
    lines = [_SIGNS.sub("", t.lower()).split() for t, w, bad, h in zip(seen, words, toxic, held) if bad and not h and telling.isdisjoint(w)]
    clean = (_SIGNS.sub("", t.lower()).split() for t, bad, h in zip(seen, toxic, held) if not bad and not h)
    phrases, others = _windows(lines, clean, random)
    windows = None
    if phrases:
        machine = _trained(phrases, others, [], rounds)
        windows = machine.table, machine.bias
    if not telling and not phrases:
        # nothing sets the few toxic texts apart from chance: how common they are, which judges none
        share = min(float(toxic.mean()), 0.5)
        return Model(np.zeros(1 << RUN_BITS, np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    if telling:
        bad = sorted(telling, key=lambda w: (-in_bad[w], w))[:3000]
        machine = _trained({w: in_bad[w] for w in bad}, good_words, pieces, rounds)
        table, bias = machine.table, machine.bias
    else:  # no word is toxic by itself
        table, bias = np.zeros(1 << RUN_BITS, np.float32), -1.0
    rough = Model(table, bias, 1.0, 0.0, windows)
    worst = np.array([rough.worst(t) for t, h in zip(seen, held) if h])
    scale, shift = fit_logistic(worst, toxic[held]) if len(worst) else (1.0, 0.0)
    return Model(table, bias, scale, shift, windows)


def _trained(bad: dict[str, int], good: list[str], more: list[str], rounds: int) -> _Machine:
    """The machine of toxic units, commonest first, against clean ones; ``more`` are clean
    units too, learned from only if they are taken for toxic."""
    against, hard, machine = good[:4000], [], None
    pool = good + more
    for _ in range(rounds):
        marks = {*list(bad)[: LANDMARKS // 4], *_spread(sorted(bad), LANDMARKS // 6), *hard[: LANDMARKS // 3]}
        marks.update(against[: LANDMARKS - len(marks)])
        machine = _Machine(against, list(bad), list(bad.values()), sorted(marks))
        # clean units that the machine takes for toxic stand against it next
        values = machine.values(pool)
        hard = [pool[i] for i in np.argsort(-values)[:1500]]
        against = list(dict.fromkeys(against + hard))
    return machine


def _words(text: str) -> set[str]:
    """A text's words, with signs as nothing and as ends."""
    text = text.lower()
    return {*_SIGNS.sub("", text).split(), *_SIGNS.sub(" ", text).split()}


def _windows(bad: list[list[str]], good: Iterator[list[str]], random: np.random.Generator) -> tuple[dict[str, int], list[str]]:
    """The windows of words that explain toxic texts, commonest first, with their counts, and
    clean windows: those with words of these, and others.

    ``bad`` are texts that no single word explains.  Windows are counted by 64-bit keys, so
    that only few become strings.
    """
    if not bad:
        return {}, []
    ids: dict[str, int] = {}

    def numbered(words: list[str]) -> np.ndarray:
        return np.array([ids.setdefault(w, len(ids) + 1) for w in words], np.uint64)

    def keys(text: np.ndarray, n: int) -> np.ndarray:
        key = np.zeros(max(0, len(text) - n + 1), np.uint64)
        for i in range(n):
            key = key * np.uint64(0x9E3779B97F4A7C15) + text[i : len(key) + i] + np.uint64(n)
        return key

    def all_keys(text: np.ndarray) -> np.ndarray:
        return np.unique(np.concatenate([keys(text, n) for n in WINDOWS]))

    bad, good = [numbered(t) for t in bad], [numbered(t) for t in good]
    found, times = np.unique(np.concatenate([all_keys(t) for t in bad]), return_counts=True)
    found = found[times > 1]

    def units(text: np.ndarray) -> set[int]:
        own = all_keys(text)
        if not len(found):
            return set()
        at = np.minimum(np.searchsorted(found, own), len(found) - 1)
        return set(own[found[at] == own].tolist())

    chosen = _telling(bad, good, units)
    if not chosen:
        return {}, []
    names = ["", *ids]
    listed = np.array(sorted(chosen), np.uint64)
    counts: Counter[str] = Counter()
    for text in bad:
        here = {tuple(text[i : i + n].tolist()) for n in WINDOWS for i in np.flatnonzero(np.isin(keys(text, n), listed))}
        counts.update(" ".join(names[i] for i in window) for window in here)
    known = np.array(sorted({ids[w] for phrase in counts for w in phrase.split()}), np.uint64)
    clean: set[str] = set()
    each = max(4, POOL // max(1, len(good)))
    for text in good:
        alike = np.flatnonzero(np.isin(text, known))
        for at in (random.permutation(alike)[:each], random.integers(0, max(1, len(text)), each)):
            for i, n in itertools.product(at.tolist(), WINDOWS):
                for begin in range(max(0, i - n + 1), min(i, len(text) - n) + 1):
                    clean.add(" ".join(names[j] for j in text[begin : begin + n].tolist()))
    others = sorted(clean - set(counts))
    random.shuffle(others)
    return dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:1500]), others[: 2 * POOL]


def _units(words: list[str]) -> set[str]:
    """Words, and the beginnings that inflected or compound words have in common."""
    return {*words, *(w[:n] + "*" for w in words for n in (4, 5) if len(w) > n)}


def _telling(bad_texts: list, good_texts: list, units: Callable = _units, rounds: int = 10) -> set:
    """The units that explain toxic texts.

    Candidates are units (words and beginnings, or windows) that toxic texts have 20 times as often as clean
    ones.  Each toxic text has one vote, which it shares among its candidates in
    proportion to their votes of the round before: what copies of one text have in common
    shares few votes, an insult of many texts gets one of each.
    """
    in_bad = Counter(u for t in bad_texts for u in units(t))
    # so often that chance alone would hardly put one candidate into toxic texts only
    share = len(bad_texts) / (len(bad_texts) + len(good_texts))
    in_bad = Counter({u: n for u, n in in_bad.items() if n > 1})
    tried = len(in_bad)
    often = max(3.0, np.log(20 * tried + 1) / -np.log(share) if share < 1 else 3.0)
    some = {u for u, n in in_bad.items() if n >= often}
    in_good = Counter(u for t in good_texts for u in units(t) if u in some)
    rate = (len(bad_texts) + 1) / (len(good_texts) + 1)
    some = {u for u in some if in_bad[u] + 0.5 >= 20 * rate * (in_good[u] + 0.5)}
    of_text = [[u for u in units(t) if u in some] for t in bad_texts]
    votes = Counter(u for t in of_text for u in t)
    for _ in range(rounds):
        new: Counter[str] = Counter()
        for text in of_text:
            total = sum(votes[u] for u in text)
            for u in text:
                new[u] += votes[u] / total if total else 0.0
        votes = new
    return {u for u, n in votes.items() if n >= often / 4}


def _spread(words: list[str], n: int) -> list[str]:
    return [words[i] for i in np.unique(np.linspace(0, len(words) - 1, min(n, len(words))).astype(int))]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    per_toxic: int = PER_TOXIC,
    per_clean: int = PER_CLEAN,
) -> Model:
    """Learn from at most ``per_toxic`` and ``per_clean`` labelled texts, among the rows of
    ``labels`` (doc_id, toxic) for which ``training`` holds.  Texts longer than
    LONGEST_SAMPLE are not learned from.  A doc_id labelled both ways counts as toxic."""
    known = (
        labels.filter(training & F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    few = bounded_sample(known, "toxic", {0: 2 * per_clean, 1: 2 * per_toxic})  # so many ids
    texts = docs.select("doc_id", "text").filter(F.length("text").between(1, LONGEST_SAMPLE))
    rows = texts.join(F.broadcast(few), F.col("doc_id") == F.col("labelled")).select("toxic", "text")
    found = bounded_sample(rows, "toxic", {0: per_clean, 1: per_toxic})

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, toxic = [], []
        for batch in batches:
            texts += batch["text"].tolist()
            toxic += batch["toxic"].tolist()
        model = zlib.compress(pickle.dumps(learn(texts, toxic)), 1)
        del texts, toxic
        give_back()
        yield pd.DataFrame({"model": [model]})

    # the bounded sample is one task's, so that no text and no kernel is in the driver
    trained = found.repartition(1).mapInPandas(train, "model binary").collect()
    return pickle.loads(zlib.decompress(trained[0][0])) if trained else learn([], [])


def scored(spark: SparkSession, text: Column, model: Model) -> Column:
    """The chance that a text is toxic."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # 2 ** RUN_BITS numbers

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from judged(batches, shared.value)

    return judge(text)


def judged(batches: Iterator[pd.Series], model: Model) -> Iterator[pd.Series]:
    """The scores of a task's texts; a worker that waits for its next task keeps no tokens."""
    for texts in batches:
        yield pd.Series(model.scores(texts.tolist()), dtype="float64")
    model.known.clear()
    give_back()


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Labels of ids whose crc32 is 1 modulo 3 are not learned from.  A null text counts as
    empty; texts without a word have one and the same low score, unless all labels are 1.
    """
    crc = remainder("doc_id", 3)
    model = fit(docs, labels, crc != 1)
    return docs.select(
        "doc_id",
        F.coalesce(crc == 1, F.lit(False)).alias("held_out"),
        scored(docs.sparkSession, F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_civil(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score less than ``threshold``, with all their columns as they were."""
    model = fit(docs, labels, remainder("doc_id", 3) != 1)
    name = free_name(docs, "score")
    judged = docs.withColumn(name, scored(docs.sparkSession, F.col("text"), model))
    return judged.filter(F.col(name) < threshold).drop(name)
