"""Periodic runs of words, found in a grammar of each text.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and ``TIMES``
times q long, that no neighbouring word extends.  Re-Pair makes a grammar: the pairs of
symbols that a text repeats become new symbols, the commonest first, until no pair is there
twice.  A run that lies within a symbol crosses the boundary between its two halves or lies
within a half; so runs are looked for once at the boundary of each symbol, in its first
occurrence, and at the boundaries between the symbols of the last line.  They are carried to
all places where the symbol is derived, and those that overlap by a period are one: what was
cut off at a symbol's end merges with the whole run.

Many texts are done at once; each has symbols of its own, so no pair joins two texts.  At a
boundary the periods from 2**k on are those at which the stretch of 2**k words beside it comes
again within 2**k words.  Stretches have exact names by doubling; only those that their text
repeats are named, and names also tell how far two places agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamsync.llm.common import free_name, small_batches

#: Least words of a run, and least times its period.
LEAST, TIMES = 6, 4
#: Words of the texts done at once; a longer text is done alone.
WORDS = 1 << 18
#: Periods tried at once.
TRIED = 1 << 20


def _dense(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pairs, and where in it a new pair begins."""
    order = np.argsort(first.astype(np.int64) * (int(second.max(initial=0)) + 1) + second, kind="stable")
    a, b = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, new


class Grammar:
    """Symbols of some texts: those below ``words`` are the words of a text, each other one
    has two halves, a length and a first place."""

    def __init__(self, words: np.ndarray, texts: np.ndarray):
        """``words`` are numbers of words, no two texts having one in common."""
        self.words = int(words.max(initial=-1)) + 1
        self.left, self.right = np.empty(0, np.int64), np.empty(0, np.int64)
        self.length, self.place = np.empty(0, np.int64), np.empty(0, np.int64)
        symbols, at = words.astype(np.int64), np.arange(len(words))
        sizes = np.ones(len(words), np.int64)
        while True:
            chosen, named = self._commonest(symbols, texts)
            if not len(chosen):
                break
            firsts, rule = np.unique(named, return_index=True)[1], np.unique(named, return_inverse=True)[1]
            heads = chosen[firsts]
            count = self.words + len(self.left)
            self.left = np.concatenate([self.left, symbols[heads]])
            self.right = np.concatenate([self.right, symbols[heads + 1]])
            self.length = np.concatenate([self.length, sizes[heads] + sizes[heads + 1]])
            self.place = np.concatenate([self.place, at[heads]])
            sizes[chosen] += sizes[chosen + 1]
            symbols[chosen] = count + rule
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            symbols, at, sizes, texts = symbols[keep], at[keep], sizes[keep], texts[keep]
        self.line, self.at = symbols, at

    @staticmethod
    def _commonest(symbols: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs to replace, and a name for the pair at each.  A pair is replaced
        where no pair that overlaps it is commoner, if it is so at two places at least."""
        often = np.bincount(symbols) > 1
        pair = often[symbols[:-1]] & often[symbols[1:]]
        equal = symbols[:-1] == symbols[1:]
        if equal.any():  # in a row of equal symbols, every other pair
            begin = np.flatnonzero(equal & ~np.append(False, equal[:-1]))
            where = np.flatnonzero(equal)
            offset = where - begin[np.searchsorted(begin, where, side="right") - 1]
            pair[where[offset % 2 == 1]] = False
        here = np.flatnonzero(pair)
        if len(here) < 2:
            return here[:0], here[:0]
        order, new = _dense(symbols[here], symbols[here + 1])
        name = np.cumsum(new) - 1
        times = np.bincount(name)
        # commoner pairs first; of equally common ones, by a mixed number
        mixed = (np.arange(len(times), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        weight = (np.minimum(times, 1 << 30).astype(np.int64) << 31) | mixed.astype(np.int64)
        strength = np.zeros(len(symbols) + 1, np.int64)
        names = np.empty(len(here), np.int64)
        names[order] = name
        strength[here + 1] = np.where(times[names] > 1, weight[names], 0)
        mine = strength[here + 1]
        best = (mine > 0) & (mine >= strength[here]) & (mine > np.append(strength, 0)[here + 2])
        here, names = here[best], names[best]
        several = np.bincount(names, minlength=len(times))[names] > 1
        return here[several], names[several]

    def half(self, symbols: np.ndarray) -> np.ndarray:
        """Length of the first half of symbols with halves."""
        left = self.left[symbols - self.words]
        return np.where(left < self.words, 1, self.length[np.maximum(left - self.words, 0)])

    def derived(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places where the ``wanted`` symbols are derived: (symbol, place)."""
        flag = np.zeros(self.words + len(self.left), bool)
        flag[wanted] = True
        known = flag.copy()
        for begin, end in self._layers():  # symbols that hold a wanted one
            known[begin:end] |= known[self.left[begin - self.words : end - self.words]]
            known[begin:end] |= known[self.right[begin - self.words : end - self.words]]
        some = known[self.line] & (self.line >= self.words)
        symbols, places = self.line[some], self.at[some]
        found_s, found_p = [], []
        while len(symbols):
            hit = flag[symbols]
            found_s.append(symbols[hit])
            found_p.append(places[hit])
            next_s = np.concatenate([self.left[symbols - self.words], self.right[symbols - self.words]])
            next_p = np.concatenate([places, places + self.half(symbols)])
            some = (next_s >= self.words) & known[next_s]
            symbols, places = next_s[some], next_p[some]
        if not found_s:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_s), np.concatenate(found_p)

    def _layers(self) -> Iterator[tuple[int, int]]:
        """Spans of symbols whose halves all come before the span."""
        begin, total = self.words, self.words + len(self.left)
        high = np.maximum(self.left, self.right)
        while begin < total:
            later = np.flatnonzero(high[begin - self.words :] >= begin)
            end = begin + int(later[0]) if len(later) else total
            yield begin, end
            begin = end


class Names:
    """Names of the stretches of 2**k words that their text repeats."""

    def __init__(self, words: np.ndarray, texts: np.ndarray):
        self.n, self.levels, self.sorted = len(words), [words.astype(np.int64)], [None]
        here = np.arange(len(words))[np.bincount(words)[words] > 1] if len(words) else np.empty(0, np.int64)
        step = 1
        while len(here):
            below = self.levels[-1]
            here = here[here + step < self.n]
            here = here[(below[here] >= 0) & (below[here + step] >= 0) & (texts[here] == texts[here + step])]
            names = np.full(self.n, -1, np.int64)
            order, new = _dense(below[here], below[here + step])
            group = np.cumsum(new) - 1
            several = (np.bincount(group, minlength=1) > 1)[group] if len(here) else np.empty(0, bool)
            here, group = here[order][several], group[several]
            if not len(here):
                break
            group = np.cumsum(np.append(True, group[1:] != group[:-1])) - 1
            names[here] = group
            self.levels.append(names)
            self.sorted.append(group * self.n + here)  # by name, then place
            here = np.sort(here)
            step *= 2

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For how many words two places (a before b) agree, themselves included."""
        a, b, far = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names = self.levels[k]
            inside = np.minimum(b, self.n - 1)
            same = (b < self.n) & (names[a] == names[inside]) & (names[inside] >= 0)
            step = same.astype(np.int64) << k
            a, b, far = a + step, b + step, far + step
        return far

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For how many words two places (a before b) agree to the left, themselves included."""
        a, b, far = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names, back = self.levels[k], (1 << k) - 1
            inside = np.maximum(a - back, 0)
            same = (a - back >= 0) & (names[inside] == names[np.maximum(b - back, 0)]) & (names[inside] >= 0)
            step = same.astype(np.int64) << k
            a, b, far = a - step, b - step, far + step
        return far

    def again(self, k: int, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and number of the entries of ``sorted[k]`` that lie from ``low`` to before
        ``high`` and have the name of the stretch at ``at``."""
        name = self.levels[k][at]
        found = self.sorted[k]
        first = np.searchsorted(found, name * self.n + np.clip(low, 0, self.n))
        stop = np.searchsorted(found, name * self.n + np.clip(high, 0, self.n))
        return first, np.where(name < 0, 0, np.maximum(stop - first, 0))


def _crossing(names: Names, middle: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Runs over boundaries, each before word ``middle`` within [low, high): (boundary,
    start, end, period).  Half of a run at least lies on one side of its boundary, so on
    that side its first period comes again."""
    found = []
    for k in range(1, len(names.levels)):
        size = 1 << k
        # the periods of this level; the shortest ones belong to pairs
        least, most = (1 if k == 1 else size), 2 * size
        for right in (True, False):
            some = np.flatnonzero((middle + size + least <= high) if right else (middle - size - least >= low))
            at = middle[some] if right else middle[some] - size
            if right:
                first, count = names.again(k, at, at + least, np.minimum(at + most, high[some]))
            else:
                first, count = names.again(k, at, np.maximum(at - most + 1, low[some]), at - least + 1)
            hit = count > 0
            some, at, first, count = some[hit], at[hit], first[hit], count[hit]
            edges, begin = np.cumsum(count), 0
            while begin < len(some):
                done = edges[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(edges, done + TRIED, side="right")))
                n = count[begin:stop]
                entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[begin:stop], n)
                other = names.sorted[k][entry] % names.n
                of, here = np.repeat(some[begin:stop], n), np.repeat(at[begin:stop], n)
                m, period = middle[of], np.abs(other - here)
                one, two = (m, m + period) if right else (m - period, m)
                end = np.minimum(two + names.forward(one, two), high[of])
                start = np.maximum(one - names.backward(np.maximum(one - 1, 0), two - 1) * (one > 0), low[of])
                length = end - start
                is_run = (length >= np.maximum(LEAST, TIMES * period)) & (start < m) & (m < end)
                found.append(np.stack([of[is_run], start[is_run], end[is_run], period[is_run]]))
                begin = stop
    if not found:
        return np.empty((4, 0), np.int64)
    return np.concatenate(found, axis=1)


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray, text: np.ndarray):
    """Stretches of one text and period that overlap by a period become one; of equal
    stretches the one with the smallest period stays.  Sorted by start, then period."""
    order = np.lexsort((-end, start, period, text))
    start, end, period, text = start[order], end[order], period[order], text[order]
    keep = np.ones(len(start), bool)
    group = np.append(True, (period[1:] != period[:-1]) | (text[1:] != text[:-1]))[: len(start)]
    if len(start):
        # the greatest end so far within a text and period: ends are lifted by their group
        lift = np.cumsum(group) * (int(end.max()) + 1)
        reach = np.maximum.accumulate(end + lift) - lift
        keep[1:] = group[1:] | (start[1:] + period[1:] > reach[:-1])
        heads = np.flatnonzero(keep)
        end = np.maximum.reduceat(end, heads)
        start, period, text = start[heads], period[heads], text[heads]
    order = np.lexsort((period, end, start, text))
    start, end, period, text = start[order], end[order], period[order], text[order]
    once = np.ones(len(start), bool)
    once[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1]) | (text[1:] != text[:-1])
    start, end, period, text = start[once], end[once], period[once], text[once]
    order = np.lexsort((period, start, text))
    return start[order], end[order], period[order], text[order]


def runs_of(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of some texts, whose words (as numbers) lie from bounds[i] to bounds[i + 1]:
    (start, end, period, text), places counted over all texts."""
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if not len(words):
        return (np.empty(0, np.int64),) * 4
    # no word in common: a number for each word of each text
    order, new = _dense(texts, words)
    own = np.empty(len(words), np.int64)
    own[order] = np.cumsum(new) - 1
    grammar, names = Grammar(own, texts), Names(own, texts)
    # boundaries within symbols, in their first occurrence
    symbols = grammar.words + np.flatnonzero(grammar.length >= LEAST)
    place, length = grammar.place[symbols - grammar.words], grammar.length[symbols - grammar.words]
    of, start, end, period = _crossing(names, place + grammar.half(symbols), place, place + length)
    # carried to all places of the symbol
    where, to = grammar.derived(np.unique(symbols[of]))
    by_symbol = np.argsort(symbols[of], kind="stable")
    head = np.searchsorted(symbols[of][by_symbol], where)
    times = np.searchsorted(symbols[of][by_symbol], where, side="right") - head
    entry = by_symbol[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(head, times)]
    shift = np.repeat(to, times) - place[of][entry]
    start, end, period = start[entry] + shift, end[entry] + shift, period[entry]
    # boundaries of the last line, over the whole text
    middle = grammar.at[np.append(True, texts[grammar.at][1:] != texts[grammar.at][:-1]) == 0]
    low, high = bounds[texts[middle]], bounds[texts[middle] + 1]
    _, start_, end_, period_ = _crossing(names, middle, low, high)
    start, end, period = np.concatenate([start, start_]), np.concatenate([end, end_]), np.concatenate([period, period_])
    return _merged(start, end, period, texts[start])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_DDL = "array<struct<start: long, length: long, period: long>>"


def _some(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Texts by WORDS words: their words, the words' numbers, and where each text's begin."""
    lists = pc.ascii_split_whitespace(texts)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + WORDS, side="right")))
        part = lists.slice(begin, stop - begin)
        words, owner = part.flatten(), np.repeat(np.arange(stop - begin), sizes[begin:stop])
        real = pc.not_equal(words, "")  # white space at an end leaves an empty word
        words, owner = words.filter(real), owner[real.to_numpy(zero_copy_only=False)]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=stop - begin))])
        numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        yield words, numbers, bounds
        begin = stop


def periodic_runs(df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """The rows with two columns added (under free names): ``runs``, an array of (start, length,
    period) by start, then period; and ``collapsed``, the words that lie in no run after its
    first period, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A null, empty or wordless text has no runs and an
    empty collapsed text.  Rows are independent: repeated rows give the same.  A long text is
    done alone and whole; a task holds its words once or a few times.
    """
    small_batches(df.sparkSession)
    whole, runs, collapsed = (free_name(df, name) for name in ("whole_text", runs, collapsed))
    given = df.withColumn(whole, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, left = [], []
            for words, numbers, bounds in _some(batch.column(whole)):
                start, end, period, of = runs_of(numbers, bounds)
                fields = [pa.array(start - bounds[of]), pa.array(end - start), pa.array(period)]
                offsets = np.searchsorted(of, np.arange(len(bounds))).astype(np.int32)
                items = pa.StructArray.from_arrays(fields, fields=list(_RUN))
                found.append(pa.ListArray.from_arrays(pa.array(offsets), items))
                depth = np.zeros(len(numbers) + 1, np.int64)
                np.add.at(depth, start + period, 1)
                np.add.at(depth, end, -1)
                stays = np.cumsum(depth)[:-1] == 0
                ends = np.concatenate([[0], np.cumsum(stays)])[bounds].astype(np.int32)
                kept = pa.ListArray.from_arrays(pa.array(ends), words.filter(pa.array(stays)))
                left.append(pc.binary_join(kept, " "))
            arrays = [batch.column(c) for c in batch.schema.names if c != whole]
            names = [c for c in batch.schema.names if c != whole]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.concat_arrays(found) if found else pa.array([], pa.list_(_RUN)),
                 pa.concat_arrays(left) if left else pa.array([], pa.string())],
                [*names, runs, collapsed],
            )

    added = StructType.fromDDL(f"`{runs}` {_RUN_DDL}, `{collapsed}` string")
    return given.mapInArrow(find, StructType([*df.schema.fields, *added.fields]))


def digest(runs: Column) -> Column:
    """Sha256 of all runs' ``start,length,period`` lines."""
    lines = F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)


def strongest(runs: Column) -> Column:
    """The run with the greatest length in periods; of equal ones the first, then that of the
    smallest period; null without runs."""

    def better(best: Column, run: Column) -> Column:
        # runs come by start, then period
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)
