"""Structured Streaming wiring: micro-batch writers and jobs."""
