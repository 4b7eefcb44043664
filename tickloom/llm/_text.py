"""Vectorised byte and word helpers for Arrow batches of texts.

Words are maximal runs of bytes other than space and 0x09-0x0D. In UTF-8 none of these bytes is part of a longer
character, so splitting bytes equals splitting characters.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

U64 = np.uint64
LONG = 32  # bytes from which a word is hashed as a whole
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_INVERSE = pow(_STEP, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (new array)."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def power(kind: str, n: int) -> np.ndarray:
    """Powers of the step, or of its inverse."""
    if len(_powers[kind]) < n:
        step = np.full(n, _STEP if kind == "up" else _INVERSE, U64)
        step[0] = 1
        _powers[kind] = np.cumprod(step, dtype=U64)
    return _powers[kind][:n]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values. Sorting is many times faster here than the hash table of np.unique."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def window_hash(v: np.ndarray, length: int) -> np.ndarray:
    """Hash of v[i:i+length] for each i, by doubling; empty if v is shorter."""
    n = len(v) - length + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, at, block, size, left = None, 0, v.astype(U64, copy=False), 1, length
    while left:
        if left & 1:
            out = block[at : at + n] if out is None else mix(out * U64(_BASE) + block[at : at + n])
            at += size
        left >>= 1
        if left:
            block = mix(block[:-size] * U64(_BASE) + block[size:])
            size *= 2
    return mix(out + U64(length))


def tune(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches small enough that whole texts of a batch stay within a few MB of a Python worker. Workers that share
    this machine also find the package, wherever the driver was started; a cluster gets it with the job."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, nulls as empty, and where each text starts (one more entry at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(at: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs [first, last) of texts with about `limit` bytes at most; one longer text is a run of its own."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = last


class Words:
    """The words of some texts: start, end (bytes), text index, hash; `first` has where each text's words begin. A short word's
    hash is a polynomial modulo 2^64 in an odd step. That is zero for differences of some patterns however the bytes are coded
    (from about 1 KB on), so words of LONG bytes and more are hashed by BLAKE2b. `space` has the bytes between words."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, lower: bool = False, space: np.ndarray = SPACE):
        if lower:
            raw = LOWER[raw]
        n, texts = len(raw), len(at) - 1
        inside = ~space[raw]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        before = np.empty(n, bool)
        if n:
            before[0] = False
            before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | edge[:n]))
        after = np.empty(n, bool)
        if n:
            after[-1] = False
            after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.text = np.searchsorted(at, self.start, "right") - 1
        total = np.zeros(n + 1, U64)
        np.cumsum(BYTE_CODE[raw] * power("up", max(n, 1))[:n], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * power("down", max(n, 1))[self.start] + U64(1)) if n else np.zeros(0, U64)
        view = memoryview(raw) if n else b""
        for k in np.flatnonzero(self.end - self.start >= LONG).tolist():
            self.hash[k] = int.from_bytes(hashlib.blake2b(view[self.start[k] : self.end[k]], digest_size=8).digest(), "little")
        self.first = np.searchsorted(self.text, np.arange(texts + 1))
        self.count = np.diff(self.first)

    def grams(self, n: int, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n consecutive words of one text, and the index of each one's first word."""
        h = window_hash(self.hash if base is None else base, n)
        own = np.flatnonzero(self.text[: len(h)] == self.text[n - 1 :]) if len(h) else np.zeros(0, np.int64)
        return h[own], own
