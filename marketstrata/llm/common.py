"""Shared helpers: reading the corpus tables, sizing partitions, splitting words."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words wherever a contract names `[^\\x20\\x09-\\x0D]+`.
WORD_GAP = " \t\n\x0b\x0c\r"

_GAPS = np.zeros(256, dtype=bool)
_GAPS[[9, 10, 11, 12, 13, 32]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_for(rows: int, per_part: int, spark: SparkSession) -> int:
    """Partitions so that each holds about ``per_part`` rows, and at least the session's number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_part))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words in UTF-8 bytes; only ASCII white space separates."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~_GAPS[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.concatenate(([0], edge))
    if word[-1]:
        edge = np.concatenate((edge, [len(data)]))
    return edge[0::2], edge[1::2]


def text_batches(texts: list[str | None], max_bytes: int = 4_000_000):
    """Cut a list of texts into index ranges of at most ``max_bytes`` (one text at least)."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if held and held + size > max_bytes:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of each node's component, for the links ``a[i] - b[i]`` among ``n`` nodes."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        # Roots hook as well, so that whole trees move and few rounds are needed.
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Values hashed at a time, and powers kept: fixed, so that a worker's memory does not follow its longest text.
HASH_BLOCK = 1 << 18
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n, modulo 2**64. A table of fixed size is kept; a longer one is made for the call."""
    held = _powers.get(str(base))
    if held is None or len(held) <= n:
        size = max(n + 1, HASH_BLOCK + (1 << 12))
        made = np.full(size, base, np.uint64)
        made[0] = 1
        made = np.multiply.accumulate(made)
        if held is not None:
            return made
        held = _powers[str(base)] = made[: HASH_BLOCK + (1 << 12)].copy()
        if len(held) <= n:
            return made
    return held


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of ``values``, from differences of running sums; equal spans have equal hashes.

    Spans are taken in blocks by their starts, each with a running sum of its own. ``starts`` must not fall.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = int(np.searchsorted(starts, base + HASH_BLOCK))
        stop = max(int(ends[first:last].max()), base)
        sums = np.zeros(stop - base + 1, np.uint64)
        block = values[base:stop].astype(np.uint64)
        block += np.uint64(1)
        block *= _power(_BASE, stop - base)[: stop - base]
        np.cumsum(block, out=sums[1:])
        a, b = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (sums[b] - sums[a]) * _power(_UNBASE, stop - base)[a]
        first = last
    return mix(out)
