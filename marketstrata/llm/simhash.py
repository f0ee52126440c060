"""SimHash near-duplicates found by a self-join over a binary trie of the fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.llm.common import local_components, text_batches, word_bounds
from marketstrata.llm.components import connected_components
from marketstrata.session import stored

_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
_ONE = np.uint64(1)


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of every shingle of ``width`` words; no word: 0."""
    data = _ASCII_LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends = word_bounds(data)
    if not len(starts):
        return 0
    if (starts[1:] - ends[:-1] == 1).all() and (data[ends[:-1]] == 32).all():
        joined = data.tobytes()
    else:
        raw = data.tobytes()
        joined = b" ".join(raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
        sizes = ends - starts
        starts = np.concatenate(([0], np.cumsum(sizes[:-1] + 1)))
        ends = starts + sizes
    width = min(width, len(starts))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: len(starts) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)]
    counts, n = np.zeros(64, np.int64), len(hashes)
    for at in range(0, n, 65536):
        part = np.array(hashes[at : at + 65536], dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(documents: DataFrame, text: str = "text", id_column: str = "doc_id", width: int = 3, seed: int = 42) -> DataFrame:
    """``(id, print)`` of every row, the fingerprint as a signed 64-bit number; whole texts, NULL is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            prints = np.array([fingerprint(t or "", width, seed) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["id", "print"])

    kind = documents.schema[id_column].dataType.simpleString()
    return documents.select(F.col(id_column).alias("id"), F.col(text).cast("string")).mapInArrow(run, f"id {kind}, print long")


class _Trie:
    """A binary trie over sorted distinct numbers: a node is a range of them, a level a bit from the top."""

    def __init__(self, values: np.ndarray):
        self.values = values

    def split(self, low: np.ndarray, bit: int) -> np.ndarray:
        """Where the children of the nodes starting at ``low`` part on ``bit``."""
        keep = ~np.uint64((1 << (bit + 1)) - 1)
        return np.searchsorted(self.values, (self.values[low] & keep) | np.uint64(1 << bit))


def trie_pairs(
    left: np.ndarray, right: np.ndarray | None, budget: int, top_bit: int = 63, leaf: int = 64, front: int = 500_000
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct numbers that differ in at most ``budget`` bits.

    Node pairs are traversed together from the top, one bit a step; children that part on the bit spend one of
    the budget, and a pair beyond it is pruned. Small node pairs are compared at their leaves. A wide front is
    halved and taken depth first, which bounds memory. ``right`` None joins ``left`` with itself, each pair once.
    """
    alone = right is None
    a, b = _Trie(left), _Trie(left if alone else right)
    stack = [(np.array([0]), np.array([len(left)]), np.array([0]), np.array([len(b.values)]), np.zeros(1, np.int8), top_bit)]
    while stack:
        la, ha, lb, hb, spent, bit = stack.pop()
        live = (ha > la) & (hb > lb) & (spent <= budget)
        la, ha, lb, hb, spent = (x[live] for x in (la, ha, lb, hb, spent))
        if not len(la):
            continue
        small = ((ha - la) * (hb - lb) <= leaf) if bit >= 0 else np.ones(len(la), bool)
        if small.any():
            wide, count = (hb - lb)[small], ((ha - la) * (hb - lb))[small]
            owner = np.repeat(np.arange(len(count)), count)
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            i = la[small][owner] + inner // wide[owner]
            j = lb[small][owner] + inner % wide[owner]
            near = np.bitwise_count(a.values[i] ^ b.values[j]) <= budget
            if alone:
                near &= i < j
            if near.any():
                yield i[near], j[near]
            la, ha, lb, hb, spent = (x[~small] for x in (la, ha, lb, hb, spent))
            if not len(la):
                continue
        if len(la) > front:
            half = len(la) // 2
            stack += [tuple(x[:half] for x in (la, ha, lb, hb, spent)) + (bit,), tuple(x[half:] for x in (la, ha, lb, hb, spent)) + (bit,)]
            continue
        ma = np.clip(a.split(la, bit), la, ha)
        mb = np.clip(b.split(lb, bit), lb, hb)
        # Of a node paired with itself only one of the two crossing pairs is kept.
        cross = ~((la == lb) & (ha == hb)) if alone else np.ones(len(la), bool)
        stack.append(
            (
                np.concatenate((la, ma, la, ma[cross])),
                np.concatenate((ma, ha, ma, ha[cross])),
                np.concatenate((lb, mb, mb, lb[cross])),
                np.concatenate((mb, hb, hb, mb[cross])),
                np.concatenate((spent, spent, spent + 1, (spent + 1)[cross])).astype(np.int8),
                bit - 1,
            )
        )


def linked_fingerprints(prints: DataFrame, budget: int = 3, prefix_bits: int = 5, chunk: int = 60_000) -> DataFrame:
    """``(src, dst)``: links that connect all fingerprints of one component; ``prints`` has distinct ``print``.

    The top ``prefix_bits`` of the trie are unrolled into tasks: a task gets one pair of subtrees whose prefixes
    are within the budget. Their number is fixed, so the bytes shuffled follow the input. A subtree with more
    fingerprints than ``chunk`` is dealt over several blocks, and blocks pair up likewise: no task is unbounded
    and no pair of close prefixes is left out. A task returns a spanning forest of the links it found.
    """
    spark = prints.sparkSession
    nodes = prints.select(F.shiftrightunsigned("print", 64 - prefix_bits).cast("int").alias("node"), "print")
    sizes = nodes.groupBy("node").agg(F.ceil(F.count("*") / chunk).cast("int").alias("blocks"))
    # The pairs of close prefixes are fixed by the parameter alone: about 2**prefix_bits times their neighbours.
    close = [(x, y) for x in range(1 << prefix_bits) for y in range(x, 1 << prefix_bits) if (x ^ y).bit_count() <= budget]
    tasks = (
        spark.createDataFrame(close, "nx int, ny int")
        .join(sizes.select(F.col("node").alias("nx"), F.col("blocks").alias("kx")), "nx")
        .join(sizes.select(F.col("node").alias("ny"), F.col("blocks").alias("ky")), "ny")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("kx") - 1)).alias("bx"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("ky") - 1)).alias("by"))
        .filter("nx < ny OR bx <= by")
        .select(F.xxhash64("nx", "bx", "ny", "by").alias("task"), "nx", "bx", "ny", "by")
    )
    sides = tasks.select("task", F.col("nx").alias("node"), F.col("bx").alias("block"), F.lit(0).alias("side")).unionByName(
        tasks.filter("nx <> ny OR bx <> by").select("task", F.col("ny").alias("node"), F.col("by").alias("block"), F.lit(1).alias("side"))
    )
    # Fingerprints travel packed, a few thousand to a row.
    packed = (
        nodes.join(F.broadcast(sizes), "node")
        .select("node", F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int").alias("block"), "print")
        .withColumn("pack", F.pmod(F.xxhash64("print", F.lit(1)), F.lit(16)).cast("int"))
        .groupBy("node", "block", "pack")
        .agg(F.collect_list("print").alias("prints"))
    )
    dealt = packed.join(sides, ["node", "block"]).select("task", "side", "prints")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def join_block(pdf: pd.DataFrame) -> pd.DataFrame:
        halves = [np.sort(np.concatenate([np.zeros(0, np.int64), *pdf.prints[pdf.side == s]]).view(np.uint64)) for s in (0, 1)]
        alone = not len(halves[1])
        every = halves[0] if alone else np.concatenate(halves)
        root = np.arange(len(every))
        for i, j in trie_pairs(halves[0], None if alone else halves[1], budget):
            j = j if alone else j + len(halves[0])
            # Links are folded into the forest as they come; their number never counts.
            top = local_components(len(every), np.concatenate((root[i], np.arange(len(every)))), np.concatenate((root[j], root)))
            root = top
        moved = np.flatnonzero(root != np.arange(len(every)))
        signed = every.view(np.int64)
        return pd.DataFrame({"src": signed[moved], "dst": signed[root[moved]]})

    return dealt.repartition(width, "task").groupBy("task").applyInPandas(join_block, "src long, dst long")


def simhash_groups(
    documents: DataFrame, text: str = "text", id_column: str = "doc_id", width: int = 3, seed: int = 42, budget: int = 3
) -> DataFrame:
    """One row a document: its id, ``fingerprint`` in 16 hex digits and ``component_id``.

    Fingerprints that differ in at most ``budget`` bits are linked; ``component_id`` is the least id reachable.
    Equal fingerprints collapse to one before any comparison, so exact copies cost nothing, whatever their
    number. NULL and empty texts have fingerprint zero and link like any other. A row with a NULL id is
    returned with its fingerprint; it takes the least id of its group and never names one. Repeated rows stay. Texts
    are read whole, other columns are not read, whatever their names. A bit set in exactly half the hashes is 0. An
    empty table gives an empty one.
    """
    rows = stored(fingerprints(documents, text, id_column, width, seed), "prints")
    distinct = stored(rows.groupBy("print").agg(F.min("id").alias("least")), "distinct-prints")
    groups = connected_components(linked_fingerprints(distinct.select("print"), budget))
    named = distinct.join(groups, distinct["print"] == groups["node"], "left").select(
        "print", "least", F.coalesce("component", "print").alias("component")
    )
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(named.join(first, "component").select("print", "component_id"), "print-groups")
    return rows.join(named, "print").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
