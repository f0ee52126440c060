"""Packing token sequences with lexical neighbours from a sharded BM25 inverted index."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.llm.common import text_batches
from marketstrata.session import stored

WINDOW = 2048
END_ID = 1
SHARD_TAILS = 768
_COUNT_ROWS = 1024
#: Signs on which two pre-tokenizers can be trusted to agree; any other text goes to the tokenizer itself.
_COMMON = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\u024f\u2010-\u2027\u2030-\u205e]")
#: Fixed value: the split pattern of byte-level pre-tokenizers.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if the file is a plain byte-level BPE whose merges rank by id."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not spec.get("normalizer")
        and not model.get("dropout")
        and not model.get("ignore_merges")
    )
    if not plain:
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    vocab = {t: i for t, i in model["vocab"].items() if all(c in byte for c in t)}
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    if any(x >= y for x, y in zip(merged, merged[1:], strict=False)) or merged[:1] == [-1]:
        return None
    special = {t["content"] for t in spec.get("added_tokens", ())}
    return {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}


class FastTokenizer:
    """The ids that the tokenizer of a file gives to whole texts.

    A byte-level BPE is run by a quicker library from the same file's vocabulary and merges; texts with a
    special token or uncommon signs, and all texts under other kinds of file, go to the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        ranks = _byte_ranks(spec)
        self.quick = None
        if ranks:
            import tiktoken

            self.quick = tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> list[int]:
        if self.quick is None or _COMMON.search(text) or any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.quick(text)


def tokenized(documents: DataFrame, tokenizer_path: str, text: str, id_column: str) -> DataFrame:
    """One row a document: ids counted, the checksums of its full windows, and the ids of its tail.

    The ids travel as 16-bit numbers when the vocabulary allows it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = FastTokenizer(tokenizer_path)
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in text_batches(texts):
                counts, sums, tails = [], [], []
                for value in texts[a:b]:
                    ids = np.array([*encode(value or ""), END_ID], dtype="<u4")
                    full = len(ids) // WINDOW
                    counts.append(len(ids))
                    sums.append([zlib.crc32(ids[k * WINDOW : (k + 1) * WINDOW]) for k in range(full)])
                    tail = ids[full * WINDOW :]
                    tails.append((tail.astype("<u2") if tail.size and tail.max() < 65536 else tail).tobytes() if tail.size else b"")
                wide = [len(t) // max(1, n % WINDOW) for t, n in zip(tails, counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [names.slice(a, b - a), pa.array(counts, pa.int64()), pa.array(sums, pa.list_(pa.int64())), pa.array(tails, pa.binary()), pa.array(wide, pa.int32())],
                    names=["id", "tokens", "sums", "ids", "wide"],
                )

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.col(id_column).alias("id"), F.col(text).cast("string"))
    return rows.mapInArrow(run, f"id {kind}, tokens long, sums array<long>, ids binary, wide int")


def _ids(tail: bytes, wide: int) -> np.ndarray:
    return np.frombuffer(tail, "<u2" if wide == 2 else "<u4").astype(np.int64)


def tail_frequencies(rows: DataFrame) -> tuple[np.ndarray, int, float]:
    """Document frequency of each id over all tails, their number and mean length.

    The vocabulary bounds the result; tasks send sums a block of ids, not rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n, length = np.zeros(0, np.int64), 0, 0
        for pdf in batches:
            for tail, wide in zip(pdf.ids, pdf.wide, strict=True):
                if len(tail):
                    ids = _ids(tail, wide)
                    top = int(ids.max()) + 1
                    if top > len(total):
                        total = np.concatenate((total, np.zeros(top - len(total), np.int64)))
                    total[np.unique(ids)] += 1
                    n, length = n + 1, length + len(ids)
        blocks = [total[k : k + _COUNT_ROWS] for k in range(0, len(total), _COUNT_ROWS)]
        yield pd.DataFrame({"block": [*range(len(blocks)), -1], "counts": [*blocks, np.array([n, length])]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(max(map(len, pdf.counts)), np.int64)
        for c in pdf.counts:
            out[: len(c)] += c
        return pd.DataFrame({"block": [pdf.block.iloc[0]], "counts": [out]})

    parts = rows.select("ids", "wide").mapInPandas(run, "block int, counts array<long>")
    sums = {r.block: np.array(r.counts) for r in parts.groupBy("block").applyInPandas(add, "block int, counts array<long>").collect()}
    n, length = sums.pop(-1, np.zeros(2, np.int64)).tolist()
    counts = np.zeros((max(sums, default=-1) + 1) * _COUNT_ROWS, np.int64)
    for block, values in sums.items():
        counts[block * _COUNT_ROWS : block * _COUNT_ROWS + len(values)] = values
    return counts, n, length / max(n, 1)


class ShardIndex:
    """An inverted index over the tails of one shard, with BM25 weights from corpus statistics."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float, k1: float = 1.2, b: float = 0.75):
        size = len(tails)
        terms, docs, weights = [], [], []
        self.terms = []
        for d, ids in enumerate(tails):
            t, tf = np.unique(ids, return_counts=True)
            self.terms.append(t)
            terms.append(t)
            docs.append(np.full(len(t), d))
            weights.append(idf[t] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(ids) / mean)))
        terms = np.concatenate([np.zeros(0, np.int64), *terms])
        order = np.argsort(terms, kind="stable")
        self.docs = np.concatenate([np.zeros(0, np.int64), *docs])[order]
        self.weights = np.concatenate([np.zeros(0), *weights])[order]
        self.start = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        self.size = size

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every tail for the distinct ids of the seed."""
        t = self.terms[seed]
        low, count = self.start[t], self.start[t + 1] - self.start[t]
        at = np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)
        return np.bincount(self.docs[at], self.weights[at], minlength=self.size)


def pack_shard(tails: list[np.ndarray], idf: np.ndarray, mean: float) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(tail, start, length)``: each seed is followed by its unused neighbours by falling score.

    The neighbour that no longer fits is cut; its rest is the next seed. Ties go by place. All but the last
    sequence are full.
    """
    index = ShardIndex(tails, idf, mean)
    sizes = [len(t) for t in tails]
    left = np.array([s > 0 for s in sizes])
    sequences: list[list[tuple[int, int, int]]] = []
    queue = iter(np.flatnonzero(left).tolist())
    rest: tuple[int, int] | None = None
    while True:
        if rest is None:
            seed = next((s for s in queue if left[s]), None)
            if seed is None:
                return sequences
            rest = (seed, 0)
            left[seed] = False
        seed, done = rest
        rest = None
        filled = sizes[seed] - done
        sequence = [(seed, done, filled)]
        sequences.append(sequence)
        if filled == WINDOW:
            continue
        score = index.scores(seed)
        unused = np.flatnonzero(left)
        for d in unused[np.argsort(-score[unused], kind="stable")].tolist():
            take = min(sizes[d], WINDOW - filled)
            sequence.append((d, 0, take))
            left[d] = False
            filled += take
            if take < sizes[d]:
                rest = (d, take)
            if filled == WINDOW:
                break


def pack_documents(
    documents: DataFrame, tokenizer_path: str, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """One row a piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document's ids end with ``END_ID``; NULL and empty texts have that id alone. Full windows of a document
    are sequences of their own; the tails are packed by shard, each shard holding an inverted index. Tails are
    dealt to shards by a hash of the row, so copies and hot sources spread evenly and a shard's size is bounded
    whatever the input. Every id lies in exactly one piece; only the last sequence of a shard may be padded.
    Rows with NULL or repeated ids are documents of their own; an empty table gives no piece.
    """
    rows = stored(tokenized(documents, tokenizer_path, text, id_column).withColumn("row", F.monotonically_increasing_id()), "tokens")
    counts, n, mean = tail_frequencies(rows)
    idf = np.append(np.log1p((n - counts + 0.5) / (counts + 0.5)), np.zeros(1))
    shards = max(1, -(-rows.count() // SHARD_TAILS))
    kind = documents.schema[id_column].dataType.simpleString()

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row").reset_index(drop=True)
        base = int(pdf["shard"].iloc[0]) << 31
        names, tokens = pdf["id"], pdf.tokens.to_numpy()
        out: list[tuple] = []
        sequence = 0
        for d, sums in enumerate(pdf.sums):
            for k, crc in enumerate(sums):
                out.append((d, k * WINDOW, WINDOW, int(crc), base + sequence, 0))
                sequence += 1
        tails = [_ids(t, w) for t, w in zip(pdf.ids, pdf.wide, strict=True)]
        for pieces in pack_shard(tails, idf, max(mean, 1.0)):
            offset = 0
            for d, start, length in pieces:
                whole = int(tokens[d]) // WINDOW * WINDOW
                crc = zlib.crc32(tails[d][start : start + length].astype("<u4"))
                out.append((d, whole + start, length, crc, base + sequence, offset))
                offset += length
            sequence += 1
        d, start, length, crc, seq, offset = (np.array(c, dtype=np.int64) for c in zip(*out, strict=True))
        return pd.DataFrame(
            {"id": names.iloc[d].array, "start": start, "length": length, "ids_crc32": crc, "doc_tokens": tokens[d], "sequence_id": seq, "offset": offset}
        )

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    packed = dealt.groupBy("shard").applyInPandas(
        pack, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    return packed.withColumnRenamed("id", id_column)
