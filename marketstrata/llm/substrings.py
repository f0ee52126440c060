"""Removal of passages that an earlier document holds, through FM-indexes over sharded windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.llm.common import parts_for, span_hashes, text_batches, word_bounds
from marketstrata.llm.fm_index import WindowIndex
from marketstrata.session import stored

WINDOW = 50
ANCHOR = 12
#: Windows of a piece at most: as many as one stretch can anchor, unless a text repeats itself.
RUN = WINDOW - ANCHOR + 1
SHARD_PIECES = 6000
HOT_TEXTS = 1500


def _normal(text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, and where they start and end."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends = word_bounds(data)
    if len(starts) and not (starts[0] == 0 and ends[-1] == len(raw) and (starts[1:] - ends[:-1] == 1).all() and (data[ends[:-1]] == 32).all()):
        raw = b" ".join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        sizes = ends - starts
        starts = np.concatenate(([0], np.cumsum(sizes[:-1] + 1)))
        ends = starts + sizes
    return raw, starts, ends


def anchor_runs(texts: list[str]) -> tuple[list[tuple[bytes, np.ndarray, np.ndarray]], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows with one anchor, over a batch of texts.

    A window's anchor is the least hash among its stretches of ``ANCHOR`` words: equal windows have equal
    anchors wherever they stand. Returns the normal texts, and for each run its text, first window, number of
    windows and anchor; last, the hash of every word.
    """
    normal = [_normal(t) for t in texts]
    hashes = [span_hashes(np.frombuffer(raw, np.uint8), s, e) if len(s) >= WINDOW else np.zeros(0, np.uint64) for raw, s, e in normal]
    sizes = np.array([len(h) for h in hashes], dtype=np.int64)
    words = np.concatenate([np.zeros(0, np.uint64), *hashes])
    none = np.zeros(0, np.int64)
    if len(words) < WINDOW:
        return normal, none, none, none, np.zeros(0, np.uint64), words
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(words) - ANCHOR + 1)
    grams = span_hashes(words, at, at + ANCHOR)
    span = WINDOW - ANCHOR + 1
    padded = np.full(-(-len(grams) // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(grams)] = grams
    blocks = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(words) - WINDOW + 1
    least = np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    least = least[inside]
    first = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (np.diff(inside) != 1)))) if len(inside) else none
    count = np.diff(np.append(first, len(inside)))
    base = np.cumsum(sizes) - sizes
    text = owner[inside[first]]
    return normal, text, inside[first] - base[text], count, least[first], words


def _texts(documents: DataFrame, text: str, id_column: str) -> DataFrame:
    """``id, body, digest``; NULL text is empty."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return documents.select(F.col(id_column).alias("id"), body.alias("body")).withColumn("digest", F.unhex(F.md5(F.encode("body", "UTF-8"))))


def _distinct(rows: DataFrame) -> DataFrame:
    """Each text once, with its least id; copies collapse before anything is shuffled."""
    return rows.groupBy("digest").agg(F.min("id").alias("least"), F.first("body").alias("body"))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, texts = batch.column(0), batch.column(1).to_pylist()
        for a, b in text_batches(texts):
            _, owner, _, _, anchor, _ = anchor_runs(texts[a:b])
            if not len(owner):
                continue
            # Sorted, so that an anchor a text has twice goes out once.
            order = np.lexsort((owner, anchor))
            owner, anchor = owner[order], anchor[order]
            new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[new].view(np.int64)), digests.slice(a, b - a).take(pa.array(owner[new]))], names=["anchor", "digest"]
            )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each text whose anchors other texts have as well, as word stretches of their own."""
    for batch in batches:
        digests, least, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        shared, hot = batch.column(3).to_pylist(), batch.column(4).to_pylist()
        for a, b in text_batches(texts, 1_000_000):
            normal, owner, first, count, anchor, words = anchor_runs(texts[a:b])
            base = np.cumsum([0] + [len(s) if len(s) >= WINDOW else 0 for _, s, _ in normal])
            wanted = [np.array(x, np.int64).view(np.uint64) for x in shared[a:b]]
            split = [np.array(x, np.int64).view(np.uint64) for x in hot[a:b]]
            rows: tuple[list, list, list, list] = ([], [], [], [])
            for t in np.unique(owner).tolist():
                mine = np.arange(*np.searchsorted(owner, (t, t + 1)))
                mine = mine[np.isin(anchor[mine], wanted[t])]
                raw, starts, ends = normal[t]
                cut = np.isin(anchor[mine], split[t])
                for r, alone in zip(mine.tolist(), cut.tolist(), strict=True):
                    s, n = int(first[r]), int(count[r])
                    if alone:
                        at = np.arange(s, s + n)
                        keys = span_hashes(words[base[t] : base[t + 1]], at, at + WINDOW).view(np.int64).tolist()
                    for k in range(0, n, 1 if alone else RUN):
                        stop = s + k + WINDOW - 1 if alone else s + min(k + RUN, n) + WINDOW - 2
                        rows[0].append(t + a)
                        rows[1].append(s + k)
                        rows[2].append(keys[k] if alone else int(anchor[r].astype(np.int64)))
                        rows[3].append(raw[starts[s + k] : ends[stop]])
                if len(rows[0]) > 20_000:
                    yield _piece_batch(digests, least, rows)
                    rows = ([], [], [], [])
            if rows[0]:
                yield _piece_batch(digests, least, rows)


def _piece_batch(digests: pa.Array, least: pa.Array, rows: tuple[list, list, list, list]) -> pa.RecordBatch:
    take = pa.array(rows[0], pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[2], pa.int64()), digests.take(take), least.take(take), pa.array(rows[1], pa.int64()), pa.array(rows[3], pa.binary()).cast(pa.string())],
        names=["key", "digest", "least", "start", "piece"],
    )


def _search_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """Index the pieces of a shard, stream them through it, report the earliest holder of each window."""
    names: dict[str, int] = {}
    texts = [np.array([names.setdefault(w, len(names) + 1) for w in p.split(" ")]) for p in pdf.piece]
    index = WindowIndex(texts, pdf.least.to_numpy(), WINDOW)
    return pd.DataFrame({"mark": pdf.mark, "earliest": index.matching(texts)})


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts and digests of each text: whole, and without the words under the given windows."""
    for batch in batches:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for text, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            raw, s, e = _normal(text)
            n = len(s)
            whole = kept = hashlib.sha256(raw if n else b"").hexdigest()
            gone = 0
            if starts:
                edge = np.zeros(n + 1, np.int64)
                at = np.unique(np.array([x for part in starts for x in part]))
                np.add.at(edge, at, 1)
                np.add.at(edge, at + WINDOW, -1)
                keep = np.cumsum(edge[:n]) == 0
                gone = int(n - keep.sum())
                kept = hashlib.sha256(b" ".join([raw[s[i] : e[i]] for i in np.flatnonzero(keep).tolist()])).hexdigest()
            for column, value in zip(out, (n, gone, kept, whole), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in out[:2]), *(pa.array(c, pa.string()) for c in out[2:])],
            names=["digest", "least", "n_words", "n_gone", "kept", "whole"],
        )


def remove_repeated(documents: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row a document: ``id, n_words, n_removed, kept_sha256``.

    A window of ``WINDOW`` words that also starts in a document with a smaller id loses its words. All texts
    are judged as they came. Exact copies collapse to their least id: a later copy loses every word that any
    window covers. Of the other texts only windows whose anchor another text also has are looked at; they are
    cut into pieces of bounded length, however long a text repeats itself, dealt to shards by anchor, and each
    shard is one FM-index over its distinct pieces. An
    anchor that very many texts have is dealt window by window instead, so that no shard depends on it.

    A row with a NULL id keeps its words and takes none from others; NULL and empty texts have no word; texts
    shorter than a window are kept. Repeated rows get equal results; ids must be numbers. Rows of one id never take words
    from each other. Texts are read whole, other columns are not read, whatever their names. An empty table gives an
    empty one.
    """
    spark = documents.sparkSession
    rows = _texts(documents, text, id_column)
    owned = rows.filter("id IS NOT NULL").withColumn("id", F.col("id").cast("long"))
    found = stored(owned.select("digest", "body").mapInArrow(_anchors, "anchor long, digest binary").select("anchor", "digest"), "anchors")
    shared = (
        found.groupBy("anchor")
        .agg(F.min("digest").alias("a"), F.max("digest").alias("b"), F.count("*").alias("n"))
        .filter("a < b")
        .select("anchor", (F.col("n") > HOT_TEXTS).alias("hot"))
    )
    lists = (
        found.join(shared, "anchor")
        .groupBy("digest")
        .agg(F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot"))
    )
    pieces = stored(
        _distinct(owned)
        .join(lists, "digest")
        .select("digest", "least", "body", "anchors", "hot")
        .mapInArrow(_pieces, "key long, digest binary, least long, start long, piece string")
        .withColumn("mark", F.unhex(F.md5(F.encode("piece", "UTF-8")))),
        "pieces",
    )
    shards = parts_for(pieces.count(), SHARD_PIECES, spark)
    once = pieces.groupBy("key", "mark").agg(F.min("least").alias("least"), F.first("piece").alias("piece"))
    earliest = (
        once.withColumn("shard", F.pmod("key", F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(_search_shard, "mark binary, earliest array<long>")
    )
    # A piece's windows all have its anchor or are its own, so a piece stands in one shard: marks are unique.
    windows = (
        pieces.select("mark", "digest", "least", "start")
        .join(stored(earliest, "earliest"), "mark")
        .select(
            "digest",
            F.filter(
                F.transform("earliest", lambda x, i: F.when(x < F.col("least"), F.col("start") + i)), lambda x: x.isNotNull()
            ).alias("windows"),
        )
        .filter(F.size("windows") > 0)
        .groupBy("digest")
        .agg(F.collect_list("windows").alias("windows"))
    )
    judged = (
        _distinct(rows.withColumn("id", F.col("id").cast("long")))
        .join(windows, "digest", "left")
        .select("digest", "least", "body", "windows")
        .mapInArrow(_removed, "digest binary, least long, n_words long, n_gone long, kept string, whole string")
    )
    short, later = F.col("n_words") < WINDOW, F.col("id").cast("long") > F.col("least")
    return (
        rows.select("id", "digest")
        .join(judged, "digest")
        .select(
            F.col("id").alias(id_column),
            "n_words",
            F.when(F.col("id").isNull() | short, 0).when(later, F.col("n_words")).otherwise(F.col("n_gone")).cast("long").alias("n_removed"),
            F.when(F.col("id").isNull() | short, F.col("whole"))
            .when(later, F.lit(hashlib.sha256(b"").hexdigest()))
            .otherwise(F.col("kept"))
            .alias("kept_sha256"),
        )
    )
