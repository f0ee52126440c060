"""Benchmark leaks found by latent semantic retrieval, then confirmed word by word."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.llm.common import span_hashes, text_batches

FEATURE_BITS = 14
RANK = 96
ITEM_WEIGHT = 4
OVERSAMPLE = 8
BLOCK = 8
PROBE_WORDS = 64
PROBE_COLUMNS = 128
RUN_WORDS = 8
SEARCH_BYTES = 250_000  # of texts searched at a time, so that their blocks' products stay in a core's reach
BOUNDS = 4096  # stretches whose subsequences are bounded at a time
LEAST_PASSAGES = 12_000  # as many count where items are weighed against fewer
PRODUCT_ROWS = 1024  # passages multiplied at a time
SUM_PARTS = 16
_SUM_ROWS = 16  # features of a block of products
_FREQUENT = 12  # rows of a feature beyond which they are summed by a matrix product
_COUNT_ROWS = 1024
_STEP = 32  # words of a passage, for counts and for products

_FEATURES = 1 << FEATURE_BITS
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = np.zeros(256, np.uint8)
_LETTERS[48:58] = np.arange(48, 58)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def word_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text begins.

    Words are runs of letters and digits, A-Z lower-cased; all other ASCII signs separate.
    """
    raw = [t.encode() for t in texts]
    data = _LETTERS[np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)]
    word = data > 0
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    codes = span_hashes(data, starts, ends)
    text_start = np.cumsum([0] + [len(r) + 1 for r in raw])
    return codes, np.searchsorted(starts, text_start)


def features(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def passage_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages of all texts each feature is, and the number of passages; the feature space bounds both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(_FEATURES, np.int64), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in text_batches(texts):
                codes, at = word_codes(texts[a:b])
                sizes = np.diff(at)
                passage = np.arange(len(codes)) - np.repeat(at[:-1], sizes)
                base = np.cumsum(np.concatenate(([0], -(-sizes // _STEP))))
                key = (np.repeat(base[:-1], sizes) + passage // _STEP) * _FEATURES + features(codes)
                key.sort()
                new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
                total += np.bincount(key[new] & (_FEATURES - 1), minlength=_FEATURES)
                n += int(base[-1])
        parts = [*total.reshape(-1, _COUNT_ROWS), np.array([n])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(len(parts) - 1), -1], pa.int32()), pa.array(parts, pa.list_(pa.int64()))], names=["part", "counts"]
        )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [pdf.part.iloc[0]], "counts": [np.sum(np.stack(pdf.counts), axis=0)]})

    sums = rows.mapInArrow(run, "part int, counts array<long>").groupBy("part").applyInPandas(add, "part int, counts array<long>")
    found = {r.part: np.array(r.counts, dtype=np.int64) for r in sums.collect()}
    n = int(found.pop(-1, np.zeros(1))[0])
    return np.concatenate([found.get(k, np.zeros(_COUNT_ROWS, np.int64)) for k in range(_FEATURES // _COUNT_ROWS)]), n


def add_products(total: np.ndarray, rows: np.ndarray, idf: np.ndarray, turned: np.ndarray) -> None:
    """Add to ``total`` the products of these TF-IDF rows with ``turned``, and back: ``AᵀA`` times the directions.

    ``rows`` has the features of a row, padded with ``_FEATURES``; ``turned`` has the directions times ``idf``, and a
    row of zeros for the padding. ``total`` lacks the factor ``idf`` of the way back, which is the same in all rows.
    Rows have unit length. Where a feature is frequent its rows are summed by a matrix product, otherwise one by one.
    """
    n, wide = rows.shape
    sums = np.take(turned, rows[:, 0], axis=0)
    taken = np.empty_like(sums)
    for k in range(1, wide):
        sums += np.take(turned, rows[:, k], axis=0, out=taken, mode="clip")
    sums /= np.maximum((np.append(idf, 0.0)[rows] ** 2).sum(axis=1), 1e-18)[:, None].astype(np.float32)
    name, row = rows.ravel(), np.repeat(np.arange(n), wide)
    row, name = row[name < _FEATURES], name[name < _FEATURES]
    frequent = np.flatnonzero(np.bincount(name, minlength=_FEATURES) > _FREQUENT)
    slot = np.full(_FEATURES, -1)
    slot[frequent] = np.arange(len(frequent))
    often = slot[name] >= 0
    counts = np.bincount(slot[name[often]] * n + row[often], minlength=len(frequent) * n).reshape(len(frequent), n)
    total[frequent] += counts.astype(np.float32) @ sums
    name, row = name[~often], row[~often]
    order = np.argsort(name.astype(np.uint16), kind="stable")  # sorted by radix
    name, row = name[order], row[order]
    # The k-th rows of all features at a time: no feature occurs twice in a round, and there are few rounds.
    first = np.searchsorted(name, name)
    turn = np.arange(len(name)) - first
    for k in range(int(turn.max(initial=-1)) + 1):
        now = np.flatnonzero(turn == k)
        total[name[now]] += sums[row[now]]


def padded(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, idf: np.ndarray) -> Iterator[np.ndarray]:
    """Feature rows of spans of words, ``PRODUCT_ROWS`` at a time; features without weight are left out."""
    weighty = np.append(np.where(idf > 0, np.arange(_FEATURES), _FEATURES), _FEATURES)
    for a in range(0, len(starts), PRODUCT_ROWS):
        low, high = starts[a : a + PRODUCT_ROWS], ends[a : a + PRODUCT_ROWS]
        place = low[:, None] + np.arange(int((high - low).max()))
        inside = place < high[:, None]
        yield weighty[np.where(inside, features(codes[np.minimum(place, len(codes) - 1)]), _FEATURES)]


def passage_products(rows: DataFrame, idf: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """``AᵀA`` times the directions, over the TF-IDF rows ``A`` of all passages of all texts: ``features x directions``.

    A task sends one matrix of a fixed size in blocks of features, which are added up block by block as they arrive.
    """
    width = directions.shape[1]
    turned = np.vstack((idf[:, None] * directions, np.zeros((1, width)))).astype(np.float32)

    def block_rows(blocks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        names = sorted(blocks)
        sums = [blocks[k].astype("<f4").tobytes() for k in names]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(sums, pa.binary())], names=["block", "sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((_FEATURES, width))
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in text_batches(texts):
                codes, at = word_codes(texts[a:b])
                counts = -(-np.diff(at) // _STEP)
                inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = np.repeat(at[:-1], counts) + _STEP * inner
                part = np.zeros((_FEATURES, width), np.float32)
                for passages in padded(codes, starts, np.minimum(starts + _STEP, np.repeat(at[1:], counts)), idf):
                    add_products(part, passages, idf, turned)
                total += part
        blocks = total.reshape(-1, _SUM_ROWS, width)
        yield from block_rows({k: x for k, x in enumerate(blocks) if x.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for name, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                totals.setdefault(name, np.zeros(_SUM_ROWS * width))
                totals[name] += np.frombuffer(sums.as_buffer(), "<f4")
        yield from block_rows(totals)

    kind = "block int, sums binary"
    found = rows.mapInArrow(run, kind).repartition(SUM_PARTS, "block").mapInArrow(add, kind)
    total = np.zeros((_FEATURES // _SUM_ROWS, _SUM_ROWS * width))
    for r in found.collect():  # as many rows as the feature space has blocks
        total[r.block] = np.frombuffer(r.sums, "<f4")
    return idf[:, None] * total.reshape(_FEATURES, width)


def latent_space(rows: DataFrame, pieces: list[np.ndarray], scale: float, idf: np.ndarray) -> np.ndarray:
    """Feature vectors by a randomised SVD of the TF-IDF matrix of all passages and of the item pieces: ``features x RANK``.

    One round over the distributed rows multiplies them with random directions and back. These products hold the row
    space and, between them and the directions, what the matrix is in it (Nyström's form), so that its singular
    vectors follow on the driver from matrices of a fixed size. A piece weighs ``scale`` times a passage.
    """
    directions = np.linalg.qr(np.random.default_rng(17).normal(size=(_FEATURES, RANK + OVERSAMPLE)))[0]
    products = passage_products(rows, idf, directions)
    if pieces:
        own = np.zeros(products.shape)
        turned = np.vstack((idf[:, None] * directions, np.zeros((1, directions.shape[1])))).astype(np.float32)
        ends = np.cumsum([len(p) for p in pieces])
        for block in padded(np.concatenate(pieces), np.concatenate(([0], ends[:-1])), ends, idf):
            add_products(own, block, idf, turned)
        products += scale * idf[:, None] * own
    inner = directions.T @ products
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    sound = values > 1e-6 * max(float(values[-1]), 1e-18)
    space = np.zeros((_FEATURES, RANK))
    if sound.any():
        vectors, _, _ = np.linalg.svd(products @ (turn[:, sound] / np.sqrt(values[sound])), full_matrices=False)
        space[:, : min(RANK, vectors.shape[1])] = vectors[:, :RANK]
    return space


@dataclass(frozen=True)
class Probes:
    """The benchmark as query vectors by length, and the word codes to confirm with."""

    item: np.ndarray
    blocks: np.ndarray
    offset: np.ndarray
    pieces: list[np.ndarray]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vector: np.ndarray | None = None
    whole: list[tuple[np.ndarray, np.ndarray]] | None = None

    def placed(self, embed: np.ndarray, weight: np.ndarray) -> Probes:
        """With the unit vectors of the pieces in the latent space and, as features and values, in the whole one."""
        vector = np.array([embed[features(p)].sum(axis=0) for p in self.pieces], dtype=np.float32).reshape(-1, embed.shape[1])
        whole = []
        for piece in self.pieces:
            f, count = np.unique(features(piece), return_counts=True)
            # A word of a window adds its own weight times the piece's: both are in the value.
            whole.append((f, (count * weight[f] / np.sqrt(max((count**2 * weight[f]).sum(), 1e-9))).astype(np.float32)))
        return replace(self, vector=vector / np.maximum(np.sqrt((vector**2).sum(axis=1, keepdims=True)), 1e-9), whole=whole)

    def columns(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each feature's row in a table, and the table: what a word adds to its window's product with each of the pieces.

        The features that no piece has share row 0, of zeros, as do places without a word.
        """
        names, values = (np.concatenate(x) for x in zip(*(self.whole[p] for p in pieces.tolist()), strict=True))
        column = np.repeat(np.arange(len(pieces)), [len(self.whole[p][0]) for p in pieces.tolist()])
        held = np.unique(names[values != 0])
        row = np.zeros(_FEATURES + 1, np.int64)
        row[held] = np.arange(1, len(held) + 1)
        table = np.zeros((len(held) + 1, len(pieces)), np.float32)
        table[row[names], column] = values
        return row, table

    @cached_property
    def bits(self) -> tuple[np.ndarray, np.uint64]:
        """For a piece and a feature the places of the piece's words, one bit each, in a hash table, and its shift.

        What meets in the table is united, so that bits are too many at times and never too few.
        """
        piece = np.repeat(np.arange(len(self.pieces)), [len(p) for p in self.pieces]).astype(np.uint64)
        size = max(10, (4 * len(piece)).bit_length())
        shift, table = np.uint64(64 - size), np.zeros(1 << size, np.uint64)
        place = np.concatenate([np.arange(len(p)) for p in self.pieces]).astype(np.uint64)
        key = (piece << np.uint64(FEATURE_BITS)) + features(np.concatenate(self.pieces)).astype(np.uint64)
        np.bitwise_or.at(table, (key * _SPREAD) >> shift, np.uint64(1) << place)
        return table, shift


def answer_of(text: str) -> str:
    """The last sentence of an item, where it has several; otherwise its last third."""
    sentences = [s for s in _SENTENCE.split(text.strip()) if word_codes([s])[1][-1] >= 3]
    if len(sentences) > 1:
        return sentences[-1]
    words = text.split()
    return " ".join(words[len(words) * 2 // 3 :])


def make_probes(items: list[tuple]) -> Probes:
    """Items are cut into pieces of at most ``PROBE_WORDS`` words; a piece's length is counted in blocks."""
    words = [word_codes([text or ""])[0] for _, text in items]
    answers = [word_codes([answer_of(text or "")])[0] for _, text in items]
    item, offset, pieces = [], [], []
    for k, codes in enumerate(words):
        parts = np.array_split(codes, max(1, -(-len(codes) // PROBE_WORDS)))
        for piece, at in zip(parts, np.cumsum([0] + [len(x) for x in parts]).tolist(), strict=False):
            if len(piece):
                item.append(k)
                offset.append(at)
                pieces.append(piece)
    blocks = [max(1, round(len(p) / BLOCK)) for p in pieces]
    return Probes(np.array(item, np.int64), np.array(blocks, np.int64), np.array(offset, np.int64), pieces, words, answers)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, all of ``a`` in the bits of one number."""
    at: dict[int, int] = {}
    for k, x in enumerate(a):
        at[x] = at.get(x, 0) | (1 << k)
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        m = at.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def subsequence_bounds(names: np.ndarray, low: np.ndarray, high: np.ndarray, pieces: np.ndarray, probes: Probes) -> np.ndarray:
    """At least the length of the longest common subsequence of each piece with the features ``names[low:high]``.

    ``common_subsequence`` of many at a time, each piece in 64 bits; words of one feature count as the same.
    """
    table, shift = probes.bits
    key = (pieces.astype(np.uint64) << np.uint64(FEATURE_BITS)) * _SPREAD
    names = names.astype(np.uint64) * _SPREAD
    order = np.argsort(high - low, kind="stable")
    bound = np.empty(len(pieces), np.int64)
    for a in range(0, len(order), BOUNDS):
        mine = order[a : a + BOUNDS]
        start, size, own = low[mine], (high - low)[mine], key[mine]
        left = np.full(len(mine), ~np.uint64(0))
        for j, k in enumerate(np.searchsorted(size, np.arange(int(size[-1])), "right").tolist()):
            v = left[k:]  # the stretches of over j words
            u = v & table[(own[k:] + names[start[k:] + j]) >> shift]
            left[k:] = (v + u) | (v - u)
        bound[mine] = 64 - np.bitwise_count(left).astype(np.int64)
    return bound


def verbatim_copies(codes: np.ndarray, at: np.ndarray, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(first word, item)`` of every copy of an item, word by word, that lies inside one text."""
    sizes = np.array([len(w) for w in words])
    every = np.concatenate(words)
    start = np.cumsum(sizes) - sizes
    run = np.minimum(sizes, RUN_WORDS)
    opening, full = span_hashes(every, start, start + run), span_hashes(every, start, start + sizes)
    places, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in np.unique(run).tolist():
        mine = np.flatnonzero(run == n)
        mine = mine[np.argsort(opening[mine], kind="stable")]
        first = np.arange(max(0, len(codes) - n + 1))
        seen = span_hashes(codes, first, first + n)
        known = np.zeros(1 << 16, bool)
        known[opening[mine] >> np.uint64(48)] = True
        first = np.flatnonzero(known[seen >> np.uint64(48)])
        seen = seen[first]
        low, high = np.searchsorted(opening[mine], seen, "left"), np.searchsorted(opening[mine], seen, "right")
        first, low, count = first[high > low], low[high > low], (high - low)[high > low]
        place = np.repeat(first, count)
        item = mine[np.arange(count.sum()) + np.repeat(low - (np.cumsum(count) - count), count)]
        inside = place + sizes[item] <= at[np.searchsorted(at, place, side="right")]
        place, item = place[inside], item[inside]
        same = span_hashes(codes, place, place + sizes[item]) == full[item]
        places.append(place[same])
        items.append(item[same])
    return np.concatenate(places), np.concatenate(items)


def find_leaks(texts: list[str], probes: Probes, embed: np.ndarray, weight: np.ndarray, cosine: float, lcs: float, answer: float) -> Iterator[tuple]:
    """``(text, item, first word, cosine, lcs share, answer share)``, the best place of each text and item."""
    codes, at = word_codes(texts)
    if not len(codes) or not len(probes.item):
        return
    sizes = np.diff(at)
    counts = -(-sizes // BLOCK)
    block_text = np.repeat(np.arange(len(texts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    block_start = np.repeat(at[:-1], counts) + BLOCK * inner
    # A row of features a block; places past a text's end point to the row of zeros.
    place = block_start[:, None] + np.arange(BLOCK)
    names = features(codes)
    feature = np.where(place < np.repeat(at[1:], counts)[:, None], names[np.minimum(place, len(codes) - 1)], _FEATURES)

    def block_sums(table: np.ndarray, row: np.ndarray) -> np.ndarray:
        sums = table[row[:, 0]]
        rows = np.empty_like(sums)
        for k in range(1, BLOCK):
            sums += np.take(table, row[:, k], axis=0, out=rows, mode="clip")
        return sums

    blocks = np.arange(len(feature))
    last = np.repeat(np.cumsum(counts), counts)  # one past the text's last block

    def widen(window: np.ndarray, sums: np.ndarray, old: int, new: int) -> None:
        """Windows of ``old`` blocks, which end with their text, to windows of ``new`` blocks, in place."""
        for k in range(old, min(new, len(blocks))):
            ended = np.flatnonzero(blocks + k >= last)
            kept = window[ended]
            window[:-k] += sums[k:]
            window[ended] = kept

    energy = np.concatenate(([0.0], np.cumsum(weight[feature].sum(axis=1))))
    latent = block_sums(embed, feature)
    window, reach = latent.copy(), 1
    begins = np.concatenate(([True], block_text[1:] != block_text[:-1]))
    exact, items = verbatim_copies(codes, at, probes.words)
    candidates = [(np.searchsorted(at, exact, side="right") - 1, items, exact, np.ones(len(exact), np.float32))]
    by_width = np.argsort(probes.blocks, kind="stable")
    ready = 0
    for part in range(0, len(by_width), PROBE_COLUMNS):
        pieces = by_width[part : part + PROBE_COLUMNS]
        row, table = probes.columns(pieces)
        sums = block_sums(table, row[feature])
        whole, spread = sums.copy(), 1
        for width in np.unique(probes.blocks[pieces]).tolist():
            if width != ready:
                stop = np.minimum(blocks + width, last)
                # A window that the end of its text cuts short is looked at from where it is whole, or at the start.
                unused = np.flatnonzero((stop - blocks != width) & ~begins)
                # The window's length is that of its whole TF-IDF vector: what lies outside the space counts against it.
                length = np.sqrt(np.maximum(energy[stop] - energy[blocks], 1e-9)).astype(np.float32)
                least = (length * (cosine - 1e-5))[:, None]
                least[unused] = np.inf
                widen(window, latent, reach, width)
                ready = reach = width
            low, high = np.searchsorted(probes.blocks[pieces], [width, width + 1])
            widen(whole[:, low:], sums[:, low:], spread, width)
            spread = width
            mine = pieces[low:high]
            # The space holds ever less of an item as the benchmark grows; the whole vectors do not depend on its size.
            product = window @ probes.vector[mine].T
            np.maximum(product, whole[:, low:high], out=product)
            hits = np.flatnonzero(product >= least)  # near enough before rounding
            w, p = np.divmod(hits, len(mine))
            near = product.ravel()[hits] / length[w]
            w, p, near = (x[near >= cosine] for x in (w, p, near))
            candidates.append((block_text[w], probes.item[mine[p]], block_start[w] - probes.offset[mine[p]], near))
    found_text, found_item, places, near = (np.concatenate(x) for x in zip(*candidates, strict=True))
    if not len(places):
        return
    # Most places share an item's vocabulary and no stretch with it. A text none of whose places can hold enough of an
    # item is not compared with it; an item of several pieces is compared as it is.
    sizes = np.array([len(w) for w in probes.words])[found_item]
    slack = np.maximum(2 * BLOCK, sizes // 2)
    low, high = np.maximum(at[found_text], places - slack), np.minimum(at[found_text + 1], places + sizes + slack)
    enough = sizes > PROBE_WORDS
    short = np.flatnonzero(~enough)
    bound = subsequence_bounds(names, low[short], high[short], np.searchsorted(probes.item, found_item[short]), probes)
    enough[short] = bound / sizes[short] >= lcs
    pair = found_text * len(probes.words) + found_item
    open_ = np.isin(pair, pair[enough])
    found_text, found_item, places, near = (x[open_] for x in (found_text, found_item, places, near))
    if not len(places):
        return
    best: dict[tuple[int, int], tuple] = {}
    order = np.lexsort((places, -near))
    confirmed: dict[tuple[int, int], list[int]] = {}
    for k in order.tolist():
        text, item = int(found_text[k]), int(found_item[k])
        words = probes.words[item]
        size = len(words)
        place = int(places[k])
        seen = confirmed.setdefault((text, item), [])
        if any(abs(place - s) < max(BLOCK, size // 2) for s in seen):
            continue  # the stretch around it has been compared
        seen.append(place)
        slack = max(2 * BLOCK, size // 2)
        low, high = max(int(at[text]), place - slack), min(int(at[text + 1]), place + size + slack)
        stretch = codes[low:high].tolist()
        found = common_subsequence(words.tolist(), stretch) / size
        if found < lcs:
            continue
        tail = probes.answers[item]
        share = common_subsequence(tail.tolist(), stretch) / len(tail) if len(tail) else 1.0
        if share < answer:
            continue
        row = (text, item, max(0, place - int(at[text])), float(near[k]), found, share)
        if (text, item) not in best or row[4] > best[text, item][4]:
            best[text, item] = row
    yield from best.values()


@dataclass(frozen=True)
class LeakFinder:
    """What a task needs: feature vectors, the benchmark's probes and their ids, and the thresholds."""

    embed: np.ndarray
    weight: np.ndarray
    probes: Probes
    ids: list
    cosine: float
    lcs: float
    answer: float

    def __call__(self, texts: list[str | None]) -> Iterator[tuple]:
        texts = [t or "" for t in texts]
        for a, b in text_batches(texts, SEARCH_BYTES):
            for text, item, *rest in find_leaks(texts[a:b], self.probes, self.embed, self.weight, self.cosine, self.lcs, self.answer):
                yield (text + a, self.ids[item], *rest)


def fit_leak_finder(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    cosine: float = 0.35,
    lcs: float = 0.7,
    answer: float = 0.6,
) -> LeakFinder:
    """Statistics over all passages of the documents, a latent space, and the benchmark projected into it.

    The frequencies and the SVD cover every passage of every document, and the SVD all items.
    The benchmark is the query set: its words go to every task, so it must fit in one task's memory; its rows
    with NULL, empty or wordless texts ask for nothing.
    """
    rows = documents.select(F.col(text).cast("string").alias("text"))
    counts, n = passage_frequencies(rows)
    idf = np.log((n - counts + 1) / (counts + 0.5)).clip(min=0.0)
    items = [tuple(r) for r in benchmark.select(item_id, F.col(item_text).cast("string")).collect()]
    items = sorted((i for i in items if i[1] and len(word_codes([i[1]])[0])), key=lambda i: (str(i[0]), i[1]))
    probes = make_probes(items)
    # The items weigh more than the corpus passages together, so that the space holds them well.
    space = latent_space(rows, probes.pieces, ITEM_WEIGHT * max(n, LEAST_PASSAGES) / max(1, len(probes.item)), idf)
    # One more row, of zeros, for places without a word.
    embed = np.vstack((idf[:, None] * space, np.zeros((1, RANK)))).astype(np.float32)
    return LeakFinder(embed, np.append(idf**2, 0.0), probes.placed(embed, np.append(idf**2, 0.0)), [i[0] for i in items], cosine, lcs, answer)


def benchmark_leaks(documents: DataFrame, finder: LeakFinder, item_kind: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row a document and leaked item: ``id, item_id, start_word, cosine, lcs, answer``.

    A window of a document whose latent or whole TF-IDF vector is close to an item's, or that copies it, is compared
    with it (``cosine`` is the greater of the two, 1 for a copy): the longest common subsequence covers at least the share ``lcs`` of the item's words, and the share ``answer`` of its answer's.
    NULL and empty texts hold nothing, very long ones are searched whole, rows with NULL or repeated ids are
    documents of their own. Other columns are not read, whatever their names. Of equally good places of an item in a
    text the first is returned. An empty table, or an empty benchmark, gives no rows. Documents are read once and not
    shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(finder(batch.column(1).to_pylist()))
            columns = list(zip(*found, strict=True)) if found else [()] * 6
            names = batch.column(0).take(pa.array(columns[0], pa.int64()))
            kinds = (None, None, pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(columns[1], pa.string() if item_kind == "string" else pa.int64()), *(pa.array(c, k) for c, k in zip(columns[2:], kinds[2:], strict=True))],
                names=["id", "item_id", "start_word", "cosine", "lcs", "answer"],
            )

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.col(id_column).alias("id"), F.col(text).cast("string"))
    return rows.mapInArrow(
        run, f"id {kind}, item_id {item_kind}, start_word long, cosine double, lcs double, answer double"
    ).withColumnRenamed("id", id_column)


def drop_leaking(documents: DataFrame, finder: LeakFinder, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that hold no benchmark item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for row in finder(batch.column(batch.schema.get_field_index(text)).to_pylist()):
                keep[row[0]] = False
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)
