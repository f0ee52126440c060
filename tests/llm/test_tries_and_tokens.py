"""BPE, the conversation trie and hard negatives against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketstrata.llm import bpe, hard_negatives, prefix_trie, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(queries.tokenizer_path())


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def _strings(n: int) -> list[str]:
    rng = random.Random(7)
    signs = "aab bcé ñ中😀 \x0b\t\n'sre0²½ـאֳ　\x85\x1c"
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    out += ["".join(chr(rng.randint(1, 0xD7FF)) for _ in range(12)) for _ in range(n)]
    out += [f"{a}<|endoftext|>{a} <|endoftext" for a in out[:50]]
    return out + ["", " ", "a" * 9000, "ab" * 4000, "".join(rng.choice("etaoinshr") for _ in range(9000)), " \n" * 3000]


def test_bpe_is_the_tokenizers_and_round_trips(spark, vocabulary, library):
    texts = _strings(300)
    rows = [(k, t, "clash") for k, t in enumerate([*texts, None, texts[0], texts[0]])]
    frame = spark.createDataFrame(rows, "doc_id long, text string, decoded string").repartition(3)
    got = bpe.decode_ids(bpe.encode_texts(frame, vocabulary).withColumn("same", F.col("ids")), vocabulary, ids="same").collect()
    want = {k: library.encode(t or "", add_special_tokens=False).ids for k, t, _ in rows}
    assert {r.doc_id: list(r.ids) for r in got} == want
    assert {r.doc_id: r.decoded for r in got} == {k: library.decode(ids, skip_special_tokens=False) for k, ids in want.items()}
    assert all(r.decoded == (rows[r.doc_id][1] or "") for r in got)


def test_bpe_memory_bounds_do_not_change_ids(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_MEMORY", 3)
    monkeypatch.setattr(bpe, "PAIR_MEMORY", 5)
    encoder = bpe.Encoder(bpe._tables(vocabulary)[0])
    for text in _strings(100):
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_bpe_pieces_take_linear_time(vocabulary):
    """Borders looked up grow with the piece, not with its square."""
    table = bpe._tables(vocabulary)[0]
    asked = []
    table_compatible = table.compatible
    table.compatible = lambda a, b: asked.append(1) or table_compatible(a, b)
    try:
        counts = []
        for n in (2000, 16000):
            asked.clear()
            table.encode_piece("".join(random.Random(3).choice("etaoinshr") for _ in range(n)))
            counts.append(len(asked))
    finally:
        del table.compatible
    assert counts[1] < 10 * counts[0]


def test_bpe_decoding_of_odd_ids(spark, vocabulary, library):
    ids = [[0, None, 60000, -1, 50256], None, [], [220, 161, 101], [447, 247, 447]]
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(ids)], "k int, ids array<int>")
    got = {r.k: r.decoded for r in bpe.decode_ids(frame, vocabulary).collect()}
    plain = [None if x is None else library.decode([i for i in x if i is not None and 0 <= i < 50257], skip_special_tokens=False) for x in ids]
    assert got == dict(enumerate(plain))


def test_bpe_edges(spark, vocabulary):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode_ids(bpe.encode_texts(empty, vocabulary), vocabulary).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_texts(empty.withColumn("ids", F.lit(1)), vocabulary, keep=["ids"])
    with pytest.raises(ValueError):
        bpe.Vocabulary({"model": {"type": "Unigram"}})


# --- conversation trie ------------------------------------------------------------------------


def _plain_trie(rows):
    """The contract, word for word, over ``(conv, turn, role, text)``."""
    told = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            who, said = role or "", text or ""
            digest = hashlib.sha256(f"{len(who)}:{who}{said}".encode()).digest()
            told[c].append(((turn is not None, turn or 0), who, digest, said))
    own = {c: [(who, said) for _, who, _, said in sorted(turns)] for c, turns in told.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for p, who in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in who if len(rebuilt[c]) == len(p)))
        out.append((
            min(who), len(p), min(members[p[:-1]]) if p else None, len(who), sum(len(q) == len(p) + 1 for q in below),
            len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def _trie(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit("clash"))
    found = prefix_trie.prefix_trie(prefix_trie.shared_starts(prefix_trie.turn_lists(frame)))
    return sorted((tuple(r) for r in found.collect()), key=repr)


def _conversations():
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 120), -7, -20, 10**12]:
        # A third are copies of one conversation; most others share its first turn.
        said = ["hi there", "a b c", "x  y"] if c % 3 == 0 else ["hi there"] * (c % 5 > 0) + [rng.choice("pqr") * rng.randint(0, 2) for _ in range(rng.randint(1, 6))]
        rows += [(c, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(said)]
    rows += [(300, 1, "u", "t"), (300, 1, "u", "t"), (300, None, None, None), (300, 1, "a", "z"), (None, 1, "u", "t")]
    rows += [(320, k, "user", f"turn {k % 3}") for k in range(400)]
    rows += [(321, k, "user", f"turn {k % 3}") for k in range(380)]
    return rows


@pytest.mark.parametrize("turns", [40, 60_000])
def test_trie_against_plain_version(spark, monkeypatch, turns):
    """With ranges of 40 turns most nodes near the root, and the copied conversation, cross ranges."""
    monkeypatch.setattr(prefix_trie, "RANGE_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 4)
    rows = _conversations()
    assert _trie(spark, rows) == _plain_trie(rows)


def test_trie_edges(spark):
    assert _trie(spark, []) == []
    empty = hashlib.sha256(b"").hexdigest()
    # Conversation 8 loses all its turns to an absent base: a member of the root alone.
    h = zlib.crc32(b"8") % 4
    assert h > 0
    assert _trie(spark, [(8, 0, "u", "x")]) == [(8, 0, None, 1, 0, 1, 0, hashlib.sha256(b"8").hexdigest())]
    rows = [(20, None, None, None)]
    assert _trie(spark, rows) == _plain_trie(rows)
    assert all(r[-1] == empty for r in _trie(spark, rows) if r[4])


def test_range_minimum_reaches():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 200)
    values[0] = -1
    table = prefix_trie.RangeMinimum(values)
    at = np.repeat(np.arange(200), 6)
    depth = np.tile(np.arange(6), 200)
    for k, d, right, left in zip(at, depth, table.reach(at, depth, True), table.reach(at, depth, False), strict=True):
        r = l = k
        while r + 1 < 200 and values[r + 1] >= d:
            r += 1
        while l > 0 and values[l] >= d:
            l -= 1
        assert (left, right) == (l, r)
    first = rng.integers(0, 200, 300)
    last = np.minimum(199, first + rng.integers(0, 90, 300))
    assert table.between(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last, strict=True)]


# --- hard negatives ---------------------------------------------------------------------------


def _plain_negatives(rows, moved=True):
    fit = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = tuple(math.floor(float(np.float32(x)) * 256) for x in vector)
        fit.append((i, (label + 1) % 10 if moved and i % 7 == 0 else label, v))
    fit = sorted(set(fit))
    out = []
    for a, la, va in fit:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=True)), i, la == lb) for i, lb, v in fit if len(v) == len(va))
        for ps, p in [(-s, i) for s, i, same in scored if same and i != a][:5]:
            fits = [(i, -s) for s, i, same in scored if not same and 50 * ps <= -100 * s <= 95 * ps]
            out += [(a, p, k + 1, i, ps, s) for k, (i, s) in enumerate(fits[:3])]
    return sorted(out)


def _negatives(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("row", F.lit("clash"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(frame, F.col("id") % 50 == 0, label=moved).collect())


@pytest.mark.parametrize("values", [600, 2_000_000])
def test_hard_negatives_against_plain_version(spark, monkeypatch, values):
    """Small cells cut every label, one of which holds half of all rows, over many tasks."""
    monkeypatch.setattr(hard_negatives, "CELL_VALUES", values)
    monkeypatch.setattr(hard_negatives, "FIRST_DEPTH", 4)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(2).tolist(), 3 if i % 2 else int(rng.integers(0, 10))) for i in range(600)]
    rows += rows[:40]  # repeated rows
    rows += [(50, rng.normal(size=6).tolist(), 1), (700 + 50, [1.0] * 4, 2), (800, [0.0] * 6, 2), (801, [0.0] * 6, 3), (850, [], 1), (851, [], 2)]
    rows += [(900, None, 1), (950, [None] * 6, 1), (1000, [float("nan")] * 6, 1), (1050, [float("inf")] * 6, 1), (1100, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    # Ties: many equal vectors under other ids.
    rows += [(2000 + k, [0.5] * 6, k % 3) for k in range(60)]
    want = _plain_negatives(rows)
    assert want and _negatives(spark, rows) == want


def test_hard_negatives_without_anchors(spark):
    assert _negatives(spark, []) == []
    assert _negatives(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_threshold_stops_before_the_end_of_the_lists():
    """On a shard with one outstanding vector most candidates are never scored."""
    rng = np.random.default_rng(3)
    vectors = rng.integers(-20, 20, (4000, 3))
    vectors[7] = 500
    shard = hard_negatives.SortedLists(np.arange(4000), vectors)
    scored = []
    shard.float = type("Spy", (), {"__getitem__": lambda s, k, m=shard.float: scored.append(len(k)) or m[k]})()
    [best] = shard.search(np.array([3, 3, 3]), np.ones(4000, bool), [(-np.inf, np.inf)], 1)
    assert best == [(4500, 7)] and sum(scored) < 400


@pytest.mark.parametrize("name", ["op1_embedding_dedup", "op10_substring_dedup", "op12_prefix_trie", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SMALL)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())


def test_number_signs_are_no_letters():
    from marketstrata.llm import language

    model = language.LanguageModel(("en",))
    assert [x[0] for x in language.classify(model, ["² ½ ①", "12 _", "", "½ a", "é", None])] == ["und", "und", "und", "en", "en", "und"]
