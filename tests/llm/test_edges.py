"""Empty tables, repeated rows, very long texts and clashing columns, operator by operator."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketstrata.llm import chat, decontaminate, embeddings, language, packing, queries, secrets, toxicity, url_filters

DOC = "doc_id long, text string, lang string, source string, n_chars long, id string, score string, digest string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "x", "y", "z") for i, t, lang in rows], DOC)


def words(n: int, seed: int, base: str = "w") -> str:
    return " ".join(f"{base}{x}" for x in np.random.default_rng(seed).integers(0, 300, n))


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


def test_secrets_of_an_empty_table(empty):
    assert secrets.scan_secrets(empty).count() == secrets.redact_secrets(empty).count() == 0


def test_urls_without_rows_or_rules(spark):
    rules = spark.createDataFrame([("com", "/", "allow")], "host string, path string, action string")
    urls = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (2, None)], "page_id long, url string")
    assert url_filters.match_urls(urls.filter("false"), rules).count() == 0
    found = url_filters.match_urls(urls, rules.filter("false")).collect()
    assert [(r.rule, r.verdict) for r in found] == [(None, "allow")] * 3


def test_leaks_of_empty_tables(spark, empty):
    benchmark = spark.createDataFrame([(1, words(40, 3)), (2, None), (3, "")], "item_id long, text string")
    some = docs(spark, [(1, words(90, 1) + " " + words(40, 3), "en"), (1, words(90, 1) + " " + words(40, 3), "en"), (2, None, None)])
    for documents, items in ((empty, benchmark), (some, benchmark.filter("false")), (empty, benchmark.filter("false"))):
        finder = decontaminate.fit_leak_finder(documents, items)
        assert decontaminate.benchmark_leaks(documents, finder, "bigint").count() == 0
        assert decontaminate.drop_leaking(documents, finder).count() == documents.count()
    finder = decontaminate.fit_leak_finder(some, benchmark)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.benchmark_leaks(some, finder, "bigint").collect()) == [(1, 1), (1, 1)]
    assert decontaminate.drop_leaking(some, finder).columns == some.columns


def test_a_long_text_is_searched_to_its_end(spark):
    benchmark = spark.createDataFrame([(1, words(40, 3, "b"))], "item_id long, text string")
    far = docs(spark, [(1, words(60_000, 5) + " " + words(40, 3, "b") + " " + words(500, 6), "en"), (2, words(60_000, 5), "en")])
    finder = decontaminate.fit_leak_finder(far, benchmark)
    [leak] = decontaminate.benchmark_leaks(far, finder, "bigint").collect()
    assert leak.doc_id == 1 and abs(leak.start_word - 60_000) <= decontaminate.BLOCK


def test_places_that_cannot_hold_an_item_are_not_compared(spark, monkeypatch):
    rng = np.random.default_rng(4)
    # Texts and items share one vocabulary; every fifth text holds an item, with every seventh word another one.
    passage = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 120, n))
    items = [(k, passage(int(n))) for k, n in enumerate([1, 3, *rng.integers(15, 64, 36), 64, 65, 150])]
    texts = [passage(int(n)) for n in rng.integers(1, 900, 150)] + [None, ""]
    for k, (_, item) in enumerate(items[2:]):
        texts[5 * (k % 30)] += " " + " ".join("z" if j % 7 == 3 else w for j, w in enumerate(item.split())) + " " + passage(20)
    finder = decontaminate.fit_leak_finder(docs(spark, [(k, t, "en") for k, t in enumerate(texts)]), spark.createDataFrame(items, "item_id long, text string"))
    plain, calls = decontaminate.common_subsequence, []
    monkeypatch.setattr(decontaminate, "common_subsequence", lambda a, b: calls.append(len(a) <= decontaminate.PROBE_WORDS) or plain(a, b))
    found, compared = sorted(finder(texts)), sum(calls)
    assert {k for _, k, *_ in found} >= set(range(2, len(items)))
    monkeypatch.setattr(decontaminate, "subsequence_bounds", lambda names, low, high, pieces, probes: np.full(len(pieces), 64))
    calls.clear()
    assert sorted(finder(texts)) == found and compared * 4 < sum(calls)


def test_bounds_are_never_below_the_subsequence():
    rng = np.random.default_rng(6)
    passage = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 30, n))
    probes = decontaminate.make_probes([(k, passage(k)) for k in range(1, 65)])
    codes = decontaminate.word_codes([passage(3000)])[0]
    low = rng.integers(0, 2900, 6000)
    high, pieces = low + rng.integers(0, 100, 6000), rng.integers(0, 64, 6000)
    got = decontaminate.subsequence_bounds(decontaminate.features(codes), low, high, pieces, probes)
    want = [decontaminate.common_subsequence(probes.pieces[p].tolist(), codes[a:b].tolist()) for a, b, p in zip(low, high, pieces, strict=True)]
    assert (got >= want).all() and np.mean(got - want) < 1


def test_product_rows_do_not_change_the_space(spark, monkeypatch):
    documents = docs(spark, [(i, words(200, i), "en") for i in range(30)])
    benchmark = spark.createDataFrame([(i, words(40, 100 + i)) for i in range(5)], "item_id long, text string")
    whole = decontaminate.fit_leak_finder(documents, benchmark).embed
    monkeypatch.setattr(decontaminate, "PRODUCT_ROWS", 7)
    cut = decontaminate.fit_leak_finder(documents, benchmark).embed
    assert np.allclose(whole @ whole.T, cut @ cut.T, atol=1e-2)


def test_the_space_holds_every_passage(spark):
    # 90 passages of 32 words of their own, 200 times each: more passages than a sample of 12,000 would take.
    topics = [" ".join(f"t{k}x{j}" for j in range(32)) for k in range(90)]
    rows = docs(spark, [(k, " ".join([t] * 20), "en") for k, t in enumerate(topics * 10)])
    finder = decontaminate.fit_leak_finder(rows, spark.createDataFrame([(1, words(40, 3))], "item_id long, text string"))
    for topic in topics:
        at = decontaminate.features(decontaminate.word_codes([topic])[0])
        assert np.linalg.norm(finder.embed[at].sum(axis=0)) > 0.95 * np.sqrt(finder.weight[at].sum())


def test_products_of_all_passages(spark):
    texts = [words(n, n, "p") + " the the the" for n in (0, 5, 31, 32, 700, 1300)] + [" ".join(["the"] * 3000), "", None]
    rows = docs(spark, [(k, t, "en") for k, t in enumerate(texts * 3)]).select("text").repartition(4)
    idf = np.random.default_rng(1).uniform(0.5, 2, decontaminate._FEATURES)
    idf[decontaminate.features(decontaminate.word_codes(["p7"])[0])] = 0
    directions = np.random.default_rng(2).normal(size=(decontaminate._FEATURES, 5))
    want = np.zeros(directions.shape)
    for text in texts:
        names = decontaminate.features(decontaminate.word_codes([text or ""])[0])
        for a in range(0, len(names), 32):
            row = np.bincount(names[a : a + 32], idf[names[a : a + 32]], decontaminate._FEATURES)
            row /= np.sqrt((idf[names[a : a + 32]] ** 2).sum())
            want += 3 * np.outer(row, row @ directions)
    got = decontaminate.passage_products(rows, idf, directions)
    assert np.abs(got - want).max() < 1e-4 * np.abs(want).max()


def test_chat_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string, link string, message string")
    assert chat.format_chat(rows).count() == 0


def test_models_without_documents(spark, empty):
    model = language.train_language(empty)
    some = docs(spark, [(1, "some text", None), (1, "some text", None), (None, None, None)])
    assert [(r.doc_id, r.lang_pred, r.score) for r in language.identify_language(some, model).collect()] == [(1, "und", 0.0), (1, "und", 0.0), (None, "und", 0.0)]
    assert language.identify_language(empty, model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    scorer = toxicity.train_toxicity(empty, labels)
    assert [(r.doc_id, r.score, r.predicted) for r in toxicity.score_toxicity(some, scorer).collect()] == [(1, 0.0, 0), (1, 0.0, 0), (None, 0.0, 0)]
    assert toxicity.score_toxicity(empty, scorer).count() == 0


def test_vectors_beside_clashing_columns(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.001], 1), (3, [0.0, 1.0], 1), (4, [1.0, 0.0], 2), (5, None, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    beside = frame.withColumns({c: F.lit(7) for c in ("rep", "n", "group", "unit", "component", "audit_links", "kept")})
    plain = sorted(map(tuple, embeddings.near_vectors(frame, audit=False).collect()))
    assert plain == sorted(map(tuple, embeddings.near_vectors(beside, audit=False).collect()))
    assert plain == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True)]
    audited = embeddings.near_vectors(beside).collect()
    assert all(r.audit_links in (None, r.n_links) for r in audited)


def test_vectors_are_audited_by_their_query(spark, tmp_path, monkeypatch):
    # Ten near copies in one label, every row twice, one id also with a vector and a label that cannot link.
    rows = [(k, [1.0, 0.001 * k], 1) for k in range(10)] * 2 + [(20 + k, [0.0, 1.0], k) for k in range(5)] + [(3, None, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    audited = embeddings.near_vectors(frame).filter("audit_links is not null and n_links > 0").collect()
    assert {(r.vec_id, r.n_links, r.audit_links) for r in audited} == {(k, 19, 19) for k in range(10)}
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op1_embedding_dedup(spark, str(tmp_path)).columns == ["vec_id", "n_links", "component_id", "kept"]
    whole = embeddings.link_vectors

    def lossy(*args):
        found, links = whole(*args)
        return found, links.filter("false")

    monkeypatch.setattr(embeddings, "link_vectors", lossy)
    with pytest.raises(ValueError, match="audited links"):
        queries.op1_embedding_dedup(spark, str(tmp_path))


def test_vectors_of_many_centres(spark, monkeypatch):
    # 120 centres, as a label of 60,000 vectors has: the sample's size must not overflow an integer.
    monkeypatch.setattr(embeddings, "SHARD_ROWS", 6)
    rng = np.random.default_rng(17)
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(np.repeat(rng.normal(size=(120, 16)), 2, axis=0) + 0.01 * rng.normal(size=(240, 16)))]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {tuple(r)[:4] for r in got} == {(k, 1, k // 2 * 2, k % 2 == 0) for k in range(240)}


def test_search_past_a_node_of_many_neighbours(monkeypatch):
    # Node 0 leads to all others; with lists padded to its length this search took 328 MB.
    rng = np.random.default_rng(19)
    vectors = np.repeat(rng.normal(size=(300, 16)), 5, axis=0) + 0.02 * rng.normal(size=(1500, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ring = np.stack(((np.arange(1, 1500) + 1) % 1500, (np.arange(1, 1500) - 1)), axis=1).ravel()
    degrees, links = np.array([1499] + [2] * 1499), np.concatenate((np.arange(1, 1500), ring))
    want = {(int(q), int(v)) for q, v in zip(*np.nonzero(vectors @ vectors.T >= 0.98), strict=True)}
    for edges in (embeddings.SEARCH_EDGES, 100):
        monkeypatch.setattr(embeddings, "SEARCH_EDGES", edges)
        tracemalloc.start()
        found = [(int(x), int(y)) for q, v in embeddings.range_search(vectors, degrees, links, np.array([0]), vectors, np.arange(1500), 0.98) for x, y in zip(q, v, strict=True)]
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(found) == len(set(found)) and set(found) == want
        assert most < 150e6


def test_packing_an_empty_table(empty):
    assert packing.pack_documents(empty, queries.tokenizer_path()).count() == 0


def test_pipeline_over_an_empty_table(spark, empty, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    empty.write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


# --- what the lexer finds ---------------------------------------------------------------------

KEY = "q8Zp#4vLm!2xTr"
HELD = [
    "cfg['password'] = '{}'",
    'x["api_key"]="{}"',
    "db:\n  password: |\n    {}\n  other: 1\n",
    "run --password {} --verbose",
    "run --password={}",
    "<password>{}</password>",
    "os.getenv('DB_PASSWORD', '{}')",
    "password: str = '{}'",
    'A = "{}"\nB = A\nC = B\nconnect(password=C)',
    "connect(password=C)\nC = B\nB = '{}'",
    '{{"clientSecret": "{}"}}',
    "# old token => `{}`",
    "if password == '{}':",
    "const dbPassword = `{}`;",
    "PASSWORD={}",
    'auth_token := "{}"',
    "password = rb'{}'",
]
JOINED = ["password = 'q8Zp#4v' + 'Lm!2xTr'", "secret = ('q8Zp#4v'\n   'Lm!2xTr')", "token = (\n 'q8Zp#4v' +\n 'Lm!2xTr')"]
CLEAN = [
    "password = get_password()", "password = os.environ['PASSWORD']", "token: ${TOKEN}", "the password: is here",
    "password = other_name", "don't pass: it's a token; key: value", "secret = '<your-secret-here>'", "tokens = tokenize(text)",
    "password = ''", "key = 'abc12345'", "author: Someone1234", "passed = 'abcd1234efgh'", "password: changeme", "token = None",
    "password = '{{ vault.password1 }}'", "path = 'q8Zp#4vLm!2xTr'",
]


@pytest.mark.parametrize("text", [t.format(KEY) for t in HELD])
def test_literals_given_to_sensitive_names(text):
    at = text.index(KEY)
    assert secrets.named_spans(text) == [(at, 3, at + len(KEY))]
    assert KEY not in secrets.redact(text, secrets.all_spans(text), "[SECRET]")


@pytest.mark.parametrize("text", JOINED)
def test_literals_in_pieces_are_scored_as_a_whole(text):
    assert [text[a:b] for a, _, b in secrets.named_spans(text)] == ["q8Zp#4v", "Lm!2xTr"]


@pytest.mark.parametrize("text", CLEAN)
def test_what_is_no_secret_stays(text):
    assert secrets.named_spans(text) == []


def _steps(text):
    import sys
    import time

    begin = time.process_time()
    secrets.named_spans(text)
    return max(time.process_time() - begin, 0.01), sys.getsizeof(text)


@pytest.mark.parametrize("make", [
    lambda n: "\n".join(f"a{i} = a{i + 1}" for i in range(n)) + f"\npassword = a0\na{n} = '{KEY}'",
    lambda n: 'password = "' + '\\"' * n,
    lambda n: "password = (" * n,
    lambda n: "password: |\n" * n,
    lambda n: "<password>" * n,
    lambda n: "secret='''" * n,
])
def test_the_lexer_takes_linear_time(make):
    """Eight times the text may take a few times eight times as long, not sixty-four times."""
    assert _steps(make(24_000))[0] < 30 * _steps(make(3_000))[0]
