"""NULLs, empty and long texts, repeated rows, empty tables and columns with an operator's own names."""

from __future__ import annotations

import itertools
import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from crmtide.llm import embedding_dedup, hmm, mixing, near_dedup, packing, sharding, substring_dedup, topk, toxicity, warc
from crmtide.llm.components import components
from crmtide.llm.words import similar

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
TEN = "one two three four five six seven eight nine ten"
KIND = "doc_id long, text string, source string, score string, row string, _key string, id string, n_chars long"
TEXTS = [
    (1, TEN, "a"),
    (2, TEN.upper(), "a"),
    (3, None, "b"),
    (4, "", None),
    (5, " \t\n ", "b"),
    (6, LONG, "a"),
    (6, LONG, "a"),
    (None, TEN, "a"),
    (None, None, None),
    (7, "three words here", "c"),
    (8, "three words here", "c"),
    (9, "three words  there", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, s, "x", "y", "z", "id", len(t or "")) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, KIND).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1), (1, 0), (3, None), (None, 1), (5, 0), (7, 0), (99, 1)]
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def order(values):
    return sorted(values, key=lambda v: (v is not None, v))


def test_shards(docs):
    placed = sharding.interleave(docs, shards=5)
    got = placed.collect()
    assert set(placed.columns) == {*docs.columns, "shard", "slot"}
    assert order(r.doc_id for r in got) == order(i for i, _, _ in TEXTS)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert sorted(len(v) for v in by.values()) == [2, 2, 2, 3, 3]
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert sharding.interleave(docs.limit(0)).count() == 0


def test_written_shards(spark, docs, path):
    sharding.write_shards(sharding.interleave(docs, shards=5), path("shards"), 5)
    back = spark.read.parquet(path("shards"))
    assert back.count() == len(TEXTS) and back.select("shard").distinct().count() == 5


def test_near_duplicates(docs):
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS)
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got}
    assert by[1] == (6, 1, True) and by[2] == (6, 1, False)
    assert by[3] == (0, 3, True) and by[4] == (0, 4, True) and by[5] == (0, 5, True)
    assert by[7] == (1, 7, True) and by[8] == (1, 7, False) and by[9] == (1, 9, True)
    assert [tuple(r) for r in got if r.doc_id == 6] == [(6, by[6][0], 6, True)] * 2
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None) == [(0, None, True), (6, None, True)]
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [[f"a{rng.integers(40)}" for _ in range(60)] for _ in range(4)]
    texts = []
    for i in range(160):
        words = list(base[i % 4])
        for _ in range(rng.integers(0, 5)):
            words[rng.integers(60)] = f"b{rng.integers(1000)}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(56)} for t in texts]
    root = list(range(160))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(160), 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            root[max(find(a), find(b))] = min(find(a), find(b))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == {i: find(i) for i in range(160)}


def test_sketch_fills_every_coordinate_and_estimates():
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 100, 100))
    x, y = np.unique(np.concatenate([both, a])), np.unique(np.concatenate([both, b]))
    found = near_dedup.sketch([x, y, x[:1], np.empty(0, np.uint64)])
    assert (found[:3] != np.uint64(2**64 - 1)).all() and (found[3] == np.uint64(2**64 - 1)).all()
    assert abs((found[0] == found[1]).mean() - 0.75) < 0.15
    assert similar(x, y) is bool(100 * 600 >= 75 * 800)


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (None, 1), *[(100, i) for i in range(101, 160)], (159, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in [1, 2, 3, *range(100, 160)]}, 7: 7, 8: 7, 9: 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mix(docs):
    got = mixing.mix(docs.withColumn("size", mixing.words("text"))).collect()
    assert len(got) == len(TEXTS)
    sizes = {s: sum(len((t or "").split()) for _, t, x in TEXTS if x == s) for s in ("a", "b", "c", None)}
    assert {r.source: r.source_size for r in got} == sizes
    assert {r.source: r.target for r in got}["b"] == 0
    assert all(r.target <= 2 * r.source_size and 0 <= r.times <= 2 for r in got)
    assert mixing.mix(docs.withColumn("size", mixing.words("text")).limit(0)).count() == 0


def test_packing(docs):
    pieces = packing.cut_pieces(docs)
    assert pieces.filter("text is null").count() == 0 if "text" in pieces.columns else True
    placed = packing.pack(pieces).collect()
    whole = Counter()
    for r in placed:
        assert len(r.ids) == 4 * r.length
        whole[r.sequence_id] += r.length
    assert max(whole.values()) <= 1024
    assert Counter(r.id for r in placed if r.piece == 0) == Counter(i for i, _, _ in TEXTS)
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_best_two_fit_uses_all_and_replaces():
    counts = np.zeros(11, np.int64)
    for length in (7, 2, 1, 2, 1):
        counts[length] += 1
    bins = packing.best_two_fit(counts, 10)
    assert bins[0] == (1, [7, 2, 1])
    counts = np.zeros(21, np.int64)
    for length in (10, 8, 6, 4):
        counts[length] += 1
    assert packing.best_two_fit(counts, 20)[0] == (1, [10, 6, 4])
    for repeats, lengths in packing.best_two_fit(np.array([0, 5, 0, 7, 2, 9, 1]), 6):
        assert sum(lengths) <= 6 and repeats > 0


def test_toxicity(docs, labels):
    scored = toxicity.score_toxicity(docs, labels).collect()
    assert order(r.doc_id for r in scored) == order(i for i, _, _ in TEXTS)
    assert all(0 <= r.score <= 1 and isinstance(r.held_out, bool) for r in scored)
    assert len({r.score for r in scored if not (r.text or "").strip()}) == 1
    assert toxicity.score_toxicity(docs, labels.limit(0)).filter("score <> 0.5").count() == 0
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_passages(spark, docs):
    assert substring_dedup.repeated_passages(docs).count() == 0
    assert order(tuple(r)[1] or "" for r in substring_dedup.remove_passages(docs).collect()) == order(t or "" for _, t, _ in TEXTS)
    passage = "The quick brown fox jumps over the lazy dog again. " * 1 + " ".join(f"p{i}" for i in range(40)) + ". Then it ends here with a few more words now."
    rows = [
        (1, f"Alpha beta gamma. {passage} Omega is the last word of this one.", 1),
        (2, f"Wholly other words stand here before it {passage} And others come after.\nline two", 2),
        (3, passage, 3),
        (None, passage, 4),
        (4, None, 5),
        (5, "", 6),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int")
    got = {r.id: (r.doc_id, r.text) for r in substring_dedup.remove_passages(df).collect()}
    assert got[1] == rows[0][:2] and got[4] == rows[3][:2] and got[5][1] is None and got[6][1] == ""
    assert "p20" not in got[2][1] and got[2][1].startswith("Wholly other words") and got[2][1].endswith("line two")
    assert 3 not in got or "p20" not in got[3][1]
    assert substring_dedup.remove_passages(df.limit(0)).count() == 0


def _stream(seed, sentence):
    """Random words in sentences of so many words."""
    rng = np.random.default_rng(seed)
    return [f"u{w}" + "." * (i % sentence == sentence - 1) for i, w in enumerate(rng.integers(0, 50_000, 700))]


def _planted(spark, passages, sentence, cut=1):
    """For each passage: which of its words the second document of a pair loses, and how many others."""
    rows, places = [], []
    for k, passage in enumerate(passages):
        for copy in (0, 1):
            own, at = _stream(2 * k + copy, sentence), (137 + 31 * k + 17 * copy) // cut * cut
            rows.append((2 * k + copy, " ".join([*own[:at], *passage, *own[at:]])))
            places.append(at)
    gone = defaultdict(set)
    for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.id == r.kept_id + 1 and r.id % 2
        gone[r.kept_id // 2].update(range(r.start, r.end))
    inside = [set(range(places[2 * k + 1], places[2 * k + 1] + len(p))) for k, p in enumerate(passages)]
    return [(len(gone[k] & own), len(gone[k] - own)) for k, own in enumerate(inside)]


def test_passage_of_short_sentences_is_found(spark):
    passages = [_stream(1000 + k, 7)[:63] for k in range(6)]
    assert _planted(spark, passages, 7, cut=7) == [(63, 0)] * 6


@pytest.mark.parametrize("sentence", [5, 11, 30, 1000])
def test_passage_is_found_wherever_it_starts(spark, sentence):
    passages = [_stream(2000 + k, sentence)[k : k + 50 + k] for k in range(11)]
    got = _planted(spark, passages, sentence)
    assert [own for own, _ in got] == [50 + k for k in range(11)]
    assert all(3 * others <= own for own, others in got), got


def test_windows_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    pool = [" ".join(f"v{w}" for w in rng.integers(0, 9, 70)) for _ in range(4)]
    texts = [" ".join(f"v{w}" for w in rng.integers(0, 9, 40)) + " " + pool[k % 4][k:] + " " + pool[k * k % 4][:k] for k in range(60)]
    rows = spark.createDataFrame([(100 + k // 2, k, t) for k, t in enumerate(texts)], "id long, tid long, text string")
    first = {}
    own = [(100 + k // 2, k, n, tuple(t.split()[n : n + 50])) for k, t in enumerate(texts) for n in range(len(t.split()) - 49)]
    for i, _, _, w in own:
        first.setdefault(w, i)
    expected = {(i, k, n, n + 50, first[w]) for i, k, n, w in own if first[w] < i}
    assert expected and {tuple(r) for r in substring_dedup.repeated_windows(rows).collect()} == expected


def test_own_words_between_shared_ones_stay(spark):
    one, two, own = (" ".join(_stream(3000 + k, 24)[:24]) for k in range(3))
    own = " ".join(own.split()[:6]) + "."
    texts = [f"{one} {two}", f"{one} {own} {two}"]
    got = substring_dedup.repeated_passages(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()
    assert sorted((r.id, r.start, r.end, r.n_words) for r in got) == [(1, 0, 24, 24), (1, 30, 54, 24)]


def test_paragraphs_just_alike_are_found(spark):
    """One word of 40 replaced leaves 31 of 41 shingles; three bands miss about 9 of 600 such pairs."""
    rows = []
    for k in range(600):
        words = _stream(4000 + k, 1000)[:40]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:20], "other", *words[21:]]))]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all((r.start, r.end, r.id) == (0, 40, r.kept_id + 1) for r in got) and len(got) >= 598


def test_every_word_is_in_a_paragraph():
    for length, sentence in itertools.product((6, 7, 50, 61, 200, 499), (3, 7, 9, 30, 1000)):
        texts = [" ".join(_stream(length + k, sentence)[:length]).encode() for k in range(4)]
        _, _, _, start, end = substring_dedup.paragraphs(texts)
        assert start[0] == 0 and end[-1] == 4 * length and (start[1:] == end[:-1]).all()


def test_language_model(docs):
    got = hmm.score_texts(docs).collect()
    assert order(r.doc_id for r in got) == order(i for i, _, _ in TEXTS)
    assert all(r.score < 0 and r.n_tokens >= 1 and math.isfinite(r.score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert hmm.score_texts(docs.limit(0)).count() == 0


def test_forward_equals_sum_over_all_paths():
    rng = np.random.default_rng(2)
    start, move, emit = rng.random(3), rng.random((3, 3)), rng.random((5, 3))
    model = hmm.Model(start / start.sum(), move / move.sum(1)[:, None], emit / emit.sum(0))
    label, bounds = np.array([0, 4, 2, 2, 1, 3, 3]), np.array([0, 4, 5, 7])
    for i, found in enumerate(model.log_likelihood(label, bounds)):
        own = label[bounds[i] : bounds[i + 1]]
        total = 0.0
        for p in itertools.product(range(3), repeat=len(own)):
            one = model.start[p[0]] * model.emit[own[0], p[0]]
            for t in range(1, len(own)):
                one *= model.move[p[t - 1], p[t]] * model.emit[own[t], p[t]]
            total += one
        assert found == pytest.approx(math.log(total))
    one = [np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))]
    model.expect([label[:4], label[4:5]], *one)
    assert one[0].sum() == pytest.approx(2) and one[1].sum() == pytest.approx(3) and one[2].sum() == pytest.approx(5)


VECTORS = [
    (1, [1.0, 0.0, 0.0], 1),
    (2, [1.0, 0.1, 0.0], 1),
    (3, [2.0, 0.0, 0.0], 1),
    (4, [1.0, 0.0, 0.0], 2),
    (5, [1.0, 0.0, 0.0], None),
    (6, [0.0, 0.0, 0.0], 1),
    (7, [float("nan"), 0.0, 1.0], 1),
    (8, None, 1),
    (9, [1.0, None, 0.0], 1),
    (10, [], 1),
    (11, [1.0, 0.0, 0.0], 1),
    (11, [1.0, 0.0, 0.0], 1),
    (None, [1.0, 0.0, 0.0], 1),
    (12, [1.0, 0.0], 1),
    (50, [float("inf"), 0.0, 1.0], 1),
]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(*v, "x") for v in VECTORS], "vec_id long, embedding array<float>, label int, id string")


def test_embeddings(vectors):
    got = embedding_dedup.near_vectors(vectors).collect()
    assert len(got) == len(VECTORS)
    by = {r.vec_id: tuple(r)[1:] for r in got}
    for i, kept in ((1, True), (2, False), (3, False), (11, False)):
        assert by[i] == (4, 1, kept)
    for i in (4, 5, 6, 7, 8, 9, 10, 12, 50):
        assert by[i] == (0, i, True)
    assert by[None] == (0, None, True)
    assert embedding_dedup.near_vectors(vectors.limit(0)).count() == 0


def test_embedding_recall_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16))
    x[::3] = x[0] + 0.2 * rng.normal(size=(500, 16))
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    links = (u @ u.T >= 0.93).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(df).collect()}
    assert all(got[i] <= n for i, n in enumerate(links)) and sum(got.values()) >= 0.99 * links.sum() > 0


def test_top_k(spark, vectors):
    rows = [(i, [float(i % 7), 1.0 - i / 50, -0.5], i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").unionByName(vectors.drop("id"))
    got = defaultdict(list)
    for r in topk.top_k(df).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    usable = [(i, v) for i, v, _ in [*rows, *VECTORS] if i is not None and v and None not in v and all(map(math.isfinite, v))]
    whole = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in usable]
    for q, v in whole:
        if q % 50 == 0 and q != 50 or (q, len(v)) == (50, 3):
            scores = sorted((-sum(map(int.__mul__, v, w)), i) for i, w in whole if i != q and len(w) == len(v))[:5]
            assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert topk.top_k(df.limit(0)).count() == 0


def test_scan_is_exact():
    rng = np.random.default_rng(6)
    x, q = rng.integers(-200, 200, (3000, 12)), rng.integers(-200, 200, (30, 12))
    q[:, 3] = 0
    near = x[:5] + 1
    for query, (rows, scores) in zip([*q, *near], topk.scan(np.concatenate([q, near]), x, 6)):
        assert set(np.argsort(-(x @ query), kind="stable")[:6]) <= set(rows)
        assert (scores == (x @ query)[rows]).all()


def test_archives(spark, path):
    rows = [
        (1, "http://a/", "<p>same</p>", "x"),
        (2, "http://b/\r\nInjected: 1", "<p>same</p>", "x"),
        (3, None, None, "x"),
        (4, "http://d/%41", "", "x"),
        (None, "http://e/", "<p>same</p>", "x"),
        (5, "http://f/", "ü\r\n\r\nWARC/1.1\r\n" * 3000, "x"),
        (5, "http://f/", "ü\r\n\r\nWARC/1.1\r\n" * 3000, "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(2)
    folder = path("archives")
    index = warc.write_archives(warc.plan_records(pages), folder)
    assert index.count() == len(rows)
    got = warc.read_archives(index, folder).collect()
    kinds = sorted(((r.page_id or 0), r.record_type, r.refers_to or 0) for r in got)
    assert kinds == [(0, "revisit", 2), (1, "revisit", 2), (2, "response", 0), (3, "revisit", 4), (4, "response", 0), (5, "response", 0), (5, "response", 0)]
    by = {r.page_id: r for r in got}
    assert by[2].url == rows[1][1] and by[3].url is None and by[4].url == rows[3][1]
    assert by[5].payload.decode() == rows[5][2] and by[1].payload_bytes == 11
    some = warc.read_archives(index.filter("page_id in (2, 5)"), folder).collect()
    assert sorted(r.page_id for r in some) == [2, 5, 5]
    small = warc.plan_records(pages, least_bytes=12)
    assert small.filter("refers_to is not null").count() == 0
    assert warc.read_archives(index.limit(0), folder).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    """Every stage takes NULLs, long and repeated rows and foreign columns, and keeps the columns it got."""
    labels = spark.createDataFrame([(1, 0), (7, 0)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, str(tmp_path))
        assert name == "packing" or out.columns == docs.columns
        assert stage(spark, kept.limit(0), str(tmp_path)).count() == 0
        kept = out
    ids = {r.doc_id for r in kept.collect()}
    assert ids <= {i for i, _, _ in TEXTS} and 2 not in ids and 8 not in ids and 6 in ids


def test_a_text_is_cut_by_one_call(spark):
    """Neither the filter on what is left nor its length cuts the text again."""
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, f"{passage} one", 0), (2, passage, 0), (3, f"Here stand seven words of own text. {passage}", 0)]
    out = substring_dedup.remove_passages(spark.createDataFrame(rows, "doc_id long, text string, n_chars int"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [(1, rows[0][1], 0), (3, "Here stand seven words of own text. ", 36)]


@pytest.mark.parametrize("work", ["segmenter", "reader", "sketches"])
def test_texts_of_a_batch_are_not_held_at_once(monkeypatch, work):
    """What a task takes beyond its batch follows a chunk, not the batch."""
    text = " ".join(f"word{i}" for i in range(2000))
    one = pa.array([text] * 400)
    ids, none = pa.array(range(400)), pa.nulls(400, pa.list_(pa.int64()))
    places = pa.nulls(400, pa.list_(pa.struct([("print", pa.int64()), ("start", pa.int32()), ("words", pa.int32())])))
    for module in (substring_dedup, near_dedup):
        monkeypatch.setattr(module, "_CHUNK", 4 * len(text))
    batch, task = {
        "segmenter": (pa.RecordBatch.from_arrays([ids, ids, one], ["id", "tid", "text"]), substring_dedup._segmenter),
        "reader": (pa.RecordBatch.from_arrays([ids, ids, one, none, places], ["id", "tid", "text", "seeds", "places"]), substring_dedup._reader),
        "sketches": (pa.RecordBatch.from_arrays([ids, one], ["id", "text"]), near_dedup._sketches),
    }[work]
    tracemalloc.start()
    try:
        for _ in task(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < one.nbytes
