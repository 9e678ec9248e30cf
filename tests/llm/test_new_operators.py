"""Byte repeats, hard negatives and fill-in-the-middle against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import time
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from crmtide.llm import common, embedding_dedup, fim, hard_negatives, hmm, packing, substring_dedup, suffix_dedup, topk, toxicity
from crmtide.llm.words import hashed, mix, shingles

KIND = "doc_id long, text string, id string, kept string, n long, output string, row string, spans string"
rng = np.random.default_rng(11)


def words(n, kinds=5000):
    return " ".join(f"w{rng.integers(kinds)}é" for _ in range(n))


SHARED, OTHER = words(80), words(60)
EDGE = SHARED[:120]
TEXTS = [
    (1, "start " + SHARED + " " + words(30)),
    (2, words(40) + SHARED + "."),
    (3, SHARED[40:] + "!" + OTHER + " " + OTHER),
    (4, OTHER[:198]),
    (5, None),
    (6, ""),
    (7, "a" * 900),
    (8, "b" + "abcdefghij" * 70),
    (9, words(200)),
    (9, words(200)),
    (10, TEN := words(90)),
    (10, TEN),
    (None, TEN + "x"),
    (None, None),
    (11, words(3) + " \n\n" + EDGE + words(20) + EDGE),
    (12, "x" * 199),
    (13, "x" * 199),
    (14, "short <S> mark"),
    (15, "é\U0001f600\n ü  z\n"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "a", "b", 1, "c", "d", "e") for i, t in TEXTS]
    return spark.createDataFrame(rows, KIND).repartition(3)


def covered(texts, length, keep):
    """Per row the set of removed byte places, by looking at every string; rows are in the order of their places."""
    where = defaultdict(list)
    for k, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            where[t[i : i + length]].append((k, i))
    gone = [set() for _ in texts]
    for places in where.values():
        if len(places) > 1:
            for k, i in places[keep == "first" :]:
                gone[k].update(range(i, i + length))
    return gone


def expected(texts, length, keep):
    out = []
    for t, gone in zip(texts, covered(texts, length, keep)):
        runs = sum(i - 1 not in gone for i in gone)
        out.append((len(t), len(gone), runs, bytes(b for i, b in enumerate(t) if i not in gone)))
    return out


@pytest.mark.parametrize("together", [1 << 17, 600])
@pytest.mark.parametrize("part", [1 << 20, 700])
def test_repeats_all_copies(docs, monkeypatch, together, part):
    """Also where groups are too large for one suffix order and texts are worked on in parts."""
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    monkeypatch.setattr(suffix_dedup, "PART", part)
    texts = [(t or "").encode() for _, t in TEXTS]
    want = Counter((i, *e) for (i, _), e in zip(TEXTS, expected(texts, 200, "none")))
    got = suffix_dedup.remove_repeats(docs, keep="none").collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want
    assert sum(r.n_removed for r in got) > 3000


@pytest.mark.parametrize("together", [1 << 17, 600])
def test_repeats_keep_first(spark, monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    rows = [(i, (t or "")) for i, t in TEXTS if i is not None and i not in (9, 10)] + [(9, TEXTS[8][1]), (10, TEN), (12, TEN)]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    df = spark.createDataFrame(rows + [rows[-1]], "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(df).collect()
    texts = [t.encode() for _, t in rows]
    for k, want in enumerate(expected(texts, 200, "first")):
        assert {(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got if r.doc_id == k} == {want}
    assert len(got) == len(rows) + 1


def test_repeats_of_nothing(docs):
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(docs, length=100)


def test_repeats_of_frequent_passages(spark):
    """One passage in every other text, at another place each time."""
    rows = [(k, words(rng.integers(5, 40)) + (SHARED if k % 2 else "") + words(20)) for k in range(300)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep="none").collect()
    want = expected([t.encode() for _, t in rows], 200, "none")
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == dict(enumerate(want))


def test_longest_previous_factors():
    data = np.frombuffer(bytes(rng.integers(97, 99, 300).astype(np.uint8)) + b"abab" * 20, np.uint8)
    starts = np.arange(len(data) - 40)
    order = suffix_dedup.SuffixOrder(data, starts, 40)
    raw = data.tobytes()
    assert order.order.tolist() == sorted(starts.tolist(), key=lambda i: (raw[i : i + 40], i))

    def common(a, b):
        n = 0
        while n < 40 and raw[a + n] == raw[b + n]:
            n += 1
        return n

    for later in (False, True):
        place, best = suffix_dedup.longest_factors(order, later)
        for p, n in zip(place, best):
            others = starts[starts > p] if later else starts[starts < p]
            assert n == max((common(p, q) for q in others), default=0)


def test_previous_smaller():
    for n in (1, 2, 50):
        values = rng.permutation(n)
        want = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(n)]
        assert suffix_dedup.previous_smaller(values).tolist() == want


def mined(rows, positives, negatives, every):
    """By the rule, from every pair of rows (id, label, whole vector)."""
    rows = [(i, x, v) for i, x, v in rows if i is not None and x is not None and v is not None]
    out = Counter()
    for anchor in {i for i, _, _ in rows if i % every == 0}:
        _, label, v = min(r for r in rows if r[0] == anchor)
        score = lambda w, v=v: int(np.dot(np.array(v, object), np.array(w, object)))
        others = [(i, x, score(w)) for i, x, w in rows if i != anchor and len(w) == len(v)]
        near = sorted((-s, i) for i, x, s in others if x == label)[:positives]
        for s, i in near:
            fit = sorted((-t, j) for j, x, t in others if x != label and 30 * -s <= 100 * t <= 90 * -s)
            for rank, (t, j) in enumerate(fit[:negatives], 1):
                out[(anchor, i, rank, j, -s, -t)] += 1
    return out


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROWS", 40 * 12)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 8 * 12)
    centres = rng.normal(size=(6, 12))
    vectors = [centres[k % 6] * 0.2 + rng.normal(size=12) * 0.1 for k in range(240)]
    rows = [(k, k % 4, v.astype(np.float32).tolist()) for k, v in enumerate(vectors)]
    rows += [(20, 3, [0.5] * 12), (20, 1, [0.25] * 12), (300, 2, [0.0] * 12), (301, 2, [-1.0] * 12)]
    rows += [(302 + k, k % 4, rows[5][2]) for k in range(30)] + [(7, 3, rows[7][2])] * 3
    rows += [(400, 1, [1.0, 2.0]), (401, 1, [1.0, 1.0]), (402, 2, [1.0, 0.25])]
    bad = [(None, 1, [1.0] * 12), (500, None, [1.0] * 12), (510, 1, None), (520, 1, []), (530, 1, [None, *[1.0] * 11])]
    bad += [(540, 1, [float("nan")] * 12), (550, 1, [float("inf"), *[1.0] * 11])]
    df = spark.createDataFrame(
        [(*r, 1, 2.0, "x") for r in rows + bad], "vec_id long, label int, embedding array<float>, id int, score double, rank string"
    ).repartition(3)
    found = hard_negatives.hard_negatives(df, positives=3, negatives=4, every=10)
    got = Counter(tuple(r) for r in found.collect())
    whole = [(i, x, tuple(int(np.floor(256 * np.float64(np.float32(c)))) for c in v)) for i, x, v in rows]
    assert got == mined(whole, 3, 4, 10)
    assert sum(got.values()) > 100
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0
    assert hard_negatives.hard_negatives(df.filter("vec_id is null")).count() == 0


@pytest.mark.parametrize("width", [1, 3, 64, 100])
def test_intervals_hold_every_inner_product(width):
    data = rng.integers(-400, 400, (500, width))
    data[:3] = 0
    anchors = np.concatenate([rng.integers(-400, 400, (20, width)), data[:5]])
    codes, aligned, rest = hard_negatives.encode(data)
    estimate, half = hard_negatives.intervals(codes, aligned, rest, anchors)
    exact = data @ anchors.T
    assert (np.abs(exact - estimate) <= half).all()
    if width == 64:
        assert np.corrcoef(exact.ravel(), estimate.ravel())[0, 1] > 0.7


def test_intervals_leave_rows_out():
    """Of 4,096 rows in 64 dimensions, those near the anchor's direction are scored, the others mostly not."""
    centres = rng.normal(size=(32, 64))
    data = np.floor(40 * (centres[rng.integers(32, size=4096)] + 0.1 * rng.normal(size=(4096, 64)))).astype(np.int64)
    codes, aligned, rest = hard_negatives.encode(data)
    estimate, half = hard_negatives.intervals(codes, aligned, rest, data[:1])
    score = lambda rows: data[rows] @ data[0]
    rows, scores, looked = hard_negatives.search(estimate[:, 0], half[:, 0], score, np.arange(4096), np.arange(1, 4096), -np.inf, np.inf, 5)
    best = np.lexsort((np.arange(1, 4096), -(data[1:] @ data[0])))[:5] + 1
    assert rows.tolist() == best.tolist() and looked < 4096 / 4


def split(text, unit):
    if not text:
        return []
    if unit == "chars":
        return list(text)
    spaces = " \t\n\v\f\r"
    if unit == "lines":
        starts = [0] + [i + 1 for i, c in enumerate(text) if c == "\n" and i + 1 < len(text)]
    else:
        starts = [i for i, c in enumerate(text) if c not in spaces and (i == 0 or text[i - 1] in spaces)]
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]


@pytest.mark.parametrize("unit", ["chars", "words", "lines"])
def test_fill_in_middle(spark, docs, unit):
    more = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 5000))
    found = fim.fill_in_middle(more, unit=unit).withColumn("again", fim.restored(F.col("output"), F.col("form")))
    texts = defaultdict(set)
    for i, t in TEXTS:
        for plus in (0, 1000, 5000):
            texts[None if i is None else i + plus].add(t or "")
    got = found.collect()
    assert len(got) == 3 * len(TEXTS)
    for r in got:
        assert r.again in texts[r.doc_id]
        t = r.again
        units = split(t, unit)
        lead = t[: len(t) - len("".join(units))]
        h = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
        a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
        assert r.n == len(units)
        if not t or "<S>" in t or h[2] % 100 >= 90:
            assert (r.form, r.prefix_units, r.middle_units, r.output) == ("plain", None, None, t)
            continue
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if a:
            prefix = lead + prefix
        elif b:
            middle = lead + middle
        else:
            suffix = lead + suffix
        assert (r.form, r.prefix_units, r.middle_units) == ("spm" if h[3] % 100 < 20 else "psm", a, b - a)
        if r.form == "psm":
            assert r.output == f"<P>{prefix}<S>{suffix}<M>{middle}"
        else:
            assert r.output == f"<S>{suffix}<P>{prefix}<M>{middle}"
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0), unit=unit).count() == 0


def test_wavelet_matrix_ranks_and_selects():
    values = rng.integers(0, 8, 1000).astype(np.uint8)
    matrix = fim.WaveletMatrix(values)
    at = np.array([0, 1, 63, 64, 65, 500, 999, 1000])
    for v in range(8):
        assert matrix.rank(v, at).tolist() == [(values[:i] == v).sum() for i in at]
    some = np.nonzero(np.isin(values, (2, 5)))[0]
    number = np.array([1, 7, len(some)])
    zero, end = np.zeros(3, np.int64), np.full(3, 1000)
    assert matrix.select((2, 5), number, zero, end).tolist() == some[number - 1].tolist()
    assert fim.WaveletMatrix(np.empty(0, np.uint8)).rank(3, np.zeros(1, np.int64)).tolist() == [0]


def test_added_tokens_are_the_tokenizers_own(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> \n", "<|endoftext |>", "x<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in packing.cut_pieces(df).collect():
        want = [*tokenizer.encode(texts[r.id], add_special_tokens=False).ids, 2]
        assert np.frombuffer(r.ids, "<u4").tolist() == want
    assert 50256 in tokenizer.encode(texts[0], add_special_tokens=False).ids


def test_classifier_equals_a_plain_one(spark):
    """Coordinate by coordinate, one row after the other, in the order of the rows' hashes."""
    vocabulary = [f"word{k}" for k in range(12)]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(vocabulary, rng.integers(0, 25)))
        rows.append((i, text, int("word3" in text and "word7" in text)))
    rows += [(120, None, 0), (121, "", 1)]
    df = spark.createDataFrame(rows, "id long, text string, label int").repartition(4)
    z, n, bias = defaultdict(float), defaultdict(float), [0.0, 0.0]
    alpha, beta, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2

    def weight(c):
        if abs(z[c]) <= l1:
            return 0.0
        return ((1 if z[c] > 0 else -1) * l1 - z[c]) / ((beta + math.sqrt(n[c])) / alpha + l2)

    turns = [(r.text, r.label) for r in df.orderBy(F.xxhash64("id"), "id", "label").collect()]
    for _ in range(toxicity.EPOCHS):
        for text, label in turns:
            own = set(toxicity.features([text])[1].tolist())
            w = {c: weight(c) for c in own}
            b = -bias[0] / ((beta + math.sqrt(bias[1])) / alpha)
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()) + b))))
            g = p - label
            for c in own:
                step = (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / alpha
                z[c] += g - step * w[c]
                n[c] += g * g
            step = (math.sqrt(bias[1] + g * g) - math.sqrt(bias[1])) / alpha
            bias[0] += g - step * b
            bias[1] += g * g
    at, w, b = toxicity.fit(df)
    want = {c: weight(c) for c in z if weight(c)}
    assert dict(zip(at.tolist(), w.tolist())) == pytest.approx(want, abs=1e-9) and len(want) > 5
    assert b == pytest.approx(-bias[0] / ((beta + math.sqrt(bias[1])) / alpha), abs=1e-9)


def test_pipeline_judges_rows_by_id_and_text(spark):
    a, b, c = (words(40) for _ in range(3))
    rows = [(1, a), (6, a), (6, b), (7, b + " z"), (9, c), (9, c), (None, a), (None, a), (10, None), (11, ""), (10, None)]
    df = spark.createDataFrame([(i, t, "s", "n") for i, t in rows], "doc_id long, text string, name string, first string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert got.columns == df.columns
    want = Counter([(1, a), (6, b), (9, c), (None, a), (None, a), (10, None), (11, "")])
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want
    assert corpus_pipeline.drop_near_duplicates(spark, df.limit(0), "").count() == 0


def _components(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in linked:
        root[max(find(x), find(y))] = min(find(x), find(y))
    return [find(x) for x in range(n)]


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="supplied tables not present")
def test_pipeline_against_plain_python(spark):
    """Each stage's rows, judged on its own input by plain code."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = common.saved(stage(spark, before, sf), f"plain-{name}")
        steps[name] = (before.collect(), after.collect())
        before = after
    last = corpus_pipeline.run(spark, sf)
    assert last.columns == before.columns
    assert last.select("doc_id", "piece", "length", "ids_crc32").exceptAll(before.select("doc_id", "piece", "length", "ids_crc32")).count() == 0

    given, kept = steps["toxicity"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, labels).collect()}
    assert Counter(kept) == Counter(r for r in given if not scored[r.doc_id])

    given, kept = steps["near_dedup"]
    given = sorted(given, key=lambda r: r.doc_id)
    token = [(r.text or "").encode().lower().split() for r in given]
    sets = [{tuple(t[k : k + 5]) for k in range(max(len(t) - 4, 1))} if t else set() for t in token]
    pairs = [(x, y) for x in range(len(sets)) for y in range(x) if sets[x] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])]
    assert Counter(kept) == Counter(r for k, (r, c) in enumerate(zip(given, _components(len(given), pairs))) if k == c)

    given, kept = steps["substring_dedup"]
    spans = defaultdict(list)
    for r in substring_dedup.repeated_passages(spark.createDataFrame(given, docs.schema)).collect():
        spans[r.id].append((r.start, r.end))
    plain = []
    for r in given:
        word = list(re.finditer(r"[^\x20\x09-\x0D]+", r.text or ""))
        cuts = [m.start() for m in word] + [len(r.text or "")]
        text, at = "", 0
        for start, end in sorted(spans[r.doc_id]):
            text, at = text + r.text[at : cuts[start]], cuts[end]
        plain.append((r.doc_id, text + (r.text or "")[at:] if r.text is not None else None, bool(spans[r.doc_id])))
    assert Counter((r.doc_id, r.text) for r in kept) == Counter((i, t) for i, t, cut in plain if not cut or t.split())
    long = Counter()
    for r in kept:
        token = (r.text or "").encode().lower().split()
        long.update({tuple(token[k : k + 50]) for k in range(len(token) - 49)})
    assert max(long.values(), default=0) <= 1

    given, kept = steps["mixing"]
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    total, taken = sum(map(size, given)), Counter()
    for r in kept:
        taken[r.source] += size(r)
    assert 1.45 * total <= sum(taken.values()) <= 1.5 * total
    assert max(Counter(r.doc_id for r in kept).values()) <= 2

    given, kept = steps["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    length = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in given}
    assert sum(r.length for r in kept) == sum(length[r.doc_id] for r in given)
    full = Counter()
    for r in kept:
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 1024 and len(full) <= 1.02 * -(-sum(full.values()) // 1024) + 1


def test_groups_are_compared_across_batches():
    """Small and large groups, of one block and of two, cut anywhere between batches."""
    base = [rng.integers(0, 2**62, 30).astype(np.int64) for _ in range(12)]
    paragraphs, rows = [], []
    for k in range(150):
        own = base[k % 12].copy()
        own[rng.permutation(30)[: rng.integers(0, 6)]] = rng.integers(0, 2**62)
        paragraphs.append(np.unique(own.view(np.uint64)).view(np.int64))
    for key in range(40):
        members = rng.choice(150, rng.integers(1, 30), replace=False)
        for m in members:
            rows.append((key, 0, 0, 0, int(m)))
        for m in members:
            rows += [(key, 0, 1, int(m) % 2, int(m))]
    rows.sort()
    bits = [int(np.bitwise_or.reduce(np.uint64(1) << (p.view(np.uint64) >> np.uint64(58))).view(np.int64)) for p in paragraphs]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    schema = pa.schema(
        [pa.field(n, t, n not in "ij") for n, t in zip(("key", "i", "j", "block", "print"), kinds)]
        + [("bits", pa.int64()), ("shingles", pa.list_(pa.int64()))]
    )
    batches = []
    for lo in range(0, len(rows), 7):
        some = rows[lo : lo + 7]
        columns = [pa.array(c, t) for c, t in zip(zip(*some), kinds)]
        columns += [pa.array([bits[r[4]] for r in some]), pa.array([paragraphs[r[4]] for r in some], pa.list_(pa.int64()))]
        batches.append(pa.RecordBatch.from_arrays(columns, schema=schema))
    got = {(a, b) for out in substring_dedup._compare(iter(batches)) for a, b in zip(*out.to_pydict().values())}
    want = set()
    groups = defaultdict(list)
    for key, i, j, block, m in rows:
        groups[key, i, j].append((block, m))
    alike = lambda x, y: 100 * len(x & y) >= 75 * len(x | y)
    for (_, i, j), members in groups.items():
        for (b1, x), (b2, y) in itertools.combinations(members, 2):
            if (i == j or b1 != b2) and alike(set(paragraphs[x].tolist()), set(paragraphs[y].tolist())):
                want.add((x, y))
    assert all(alike(set(paragraphs[a].tolist()), set(paragraphs[b].tolist())) for a, b in got)
    assert _components(150, got) == _components(150, want) and len(want) > 50


def test_alike_paragraphs_and_their_components_equal_brute_force(spark):
    """One paragraph a document: what is removed follows from all pairs of paragraphs."""
    texts = []
    for k in range(40):
        own = [f"k{k}x{rng.integers(1000)}" for _ in range(40)]
        texts.append(own)
        for _ in range(rng.integers(0, 4)):
            own = list(own)
            own[rng.integers(40)] = f"new{rng.integers(10**6)}"
            texts.append(own)
    texts = [texts[i] for i in rng.permutation(len(texts))]
    sets = [{tuple(t[i : i + 5]) for i in range(36)} for t in texts]
    pairs = [p for p in itertools.combinations(range(len(sets)), 2) if 100 * len(sets[p[0]] & sets[p[1]]) >= 75 * len(sets[p[0]] | sets[p[1]])]
    least = _components(len(sets), pairs)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(r.id, r.start, r.end, r.kept_id) for r in substring_dedup.repeated_passages(df).collect()}
    assert got == {(i, 0, 40, c) for i, c in enumerate(least) if i != c} and len(got) > 30


def test_bands_of_paragraphs_do_not_meet_by_chance(spark, path):
    """200,000 paragraphs without a common shingle: their keys are all different, and hold the high bits of the least hashes."""
    made = np.random.default_rng(11)
    texts = ["\n".join(" ".join(f"{w:x}" for w in line) for line in made.integers(0, 1 << 62, (1000, 6))) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(range(200)), pa.array(texts)], ["id", "tid", "text"])
    pq.write_table(pa.Table.from_batches(list(substring_dedup._segmenter(iter([batch])))), path("paragraphs"))
    found = spark.read.parquet(path("paragraphs")).select("id", F.inline("paragraphs"))
    keys = found.select("id", "start", F.explode(substring_dedup._keys(range(substring_dedup.BANDS))).alias("key"))
    assert keys.count() == keys.select("key").distinct().count() == 200_000 * substring_dedup.BANDS
    word, _ = hashed([texts[7].encode()])
    run = shingles(word)
    want = set()
    for start in range(0, 6000, 6):
        for j in range(substring_dedup.BANDS):
            least = min(int(mix(run[start : start + 2], 200 + j)[k]) for k in (0, 1))
            want.add((j << 42) + (least >> 22))
    assert {r.key for r in keys.filter("id = 7").collect()} == want


def test_shuffle_files_go_with_their_step(spark, monkeypatch):
    """When a step of the passages is written, the shuffle files it made are deleted before the next step begins."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    left = {}

    def step(df, purpose, real=substring_dedup._step):
        before = shuffles()
        out, until = real(df, purpose), time.time() + 5
        while (more := shuffles() - before) and time.time() < until:
            time.sleep(0.1)
        left[purpose] = len(more)
        return out

    monkeypatch.setattr(substring_dedup, "_step", step)
    own = [" ".join(f"k{k}x{w}" for w in np.random.default_rng(k).integers(0, 1000, 60)) for k in range(20)]
    texts = [*own, *(f"{t} {u}" for t, u in zip(own, own[1:]))]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    assert substring_dedup.repeated_passages(df).count() == 19
    assert len(left) > 5 and not any(left.values()), left


@pytest.mark.parametrize("width", [4, 8, 16, 64])
def test_index_with_many_lists_misses_no_link(spark, monkeypatch, width):
    """About 125 lists, half of the vectors planted beside others at cosines around the threshold."""
    made = np.random.default_rng(width)
    monkeypatch.setattr(embedding_dedup, "Model", lambda sample, lists, real=embedding_dedup.Model: real(sample, 125))
    base = made.normal(size=(900, width))
    base /= np.linalg.norm(base, axis=1)[:, None]
    other = made.normal(size=(900, width))
    other -= (other * base).sum(axis=1)[:, None] * base
    other /= np.linalg.norm(other, axis=1)[:, None]
    cosine = made.uniform(0.92, 0.95, 900)[:, None]
    x = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * other])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = x @ x.T >= 0.93
    np.fill_diagonal(links, False)
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(df).collect()}
    assert [got[i] for i in range(1800)] == links.sum(axis=1).tolist()


def test_cosines_are_taken_in_double_precision(spark):
    rows = [(1, [1.0, 0.0]), (2, [1e-50, 0.0]), (3, [1e300, 1.0]), (4, [0.0, 1e-300])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}


def test_sorted_lists_end_by_their_bounds():
    """On skewed components most queries stop before the lists end; on even ones none does, and the sums are the scores."""
    ended = {}
    for name, data in (("skewed", rng.exponential(40, (600, 4)) ** 2), ("even", rng.normal(0, 100, (600, 64)))):
        data = np.floor(data).astype(np.int64)
        queries = data[:40]
        found = topk.scan(queries, data, 5)
        ended[name] = [step for _, _, step in found]
        for q, (at, scores, _) in zip(queries, found):
            exact = data @ q
            assert (exact[at] == scores).all()
            assert sorted(scores)[-5:] == sorted(exact)[-5:]
            assert set(np.nonzero(exact >= np.sort(exact)[-5])[0]) <= set(at)
    assert np.mean(np.array(ended["skewed"]) < topk.STEPS) > 0.8 and min(ended["even"]) > topk.STEPS // 2


def test_baum_welch_counts_equal_sums_over_all_paths():
    """Whole texts: starts are counted once a text, whatever its length."""
    states, kinds = 3, 5
    made = np.random.default_rng(2)
    model = hmm.Model(made.dirichlet([1] * states), made.dirichlet([1] * states, states), made.dirichlet([1] * kinds, states).T)
    texts = [np.array(t, np.int32) for t in ([0, 1, 2, 3, 4, 0], [4, 4, 1], [2])]
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((kinds, states))
    model.expect(texts, start, move, emit)
    want = np.zeros(states), np.zeros((states, states)), np.zeros((kinds, states))
    for t in texts:
        paths = list(itertools.product(range(states), repeat=len(t)))
        weight = []
        for path in paths:
            w = model.start[path[0]] * model.emit[t[0], path[0]]
            for a, b, x in zip(path, path[1:], t[1:]):
                w *= model.move[a, b] * model.emit[x, b]
            weight.append(w)
        for path, w in zip(paths, np.array(weight) / sum(weight)):
            want[0][path[0]] += w
            for a, b in zip(path, path[1:]):
                want[1][a, b] += w
            for x, s in zip(t, path):
                want[2][x, s] += w
    for a, b in zip((start, move, emit), want):
        assert np.allclose(a, b, atol=1e-12)
    assert start.sum() == pytest.approx(len(texts))


def test_long_and_short_texts_are_counted_together(monkeypatch):
    """By their tokens alone: short texts take no room up to the length of the longest."""
    own, expect, met = np.random.default_rng(8), hmm.Model.expect, []
    model = hmm.Model.first(np.full(hmm.CLASSES + 1, 1 / (hmm.CLASSES + 1)), 4)
    texts = [own.integers(0, 50, n).astype(np.int32) for n in (3000, 1, 40, 2, 700, 40)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in texts], pa.binary())], ["label"])
    count = lambda: next(hmm._expecter(SimpleNamespace(value=model))(iter([batch]))).to_pandas()
    monkeypatch.setattr(hmm.Model, "expect", lambda self, group, *sums: met.append(len(group)) or expect(self, group, *sums))
    monkeypatch.setattr(hmm, "TOGETHER", sum(map(len, texts)))
    together = count()
    monkeypatch.setattr(hmm, "TOGETHER", 1)
    alone = count()
    assert met == [6] + [1] * 6
    assert np.allclose(together, alone, rtol=1e-9)


def test_language_model_reads_its_texts_once_for_all_rounds(spark):
    """Counting, the starting rows, the labels of all rounds and scoring: four times, however many rounds there are."""
    read = spark.sparkContext.accumulator(0)
    texts = [(k, f"a word{k % 7} and word{k % 3}") for k in range(40)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(texts, 2).map(lambda r: read.add(1) or r), "doc_id long, text string")
    docs = hmm.score_texts(docs)
    assert read.value == 4 * len(texts)
    assert docs.count() == len(texts)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_large_groups_make_a_few_rows_of_a_context(spark, monkeypatch, keep):
    """Of one passage in all texts, on which they end alike or not, and of texts that repeat themselves."""
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 3000)
    made = []
    monkeypatch.setattr(suffix_dedup, "saved", lambda df, purpose: made.append((purpose, out := common.saved(df, purpose))) or out)
    own = np.random.default_rng(3)
    letters = lambda n: "".join(own.choice(list("abcdefgh "), n))
    passage, ends = letters(170), [letters(60) for _ in range(4)]
    texts = [letters(250) + passage + ends[k % 4][: own.integers(61)] + letters(250) for k in range(160)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(df, keep=keep).collect()
    rows = [(purpose, frame.count()) for purpose, frame in made if purpose != "contexts"]
    contexts = dict(rows)["snippets"]
    assert contexts >= 160 and sum(n for _, n in rows) < 20 * contexts
    periods = ["xy" * 300, "xy" * 200 + letters(50) + "xy" * 150, "y" * 700, letters(30) + "y" * 300]
    df = spark.createDataFrame(list(enumerate(texts[:40] + periods)), "doc_id long, text string").repartition(3)
    got += suffix_dedup.remove_repeats(df, keep=keep).collect()
    want = [expected([t.encode() for t in part], 200, keep) for part in (texts, texts[:40] + periods)]
    at = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in got]
    assert Counter(at) == Counter((k, e) for part in want for k, e in enumerate(part))
    assert sum(r.n_removed for r in got) > 3000


def test_classifier_keeps_its_sums_in_the_task(spark, monkeypatch):
    """Nothing is broadcast between epochs, and only weights that are not zero reach the driver."""
    rows = [(i, f"{'bad' if i % 3 else 'good'} word{i} x{i % 7}", int(i % 3 > 0)) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, text string, label int").repartition(3)
    sent = []
    collect = type(df).toArrow
    monkeypatch.setattr(type(df), "toArrow", lambda frame: sent.append(out := collect(frame)) or out)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *_: pytest.fail("sums went through the driver"))
    at, w, _ = toxicity.fit(df)
    assert len(at) == len(set(at.tolist())) > 1 and (w != 0).all()
    assert sum(len(t) for t in sent) <= len(at) + 1
