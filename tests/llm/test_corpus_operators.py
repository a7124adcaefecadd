"""Operators over many texts, against brute force: similarity classes, benchmark search, learned scores, the pipeline."""

import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from checkmart.llm import decontamination, ngram_join, quality, toxicity
from checkmart.llm.oracle import ORACLE
from checkmart.llm.queries import QUERIES
from checkmart.llm.tables import components
from compare import connect, difference
from pyspark.sql import functions as F

from llm.conftest import EDGE_TEXTS, SCHEMA, rows_of

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def classes_by_brute_force(texts):
    sets = Counter(shingle_set(t) for _, t in texts)
    kinds = list(sets)
    linked = {
        a: [b for b in kinds if a != b and a and len(a & b) >= 0.8 * len(a | b) - 1e-9] for a in kinds
    }
    label = {}
    for a in kinds:
        todo, group = [a], {a}
        while todo:
            for b in linked[todo.pop()]:
                if b not in group:
                    group.add(b)
                    todo.append(b)
        ids = [i for i, t in texts if shingle_set(t) in group and i is not None]
        label[a] = min(ids) if ids else None
    return Counter((i, label[s], len(linked[s]), sets[s]) for i, s in ((i, shingle_set(t)) for i, t in texts))


def near_texts(n, rng):
    """Groups of texts that differ in a few words."""
    texts = []
    for i in range(n):
        words = [f"g{i % 12}w{k}" for k in range(60)]
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(60)] = f"x{rng.randrange(5)}"
        texts.append((i, " ".join(words)))
    return texts


@pytest.mark.parametrize("chunk", [ngram_join.CHUNK_SHINGLES, 150])
def test_jaccard_classes(spark, edge_docs, no_docs, chunk, monkeypatch):
    """Also with groups cut into many chunks."""
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", chunk)
    texts = near_texts(150, random.Random(1))
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).union(edge_docs)
    got = ngram_join.jaccard_classes(docs).select("doc_id", "class_id", "n_links", "n_copies").collect()
    assert Counter(tuple(r) for r in got) == classes_by_brute_force(texts + EDGE_TEXTS)
    assert ngram_join.jaccard_classes(no_docs).collect() == []


def test_dense_and_indexed_overlaps_agree(monkeypatch):
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 80)).astype(np.uint64)) for _ in range(70)]
    exact = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]

    def gathered():
        parts = list(ngram_join._overlaps(sets))
        assert [first for first, _ in parts] == sorted(first for first, _ in parts)
        out = np.concatenate([np.asarray(rows) for _, rows in parts])
        for i, s in enumerate(sets):  # a shingle in one set only does not count towards others
            out[i, i] = len(s)
        return out.tolist()

    assert gathered() == exact
    monkeypatch.setattr(ngram_join, "_DENSE_FROM", 0)
    monkeypatch.setattr(ngram_join, "_DENSE_CELLS", 1000)
    assert gathered() == exact


def test_banding_reaches_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = ngram_join.banding(threshold, 0.999, 128)
        assert 1 - (1 - threshold**rows) ** bands >= 0.999


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 102), (102, 101), (200, 200)]
    edges = spark.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges, "test").collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


def folded_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def contamination_by_brute_force(texts, items):
    out = []
    for i, t in texts:
        words, hit, found = folded_words(t), set(), set()
        for item_id, item_text in items:
            item = folded_words(item_text)
            n = min(10, len(item))
            wanted = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
            for k in range(len(words) - n + 1):
                if n and tuple(words[k : k + n]) in wanted:
                    hit.update(range(k, k + n))
                    if item_id is not None:
                        found.add(str(item_id))
        out.append((i, len(words), len(hit), tuple(sorted(found))))
    return Counter(out)


def test_contamination(spark, edge_docs, no_docs):
    rng = random.Random(9)
    vocabulary = [f"v{k}" for k in range(12)] + ["The", "É", "ß"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 10, 14, 25])))) for k in range(25)]
    items += [(30, None), (31, "!!!"), (3, items[3][1]), (None, items[5][1]), (32, "the the the the the the the the the the the")]
    texts = []
    for i in range(120):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30)))]
        if i % 3 == 0:
            parts.insert(rng.randint(0, 1), rng.choice(items[:25])[1].upper())
        texts.append((i, "; ".join(parts)))
    texts.append((500, "the " * 200))
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).union(edge_docs)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(docs, benchmark).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in found)
    assert got == contamination_by_brute_force(texts + EDGE_TEXTS, items)
    assert decontamination.contamination(no_docs, benchmark).collect() == []
    nothing = decontamination.contamination(edge_docs, benchmark.limit(0)).collect()
    assert len(nothing) == len(EDGE_TEXTS) and not any(r["n_hit"] for r in nothing)


def test_contamination_without_broadcast(spark, monkeypatch):
    """The shuffled joins beyond the size bound give the same."""
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    items = [(1, " ".join(f"a{k}" for k in range(12)))]
    texts = [(k, " ".join(f"a{j}" for j in range(k, k + 11))) for k in range(4)]
    found = decontamination.contamination(
        spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in found)
    assert got == contamination_by_brute_force(texts, items)


def test_proximity(spark):
    items = decontamination.item_words(spark.createDataFrame([(1, "red fox ran far")], "item_id long, text string"))
    texts = [(1, "red fox ran far"), (2, "a red little fox ran very far"), (3, "red " + "x " * 30 + "fox ran far"), (4, "far")]
    docs = spark.createDataFrame(texts, "id long, text string").withColumn("key", F.xxhash64("text"))
    near, lengths = decontamination.occurrences(docs, items, proximity=2)
    assert {r["id"] for r in near.collect()} == {1, 2}
    assert {r["id"]: r["n_words"] for r in lengths.collect()} == {1: 4, 2: 7, 3: 34, 4: 1}


def scored(spark, label, score):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = toxicity.fold("doc_id", 3) == 1
    rows = score(docs, labels.filter(~held)).join(labels, "doc_id").filter(held).select("score", label).collect()
    return np.array([r["score"] for r in rows]), np.array([r[label] for r in rows])


def test_toxicity_on_held_out_rows(spark):
    def score(docs, labels):
        return toxicity.with_score(docs, toxicity.learn_toxicity(docs, labels), F.col("text"), ["doc_id"])

    p, y = scored(spark, "toxic", score)
    assert ((p >= 0.7) & (y == 0)).sum() <= 0.02 * (y == 0).sum()
    assert ((p >= 0.7) & (y == 1)).sum() >= 0.6 * (y == 1).sum()


def test_quality_on_held_out_rows(spark):
    p, y = scored(spark, "quality", quality.quality_scores)
    assert ((p >= 0.7) == (y == 1)).mean() >= 0.95
    # calibrated: the mean probability is close to the share of good rows
    assert abs(p.mean() - y.mean()) < 0.05


def test_ftrl_equals_brute_force():
    rng = random.Random(5)
    rows = [(sorted(rng.sample(range(16), rng.randint(0, 6))), rng.randint(0, 1)) for _ in range(200)]
    z, n = dict.fromkeys([*range(16), "bias"], 0.0), dict.fromkeys([*range(16), "bias"], 0.0)

    def weight(at):
        if at == "bias":  # not regularised
            return -z[at] * toxicity.ALPHA / (toxicity.BETA + n[at] ** 0.5)
        if abs(z[at]) <= toxicity.L1:
            return 0.0
        rate = (toxicity.BETA + n[at] ** 0.5) / toxicity.ALPHA + toxicity.L2
        return -(z[at] - (toxicity.L1 if z[at] > 0 else -toxicity.L1)) / rate

    for epoch in range(2):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            held = [*rows[k][0], "bias"]
            before = {at: weight(at) for at in held}
            g = 1 / (1 + np.exp(-sum(before.values()))) - rows[k][1]
            for at in held:
                z[at] += g - ((n[at] + g * g) ** 0.5 - n[at] ** 0.5) / toxicity.ALPHA * before[at]
                n[at] += g * g
    weights, bias = toxicity.fit_ftrl([(np.array(at, int), y) for at, y in rows], bits=4, epochs=2)
    assert np.allclose(weights, [weight(at) for at in range(16)]) and abs(bias - weight("bias")) < 1e-9
    assert np.any(weights) and not np.all(weights)


def test_features_equal_brute_force():
    texts = ["Red fox, red fox!", "", "fox", "red  FOX ran far"]
    at, owner = toxicity.features([t.encode() for t in texts])
    seen = []
    for k, t in enumerate(texts):
        ws = re.findall("[a-z0-9]+", t.lower())
        expected = Counter(
            [("w", w) for w in ws]
            + [(size, w[:size]) for size in toxicity.BEGINNINGS for w in ws]
            + [("p", *p) for p in zip(ws, ws[1:])]
            + [("s", *p) for p in zip(ws, ws[2:])]
        )
        found = Counter(at[owner == k].tolist())
        assert sorted(found.values()) == sorted(expected.values())
        seen.append((expected, found))
    for expected, found in seen:
        for other, also in seen:  # a coordinate is shared where a feature is
            assert sorted((found & also).values()) == sorted((expected & other).values())


def test_labels_that_differ_teach_nothing(spark):
    labels = [(1, 0), (1, 1), (2, 1), (2, 1), (3, 0), (None, 1), (4, None)]
    for rows in (labels, labels[::-1]):
        df = spark.createDataFrame(rows, "id long, y int")
        assert {tuple(r) for r in toxicity.sample_of(df, "id", "y", 10).collect()} == {(2, 1), (3, 0)}


def test_repeated_ids_are_learned_once(spark):
    texts = [(i, f"good word{i % 7}" if i % 2 else f"vile word{i % 7}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    once = spark.createDataFrame(texts, "doc_id long, text string")
    more = spark.createDataFrame(texts + [(3, "zz later text")] * 50 + texts[:9], "doc_id long, text string").repartition(5)
    one, other = toxicity.learn_toxicity(once, labels), toxicity.learn_toxicity(more, labels)
    assert np.array_equal(one[0], other[0]) and one[1] == other[1] and np.any(one[0])
    score = {}
    for name, docs in (("once", once), ("more", more)):
        rows = quality.quality_scores(docs.filter("text <> 'zz later text'"), labels, label_col="toxic").collect()
        score[name] = {r["doc_id"]: round(r["score"], 2) for r in rows}
    assert score["once"].keys() == score["more"].keys()


def test_scores_on_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame(
        [(3, 1, 0), (4, 1, 1), (8, 0, 0), (8, 0, 0), (None, 1, 1), (10, None, None), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for given in (labels, labels.limit(0)):
        model = toxicity.learn_toxicity(edge_docs, given)
        for rows in (
            toxicity.with_score(edge_docs, model, F.col("text"), ["doc_id"]),
            quality.quality_scores(edge_docs, given),
        ):
            found = rows.collect()
            assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in EDGE_TEXTS)
            assert all(0 <= r["score"] <= 1 for r in found)
    assert quality.quality_scores(no_docs, labels).collect() == []
    model = toxicity.learn_toxicity(no_docs, labels)
    assert toxicity.with_score(no_docs, model, F.col("text"), ["doc_id"]).collect() == []


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), ORACLE[name], connect(SMALL)) == []


def test_pipeline_stages_on_edge_cases(spark, edge_docs, no_docs):
    docs = edge_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, SMALL)
        assert docs.columns == corpus_pipeline.COLUMNS
        assert docs.count() <= before
        assert stage(spark, no_docs, SMALL).collect() == [], name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SMALL).count() >= docs.count()
    assert last(spark, no_docs, SMALL).collect() == []


def test_near_copy_stage_keeps_one_of_each_group(spark, edge_docs):
    left = corpus_pipeline.drop_near_copies(spark, edge_docs, SMALL).select("doc_id", "text").collect()
    groups = {}
    for r in left:
        groups.setdefault(shingle_set(r["text"]), []).append(r["doc_id"])
    assert all(len(ids) == 1 for ids in groups.values())
    kept = {r["doc_id"] for r in left}
    assert {1, 3, 8, 10, 11, 12, -4} <= kept and not kept & {2, 4, 5, 7}


def test_pipeline_run(spark):
    """Contaminated, toxic and repeated documents are gone; ids of the rest are complete."""
    rows = corpus_pipeline.run(spark, SMALL).collect()
    totals, lengths = {}, Counter()
    for r in rows:
        totals[r["doc_id"]] = r["doc_tokens"]
        lengths[r["doc_id"]] += r["length"]
    assert totals == dict(lengths)
    found = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hit = contamination_by_brute_force([(r["doc_id"], r["text"]) for r in found], items)
    assert not {i for i, _, n, _ in hit if n} & set(totals)
    assert len(totals) > 0.5 * len(found)
