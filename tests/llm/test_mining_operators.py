"""Operators 11 to 13 against brute force."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from checkmart.llm import collocations, hard_negatives, simhash_trie
from checkmart.llm.queries import QUERIES

from .conftest import CLASHES, EDGE_TEXTS, SCHEMA


def full_rows(spark, rows):
    """Rows (doc_id, text, lang) with values in every further column."""
    return spark.createDataFrame([(i, t, lang, None, None, *["x"] * len(CLASHES.split())) for i, t, lang in rows], SCHEMA)


# collocations


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def expected_collocations(rows, threshold, longest=4, per_lang=2000, covered=80):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    out = []
    frequent = {key: a for key, a in counts.items() if a >= threshold and len(key[1]) > 1}
    for (lang, phrase), a in frequent.items():
        size = len(phrase)
        cuts = [(k, counts[lang, phrase[:k]], counts[lang, phrase[k:]]) for k in range(1, size)]
        score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, x, y in cuts)
        inside = any(
            other == lang and len(longer) > size and 100 * b >= covered * a
            and any(longer[i : i + size] == phrase for i in range(len(longer) - size + 1))
            for (other, longer), b in frequent.items()
        )
        if not inside:
            out.append((lang, -score, -a, " ".join(phrase).encode(), left, right))
    ranked = []
    for lang, group in itertools.groupby(sorted(out), key=lambda r: r[0]):
        for rank, (_, score, a, phrase, left, right) in enumerate(itertools.islice(group, per_lang), 1):
            ranked.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return ranked


def collocation_rows():
    draw = random.Random(3)
    words = ["the", "The", "of", "red", "car", "é", "Éa", "x\x00y", "z w", "\x1c"]
    rows = []
    for n in range(60):
        tokens = draw.choices(words, k=draw.randint(0, 60))
        text = "".join(w + draw.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\x0b"]) for w in tokens)
        rows.append((n, text + " new york city hall " * draw.randint(0, 3), draw.choice(["en", "und", None, "de"])))
    return [*rows, (1, None, "en"), (2, "", None), (3, " ;. ", "fr"), (4, "ab cd", "fr"), *rows[:5]]


@pytest.mark.parametrize("chunk", [collocations.CHUNK_BYTES, 90])
def test_collocations_equal_brute_force(spark, monkeypatch, chunk):
    rows = collocation_rows()
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    got = collocations.collocations(full_rows(spark, rows).repartition(3), threshold=4, per_lang=25)
    expected = expected_collocations([(t, lang) for _, t, lang in rows], 4, per_lang=25)
    assert sorted(map(tuple, got.collect())) == sorted(expected) and len(expected) > 30


def test_collocations_of_a_full_bit_table_are_the_same(spark, monkeypatch):
    rows = collocation_rows()
    monkeypatch.setattr(collocations, "MOST_BITS", 6)
    got = collocations.collocations(full_rows(spark, rows), threshold=4)
    assert sorted(map(tuple, got.collect())) == sorted(expected_collocations([(t, lang) for _, t, lang in rows], 4))


def test_a_summary_loses_no_frequent_key():
    draw = np.random.default_rng(5)
    for threshold in (2, 7, 30):
        keys = np.concatenate([draw.integers(0, 5000, 6000), np.repeat(draw.integers(5000, 6000, 40), threshold)])
        draw.shuffle(keys)
        keys = keys.astype(np.uint32)
        parts = np.array_split(keys, 50)
        for slack in (1, 4):
            summary = collocations.Summary(slack * len(keys) // threshold + 1)
            for part in parts:
                summary.add(*np.unique(part, return_counts=True))
            kept = set(summary.reaching(threshold).tolist())
            assert {k for k, n in Counter(keys.tolist()).items() if n >= threshold} <= kept
            assert len(summary.keys) <= summary.capacity and summary.error < threshold


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**18
    counts = spark.createDataFrame(
        [("en", "a b", 2, big), ("en", "a", 1, big), ("en", "b", 1, big), ("en", "", 0, 1)],
        "lang string, phrase string, size int, occurrences long",
    )
    assert [(r.a, r.score) for r in collocations.cut_scores(counts).collect()] == [(big, 1_000_000)]


# hard negatives


def expected_negatives(rows, anchor=100, positives=5, negatives=10):
    out = []
    for q, label, v in rows:
        if q % anchor:
            continue
        scored = sorted((-int(np.dot(v, w)), i, other == label) for i, other, w in rows if i != q)
        for score, p, _ in [s for s in scored if s[2]][:positives]:
            found = [(i, -s) for s, i, same in scored if not same and 30 * -score <= 100 * -s <= 90 * -score]
            out.extend((q, p, r, i, -score, s) for r, (i, s) in enumerate(found[:negatives], 1))
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, tree string, site int, vector string, score double"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "t", 1, "v", 0.5) for i, v, label in rows], VECTORS)


@pytest.mark.parametrize("tree_rows", [hard_negatives.TREE_ROWS, 60])
def test_hard_negatives_equal_brute_force(spark, tree_rows):
    draw = np.random.default_rng(2)
    centers = draw.normal(size=(6, 8))
    plain = [(n, (centers[n % 6] + draw.normal(size=8) / 2).astype(np.float32).tolist(), int(draw.integers(0, 3))) for n in range(-150, 450)]
    plain += [(1000 + n, plain[7][1], 1) for n in range(20)]  # ties
    plain += [(600, [0.0] * 8, 2), (700, plain[9][1], 9)]  # a zero vector, a label of its own
    useless = [(None, [1.0] * 8, 1), (2000, None, 1), (2100, [1.0] * 8, None), (2200, [1.0] * 7 + [None], 1), (2300, [float("nan")] * 8, 1), (2400, [float("inf")] * 8, 1)]
    frame = vector_frame(spark, plain + plain[:40] + useless).repartition(3)
    got = hard_negatives.hard_negatives(frame, tree_rows=tree_rows)
    whole = [(i, label, np.floor(256 * np.array(v, np.float64))) for i, v, label in plain]
    expected = expected_negatives(whole)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 200


def test_cover_tree_invariants():
    draw = np.random.default_rng(4)
    vectors = np.floor(draw.normal(size=(900, 5)) * 300)
    vectors[100:130] = vectors[5]
    tree = hard_negatives.cover_tree(vectors, np.arange(900), np.zeros(900, np.int64), leaf=6)
    assert sorted(tree.ids.tolist()) == list(range(900)) and np.array_equal(tree.vectors, vectors[tree.ids])
    lifted = hard_negatives.augmented(tree.vectors)
    assert np.allclose(np.linalg.norm(lifted, axis=1), np.linalg.norm(vectors, axis=1).max())

    def below(node):
        rows = list(range(*tree.points[node]))
        for child in range(*tree.children[node]):
            rows += below(child)
        return rows

    for node in range(len(tree.radii)):
        away = np.linalg.norm(lifted[below(node)] - lifted[tree.centers[node]], axis=1)
        assert away.max() <= tree.radii[node] + 1e-9  # covering
        centers = lifted[tree.centers[slice(*tree.children[node])]]
        for i, j in itertools.combinations(range(len(centers)), 2):  # separation
            assert np.linalg.norm(centers[i] - centers[j]) > tree.radii[node] / hard_negatives.SHRINK
    # a search does not open every node
    best = hard_negatives.Best(-(2**63), 2**63 - 1, 3)
    verified = hard_negatives.search(tree, tree.vectors[17], 0, True, int(tree.ids[17]), [best])
    scores = tree.vectors @ tree.vectors[17]
    order = np.lexsort((tree.ids, -scores))
    order = order[tree.ids[order] != tree.ids[17]][:3]
    assert best.ids.tolist() == tree.ids[order].tolist() and verified < 900 / 2


def test_products_are_exact_or_refused():
    vectors, query = np.array([[2.0**30, 1.0]]), np.array([2.0**30, 3.0])
    kind = hard_negatives.exact(vectors, query)
    assert (vectors.astype(kind) @ query.astype(kind)).tolist() == [2**60 + 3]
    assert hard_negatives.exact(vectors / 2**10, query) is np.float64
    with pytest.raises(OverflowError):
        hard_negatives.exact(vectors * 2**10, query)
    for p in range(-7, 400):
        low, high = hard_negatives.window_of(p)
        assert [s for s in range(-50, 400) if 30 * p <= 100 * s <= 90 * p] == list(range(low, high + 1))


def test_hard_negatives_of_no_rows_and_several_lengths(spark):
    assert hard_negatives.hard_negatives(vector_frame(spark, [])).count() == 0
    rows = [(0, [1.0, 1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, [0.5], 2), (3, [], 2), (4, [0.25, 0.25, 0.25, 9.0], 2)]
    got = hard_negatives.hard_negatives(vector_frame(spark, rows)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 4, 256 * 384, 64 * 768), (0, 1, 2, 2, 256 * 384, 128 * 256)][:2]


# SimHash


def expected_print(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered(text)) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected_components(prints, budget=2):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for x, y in itertools.combinations(values, 2):
        if (x ^ y).bit_count() <= budget:
            root[find(x)] = find(y)
    return [find(v) for v in prints]


def test_simhash_of_edge_documents(spark, edge_docs, no_docs):
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash_trie.near_duplicates(edge_docs).collect()), key=str)
    prints = [expected_print(t) for _, t in EDGE_TEXTS]
    roots = expected_components(prints)
    least = {}
    for (i, _), r in zip(EDGE_TEXTS, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    expected = [(i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(EDGE_TEXTS, prints, roots, strict=True)]
    assert got == sorted(expected, key=str)
    assert simhash_trie.near_duplicates(no_docs).count() == 0


def some_prints(draw, clusters, each, alone):
    """Dense corners, where fingerprints differ in few bits, and fingerprints of their own."""
    out = {draw.getrandbits(64) for _ in range(alone)} | {0, 1, 2**64 - 1}
    for _ in range(clusters):
        center = draw.getrandbits(64)
        bits = draw.sample(range(64), 9)
        for _ in range(each):
            out.add(center ^ sum(1 << b for b in draw.sample(bits, draw.randint(0, 4))))
    return sorted(out)


@pytest.mark.parametrize("pair_size", [simhash_trie.PAIR_SIZE, 24])
def test_trie_self_join_equals_brute_force(spark, pair_size):
    prints = some_prints(random.Random(6), 4, 60, 150)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    joined = {r.node: r.component for r in simhash_trie.print_components(frame, pair_size=pair_size).collect()}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    roots = expected_components(prints)
    groups = {}
    for p, r in zip(signed, roots, strict=True):
        groups.setdefault(r, []).append(p)
    expected = {p: min(g) for g in groups.values() for p in g if len(g) > 1}
    assert {n: c for n, c in joined.items()} == expected and len(expected) > 100


@pytest.mark.parametrize("budget", [0, 1, 3])
def test_linked_finds_every_pair_of_two_nodes(budget):
    prints = np.array(some_prints(random.Random(8), 3, 80, 60), np.uint64)
    roots = expected_components([int(p) for p in prints], budget)
    parent = simhash_trie.linked(prints, None, 0, 0, budget)
    assert [parent[i] == parent[j] for i, j in itertools.combinations(range(len(prints)), 2)] == [
        roots[i] == roots[j] for i, j in itertools.combinations(range(len(prints)), 2)
    ]
    low, high = prints[prints >> np.uint64(63) == 0], prints[prints >> np.uint64(63) == 1]
    parent = simhash_trie.linked(low, high, 1, 1, budget)
    for i, j in itertools.product(range(len(low)), range(len(high))):
        if (int(low[i]) ^ int(high[j])).bit_count() <= budget:
            assert parent[i] == parent[len(low) + j]


def test_long_texts_are_summed_in_slabs(monkeypatch):
    text = " ".join(f"w{n % 311}" for n in range(2000))
    monkeypatch.setattr(simhash_trie, "_SLAB", 64)
    assert simhash_trie.fingerprint(text.encode()) == expected_print(text)


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op13_simhash_near_dedup"])
def test_queries_of_edge_tables(spark, tmp_path, edge_docs, name):
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES[name](spark, str(tmp_path))
    assert got.count() == (len(EDGE_TEXTS) if "op13" in name else got.filter(F.col("a") >= 30).count())
