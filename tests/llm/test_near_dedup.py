from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.helpers import near_copies, no_documents, odd_documents, words
from tidemark.llm.components import components
from tidemark.llm.near_dedup import drop_near_duplicates, near_duplicates, parity_sketch, shingle_set, super_min_hash


def brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_equals_brute_force(spark, size):
    rng = random.Random(1)
    texts = [" ".join(words(rng, rng.randint(1, 60))) for _ in range(60)]
    for _ in range(6):
        texts += near_copies(rng, words(rng, rng.randint(12, 80)), 12, rng.randint(1, 4))
    texts += texts[:15]
    # A chain: each is like the next one, and the ends are not alike.
    chain = words(rng, 100)
    texts += [" ".join(chain[6 * k :] + words(rng, 6 * k, "qrstuv")) for k in range(6)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=size)
    assert {tuple(r) for r in got.collect()} == brute(rows, size, 80)


def test_many_hubs_are_needed(spark):
    """Members like each other but not like the hub of their buckets are still joined, with no round of hubs too."""
    rng = random.Random(2)
    base = words(rng, 60)
    rows = list(enumerate(near_copies(rng, base, 60, 5)))
    expected = brute(rows, 2, 80)
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string")
    for rounds in (0, 1, 2):
        assert {tuple(r) for r in near_duplicates(docs, shingle=2, hub_rounds=rounds).collect()} == expected


def test_signature_tells_similarity():
    rng = np.random.default_rng(3)
    for share in (0.3, 0.8):
        errors = []
        for _ in range(60):
            pool = rng.integers(0, 2**63, 400).astype(np.uint64)
            k = int(200 * 2 * share / (1 + share))
            a, b = super_min_hash([np.sort(pool[:200]), np.sort(pool[200 - k : 400 - k])], 200)
            errors.append((a == b).mean() - k / (400 - k))
        assert abs(np.mean(errors)) < 0.02
        # Not more variance than independent minima have.
        assert np.var(errors) < 1.3 * share * (1 - share) / 200


def test_signatures_do_not_depend_on_company():
    rng = np.random.default_rng(4)
    sets = [np.sort(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 3, 40, 700, 5000)]
    together = super_min_hash(sets, 200)
    for s, row in zip(sets, together):
        assert (super_min_hash([s], 200)[0] == row).all()


def test_components(spark):
    edges = [(5, 1), (5, 9), (9, 12), (2, 3), (7, 7), (3, 2), (2, 3)] + [(100 + i, 101 + i) for i in range(30)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(n, 1) for n in (1, 5, 9, 12)} | {(2, 2), (3, 2)} | {(100 + i, 100) for i in range(31)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd_documents(spark), shingle=2).collect())
    by_id = {g[0]: g for g in got}
    assert len(got) == 12 and got[0] == (-1, 6, None, True)
    assert [g for g in got if g[0] == 1] == [(1, 6, 1, True)] * 2
    assert by_id[2] == (2, 0, 2, True) and by_id[3] == (3, 0, 3, True) and by_id[4] == (4, 0, 4, True)
    assert by_id[6][2:] == (5, False) and by_id[8] == (8, 1, 7, False)
    assert near_duplicates(no_documents(spark)).count() == 0
    kept = drop_near_duplicates(odd_documents(spark), shingle=2)
    assert kept.columns == odd_documents(spark).columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 1, 2, 3, 4, 5, 7, 9, 10]


def test_rows_with_one_id_are_one_document(spark):
    rows = [(1, "a b c d e f g h i j k"), (2, "a b c d e f g h i j k"), (2, "l m n o p q r s t u v"), (3, "l m n o p q r s t u v"), (4, "w x y z")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2)
    assert sorted({(r.doc_id, r.component_id) for r in got.collect()}) == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(9)
    base, other = words(rng, 80), words(rng, 80)
    near = near_copies(rng, base, 3, 1)
    rows = [(1, " ".join(base), "a"), (1, " ".join(base), "a"), (1, " ".join(base), "b"), (None, " ".join(base), "a"), (None, near[0], "a"), (2, near[1], "a")]
    rows += [(None, " ".join(other), "c"), (None, " ".join(other), "c"), (None, near_copies(rng, other, 1, 1)[0], "d"), (None, " ".join(words(rng, 30)), "e")]
    rows += [(None, None, "f"), (None, None, "f"), (None, " ", "f"), (3, None, "g"), (3, None, "g"), (3, " ".join(words(rng, 30)), "g"), (4, None, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = drop_near_duplicates(docs, one_row=True)
    assert got.columns == docs.columns
    kept = got.collect()
    assert sorted((r.doc_id or -1, r.source) for r in kept if r.source not in "abcd") == [(-1, "e"), (-1, "f"), (-1, "f"), (-1, "f"), (3, "g"), (3, "g"), (4, "h")]
    assert [r.doc_id for r in kept if r.source in "ab"] == [1] and [r.doc_id for r in kept if r.source in "cd"] == [None]
    stage = {(r.doc_id, r.text) for r in corpus_pipeline.dedupe(spark, docs, "").collect()}
    assert stage == {(r.doc_id, r.text) for r in kept}
    assert drop_near_duplicates(no_documents(spark), one_row=True).count() == 0


def test_words_are_cut_at_white_space_only():
    assert len(shingle_set("A-b c d", 1)) == 2 and (shingle_set("A b", 2) == shingle_set("a\x0bB", 2)).all()
    assert not (shingle_set("É", 1) == shingle_set("é", 1)).all()


def test_sketches_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(5)
    for n in (1, 50, 3000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[n // 10 :], rng.integers(0, 2**63, n // 5).astype(np.uint64))))
        bits = sum(int(x).bit_count() for x in (parity_sketch(a) ^ parity_sketch(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b)) and bits >= 0.6 * min(400, len(np.setxor1d(a, b)))
