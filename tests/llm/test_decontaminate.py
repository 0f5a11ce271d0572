from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tests.llm.helpers import no_documents, odd_documents, words
from tidemark.llm.common import map_batches
from tidemark.llm.decontaminate import BITS, SHORTEST, _bits, _has, drop_contaminated, find_contaminated, tiles, words_of


def brute_tiles(doc, item, shortest):
    """The longest common run of unmarked words, again and again."""
    d, t, found = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and not d[i + k] and not t[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < shortest:
            return found
        d[i : i + k] = t[j : j + k] = [True] * k
        found.append((i, j, k))


def test_tiles_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        size = rng.choice([2, 3, 8])
        doc = [rng.randrange(size) for _ in range(rng.randint(0, 40))]
        item = [rng.randrange(size) for _ in range(rng.randint(0, 25))]
        if rng.random() < 0.5 and len(doc) > 12:
            item = doc[6:12] + item + doc[:5]
        shortest = rng.choice([2, 3, 5])
        got = tiles(np.array(doc, np.uint64), np.array(item, np.uint64), shortest)
        want = brute_tiles(doc, item, shortest)
        assert sorted(k for *_, k in got) == sorted(k for *_, k in want)
        used_d, used_i = set(), set()
        for i, j, k in got:
            assert doc[i : i + k] == item[j : j + k]
            assert not used_d & set(range(i, i + k)) and not used_i & set(range(j, j + k))
            used_d |= set(range(i, i + k))
            used_i |= set(range(j, j + k))


def test_reordered_passages_are_found(spark):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, 40))) for i in range(12)]
    docs = []
    for i, text in items[:8]:
        w = text.split()
        moved = w[20:30] + words(rng, 5) + w[:12] + words(rng, 7) + w[30:]
        docs.append((i, " ".join(words(rng, 100) + moved + words(rng, 100))))
    docs += [(100 + i, " ".join(words(rng, 200))) for i in range(30)]
    docs += [(200, " ".join(items[9][1].split()[:12] + words(rng, 50))), (201, items[10][1].upper() + " " + items[11][1])]
    got = find_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    rows = got.collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(i, i) for i in range(8)} | {(201, 10), (201, 11)}
    for r in rows:
        doc, item = dict(docs)[r.doc_id], dict(items)[r.item_id]
        assert r.matched == sum(t.length for t in r.tiles) and abs(r.coverage - r.matched / 40) < 1e-9 and r.n_tiles == len(r.tiles)
        brute = brute_tiles(list(words_of(doc)), list(words_of(item)), SHORTEST)
        assert sum(k for *_, k in brute) == r.matched


def test_items_that_repeat_themselves_are_found(spark):
    rng = random.Random(3)
    fill = lambda n: " ".join(words(rng, n, "uvwxyz"))
    refrain = " ".join(["yes", "no", "none", "both", "neither"] * 12)
    a, b, c = (" ".join(words(rng, 5)) for _ in range(3))
    items = [(1, refrain), (2, " ".join([a, fill(5), b, fill(5), a, fill(5), c, fill(5)])), (3, "la " * 40)]
    docs = [(1, f"{fill(80)} {refrain} {fill(80)}"), (2, " ".join([fill(9), a, fill(3), c, fill(3), a, fill(3), b, fill(9)])), (3, fill(20) + " la" * 60), (4, f"{fill(50)} {a} {fill(50)}")]
    got = find_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.coverage) for r in got.collect()} == {(1, 1, 1.0), (2, 2, 0.5), (3, 3, 1.0)}


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven"), (2, "word"), (3, None), (None, "un deux trois quatre cinq six sept huit")], "item_id long, text string")
    docs = odd_documents(spark)
    got = {(r.doc_id, r.item_id, r.coverage) for r in find_contaminated(docs, items).collect()}
    assert got == {(1, 1, 1.0), (None, 1, 1.0), (10, None, 1.0)}
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 6, 7, 8, 9]
    assert find_contaminated(no_documents(spark), items).count() == 0
    assert find_contaminated(docs, items.limit(0)).count() == 0
    assert drop_contaminated(docs, items.limit(0)).count() == 12


def test_filter_holds_its_numbers_and_no_others(spark):
    given = [0, 1, 7, 8, 9, 32_767, 32_768, 32_769, BITS - 32_768, BITS - 2, BITS - 1]
    bits = _bits(spark.createDataFrame([(given[:5],), (given[5:],), ([],)], "probes array<long>"))
    near = np.unique(np.clip(np.add.outer(given, range(-9, 10)).ravel(), 0, BITS - 1))
    assert near[_has(bits, near)].tolist() == given
    assert len(bits) * 8 == BITS and int(np.unpackbits(bits).sum()) == len(given)


def test_batches_are_bounded_unless_the_session_says_otherwise(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting, None)
    long = spark.range(0, 40, 1, 1).selectExpr("repeat('x', 1000000) AS text")
    rows = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)
    try:
        spark.conf.unset(setting)
        counts = [r.n for r in map_batches(long, rows, "n long").collect()]
        assert sum(counts) == 40 and max(counts) <= 6
        spark.conf.set(setting, "1g")
        assert [r.n for r in map_batches(long, rows, "n long").collect()] == [40]
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
