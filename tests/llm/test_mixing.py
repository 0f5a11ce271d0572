from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.helpers import no_documents, odd_documents, words
from tidemark.llm.mixing import mix_sources, plan_mixture, weight_exponent


def sample(spark, sizes):
    rng = random.Random(4)
    rows = [(s * 1000 + i, " ".join(words(rng, rng.randint(1, 30))), f"s{s}") for s, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_exponent_meets_the_entropy(spark):
    sizes = [900, 300, 100, 30, 10]
    sources = spark.createDataFrame([(s,) for s in sizes], "tokens long")
    for aim in (0.7, 0.8, 0.9, 0.99):
        x = weight_exponent(sources, aim, 1e9, 1000)
        p = [(s / sum(sizes)) ** x for s in sizes]
        p = [v / sum(p) for v in p]
        assert abs(-sum(v * math.log(v) for v in p) - aim * math.log(5)) < 1e-3 or x == 1
    limited = weight_exponent(sources, 0.99, 3.0, sum(sizes))
    p = [(s / sum(sizes)) ** limited for s in sizes]
    assert abs(p[-1] / sum(p) * sum(sizes) / sizes[-1] - 3) < 1e-2


def test_budget_equals_brute_force(spark):
    docs = sample(spark, [150, 40, 12, 3])
    planned = plan_mixture(docs, block=200).collect()
    total = sum(r.tokens for r in planned)
    by = defaultdict(list)
    for r in planned:
        by[r.source].append(r)
    for rows in by.values():
        size, goal = sum(r.tokens for r in rows), math.floor(total * rows[0].weight)
        used, want = 0, {}
        blocks = math.ceil(size / 200)
        for r in sorted(rows, key=lambda r: (int(r.mix_key[:8], 16) * blocks // 2**32, r.mix_key)):
            used += r.tokens
            want[r.doc_id] = goal // size + (used <= goal % size)
        assert {r.doc_id: r.repeats for r in rows} == want
        taken = sum(r.tokens * r.repeats for r in rows)
        assert goal - 30 < taken <= goal


def test_shares_as_they_are_take_every_document(spark):
    # No exponent gives equal sources less than the full entropy, so that their shares stay.
    for n in (49, 98, 103):
        docs = spark.createDataFrame([(i, f"one two three {i}", f"s{i % n}") for i in range(n * 3)], "doc_id long, text string, source string")
        assert {r.repeats for r in plan_mixture(docs).collect()} == {1}
        assert {r.repeats for r in plan_mixture(docs, budget=n * 3 * 4 * 2).collect()} == {2}


def test_mixture_has_every_copy(spark):
    docs = sample(spark, [60, 20, 2])
    planned = {r.doc_id: r.repeats for r in plan_mixture(docs, block=100).collect()}
    mixed = mix_sources(docs, block=100)
    assert set(docs.columns) <= set(mixed.columns)
    rows = mixed.collect()
    assert Counter(r.doc_id for r in rows) == Counter({k: v for k, v in planned.items() if v})
    assert all(sorted(r["pass"] for r in rows if r.doc_id == i) == list(range(1, n + 1)) for i, n in planned.items() if n)
    assert len({r.mix_block for r in rows}) > 3


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("weight", F.lit("x")).withColumn("mix_key", F.lit(1))
    rows = plan_mixture(docs).collect()
    assert len(rows) == 12 and all(r.tokens == 0 and r.repeats == 1 for r in rows if r.doc_id in (2, 3, 4))
    again = [r.repeats for r in rows if r.doc_id == 1]
    assert again[0] == again[1]
    assert mix_sources(no_documents(spark)).count() == 0
    only_empty = odd_documents(spark).filter("doc_id in (2, 3)")
    assert sorted(r.doc_id for r in mix_sources(only_empty).collect()) == [2, 3]
