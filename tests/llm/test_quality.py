from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from tests.llm.helpers import no_documents, odd_documents
from tidemark.llm.quality import STATISTICS, RuleEnsemble, draw_examples, learn_rules, score_quality, with_statistics
from tidemark.llm.queries import op5_rule_ensemble

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op5_rule_ensemble(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in rows if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_rules_compile_to_what_they_say(spark):
    """The column gives the same score as the rules evaluated one by one in Python."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    ensemble = learn_rules(draw_examples(docs, labels))
    assert 0 < len(ensemble.rules) < 200
    import math

    for r in with_statistics(docs).withColumn("score", ensemble.score()).limit(100).collect():
        total = ensemble.intercept + sum(w for rule, w in ensemble.rules if all(low < r[n] <= high for n, low, high in rule.bounds))
        assert abs(1 / (1 + math.exp(-total)) - r.score) < 1e-9


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = with_statistics(docs).collect()
    assert len(rows) == 12 and all(r[s] is not None for r in rows for s in STATISTICS)
    assert all(r[s] == 0 for r in rows if r.doc_id in (2, 3) for s in STATISTICS)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, 1), (None, 1, 0), (10, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    got = score_quality(docs, learn_rules(draw_examples(docs, labels)))
    assert got.count() == 12 and got.filter(F.col("score").isNull()).count() == 0
    assert score_quality(no_documents(spark), RuleEnsemble(0.0, [])).count() == 0


def test_too_little_to_learn_from(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert learn_rules(draw_examples(docs, labels)).intercept > 1
    assert learn_rules(draw_examples(docs, labels.limit(0))).intercept == 0
