from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.queries import op11_merkle_manifest
from tests.llm.helpers import no_documents, odd_documents

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row) -> str:
    parts = []
    for c in COLUMNS:
        value = None if row[c] is None else str(row[c])
        parts.append("-" if value is None else f"{len(value.encode())}:{value}")
    return sha("".join(parts))


def brute_tree(digests: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root and, for each leaf, the digests left and right of its branch on every level."""
    paths = [[] for _ in digests]
    level, members = list(digests), [[i] for i in range(len(digests))]
    while len(level) > 1:
        above, inside = [], []
        for at in range(0, len(level), 3):
            run = level[at : at + 3]
            for k in range(len(run)):
                for leaf in members[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            inside.append([i for m in members[at : at + 3] for i in m])
        level, members = above, inside
    return level[0], paths


def brute(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source["" if r["source"] is None else "=" + r["source"]].append((r["doc_id"] is not None, r["doc_id"], brute_leaf(r)))
    trees = {s: sorted(of) for s, of in by_source.items()}
    sources = sorted(trees, key=str.encode)
    built = {s: brute_tree([leaf for _, _, leaf in trees[s]]) for s in sources}
    root, top = brute_tree([built[s][0] for s in sources])
    out = []
    for s, up in zip(sources, top):
        for (_, doc_id, leaf), path in zip(trees[s], built[s][1]):
            out.append((doc_id, leaf, built[s][0], root, tuple(path + up)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in df.collect()), key=repr)


def docs(spark, counts: dict):
    rng = random.Random(2)
    rows = [(rng.randrange(10**9), f"text {i} é\n", "en", s, i) for s, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("counts", [{"a": 1}, {None: 1, "a": 2}, {"a": 3, "b": 4, "é": 27, None: 28, "c": 1}, {"a": 728, "b": 729, "c": 730}, {"hot": 2500, **{f"s{i}": 1 for i in range(800)}}])
def test_digests_and_paths_equal_brute_force(spark, counts):
    given = docs(spark, counts)
    want = brute(given.collect())
    assert got(merkle.manifest(given, COLUMNS, "source", "doc_id")) == want


def test_odd_rows_have_a_leaf_each(spark):
    given = odd_documents(spark).withColumns({c: F.lit(1) for c in ("tree", "rank", "digest", "id", "page", "path", "root")})
    found = merkle.manifest(given, COLUMNS, "source", "doc_id")
    assert got(found) == brute(given.collect()) and found.count() == given.count()
    assert merkle.manifest(no_documents(spark), COLUMNS, "source", "doc_id").collect() == []


def test_many_equal_rows(spark):
    given = spark.createDataFrame([(None, "same", "en", "a", 4)] * 3000 + [(1, "other", "en", "a", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    assert got(merkle.manifest(given, COLUMNS, "source", "doc_id")) == brute(given.collect())


def test_a_changed_row_does_not_fold_to_the_root(spark, tmp_path):
    given = docs(spark, {"a": 40, "b": 3})
    given.write.parquet(str(tmp_path / "documents.parquet"))
    for r in op11_merkle_manifest(spark, str(tmp_path)).collect():
        import zlib

        tampered = zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        assert r.verified == (not tampered) == (r.folded_root == r.root)


def test_requests_for_some_leaves_only(spark):
    nodes = spark.range(2000).select(F.lit("t").alias("tree"), F.col("id").alias("rank"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    forest = merkle.build(nodes, "some")
    root, paths = brute_tree([sha(str(i)) for i in range(2000)])
    starts = forest.roots.select("tree", F.array().cast("array<struct<left: string, right: string>>").alias("path"), F.lit(None).alias("kept"))
    asked = nodes.filter("rank IN (0, 728, 729, 1999)").select("tree", "rank", F.lit("x").alias("asked"))
    found = merkle.descend(forest, starts, asked).collect()
    assert forest.roots.first().digest == root
    assert {r["rank"]: [tuple(s) for s in r.path] for r in found} == {i: paths[i] for i in (0, 728, 729, 1999)}
