from __future__ import annotations

import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.helpers import near_copies, words
from tests.llm.test_near_dedup import brute as brute_groups
from tidemark.llm.common import stage
from tidemark.llm.decontaminate import COVER, tiles, words_of
from tidemark.llm.language_id import Compressor, learn_dictionaries
from tidemark.llm.pii import Pseudonyms
from tidemark.llm.queries import EXAMPLE_KEY

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two languages, near copies, benchmark passages in order and moved, personal data, junk, nulls."""
    rng = random.Random(11)
    path = tmp_path_factory.mktemp("corpus")
    en = lambda n: words(rng, n, "abcdeflmnt")
    fr = lambda n: words(rng, n, "éèouvrsqij")
    items = [" ".join(en(30)) for _ in range(4)]
    texts = [(" ".join(en(rng.randint(20, 90))), "en") for _ in range(60)] + [(" ".join(fr(rng.randint(20, 90))), "fr") for _ in range(40)]
    texts += [(t, "en") for t in near_copies(rng, en(80), 8, 1)] + texts[:5]
    moved = items[1].split()
    texts += [(" ".join(en(40)) + " " + items[0] + " " + " ".join(en(40)), "en"), (" ".join(moved[15:] + en(30) + moved[:15]), "en")]
    texts += [(" ".join(en(20)) + " write to ab.12@mail1.example.com or +1 (667) 555-4170 or 4111111111111111 now", "en")]
    texts += [("123 456 !!!", "en"), ("", "en"), (None, None), (" ".join(en(25)), None)]
    rows = [(i, t, lang, f"s{i % 3}", None if t is None else len(t)) for i, (t, lang) in enumerate(texts)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_equal_brute_force(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "pii", "mix"]
    steps = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    kept = stage(steps["language_id"](spark, docs, folder), "t")
    judge = Compressor(learn_dictionaries(docs)).judge
    want = {i for i, r in rows.items() if not judge(r.text)[2]}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want
    assert {i for i, r in rows.items() if r.text and len(r.text) > 100} <= want and len(rows) - len(want) >= 3

    single = stage(steps["near_dedup"](spark, kept, folder), "t")
    want = {i for i, _, root, own in brute_groups([(i, rows[i].text) for i in want], 5, 80) if own}
    assert {r.doc_id for r in single.collect()} == want

    clean = stage(steps["decontaminate"](spark, single, folder), "t")
    items = [words_of(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = {i for i in want if any(sum(k for *_, k in tiles(words_of(rows[i].text), w)) >= COVER * len(w) for w in items)}
    assert len(found) == 2 and {r.doc_id for r in clean.collect()} == want - found

    hidden = stage(steps["pii"](spark, clean, folder), "t")
    apply = Pseudonyms(EXAMPLE_KEY).apply
    got = {r.doc_id: r for r in hidden.collect()}
    assert hidden.columns == docs.columns and set(got) == want - found
    assert all(r.text == apply(rows[i].text)[0] and r.n_chars == len(r.text) for i, r in got.items())
    assert sum(r.text != rows[i].text for i, r in got.items()) == 1

    mixed = steps["mix"](spark, hidden, folder).collect()
    assert {r.doc_id for r in mixed} <= set(got) and all(r.text == got[r.doc_id].text for r in mixed)
    assert abs(sum(r.tokens for r in mixed) / sum(len((r.text or "").split()) for r in got.values()) - 1) < 0.2


def test_run_gives_the_last_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "text", "lang", "source", "n_chars", "repeats", "pass", "mix_block", "mix_order"} <= set(out.columns) and out.count() > 50


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_rest_stands_without_this_part(tmp_path):
    repo = Path(corpus_pipeline.__file__).parent
    rest = tmp_path / "repo"
    shutil.copytree(repo, rest, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "corpus_pipeline.py"))
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') for k in q), 'pipeline' in q)"],
        cwd=rest, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONDONTWRITEBYTECODE": "1"},
    )
    assert said.stdout.split()[1:] == ["False", "False"], said.stderr
    assert not [p for p in (rest / "tidemark").rglob("*.py") if "llm" in p.read_text()]
