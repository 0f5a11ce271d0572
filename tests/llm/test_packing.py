from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import packing
from tests.conftest import SF
from tests.llm.helpers import no_documents, odd_documents

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def descending_best_fit(sizes, capacity):
    gaps, n = packing._Gaps(capacity), 0
    for s in sorted(sizes, reverse=True):
        found = gaps.take(s)
        n += found is None
        g, _ = found or (capacity, 0)
        if g > s:
            gaps.add(g - s, 0)
    return n


def check_places(rows, capacity):
    """Sequences are filled from 0 without gaps, and none is too long; returns their number."""
    by = defaultdict(list)
    for offset, length, sequence in rows:
        by[sequence].append((offset, length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def brute_pieces(tokenizer, doc_id, text, capacity, end_id=2):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
    if len(ids) <= capacity:
        parts = [(0, ids)]
    else:
        first = len(ids) % capacity or capacity
        parts = [(0, ids[:first]), *((at, ids[at : at + capacity]) for at in range(first, len(ids), capacity))]
    return [(doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())) for k, (at, part) in enumerate(parts)]


def test_ids_are_the_tokenizers_own(tokenizer):
    rng = random.Random(4)
    texts = ["", " ", "don't  we'll\n\n\tgo ", "<|endoftext|> x", "naïve 東京 1234567 !!!  　x", "a" * 3000, "  \n" * 500]
    signs = "ab Zé\n\t\x1c\x85\xa0 '’.,1²٣東 ​-!\U0001f600"
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 200))) for _ in range(500)]
    for text in texts:
        assert np.frombuffer(bytes(packing.packed_ids(text, PATH)), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n,capacity,want", [(1, 8, [(0, 1)]), (8, 8, [(0, 8)]), (9, 8, [(0, 1), (1, 8)]), (16, 8, [(0, 8), (8, 8)]), (19, 8, [(0, 3), (3, 8), (11, 8)])])
def test_cuts(n, capacity, want):
    assert packing.cuts(n, capacity) == want


def test_pieces_and_places_of_the_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs, PATH).collect()
    want = [p for d in docs.collect() for p in brute_pieces(tokenizer, d.doc_id, d.text, 1024)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    n = check_places([(r.offset, r.length, r.sequence_id) for r in rows], 1024)
    assert n <= descending_best_fit([w[3] for w in want], 1024) + 1


def test_odd_documents(spark, tokenizer):
    docs = odd_documents(spark).withColumns({c: F.lit(1) for c in ("piece", "id", "size", "sequence_id", "offset", "is_doc")})
    rows = packing.pack_documents(docs, PATH, capacity=64).collect()
    want = [p for d in docs.collect() for p in brute_pieces(tokenizer, d.doc_id, d.text, 64)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    check_places([(r.offset, r.length, r.sequence_id) for r in rows], 64)
    assert packing.pack_documents(no_documents(spark), PATH).collect() == []


SIZES = {
    "uniform": lambda rng: rng.randint(1, 64),
    "small": lambda rng: rng.randint(1, 6),
    "one": lambda rng: 1,
    "just over a third": lambda rng: 22,
    "two sizes": lambda rng: rng.choice((20, 44)),
    "full": lambda rng: 64,
}


@pytest.mark.parametrize("kind", SIZES)
def test_many_ranges_pack_about_as_well_as_one(spark, monkeypatch, kind):
    monkeypatch.setattr(packing, "FEW", 100)
    rng = random.Random(6)
    sizes = [SIZES[kind](rng) for _ in range(4000)]
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, size int")
    rows = packing.best_fit(items, 64).collect()
    assert sorted(r.id for r in rows) == list(range(len(sizes)))
    n = check_places([(r.offset, sizes[r.id], r.sequence_id) for r in rows], 64)
    best = descending_best_fit(sizes, 64)
    assert n <= 1.01 * best + 2, (n, best)


def test_ranks_pair_each_gap_once():
    summary = [
        {"part": 0, "docs": 0, "largest": None, "gaps": 3, "smallest": 40},
        {"part": 1, "docs": 2, "largest": 20, "gaps": 2, "smallest": 19},
        {"part": 2, "docs": 7, "largest": 9, "gaps": 0, "smallest": None},
    ]
    pairs, covered = packing.pair_ranges(summary)
    assert pairs == [(1, 0, 2, 0, 0, 2), (2, 0, 4, 1, 0, 2), (2, 4, 7, 0, 1, 4)] and covered == {0: 0, 1: 2, 2: 7}


def test_pieces_of_usual_texts_are_the_librarys():
    import regex

    rng = random.Random(5)
    signs = "abZéßñ'sdtrevml 019_-.,!\n\t\x07\x7f\xa0\"é世"
    for _ in range(3_000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 40)))
        assert packing.USUAL.findall(text) == regex.findall(packing.PIECES, text), text


def test_packed_ids_are_little_endian_words():
    assert packing._packed([]) == b"" and packing._packed([1, 2**32 - 1]) == b"\x01\0\0\0\xff\xff\xff\xff"
