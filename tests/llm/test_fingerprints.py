from __future__ import annotations

import hashlib
import random

import numpy as np
import xxhash

from tests.llm.helpers import no_documents, odd_documents, words
from tidemark.llm.fingerprints import Lexicon, compare_edited, edited, fingerprints, learn_lexicon, likeness, terms_of


def corpus(n=300):
    rng = random.Random(3)
    return [(i * 3, " ".join(rng.choice(W) for _ in range(rng.randint(0, 80)))) for i in range(n)]


W = words(random.Random(9), 400)


def test_lexicon_equals_brute_force(spark):
    rows = corpus()
    counts: dict[int, int] = {}
    for _, text in rows:
        for t in terms_of(text).tolist():
            counts[t] = counts.get(t, 0) + 1
    got = learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), low=0.03, high=0.1)
    assert got.tolist() == sorted(t for t, n in counts.items() if 0.03 * 300 <= n <= 0.1 * 300)


def test_comparison_equals_brute_force(spark):
    rows = corpus() + [(1000, None), (1001, ""), (1002, "é" * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    lexicon = learn_lexicon(docs, low=0.01)
    known = Lexicon(lexicon)
    want = {}
    rows = sorted((i, t or "") for i, t in rows)
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        changed = edited(text, following)
        a, b = known.fingerprint(text), known.fingerprint(changed)
        want[i] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, likeness(a, b), likeness(a, known.fingerprint(following)))
    for parts in (1, 2, 9):
        got = compare_edited(docs, lexicon, parts)
        assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want


def by_hand(text: str | None, lexicon: set[int]) -> str:
    """A fingerprint written out in whole numbers, one term at a time."""
    two64 = 1 << 64

    def scatter(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % two64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % two64
        return x ^ x >> 31

    digest = lambda terms: xxhash.xxh64_hexdigest(b"".join(t.to_bytes(8, "little") for t in terms))
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found, word = set(), ""
    for c in lowered + " ":
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 127:
            word += c
        elif word:
            found.add(xxhash.xxh64_intdigest(word.encode()))
            word = ""
    if not found:
        return "0"
    own = sorted(found & lexicon)
    if not own:
        return "x" + digest(sorted(found))
    out = [digest(own)]
    for i in range(8):
        for power in (3, 5, 7, 9, 11):
            # a part of one in 2 ** power terms: the lowest bits of the term's draw are all 0
            part = [t for t in own if scatter((t + (i + 1) * 0x632BE59BD9B4E019) % two64) % (1 << power) == 0]
            out.append(digest(part) if part else "0")
    return "-".join(out)


def likeness_by_hand(a: str, b: str) -> float:
    if a == b:
        return 1.0
    one, two, best = a.split("-")[1:], b.split("-")[1:], 0.0
    if one and two:
        for size in range(5):
            equal = [one[k] == two[k] for k in range(size, 40, 5) if one[k] != "0" or two[k] != "0"]
            if len(equal) > 2:
                best = max(best, sum(equal) / len(equal))
    return best


def test_fingerprints_equal_those_written_out_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lexicon = learn_lexicon(docs)
    terms, rows = set(lexicon.tolist()), sorted((r.doc_id, r.text or "") for r in docs.collect())
    for k, r in enumerate(compare_edited(docs, lexicon).orderBy("doc_id").collect()):
        text, following = rows[k][1], rows[(k + 1) % len(rows)][1]
        n = len(text) // 4
        changed = (text[:-n] if n else text) + following[:n]
        prints = [by_hand(t, terms) for t in (text, changed, following)]
        assert (r.fingerprint, r.edited_fingerprint) == tuple(prints[:2])
        assert r.near_edited == likeness_by_hand(*prints[:2]) and r.near_next == likeness_by_hand(prints[0], prints[2])


def test_edits_are_nearer_than_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = compare_edited(docs, learn_lexicon(docs)).collect()
    assert len(rows) == docs.count()
    near, far = (np.mean([r[c] for r in rows]) for c in ("near_edited", "near_next"))
    assert near > far + 0.2
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    lexicon = learn_lexicon(docs)
    for parts in (None, 1, 4):
        got = compare_edited(docs, lexicon, parts).collect()
        assert len(got) == 12
        prints = {}
        for r in got:
            if r.doc_id in (1, None):
                prints.setdefault("same", set()).add(r.fingerprint)
            if r.doc_id in (2, 3):
                prints.setdefault("empty", set()).add(r.fingerprint)
        assert len(prints["same"]) == 1 and prints["empty"] == {"0"}
    assert sorted(r.doc_id or -1 for r in fingerprints(docs, lexicon).collect()) == [-1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    empty = no_documents(spark)
    assert len(learn_lexicon(empty)) == 0 and compare_edited(empty, learn_lexicon(empty)).count() == 0
    one = docs.filter("doc_id = 10")
    assert compare_edited(one, learn_lexicon(one)).first().near_next == 1.0
