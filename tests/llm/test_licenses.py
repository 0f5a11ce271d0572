from __future__ import annotations

import random
import re

from tests.llm.helpers import no_documents, odd_documents
from tidemark.llm.licenses import BASE, scan_licenses


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for label, phrase in BASE:
        p = phrase.split()
        own = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += own
        labels |= {label} if own else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_equals_brute_force(spark):
    rng = random.Random(3)
    vocabulary = "under the mit license apache version 2 cc by nc É word Under-the MIT".split(" ")
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 400)))) for i in range(60)]
    rows += [(100, "Under the\nMIT License under the mit license"), (101, "cc-by-nc CC BY NC cc by nc cc by"), (102, None)]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), i
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_notices_are_found_with_small_changes(spark):
    rows = [
        (1, "This work is licensed under the GNU General Public License, version 3."),
        (2, "This work is licensed under the said GNU General Public License, version 3."),
        (3, "Redistribution and use in source and binary forms, with or without any modification, are permitted provided that the following conditions are met:"),
        (4, "the general public got a license to work in version 3"),
    ]
    got = {r.doc_id: (r.labels, r.n_base, r.score) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ("gpl-3", 0, 1.0) and got[2][0] == "" or got[2][0] == "gpl-3"
    assert got[3][0] == "bsd" and got[4] == ("", 0, 0.0)


def test_odd_rows(spark):
    got = scan_licenses(odd_documents(spark))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = sorted((r.doc_id or -1, r.n_words, r.n_base, r.first_word, r.labels) for r in got.collect())
    assert len(rows) == 12 and rows[0] == (-1, 7, 0, None, "") and [r[1] for r in rows if r[0] == 1] == [7, 7]
    assert [r[1] for r in rows if r[0] in (2, 3, 4, 5)] == [0, 0, 0, 40_000]
    assert scan_licenses(no_documents(spark)).count() == 0
