"""I-Match fingerprints over randomised lexicons.

The lexicon holds the terms whose share of documents lies in a band: neither so frequent that they tell nothing nor
so rare that they may be slips. A document's distinct terms in the lexicon are sorted and hashed. To outlive small
edits, this is done again for several random parts of the lexicon: a part that none of the changed terms is in gives
the same hash as before. Parts of several sizes serve documents of several lengths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, rows_of, stage, word_hashes

#: Shares of documents between which a term's lies. By the lower one the lexicon has a bound: (distinct terms of an
#: average document) / LOW terms at most, however many documents there are.
LOW, HIGH = 0.0005, 0.2
#: Sizes of the random parts (one in so many terms), and how many there are of each.
ONE_IN, EACH = (8, 32, 128, 512, 2048), 8
#: Parts of a size must give so many hashes to be compared.
ENOUGH = 3
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Rows of a range at most, on average; ranges have at least 500 where the session's shuffle partitions allow for more.
RANGE = 20_000
#: Distinct terms that a task holds before it hands its counts on.
HELD = 2_000_000


def terms_of(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the terms: runs of letters, digits and signs outside ASCII, with A-Z lower-cased."""
    return np.unique(word_hashes(TERM.findall((text or "").encode().lower())))


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms with the number of documents that have them, summed over a task's documents as far as they fit in memory."""
    held: list[np.ndarray] = []
    terms, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def fold():
        nonlocal terms, counts, held
        every = np.concatenate([terms, *held])
        weights = np.concatenate([counts, np.ones(len(every) - len(terms), np.int64)])
        terms, at = np.unique(every, return_inverse=True)
        counts, held = np.bincount(at, weights, len(terms)).astype(np.int64), []

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], names=["term", "n"])

    waiting = 0
    for (texts,) in rows_of(batches, "text"):
        for text in texts:
            held.append(terms_of(text))
            waiting += len(held[-1])
            if waiting >= HELD:
                fold()
                waiting = 0
                if len(terms) >= HELD:
                    yield given()
                    terms, counts = terms[:0], counts[:0]
    fold()
    yield given()


def learn_lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the terms that ``low`` to ``high`` of all documents have (at least two documents)."""
    texts = docs.select(F.col(text_col).alias("text"))
    n = docs.count()
    counts = texts.mapInArrow(_counter, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    kept = counts.filter((F.col("n") >= max(2.0, low * n)) & (F.col("n") <= high * n)).select("term")
    return np.sort(np.array([r["term"] for r in kept.toLocalIterator()], np.int64).view(np.uint64))


class Lexicon:
    """Fingerprints of texts by a lexicon and its random parts."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms

    def fingerprint(self, text: str | None) -> str:
        """Hashes joined by ``-``: of all terms in the lexicon, then of each part; ``0`` where a part has no term of the text.

        A text without a term in the lexicon has the first hash only, of all its terms (``0`` without any).
        """
        every = terms_of(text)
        if not len(every):
            return "0"
        own = every
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, every), len(self.terms) - 1)
            own = every[self.terms[at] == every]
        if not len(own) or not len(self.terms):
            return "x" + xxhash.xxh64_hexdigest(every.tobytes())
        out = [xxhash.xxh64_hexdigest(own.tobytes())]
        for i in range(EACH):
            part, draw = own, mix(own + np.uint64((i + 1) * 0x632BE59BD9B4E019 & (2**64 - 1)))
            for one_in in ONE_IN:
                stay = (draw & np.uint64(one_in - 1)) == 0
                part, draw = part[stay], draw[stay]
                out.append(xxhash.xxh64_hexdigest(part.tobytes()) if len(part) else "0")
        return "-".join(out)


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints; else the share of equal hashes among the places where either has one.

    The share is taken for each size of parts by itself, and the best counts: the larger a document, the smaller the
    parts that tell how much of it has changed.
    """
    if a == b:
        return 1.0
    _, *one = a.split("-")
    _, *two = b.split("-")
    best = 0.0
    for size in range(len(ONE_IN) if one and two else 0):
        pairs = [(x, y) for x, y in zip(one[size :: len(ONE_IN)], two[size :: len(ONE_IN)]) if x != "0" or y != "0"]
        if len(pairs) >= ENOUGH:
            best = max(best, sum(x == y for x, y in pairs) / len(pairs))
    return best


def fingerprints(docs: DataFrame, lexicon: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, fingerprint. Null text counts as empty; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lexicon(shared.value)
        for ids, texts in rows_of(batches, "doc_id", "text"):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([known.fingerprint(t) for t in texts], pa.string())], names=["doc_id", "fingerprint"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return given.mapInArrow(make, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last quarter (rounded down) replaced by as many first signs of the one that follows, or all."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter] if quarter else text


def _dealer(cuts: list[int], edges: dict[int | None, list[int]]):
    """Rows with the range of ids they belong to, and once more for each range that they follow."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=3)
        bounds = np.array(cuts, np.int64)
        for ids, texts in rows_of(batches, "doc_id", "text"):
            out: list[tuple] = []
            for doc_id, text in zip(ids, texts):
                raw = (text or "").encode()
                part = 0 if doc_id is None else int(np.searchsorted(bounds, doc_id, "right"))
                for target, edge in [(part, False), *((e, True) for e in edges.get(doc_id, ()))]:
                    out.append((target, edge, doc_id, hashlib.md5(raw).digest(), zip_.compress(raw)))
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["part", "edge", "doc_id", "digest", "packed"])

    return deal


def _first_finder(cuts: list[int]):
    """The smallest id of each range in a task's rows, null being smaller than all."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, first = np.array(cuts, np.int64), {}
        for (ids,) in rows_of(batches, "doc_id"):
            for doc_id in set(ids):
                part = 0 if doc_id is None else int(np.searchsorted(bounds, doc_id, "right"))
                if part not in first or doc_id is None or first[part] is not None and doc_id < first[part]:
                    first[part] = doc_id
        yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.int32()), pa.array(list(first.values()), pa.int64())], names=["part", "doc_id"])

    return find


def _comparer(shared):
    kinds = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, unzip = Lexicon(shared.value), zstandard.ZstdDecompressor()
        before: tuple[int, int | None, str, str] | None = None  # the part, id, text and fingerprint that wait for their next
        for parts, edges, ids, packed in rows_of(batches, "part", "edge", "doc_id", "packed"):
            out: list[tuple] = []
            for part, edge, doc_id, raw in zip(parts, edges, ids, packed):
                if edge and (before is None or before[0] != part):
                    continue  # a further row with the id of the first that follows
                text = unzip.decompress(raw).decode()
                own = known.fingerprint(text)
                if before is not None:
                    changed = edited(before[2], text)
                    theirs = known.fingerprint(changed)
                    out.append((before[1], len(before[2]), hashlib.sha256(changed.encode()).hexdigest(), before[3], theirs, likeness(before[3], theirs), likeness(before[3], own)))
                before = None if edge else (part, doc_id, text, own)
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds.values())], names=list(kinds))

    return compare


def compare_edited(docs: DataFrame, lexicon: np.ndarray, parts: int | None = None) -> DataFrame:
    """One row per document: how its fingerprint holds out against an edit, and differs from its neighbour's.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next (``likeness`` to the
    fingerprints of the edited text and of the next document's). The next document is that with the next larger id;
    rows with equal ids follow in the order of the MD5 of their texts, null ids come first; after the last comes the
    first. Null text counts as empty. A single row follows itself; an empty table gives none.

    Rows are dealt out by ranges of the id, compressed, in one shuffle. The first row of each range also goes to the
    range before it, so that ranges are compared independently; one text at a time is held.
    """
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = given.select("doc_id").filter("doc_id is not null")
    n = known.count()
    parts = parts or max(1, -(-n // RANGE), min(n // 500, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts = sorted({int(c) for c in known.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts)}) if n and parts > 1 else []
    firsts = given.select("doc_id").mapInArrow(_first_finder(cuts), "part int, doc_id long")
    firsts = firsts.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("f"))
    firsts = [(r["part"], r["f"]["doc_id"]) for r in firsts.orderBy("part").collect()]
    edges: dict[int | None, list[int]] = {}
    for i, (_, doc_id) in enumerate(firsts):
        edges.setdefault(doc_id, []).append(firsts[i - 1][0])
    dealt = given.mapInArrow(_dealer(cuts, edges), "part int, edge boolean, doc_id long, digest binary, packed binary")
    dealt = dealt.repartition("part").sortWithinPartitions("part", "edge", F.col("doc_id").asc_nulls_first(), "digest")
    shared = spark.sparkContext.broadcast(lexicon)
    return dealt.mapInArrow(
        _comparer(shared),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
