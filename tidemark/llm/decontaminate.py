"""Benchmark decontamination by greedy string tiling.

Runs of words that a document shares with a benchmark item are found by a join of their hashes. For each such pair
the two texts are tiled: the longest common runs are marked, longest first and never overlapping, until none of the
least length is left. Since tiles may stand in any order, the share of the item's words they cover also tells
passages whose sentences were moved. Runs of one length are compared by a rolling hash (running Karp-Rabin).
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, map_batches, mix, rows_of, stage, word_hashes

#: Words of the shortest tile, and of the seeds that are joined.
SHORTEST = 5
#: Share of an item's words that tiles must cover.
COVER = 0.5
#: Words that tiles must cover besides, or all of a shorter item: a few common words in a row prove nothing.
LEAST = 8
#: Bits that tell most seeds of documents from those of the benchmark before the join.
BITS = 1 << 24
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> np.ndarray:
    """Hashes of the words: runs of letters, digits and signs outside ASCII, with A-Z lower-cased."""
    return word_hashes(WORD.findall((text or "").encode().lower()))


class Rolling:
    """Hashes of all runs of any one length, from sums over the text so far."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.powers = np.cumprod(np.full(n + 1, _BASE, np.uint64), dtype=np.uint64)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(words) * self.powers[:n], dtype=np.uint64)))

    def runs(self, length: int) -> np.ndarray:
        n = len(self.sums) - 1 - length + 1
        return (self.sums[length:] - self.sums[:n]) * self.powers[:n][::-1] if n > 0 else np.empty(0, np.uint64)


def _free_runs(marked: np.ndarray, length: int) -> np.ndarray:
    """Where ``length`` unmarked words begin."""
    sums = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(sums[length:] == sums[:-length]) if len(marked) >= length else np.empty(0, np.intp)


def tiles(doc: np.ndarray, item: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two arrays of words: (start in doc, start in item, length), longest first.

    Of equally long matches the one that begins first in the document, then in the item, is marked.
    """
    found: list[tuple[int, int, int]] = []
    if min(len(doc), len(item)) < shortest:
        return found
    # Run hashes of both texts must agree, so both are rolled as one text.
    rolling, cut = Rolling(np.concatenate((doc, item))), len(doc)
    in_doc, in_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    length = max(shortest, min(len(doc), len(item)))
    while True:
        hashes = rolling.runs(length)
        at_item: dict[int, list[int]] = defaultdict(list)
        for j in _free_runs(in_item, length):
            at_item[int(hashes[cut + j])].append(int(j))
        starts = _free_runs(in_doc, length)
        starts = starts[np.isin(hashes[starts], np.array(list(at_item), np.uint64))] if at_item else starts[:0]
        matches: list[tuple[int, int, int]] = []
        for i in map(int, starts):
            for j in at_item[int(hashes[i])]:
                if i and j and not in_doc[i - 1] and not in_item[j - 1] and doc[i - 1] == item[j - 1]:
                    continue  # it continues a match that begins earlier
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and not in_doc[i + k] and not in_item[j + k]:
                    k += 1
                if k >= length:
                    matches.append((k, i, j))
        if matches:
            # Only the longest are marked before the next look: what marks leave of others may still be long enough.
            longest = max(matches)[0]
            for k, i, j in sorted(m for m in matches if m[0] == longest):
                if not in_doc[i : i + k].any() and not in_item[j : j + k].any():
                    in_doc[i : i + k] = in_item[j : j + k] = True
                    found.append((i, j, k))
        elif length > shortest:
            length = max(shortest, length // 2)
        else:
            return sorted(found, key=lambda t: (-t[2], t[0], t[1]))


def _probes(hashes):
    return (hashes & np.uint64(BITS - 1)).astype(np.int64), ((hashes >> np.uint64(24)) & np.uint64(BITS - 1)).astype(np.int64)


def _seed_maker(shortest: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "item_id", "text"):
            for item_id, text in zip(ids, texts):
                words = words_of(text)
                seeds, places = np.unique(gram_hashes(words, shortest), return_counts=True)
                probes = np.concatenate(_probes(seeds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item_id], pa.int64()), pa.array([text], pa.string()), pa.array([len(words)], pa.int64()), pa.array([seeds.view(np.int64)], pa.list_(pa.int64())), pa.array([places], pa.list_(pa.int64())), pa.array([probes], pa.list_(pa.int64()))],
                    names=["item_id", "item_text", "item_words", "seeds", "places", "probes"],
                )

    return make


def _has(bits: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """Whether each number is in the filter, eight places a byte; number p is at place p - 1, number 0 at the last."""
    at = (probes - 1) & (BITS - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _hit_finder(shortest: int, sent: Broadcast):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for ids, texts in rows_of(batches, "doc_id", "text"):
            out: list[tuple] = []
            for doc_id, text in zip(ids, texts):
                grams = gram_hashes(words_of(text), shortest)
                one, two = _probes(grams)
                hits = np.unique(grams[_has(bits, one) & _has(bits, two)])
                if len(hits):
                    out.append((doc_id, hashlib.md5(text.encode()).digest(), text, hits.view(np.int64)))
            kinds = (pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["doc_id", "digest", "text", "hits"])

    return find


def _tiler(shortest: int, cover: float, least: int):
    inner = pa.struct([("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())])

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, digests, texts, items, item_texts in rows_of(batches, "doc_id", "digest", "text", "item_id", "item_text"):
            out: list[tuple] = []
            for doc_id, digest, text, item_id, item_text in zip(ids, digests, texts, items, item_texts):
                item = words_of(item_text)
                found = tiles(words_of(text), item, shortest)
                matched = sum(k for _, _, k in found)
                if matched >= max(cover * len(item), min(least, len(item))):
                    spans = [{"doc_start": i, "item_start": j, "length": k} for i, j, k in found]
                    out.append((doc_id, digest, item_id, matched / len(item), matched, len(found), spans))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.list_(inner))
            names = ["doc_id", "digest", "item_id", "coverage", "matched", "n_tiles", "tiles"]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=names)

    return tile


def _bits(seeds: DataFrame) -> np.ndarray:
    """The filter of all seeds: BITS bits at most, whatever the size of the benchmark."""
    probes = seeds.select(F.explode("probes").alias("p"))
    parts = probes.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    bits = np.zeros(BITS // 8, np.uint8)
    for row in parts.collect():
        # Buckets count from 1 and hold 2^15 numbers; bucket 0 holds number 0 alone.
        if row["bucket"]:
            part = np.frombuffer(bytes(row["bits"]), np.uint8)
            start = (row["bucket"] - 1) * (1 << 12)
            bits[start : start + len(part)] |= part
        else:
            bits[-1] |= 128
    return bits


def find_contaminated(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """Pairs of a document and an item whose words its tiles cover by ``cover`` or more, and at least ``least`` of them or all.

    doc_id, digest (MD5 of the text), item_id, coverage (share of the item's words), matched (words), n_tiles, tiles
    (array of doc_start, item_start, length, in words). Clean documents give no row.

    A null or empty text, and an item of fewer than ``shortest`` words, match nothing. Rows with equal ids and texts
    give one row for each item; null ids are allowed. Empty tables on either side give an empty result. Only the
    columns named are looked at.

    Documents are read once; only those with a hit on the filter are kept, with their text. The join of seeds is exact, and a pair is tiled
    only if its seeds could reach the coverage: a tile of k words has k + 1 - shortest seeds, a shortest-th of k at least.
    A seed counts as often as the item has it, since an item that repeats itself has fewer seeds than places for them.
    """
    given = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = stage(map_batches(given, _seed_maker(shortest), "item_id long, item_text string, item_words long, seeds array<long>, places array<long>, probes array<long>"), "items")
    bits = docs.sparkSession.sparkContext.broadcast(_bits(items))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hits = stage(map_batches(texts, _hit_finder(shortest, bits), "doc_id long, digest binary, text string, hits array<long>").dropDuplicates(["doc_id", "digest"]), "hits")
    seeds = items.select("item_id", "item_words", F.inline(F.arrays_zip(F.col("seeds").alias("seed"), F.col("places").alias("places"))))
    shared = hits.select("doc_id", "digest", F.explode("hits").alias("seed")).join(seeds, "seed")
    pairs = shared.groupBy("doc_id", "digest", "item_id", "item_words").agg(F.sum("places").alias("n")).filter(F.col("n") * shortest >= cover * F.col("item_words"))
    pairs = stage(pairs.select(F.col("doc_id").alias("__doc"), F.col("digest").alias("__digest"), F.col("item_id").alias("__item")), "pairs")
    both = hits.join(pairs, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("digest") == F.col("__digest")))
    both = both.join(items.select("item_id", "item_text"), F.col("__item").eqNullSafe(F.col("item_id"))).select("doc_id", "digest", "text", "item_id", "item_text")
    return map_batches(
        both,
        _tiler(shortest, cover, least),
        "doc_id long, digest binary, item_id long, coverage double, matched long, n_tiles long, tiles array<struct<doc_start:long,item_start:long,length:long>>",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The input's rows without those whose text is contaminated; columns unchanged."""
    found = stage(find_contaminated(docs, benchmark, **options).select(F.col("digest").alias("__found")).distinct(), "contaminated")
    return docs.join(found, F.unhex(F.md5("text")) == F.col("__found"), "left_anti")
