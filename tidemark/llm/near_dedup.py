"""MinHash near-duplicates: SuperMinHash signatures, banding, verification, union of verified links.

A SuperMinHash signature has m slots. Every element of a set visits the slots in a random order of its own; in
round j it offers j plus a random fraction to the slot it visits, and a slot keeps the smallest offer. Within one
element the ranks of the slots are thus a permutation, which lowers the variance against independent minima, and
once every slot has an offer from a round, later rounds can't win: the loop stops early.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, map_batches, mix, rows_of, stage, word_hashes
from .components import components

#: 40 bands of 5 slots miss a pair of similarity 0.8 with probability (1 - 0.8 ** 5) ** 40, about 1e-7.
BANDS, ROWS = 40, 5
#: Bits of a parity sketch.
SKETCH = 1024
#: Members of a group that are held against each other in one piece.
BLOCK = 512
#: Elements handled at a time; the order of visits takes one byte for each of them and slot.
CHUNK = 65_536


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; the whole sequence when there are fewer words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(size, len(words))) ^ np.uint64(min(size, len(words))))


def super_min_hash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures, one row of ``slots`` values for each non-empty set."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seed = np.concatenate(sets)
    best = np.full(len(sets) * slots, np.iinfo(np.uint64).max, np.uint64)
    order = None
    for j in range(slots):
        draw = mix(seed + np.uint64((0x9E3779B97F4A7C15 * (j + 1)) & (2**64 - 1)))
        pick = j + ((draw >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.intp)
        if order is None:
            slot = pick
        else:
            at = np.arange(len(seed))
            slot = order[at, pick].astype(np.intp)
            order[at, pick] = order[:, j]
        offer = np.uint64(j << 32) | (draw & np.uint64(0xFFFFFFFF))
        np.minimum.at(best, owner * slots + slot, offer)
        open_ = (best.reshape(-1, slots) == np.iinfo(np.uint64).max).any(axis=1)
        if not open_.any():
            break
        stay = open_[owner]
        if order is None:
            seed, owner, first = seed[stay], owner[stay], pick[stay]
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(seed), 1))
            order[np.arange(len(seed)), first] = 0
        elif not stay.all():
            seed, owner, order = seed[stay], owner[stay], order[stay]
    return best.reshape(-1, slots)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band of a signature."""
    parts = signatures.reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019), parts.shape[:2])
    for i in range(rows):
        key = mix(key + parts[:, :, i])
    return key.view(np.int64)


def _signer(size: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            sets = [shingle_set(t, size) for t in texts]
            counts = np.array([len(s) for s in sets])
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            keys = np.zeros((len(sets), bands), np.int64)
            full = np.flatnonzero(counts)
            cuts = np.flatnonzero(np.diff(np.cumsum(counts[full]) // CHUNK)) + 1
            for part in np.split(full, cuts):
                if len(part):
                    keys[part] = band_keys(super_min_hash([sets[i] for i in part], bands * rows), bands, rows)
            offsets = pa.array(np.concatenate(([0], np.cumsum(np.where(counts > 0, bands, 0)))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys[full].ravel())),
                ],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return sign


def parity_sketch(elements: np.ndarray) -> np.ndarray:
    """SKETCH bits as int64: each element flips one. Two sets' sketches differ in no more bits than the sets in elements."""
    flips = np.bincount((elements & np.uint64(SKETCH - 1)).astype(np.intp), minlength=SKETCH) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def _set_maker(size: int):
    longs = pa.list_(pa.int64())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            sets = [shingle_set(t, size) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], longs),
                    pa.array([parity_sketch(s) for s in sets], longs),
                ],
                names=["doc_id", "digest", "shingles", "sketch"],
            )

    return make


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) whose full shingle sets reach the similarity.

    A hub is in one pair with each of its copies. Its set is repeated for every ``BLOCK`` of them, so that they are
    dealt to many tasks and none holds more than a block of one key.
    """
    degree = pairs.groupBy(F.col("b").alias("hub")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = pairs.join(degree, F.col("b") == F.col("hub")).select("a", "b", F.pmod(F.xxhash64("a"), "blocks").cast("int").alias("block"))
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = degree.join(sets, F.col("hub") == F.col("doc_id")).select(F.col("hub").alias("b"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    total = F.size("sa") + F.size("sb")
    return dealt.join(right, ["b", "block"]).join(left, "a").filter(100 * both >= percent * (total - both)).select("a", "b").distinct()


def _unsettled(buckets: DataFrame, found: DataFrame | None) -> DataFrame:
    """Entries of the buckets whose members are in several components, with their component; c1 is the bucket's largest."""
    here = buckets.withColumn("component", F.col("rep"))
    if found is not None:
        here = buckets.join(found, F.col("rep") == F.col("node"), "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("component"))
    mixed = here.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 < c1")
    return here.join(mixed, "key")


def _stragglers(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components within a hub's group that can reach the similarity, and few others.

    ``groups`` has (hub, doc_id, component). Most members of a group of copies are in one component by now, and need no
    look at each other: only the others are held against the group. Both sides are dealt to blocks, so that a large group
    is many tasks. Of each pair the sizes and the parity sketches are looked at, which differ in no more bits than the
    sets differ in elements; what the join gives are pairs that pass, little but true links.
    """
    counts = groups.groupBy("hub", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("hub").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    main = main.filter("most < all").select("hub", "main", blocks(F.col("all")).alias("of_all"), blocks(F.col("all") - F.col("most")).alias("of_rest"))
    words = [F.col("sketch")[i].alias(f"w{i}") for i in range(SKETCH // 64)]
    sketched = sets.select("doc_id", F.size("shingles").alias("size"), *words)
    here = stage(groups.join(main, "hub").join(sketched, "doc_id"), "stragglers")
    own = F.xxhash64("doc_id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rest = here.filter("component <> main").withColumn("i", F.pmod(own, "of_rest").cast("int")).withColumn("j", every("of_all"))
    whole = here.withColumn("j", F.pmod(own, "of_all").cast("int")).withColumn("i", every("of_rest"))
    whole = whole.select("hub", "i", "j", *[F.col(c).alias(f"_{c}") for c in ("doc_id", "component", "size", *(f"w{i}" for i in range(SKETCH // 64)))])
    apart = " + ".join(f"bit_count(w{i} ^ _w{i})" for i in range(SKETCH // 64))
    alike = f"100 * least(size, _size) >= {percent} * greatest(size, _size) AND {100 + percent} * ({apart}) <= {100 - percent} * (size + _size)"
    pairs = rest.join(whole, ["hub", "i", "j"]).filter(f"component <> _component AND {alike}")
    return pairs.select(F.greatest("doc_id", "_doc_id").alias("a"), F.least("doc_id", "_doc_id").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    hub_rounds: int = 1,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable), kept.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a document's set is its distinct runs of ``shingle``
    words. Two documents are linked when the intersection is at least ``percent`` of the union.

    Equal sets form a class, whose smallest id stands for it; only such representatives are banded. In each bucket
    every member is verified against one hub, its smallest id. Members that are in one component by then need no
    further look; buckets that still span several components go through further hubs. Of those that are left, members
    outside the largest component are held against the others by parity sketches, in blocks. So a bucket of near copies
    costs about one verification for each member, and still no link that could join two components is skipped.

    Null or empty text, or text without words: n_shingles 0, linked with nothing. Rows with a null id get their
    n_shingles, a null component_id, and are kept. Rows that share an id are one document: a link of one is a link of all.
    An empty table gives an empty result; other columns of the input are not looked at.
    """
    if bands * rows > 256:
        raise ValueError("at most 256 slots")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stage(
        map_batches(texts, _signer(shingle, bands, rows), "doc_id long, n_shingles long, digest binary, bands array<long>"),
        "signatures",
    )
    usable = signed.filter("doc_id is not null and n_shingles > 0")
    classes = stage(
        usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    entries = classes.select("rep", "n", F.explode("bands").alias("key"))
    crowded = entries.groupBy("key").agg(F.count("*").alias("members"), F.min("rep").alias("least"), F.max("rep").alias("most")).filter("least < most")
    buckets = stage(entries.join(crowded.select("key"), "key"), "buckets")
    involved = stage(buckets.select(F.col("rep").alias("doc_id")).distinct(), "involved")
    sets = stage(map_batches(texts.join(involved, "doc_id", "left_semi"), _set_maker(shingle), "doc_id long, digest binary, shingles array<long>, sketch array<long>"), "sets")

    member_of = usable.select("doc_id", "digest").join(classes.select("digest", "rep"), "digest").select("doc_id", "rep")
    split = member_of.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).filter("b < most")
    links = stage(member_of.join(split, "doc_id").select(F.col("rep").alias("a"), "b").filter("a <> b"), "shared-ids")

    similar_size = F.expr(f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)")
    tested = None
    found = None
    for turn in range(hub_rounds):
        here = _unsettled(buckets, found)
        hub = here if not turn else here.filter("component = c1")
        hub = hub.groupBy("key").agg(F.min(F.struct("rep", "n", "component")).alias("h"))
        hub = hub.select("key", F.col("h.rep").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.component").alias("hub_component"))
        pairs = here.join(hub, "key").filter("component <> hub_component")
        pairs = pairs.filter(similar_size).select(F.greatest("rep", "hub").alias("a"), F.least("rep", "hub").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        links = stage(links.union(_verified(pairs, sets, percent)), "verified")
        found = components(links)
    if found is None:
        found = components(links)
    open_ = _unsettled(buckets, found)
    hubs = open_.groupBy("key").agg(F.min("rep").alias("hub"))
    open_ = stage(open_.join(hubs, "key").select("hub", F.col("rep").alias("doc_id"), "component").distinct(), "unsettled")
    if not open_.isEmpty():
        pairs = _stragglers(open_, sets, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        links = links.union(_verified(stage(pairs, "pairs"), sets, percent))
        found = components(links)
    groups = found.filter("node <> component")
    reps = classes.select("digest", "rep").join(groups, F.col("rep") == F.col("node"), "left")
    reps = reps.select(F.col("digest").alias("__digest"), F.coalesce("component", "rep").alias("component_id"))
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(reps, F.col("digest") == F.col("__digest"), "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
        )
    )


def _one_row_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, also of rows without ids, and one row for each id and text.

    Numbers that stand for null ids are 2^62 or more, so that documents with ids of a usual size stay before them. Only
    rows that occur again are shuffled with their text; of these the one with the smallest digest of all columns stays.
    """
    text = F.col(text_col)
    stand_in = F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(1 << 62).bitwiseOR(F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1))))
    keyed = docs.withColumns({"__id": F.coalesce(F.col(id_col).cast("long"), stand_in), "__text": F.unhex(F.md5(F.coalesce(text, F.lit(""))))})
    found = near_duplicates(keyed.select("__id", text_col), id_col="__id", text_col=text_col, **options)
    gone = stage(found.filter("not kept").select(F.col("doc_id").alias("__gone")).distinct(), "copies")
    left = keyed.join(gone, F.col("__id") == F.col("__gone"), "left_anti")
    counts = left.filter("__id is not null").groupBy("__id", "__text").agg(F.count("*").alias("n"))
    repeated = stage(counts.filter("n > 1").select("__id", "__text"), "repeated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    again = left.join(repeated, ["__id", "__text"], "left_semi").groupBy("__id", "__text").agg(F.min_by(row, F.md5(F.to_json(row))).alias("row"))
    return left.join(repeated, ["__id", "__text"], "left_anti").select(docs.columns).unionByName(again.select("row.*"))


def drop_near_duplicates(docs: DataFrame, one_row: bool = False, **options) -> DataFrame:
    """The input's rows without those whose group has a smaller id; columns unchanged.

    Only the ids that go are joined, so the texts move only where that list is too large to broadcast.

    Rows with a null id stay, and so do repeated rows. With ``one_row`` they don't: rows of a null id and a text with words
    take part under a number that their text gives, and of rows with equal ids and texts one stays.
    """
    if one_row:
        return _one_row_each(docs, **options)
    gone = stage(near_duplicates(docs, **options).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct(), "copies")
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
