"""Best-fit packing of tokenized documents into sequences of one capacity, in bulk-synchronous rounds.

A round sorts the documents and the gaps of open sequences together by ranges of their size, largest first. Each range
is swept by one task: a document takes the smallest gap of its range that holds it. What a range leaves over meets the
gaps that larger ranges left over; there documents and gaps are paired by their ranks, so that no two documents take
one gap. Gaps shrink, and the next round begins. Documents that no gap holds open sequences, as many as their tokens
need at least.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.local import local_frame
from .common import rows_of, stage

#: How byte-level vocabularies split a text before merging: for the regex module, and for Python's own, which is faster
#: and takes the same pieces where a text has none of the signs that it knows under other classes. There words come
#: first, as most pieces are words, and no piece that begins with an apostrophe is one.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
USUAL = re.compile(r" ?(?:[A-Za-z]++[^\W\d_]*+|[^\W\d_]++)| ?\d+|'s|'t|'re|'ve|'m|'ll|'d| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
OTHER = frozenset(c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("No", "Nl") or "\x1c" <= c <= "\x1f")
#: Most texts have no sign that might be one of these.
MAYBE = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\xff]")
#: Pieces that a task remembers the ids of, and their longest length; signs of a text that are split at a time.
REMEMBERED, SHORT, AT_ONCE = 600_000, 48, 1_000_000
#: Items that one task sweeps: at least and at most, where the session's shuffle partitions leave a choice.
FEW, MANY = 2_000, 200_000


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Ids(dict):
    """Ids of pieces as packed little-endian 32-bit numbers; what was seen before is not merged again."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        said = json.loads(self.tokenizer.to_str())
        first = said["pre_tokenizer"] or {}
        self.by_bytes = said["normalizer"] is None and (first.get("type"), first.get("add_prefix_space"), first.get("use_regex", True)) == ("ByteLevel", False, True)
        self.signs, self.model, self.pieces = _byte_signs(), self.tokenizer.model, regex.compile(PIECES)

    def __missing__(self, piece: str) -> bytes:
        # of the printable ASCII signs only the space has another sign
        plain = piece.isascii() and piece.isprintable()
        said = piece.replace(" ", self.signs[0x20]) if plain else piece.encode().decode("latin-1").translate(self.signs)
        ids = _packed([t.id for t in self.model.tokenize(said)])
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


_ids = lru_cache(maxsize=1)(_Ids)


def packed_ids(text: str | None, path: str) -> bytearray:
    """All ids of a text, four bytes each. Byte-level vocabularies are applied piece by piece, others to the whole text."""
    ids, text = _ids(path), text or ""
    if not ids.by_bytes:
        return bytearray(_packed(ids.tokenizer.encode(text, add_special_tokens=False).ids))
    pattern = ids.pieces if MAYBE.search(text) and not OTHER.isdisjoint(text) else USUAL
    if len(text) <= AT_ONCE:
        return bytearray(b"".join(map(ids.__getitem__, pattern.findall(text))))
    out, found = bytearray(), pattern.finditer(text)
    while some := [m[0] for m in islice(found, 65_536)]:
        out += b"".join(map(ids.__getitem__, some))
    return out


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: whole sequences but for the first one, or the document itself."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *[(at, capacity) for at in range(first, n, capacity)]]


def _piece_maker(path: str, capacity: int, end_id: int):
    end = _packed([end_id])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches, "doc_id", "text"):
            rows = []
            for doc_id, text in zip(ids, texts):
                packed = packed_ids(text, path) + end
                for k, (start, length) in enumerate(cuts(len(packed) // 4, capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(packed[4 * start : 4 * (start + length)])))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return make


class _Gaps:
    """Open sequences by free space."""

    def __init__(self, capacity: int):
        self._at = [[] for _ in range(capacity + 1)]
        self._open = 0  # bit g: there is a gap of size g

    def add(self, size: int, sequence: int) -> None:
        self._at[size].append(sequence)
        self._open |= 1 << size

    def take(self, size: int) -> tuple[int, int] | None:
        """The smallest gap that holds so much."""
        fits = self._open >> size
        if not fits:
            return None
        g = size + (fits & -fits).bit_length() - 1
        sequence = self._at[g].pop()
        if not self._at[g]:
            self._open ^= 1 << g
        return g, sequence

    def rest(self) -> list[tuple[int, int]]:
        return [(g, s) for g, held in enumerate(self._at) for s in held]


_SWEPT = "kind string, part int, rank long, id long, size int, sequence_id long, offset int"


def _sweeper(capacity: int, alone: bool):
    """Best fit within one range of documents and gaps, in descending order.

    Gives documents with their place (kind placed), documents left over (doc) in their order, and gaps: those that later
    ranges may fill (gap), smallest first, and those that have become smaller than this range (small). A range that is
    the only one opens the sequences it needs.
    """

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        docs, gaps, least = [], _Gaps(capacity), capacity
        for is_doc, ids, sizes in rows_of(batches, "is_doc", "id", "size"):
            least = sizes[-1]
            for d, i, s in zip(is_doc, ids, sizes):
                if d:
                    docs.append((i, s))
                else:
                    gaps.add(s, i)
        out, left = [], 0
        for i, s in docs:
            found = gaps.take(s) or ((capacity, i) if alone else None)
            if found is None:
                out.append(("doc", part, left, i, s, None, None))
                left += 1
                continue
            g, sequence = found
            out.append(("placed", part, None, i, s, sequence, capacity - g))
            if g > s:
                gaps.add(g - s, sequence)
        later = 0
        for g, sequence in gaps.rest():
            if g < least:
                out.append(("small", part, None, sequence, g, None, None))
            else:
                out.append(("gap", part, later, sequence, g, None, None))
                later += 1
        types = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
        names = ["kind", "part", "rank", "id", "size", "sequence_id", "offset"]
        for at in range(0, len(out), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 10_000]), types)], names=names)

    return sweep


def pair_ranges(summary: list) -> tuple[list[tuple], dict[int, int]]:
    """Which ranks of a range's documents take which ranks of an earlier range's gaps.

    ``summary``: per range its documents left over and the largest of them, its gaps left over and the smallest of them.
    Ranges come largest first, so every gap of an earlier range holds every document of a later one, often several. The
    nearest range's gaps go first. Gives (part, first rank, end, part of gaps, first gap, documents a gap) rows, and how
    many documents of each range they cover.
    """
    open_, pairs, covered = [], [], {}
    for r in sorted(summary, key=lambda r: r["part"]):
        at = 0
        while at < r["docs"] and open_:
            part, first, end, size = open_.pop()
            each = max(1, size // r["largest"])
            n = min(r["docs"] - at, each * (end - first))
            used = -(-n // each)
            pairs.append((r["part"], at, at + n, part, first, each))
            if first + used < end:
                open_.append((part, first + used, end, size))
            at += n
        covered[r["part"]] = at
        if r["gaps"]:
            open_.append((r["part"], 0, r["gaps"], r["smallest"]))
    return pairs, covered


def _paired(swept: DataFrame, pairs: list[tuple]) -> DataFrame:
    """Placed rows (id, size, sequence_id, offset) of documents that take another range's gaps."""
    spark = swept.sparkSession
    table = local_frame(spark, pairs, "part int, first long, end long, gap_part int, gap_first long, each long")
    docs = swept.filter("kind = 'doc'").select("part", "rank", "id", "size").join(table, "part").filter("rank >= first AND rank < end")
    docs = docs.select("id", "size", "rank", "gap_part", F.expr("gap_first + (rank - first) div each").alias("gap_rank"))
    gaps = swept.filter("kind = 'gap'").select(F.col("part").alias("gap_part"), F.col("rank").alias("gap_rank"), F.col("id").alias("sequence_id"), F.col("size").alias("free"))
    joined = docs.join(gaps, ["gap_part", "gap_rank"])
    earlier = F.sum("size").over(Window.partitionBy("gap_part", "gap_rank").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    return joined.withColumn("taken", F.coalesce(earlier, F.lit(0)))


def _n_ranges(spark, items: int) -> int:
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(usual, items // FEW), -(-items // MANY))


def best_fit(items: DataFrame, capacity: int, label: str = "packing") -> DataFrame:
    """Places (id, sequence_id, offset) for items (id: long and distinct, size: 1 to capacity).

    A sequence's number is the id of the item that opened it. Offsets in a sequence have no gaps and begin at 0.
    """
    spark = items.sparkSession
    # No two items over half the capacity share a sequence.
    large = items.filter(2 * F.col("size") > capacity)
    placed = [large.select("id", F.col("id").alias("sequence_id"), F.lit(0).alias("offset"))]
    docs = items.filter(2 * F.col("size") <= capacity).select("id", "size")
    gaps = large.filter(F.col("size") < capacity).select("id", (F.lit(capacity) - F.col("size")).cast("int").alias("size"))
    while True:
        facts = docs.agg(F.count("*").alias("n"), F.min("size").alias("least")).first()
        if not facts["n"]:
            break
        gaps = gaps.filter(F.col("size") >= facts["least"])
        n = facts["n"] + gaps.count()
        parts = _n_ranges(spark, n)
        both = docs.select(F.lit(True).alias("is_doc"), "id", "size").union(gaps.select(F.lit(False), "id", "size"))
        order = [F.col("size").desc(), "is_doc", "id"]
        swept = both.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        swept = stage(swept.mapInArrow(_sweeper(capacity, parts == 1), _SWEPT), f"{label}-swept")
        placed.append(swept.filter("kind = 'placed'").select("id", "sequence_id", "offset"))
        if parts == 1:
            break
        count = lambda kind: F.count_if(F.col("kind") == kind)
        only = lambda kind: F.when(F.col("kind") == kind, F.col("size"))
        summary = swept.groupBy("part").agg(
            count("doc").alias("docs"), F.max(only("doc")).alias("largest"), count("gap").alias("gaps"), F.min(only("gap")).alias("smallest"), count("placed").alias("placed")
        ).collect()
        pairs, covered = pair_ranges(summary)
        paired = stage(_paired(swept, pairs), f"{label}-paired")
        placed.append(paired.select("id", "sequence_id", (capacity - F.col("free") + F.col("taken")).cast("int").alias("offset")))
        progress = sum(r["placed"] for r in summary) + sum(covered.values())

        used = paired.groupBy(F.col("sequence_id").alias("of")).agg(F.sum("size").alias("used"))
        left = swept.filter("kind IN ('gap', 'small')").join(used, F.col("id") == F.col("of"), "left")
        gaps = left.select("id", (F.col("size") - F.coalesce("used", F.lit(0))).cast("int").alias("size")).filter("size > 0")
        rest = [(r["part"], covered[r["part"]], r["docs"]) for r in sorted(summary, key=lambda r: r["part"]) if r["docs"] > covered[r["part"]]]
        table = local_frame(spark, [(p, first) for p, first, _ in rest], "part int, first long")
        docs = swept.filter("kind = 'doc'").join(table, "part").filter("rank >= first").select("part", "rank", "id", "size")
        docs, gaps = stage(docs, f"{label}-docs"), stage(gaps, f"{label}-gaps")
        need, room = (df.agg(F.coalesce(F.sum(F.col("size").cast("long")), F.lit(0))).first()[0] for df in (docs, gaps))
        # Space that is open may still hold some of the rest; where nothing found a place, it can't.
        opens = max(0, -(-(need - (room if progress else 0)) // capacity))
        if opens:
            # The largest ones: ranges come in descending order, and so do ranks within a range.
            edges, still = [], opens
            for p, first, end in rest:
                n = min(still, end - first)
                edges.append((p, first + n))
                still -= n
            table = local_frame(spark, edges, "part int, end long")
            marked = docs.join(table, "part").withColumn("opens", F.col("rank") < F.col("end"))
            new = stage(marked.filter("opens").select("id", "size"), f"{label}-opened")
            placed.append(new.select("id", F.col("id").alias("sequence_id"), F.lit(0).alias("offset")))
            gaps = gaps.union(new.select("id", (F.lit(capacity) - F.col("size")).cast("int").alias("size")))
            docs = marked.filter("not opens")
        docs = docs.select("id", "size")
    out = placed[0]
    for more in placed[1:]:
        out = out.union(more)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its text's ids (null or empty text: none) and ``end_id``. Only documents longer than ``capacity`` are
    cut, into pieces of the capacity but for the first one, which may be shorter. Pieces are packed by best fit; offsets
    in a sequence begin at 0 and leave no gaps. ``ids_crc32`` is over the piece's ids as little-endian 32-bit numbers.
    Names of special tokens within a text are ordinary text. The tokenizer's file must be readable by every executor.

    Rows with equal or null ids are documents of their own. An empty table gives an empty result. Other columns are not
    looked at. Texts are encoded word by word with a bounded memory, very long ones too; one document's ids are held at once.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = texts.mapInArrow(_piece_maker(tokenizer_path, capacity, end_id), schema)
    pieces = stage(pieces.withColumn("id", F.monotonically_increasing_id()), "pieces")
    places = best_fit(pieces.select("id", F.col("length").cast("int").alias("size")), capacity)
    placed = pieces.join(places.select("id", "sequence_id", F.col("offset").cast("long").alias("offset")), "id").drop("id")
    return placed.withColumnRenamed("doc_id", id_col)
