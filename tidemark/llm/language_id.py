"""Language identification by compression: the language whose dictionary encodes a text in the fewest bytes.

A language is learned as a zstandard raw-content dictionary: pieces of labelled texts, joined. A text is encoded in
blocks with each dictionary in turn; the sums of sizes are compared, and the lead of the best over the second tells
how sure the choice is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, rows_of, stage

#: Bytes of a dictionary, and of the pieces of text it is made of. Only so much is learned for each language,
#: from a sample that a hash of the text draws from all labelled rows.
DICTIONARY, PIECE = 32_768, 256
#: Texts are encoded in blocks of so many bytes, so that the dictionary stays what a block has most to gain from.
BLOCK = 8_192
#: A lead of less than this share of the second best size is too narrow to tell, in texts of MEASURED bytes or more;
#: sizes are whole bytes, so that shorter texts can tie without being mixed.
MARGIN, MEASURED = 0.002, 64
#: A text's first block is led by so many bytes of the dictionary: a few words alone would be stored as they are.
LEAD_IN = 1024
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def learn_dictionaries(labelled: DataFrame, dictionary: int = DICTIONARY, piece: int = PIECE, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A raw-content dictionary for each language, on the driver: ``dictionary`` bytes at most for each.

    Rows with a null language or text teach nothing. Each row drawn gives one piece, from a place its hash chooses.
    """
    wanted = dictionary // piece
    texts = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null and text <> ''")
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    rows = stage(texts.groupBy("lang").count(), "languages")
    share = rows.select(F.col("lang").alias("__lang"), F.least(F.lit(1.0), 4.0 * wanted / F.col("count")).alias("share"))
    drawn = texts.select("lang", "text", draw.alias("draw")).join(share, F.col("lang") == F.col("__lang"))
    # About four times as many as wanted are left of each language, so the lists below are short.
    drawn = drawn.filter(F.col("draw") < F.col("share") * float(1 << 40))
    start = F.lit(1) + F.pmod(F.hash("text"), F.greatest(F.lit(1), F.length("text") - piece)).cast("int")
    pieces = drawn.select("lang", F.struct("draw", F.substring(F.col("text"), start, F.lit(piece)).alias("said")).alias("p"))
    chosen = pieces.distinct().groupBy("lang").agg(F.slice(F.sort_array(F.collect_list("p")), 1, wanted)["said"].alias("said"))
    frequent = {r["lang"]: r["count"] for r in rows.collect()}
    learned = sorted(chosen.collect(), key=lambda r: (-frequent[r["lang"]], r["lang"]))
    return {r["lang"]: "\n".join(r["said"]).lower().encode()[-dictionary:] for r in learned}


class Compressor:
    """Sizes of texts under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        # The order of the dictionaries settles ties.
        self.langs = list(dictionaries)
        self.lead_in = [d[-LEAD_IN:] + b"\n" for d in dictionaries.values()]
        self.encoders = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.encoders.append(self._encoder(content, 1 << 14))

    @staticmethod
    def _encoder(content, source_size: int):
        how = zstandard.ZstdCompressionParameters.from_level(
            5, source_size=source_size, dict_size=len(content), min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        content.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=content, compression_params=how)

    def sizes(self, text: str) -> list[int]:
        raw = text.lower().encode()
        blocks = [raw[i : i + BLOCK] for i in range(BLOCK, len(raw), BLOCK)]
        return [len(e.compress(lead + raw[:BLOCK])) + sum(len(e.compress(b)) for b in blocks) for e, lead in zip(self.encoders, self.lead_in)]

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score (the lead over the second best, 0 to 1), and whether it is rejected."""
        if not text or not self.encoders or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(order) == 1:
            return self.langs[0], 1.0, False
        best, second = sizes[order[0]], sizes[order[1]]
        lead = (second - best) / second
        return self.langs[order[0]], min(1.0, lead * 4), lead < MARGIN and len(text) >= MEASURED


def _judge(dictionaries: dict[str, bytes]):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = Compressor(dictionaries)
        for batch in batches:
            judged = [compressor.judge(t) for (texts,) in rows_of([batch], "text") for t in texts]
            columns = [pa.array([j[i] for j in judged], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([c for n, c in zip(batch.schema.names, batch.columns) if n != "text"] + columns, names=[n for n in batch.schema.names if n != "text"] + ["lang_pred", "score", "rejected"])

    return judge


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, rejected.

    ``und`` with score 0, rejected, for a null text, one without a letter, or where no language was learned. Equal
    sizes go to the language with most labelled rows, with score 0. A row is rejected too when the lead is under
    MARGIN; lang_pred still names the best. Null ids and repeated rows give a row each; an empty table gives none.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(given, _judge(dictionaries), "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """The input's rows without those rejected; columns unchanged. Nothing is shuffled."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = Compressor(dictionaries)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            mask = [not compressor.judge(t)[2] for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return map_batches(docs, keep, docs.schema)
