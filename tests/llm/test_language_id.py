from __future__ import annotations

import zlib

import zstandard

from tests.llm.helpers import no_documents, odd_documents
from tidemark.llm.language_id import UNKNOWN, Compressor, identify, keep_identified, learn_dictionaries
from tidemark.llm.queries import op7_compression

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op7_compression(spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_odd_rows(spark):
    learned = learn_dictionaries(spark.read.parquet(f"{SF}/documents.parquet"), dictionary=8192)
    assert set(learned) == {"en", "fr", "de", "es"} and all(0 < len(d) <= 8192 for d in learned.values())
    docs = odd_documents(spark)
    got = identify(docs, learned)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == 12
    for i in (2, 3, 4, 9):
        assert (rows[i].lang_pred, rows[i].score, rows[i].rejected) == (UNKNOWN, 0.0, True)
    kept = keep_identified(docs, learned)
    assert kept.columns == docs.columns and {2, 3, 4, 9}.isdisjoint(r.doc_id for r in kept.collect())
    assert identify(no_documents(spark), learned).count() == 0
    assert learn_dictionaries(no_documents(spark)) == {}
    assert {r.lang_pred for r in identify(docs, {}).collect()} == {UNKNOWN}
    assert learn_dictionaries(docs) == learn_dictionaries(docs)


def test_whole_texts_count():
    import random

    rng = random.Random(1)
    said = lambda vowels, n: " ".join("".join(rng.choice("lmnprst") + rng.choice(vowels) for _ in range(3)) for _ in range(n))
    c = Compressor({"a": said("ae", 1500).encode(), "b": said("ou", 1500).encode()})
    text = said("ae", 300)
    assert c.judge(text)[0] == "a" and c.judge(text + said("ou", 3000))[0] == "b"
    assert c.judge(text + said("ou", 250))[1] < c.judge(text + said("ae", 250))[1]


def test_judgements_equal_those_by_frames_that_decode_again(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = learn_dictionaries(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}

    def frame(content: bytes, piece: bytes) -> int:
        """Bytes of a frame, written as a stream and read back with the dictionary."""
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(
            5, source_size=1 << 14, dict_size=len(content), min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        raw.precompute_compress(compression_params=how)
        out = zstandard.ZstdCompressor(dict_data=raw, compression_params=how).compress(piece)
        assert zstandard.ZstdDecompressor(dict_data=raw).decompress(out, max_output_size=1 << 16) == piece
        return len(out)

    for r in identify(docs, learned).collect():
        text = (texts[r.doc_id] or "").lower().encode()
        if not any(c.isalpha() for c in texts[r.doc_id] or ""):
            assert (r.lang_pred, r.rejected) == (UNKNOWN, True)
            continue
        sizes = []
        for lang, content in learned.items():
            first = content[-1024:] + b"\n" + text[:8192]
            sizes.append((sum(frame(content, p) for p in (first, *(text[i : i + 8192] for i in range(8192, len(text), 8192)))), len(sizes), lang))
        sizes.sort()
        lead = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        assert r.lang_pred == sizes[0][2] and abs(r.score - min(1, 4 * lead)) < 1e-12
        assert r.rejected == (lead < 0.002 and len(texts[r.doc_id]) >= 64)
