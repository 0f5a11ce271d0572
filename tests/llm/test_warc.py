from __future__ import annotations

import gzip
import hashlib
import random

import pytest

from tidemark.llm.warc import encode_record, read_archives, read_records, write_archives

SCHEMA = "page_id long, url string, html string, archive string, digest string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def brute(rows):
    first = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 100 and i is not None:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = first.get(html) if len(body) >= 100 else None
        to = None if to == i else to
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\r\n<>") for _ in range(n)) for n in (0, 10, 99, 100, 101, 5000, 300_000)]
    rows = [(i, f"http://x/{i}", rng.choice(texts)) for i in range(1, 60)]
    rows += [(70, None, None), (71, "http://x/\r\nEvil: 1", texts[5]), (None, "http://x", texts[5]), (None, None, "short"), (5, "http://x/5", texts[6]), (5, "http://x/5", texts[6]), (80, "u", "WARC/1.1\r\n\r\n" * 30)]
    folder, manifest = write_archives(pages(spark, rows), str(tmp_path / "w"), archive_bytes=20_000)
    assert sum(r.records for r in manifest.collect()) == len(rows) and manifest.count() > 3
    got = read_archives(spark, folder, manifest).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute(rows)
    by_kind = {r.record_type for r in got}
    assert by_kind == {"response", "revisit"}
    texts_of = {(i, h or "") for i, _, h in rows}
    for r in got:
        assert r.verified is (True if r.record_type == "response" else None)
        assert r.payload is None if r.record_type == "revisit" else (r.page_id, r.payload) in texts_of
    # Each archive is plain gzip, with a member for each record.
    for name in (r.archive for r in manifest.collect()):
        assert gzip.open(f"{folder}/{name}").read().count(b"WARC-Record-ID") >= 1


def test_empty(spark, tmp_path):
    folder, manifest = write_archives(pages(spark, []), str(tmp_path / "w"))
    assert manifest.count() == 0 and read_archives(spark, folder, manifest).count() == 0


def _archive():
    bodies = [b"x" * 50_000, b"", b"\r\n\r\n" * 9]
    return [encode_record(i, "u", b, hashlib.sha256(b).hexdigest(), None, "1970-01-01T00:00:00Z", 6) for i, b in enumerate(bodies)], bodies


@pytest.mark.parametrize("step", [1, 7, 100, 1 << 20])
def test_pieces_of_any_size(step):
    members, bodies = _archive()
    data = b"".join(members)
    got = list(read_records([data[i : i + step] for i in range(0, len(data), step)]))
    assert [r.payload for r in got] == bodies and [r.length for r in got] == [len(b) for b in bodies]


def test_broken_archives_raise():
    members, bodies = _archive()
    with pytest.raises(ValueError):
        list(read_records([members[0][:-20]]))
    plain = gzip.decompress(members[0])
    for bad in (plain.replace(b"Content-Length: 5", b"Content-Length: 4", 1), plain[:-6], plain + b"x", b"HTTP" + plain):
        with pytest.raises(ValueError):
            list(read_records([gzip.compress(bad)]))
    changed = list(read_records([gzip.compress(plain.replace(b"xxx\r\n\r\n", b"xxy\r\n\r\n"))]))[0]
    assert changed.digest != hashlib.sha256(bodies[0]).hexdigest()
