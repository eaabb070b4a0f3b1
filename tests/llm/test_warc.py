import gzip
import os
import random
import zlib

import pytest
from cases import bag

from tidewell.llm import queries, warc

SCHEMA = "page_id long, url string, html string, kind string, payload string, digest string"


def page_rows():
    shared = "<p>the same</p>" * 30
    rows = [(n, f"http://h{n % 3}/p {n}\r\nX-Evil: 1", shared if n % 3 == 0 else f"<p>ü {n}</p>") for n in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", None), (None, "u", shared), (None, "n", "only null"), (None, "m", "only null")]
    rows += [(57, "again", shared), (58, "u", "other text"), (5, "u", "<p>ü 5</p>"), (200, "l", "long " * 400_000), (201, "l", "long " * 400_000)]
    # a payload that looks like archives itself
    rows.append((300, "w", warc.record(7, "u", b"inner").decode() + "\x1f\x8b\x08 WARC/1.1\r\n\r\n"))
    return rows


def pages(spark, rows=None):
    return spark.createDataFrame([(*r, "c", "c", "c") for r in (page_rows() if rows is None else rows)], SCHEMA).repartition(3)


def brute(rows, least=0):
    payloads = [(r[0], (r[2] or "").encode()) for r in rows]
    largest = {}
    for page, payload in payloads:
        largest[payload] = max(-1 if page is None else page, largest.get(payload, -1))
    found = []
    for page, payload in payloads:
        first = (-1 if page is None else page) == largest[payload] or len(payload) < least
        kind, refers = ("response", None) if first else ("revisit", largest[payload])
        found.append((page, len(payload), warc.sha1_base32(payload), kind, refers))
    return found


@pytest.mark.parametrize("least", [0, 1, 100])
def test_round_trip(spark, least):
    assert bag(warc.round_trip(pages(spark), least).collect()) == bag(brute(page_rows(), least))


def test_nothing(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


def written(spark, folder, archive_bytes=warc.ARCHIVE_BYTES):
    warc.write_archives(pages(spark), folder, archive_bytes=archive_bytes)
    return sorted(os.path.join(folder, n) for n in os.listdir(folder) if n.startswith("part-") and os.path.getsize(os.path.join(folder, n)))


def test_archives_are_members_of_one_record_of_bounded_size(spark, tmp_path):
    files = written(spark, str(tmp_path / "a"), 2_000)
    assert len(files) > 5
    members = 0
    for name in files:
        data = open(name, "rb").read()
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        while data:
            unpacker = zlib.decompressobj(31)
            content = unpacker.decompress(data)
            assert unpacker.eof and (not content or warc.parse(content, 0)[2] == len(content))
            data, members = unpacker.unused_data, members + bool(content)
    assert members == len(page_rows())


def test_a_member_of_any_length_ends_with_zero():
    for size in (0, 1, 70_000, (16 << 20) - 1, 16 << 20, (16 << 20) + 5):
        packed = warc.member(b"x" * size)
        assert packed.endswith(b"\0") and gzip.decompress(packed) == b"x" * size


RECORDS = [warc.record(n, f"u{n}", b"payload %d " % n * (n % 7)) for n in range(40)]


def told(data):
    found = list(warc.salvage(data))
    return [f for f in found if f[5] is not None], [f for f in found if f[5] is None]


def page_ids(records):
    return [int(f[5]["warc-page-id"]) for f in records]


FORMS = {
    "members": [warc.member(r) for r in RECORDS],
    "plain": RECORDS,
    "mixed": [warc.member(r) if n % 3 else r for n, r in enumerate(RECORDS)],
}


@pytest.mark.parametrize("form", sorted(FORMS))
def test_salvage_recovers_all_that_is_whole_and_logs_every_other_byte(form):
    parts = FORMS[form]
    draw = random.Random(form)
    for trial in range(60):
        kept, damaged, gaps = bytearray(), set(), []
        for n, part in enumerate(parts):
            kind = draw.choice(["flip", "cut", "junk"]) if draw.random() < 0.2 else None
            begin = len(kept)
            if kind == "flip":
                # in the content of the record, not in what the formats leave unchecked
                at = draw.randrange(12, len(part) - 9) if part[:1] == b"\x1f" else part.index(b"HTTP") + draw.randrange(8)
                part = part[:at] + bytes([part[at] ^ 1 + draw.randrange(255)]) + part[at + 1 :]
                damaged.add(n)
            elif kind == "cut":
                part = part[: draw.randrange(1, len(part) - 1)]
                damaged.add(n)
            if kind == "junk":
                kept += b"\x1f\x8b\x08junk\xff WARC/1.1\r\nno" * draw.randrange(1, 3)
                gaps.append((begin, len(kept)))
            kept += part
            if n in damaged:
                gaps.append((begin, len(kept)))
        records, found = told(bytes(kept))
        assert page_ids(records) == [n for n in range(len(parts)) if n not in damaged]
        joined = []
        for begin, end in gaps:
            if joined and joined[-1][1] == begin:
                joined[-1] = (joined[-1][0], end)
            else:
                joined.append((begin, end))
        assert [f[:2] for f in found] == joined
        # records and gaps are all of the bytes, in order
        places = sorted(f[:2] for f in [*records, *found])
        assert [p[0] for p in places] == [0, *[p[1] for p in places[:-1]]] and places[-1][1] == len(kept)


def test_damage_within_a_member_of_many_records():
    whole = b"".join(RECORDS)
    begin = whole.index(RECORDS[4])
    hurt = whole[: begin + 3] + b"?" + whole[begin + 4 :]
    records, gaps = told(gzip.compress(hurt))
    assert page_ids(records) == [n for n in range(40) if n != 4]
    assert [g[2:5] for g in gaps] == [(begin, begin + len(RECORDS[4]), "no version line")]


@pytest.mark.parametrize("data", [b"", b"\0" * 100, b"WARC/1.1\r\n", b"\x1f\x8b\x08", gzip.compress(b"no record"), b"\x1f\x8b\x08" * 50])
def test_files_without_a_record(data):
    records, gaps = told(data)
    assert not records and [g[:2] for g in gaps] == ([(0, len(data))] if data else [])


def test_gaps_and_records_behind_them_are_read_from_files(spark, tmp_path):
    folder = str(tmp_path / "b")
    largest = max(written(spark, folder), key=os.path.getsize)
    data = open(largest, "rb").read()
    first = zlib.decompressobj(31)
    first.decompress(data)
    end = len(data) - len(first.unused_data)
    foreign = tmp_path / "foreign"
    foreign.mkdir()
    (foreign / "one.warc.gz").write_bytes(data[:40] + b"????" + data[44:])
    (foreign / "two.warc").write_bytes(b"".join(RECORDS) + warc.record(77, "u", b"abc").replace(b"abc", b"abd"))
    found = warc.read_archives(spark, str(foreign)).collect()
    gaps = [(os.path.basename(r["path"]), r["start"], r["stop"], r["problem"]) for r in found if r["kind"] == "gap"]
    assert sorted(gaps)[0][:3] == ("one.warc.gz", 0, end) and sorted(gaps)[1][0] == "two.warc"
    assert sorted(gaps)[1][3] == "block digest" and len(gaps) == 2
    whole = [r for r in warc.read_archives(spark, largest).collect() if r["kind"] == "record"]
    assert sum(r["kind"] == "record" and r["path"].endswith("gz") for r in found) == len(whole) - 1


def test_a_payload_unlike_its_digest_is_told():
    block = warc.RESPONSE % 3 + b"abc"
    fields = {"warc-type": "response", "content-type": "application/http"}
    assert warc.payload_of(fields, block) == b"abc"
    assert warc.payload_of({"warc-type": "revisit"}, block) is None
    assert warc.payload_of({"warc-type": "warcinfo", "content-type": "text/plain"}, b"x") == b"x"


def test_query_equals_its_sql_on_repeated_payloads(spark, tmp_path):
    import duckdb

    frame = pages(spark).toPandas()  # noqa: F841
    frame["page_id"] = frame["page_id"].astype("Int64")
    with duckdb.connect() as base:
        base.execute("create view pages as select * from frame")
        want = base.execute(queries.ORACLE_SQL["op12_warc_salvage"]).fetchall()
    assert bag(warc.round_trip(pages(spark)).collect()) == bag(want)
