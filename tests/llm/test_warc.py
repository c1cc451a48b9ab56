import struct

import pytest
import zstandard

from tandem.llm.queries import ORACLES, QUERIES
from tandem.llm.warc import (
    DICTIONARY_FRAME, FILLER, frames_of, parsed, read_archives, write_archives, _record)
from tests.oracle import connect, difference

LONG = "<p>é</p>" * 200


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload int")


def test_round_trip(spark, tmp_path):
    rows = [(1, "http://a/ b\r\nX: y", LONG, 0), (2, None, LONG, 0), (5, "u", LONG, 0), (3, "u", "short", 0),
            (4, "u", "short", 0), (6, "u", None, 0), (7, "u", "", 0), (None, "u", LONG, 0), (5, "u", LONG, 0),
            (8, "u", "\r\n\r\nWARC/1.1\x00\n" * 3000, 0)]
    write_archives(table(spark, rows), str(tmp_path / "w"), archive_bytes=4000)
    found = read_archives(spark, str(tmp_path / "w")).collect()
    assert len(found) == len(rows)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in found)
    assert kinds == sorted([(1, "revisit", 5), (2, "revisit", 5), (5, "response", None), (5, "response", None),
                            (3, "response", None), (4, "response", None), (6, "response", None), (7, "response", None),
                            (0, "response", None), (8, "response", None)], key=lambda x: (x[0], x[1]))
    texts = {i: text or "" for i, _, text, _ in rows}
    for row in found:
        assert row.payload_bytes == len(texts[row.page_id].encode())
        if row.record_type == "response":
            assert bytes(row.payload).decode() == texts[row.page_id]
    assert {r.url for r in found} == {"http://a/%20b%0D%0AX:%20y", None, "u"}


def test_archives_are_plain_zstandard(spark, tmp_path):
    rows = [(i, "u", f"{LONG}{i}", 0) for i in range(40)]
    write_archives(table(spark, rows), str(tmp_path / "w"))
    data = next((tmp_path / "w").glob("part-*")).read_bytes()
    magic, size = struct.unpack_from("<II", data)
    assert magic == DICTIONARY_FRAME
    known = zstandard.ZstdCompressionDict(data[8: 8 + size]) if size else None
    whole = zstandard.ZstdDecompressor(dict_data=known).stream_reader(data[8 + size:], read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 40


def test_empty_table(spark, tmp_path):
    write_archives(table(spark, []), str(tmp_path / "w"))
    assert read_archives(spark, str(tmp_path / "w")).count() == 0


GOOD = _record(1, "u", b"abc", "a9993e364706816aba3e25717850c26c9cd0d89d", 3, None, "1970-01-01T00:00:00Z")


@pytest.mark.parametrize("old, new", [
    (b"WARC/1.1", b"WARC/9"), (b"WARC-Type", b"WARC Type"), (b"WARC-Date: ", b"WARC-Day: "),
    (b"abc\r\n\r\n", b"abcd\r\n\r\n"), (b"abc\r\n", b"abd\r\n"), (b"Content-Length: 3", b"Content-Length: x"),
    (b"response\r\nWARC", b"request\r\nWARC"), (b"sha1:", b"md5:"), (b"<urn:page:1>", b"<urn:page:x>")])
def test_bad_records_are_refused(old, new):
    assert parsed(GOOD)["payload"] == b"abc"
    assert old in GOOD
    with pytest.raises(ValueError):
        parsed(GOOD.replace(old, new, 1))


def test_frames_that_are_cut_off():
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(b"x" * 1000 + bytes(range(256)))
    data = frame + FILLER + b"\n"
    assert [place for place, _, _ in frames_of(memoryview(data))] == [0, len(frame)]
    for cut in (3, 9, len(frame) - 1, len(frame) + 3, len(data) - 1):
        with pytest.raises(ValueError):
            list(frames_of(memoryview(data[:cut])))


def test_query_matches_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert difference(QUERIES["op4_warc"](spark, sf_dir), connect(sf_dir), ORACLES["op4_warc"]) is None
