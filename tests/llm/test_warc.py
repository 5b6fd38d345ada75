import gzip

import checker
import pytest

from alertloom.llm import catalog, warc
from alertloom.llm.files import read_file


def test_query(spark, sf_dir):
    assert checker.compare(warc.op9_warc(spark, sf_dir), checker.connect(sf_dir), catalog.ORACLES["op9_warc"]) == []


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b\r\nX: y", "é\r\n\r\nWARC/1.1\r\n\r\n"), (4, "u", None), (5, "u", "")]
    rows += [(None, "u", "none"), (7, "u", "twice"), (7, "u", "twice"), (8, "u", "long " * 300_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_records_and_members(spark, pages, tmp_path):
    captured = warc.capture(pages, f"{tmp_path}/raw", per_file=400)
    done = warc.normalise(captured, f"{tmp_path}/out")
    for r in done.collect():
        raw = read_file(r.path)
        index = [x.split() for x in read_file(f"{r.path}.idx").decode().splitlines()]
        assert len(index) == r.records and sum(int(n) for _, n, *_ in index) == len(raw)
        for place, length, kind, _ in index:  # each member is readable alone
            whole = gzip.decompress(raw[int(place) : int(place) + int(length)])
            assert whole.startswith(b"WARC/1.1\r\n") and f"WARC-Type: {kind}".encode() in whole
    got = sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(done).collect()), key=str)
    want = [(0, "response", None, 4), (1, "revisit", 2, 8), (2, "response", None, 8), (3, "response", None, 18), (4, "revisit", 5, 0)]
    want += [(5, "response", None, 0), (7, "response", None, 5), (7, "revisit", 7, 5), (8, "response", None, 1_500_000)]
    assert got == sorted(want, key=str)
    only = warc.read_archives(warc.normalise(captured, f"{tmp_path}/least", least_bytes=6)).filter("record_type = 'revisit'").collect()
    assert [(r.page_id, r.refers_to) for r in only] == [(1, 2)]


def test_broken_and_joined_streams(tmp_path):
    whole = warc.record("response", 1, "u", warc.payload_digest(b"x"), 1, b"x")
    joined = gzip.compress(whole) + gzip.compress(whole * 2)
    assert len(list(warc.records(warc.inflated(iter([joined[:50], joined[50:]]))))) == 3
    with pytest.raises(EOFError):
        list(warc.records(warc.inflated(iter([joined[:-20]]))))
    with pytest.raises(EOFError):
        list(warc.records(iter([whole[:-30]])))


def test_empty(spark, pages, tmp_path):
    assert warc.read_archives(warc.normalise(warc.capture(pages.limit(0), f"{tmp_path}/a"), f"{tmp_path}/b")).count() == 0
