"""Archives: exact round trips through writing, normalising and reading."""

from __future__ import annotations

import gzip
import hashlib
import zlib
from pathlib import Path

import pytest

from tidelake.llm import warc
from tidelake.llm.base import settle, ship, text_bytes


def record(kind, uri, block):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{uri}>\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def members(data):
    out = []
    while data:
        inflate = zlib.decompressobj(31)
        out.append(inflate.decompress(data))
        assert inflate.eof
        data = inflate.unused_data
    return out


BLOCKS = [b"", b"x", b"\r\n\r\n", b"line\r\n\r\nline\r\n\r\n", bytes(range(256)) * 30, b"a" * 3_000_000]


@pytest.mark.parametrize("layout", ["one", "many", "split"])
def test_normalise_any_layout(tmp_path, layout):
    records = [record("response", str(i), b) for i, b in enumerate(BLOCKS)]
    whole = b"".join(records)
    cut = len(records[0]) + 20
    parts = {"one": [whole], "many": records, "split": [whole[:cut], whole[cut:]]}[layout]
    source, target = tmp_path / "a.warc.gz", tmp_path / "out" / "b.warc.gz"
    source.write_bytes(b"".join(map(gzip.compress, parts)))
    index = warc.normalise_archive(str(source), str(target))
    data = target.read_bytes()
    assert members(data) == records
    assert [zlib.decompress(data[r["offset"] : r["offset"] + r["length"]], 31) for r in index] == records
    lines = Path(f"{target}.index.tsv").read_text().splitlines()
    assert [int(x.split("\t")[0]) for x in lines] == [r["offset"] for r in index]
    warc.normalise_archive(str(source), str(target))
    assert target.read_bytes() == data and len(list(target.parent.iterdir())) == 2


@pytest.mark.parametrize("wrong", [b"WARC/1.0\r\nContent-Length: 5\r\n\r\nab", b"WARC/1.0\r\nContent-Length: 2\r\n\r\nabXXXX", b"WARC/1.0\r\nConte"])
def test_broken_archives_raise(tmp_path, wrong):
    source = tmp_path / "a.gz"
    source.write_bytes(gzip.compress(wrong))
    with pytest.raises(ValueError):
        warc.normalise_archive(str(source), str(tmp_path / "b.gz"))
    assert not (tmp_path / "b.gz").exists()


def test_a_cut_off_gzip_stream_raises(tmp_path):
    source = tmp_path / "a.gz"
    source.write_bytes(gzip.compress(record("response", "u", bytes(range(256)) * 40))[:-200])
    with pytest.raises((ValueError, zlib.error)):
        warc.normalise_archive(str(source), str(tmp_path / "b.gz"))


def test_empty_archive(tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b""))
    assert warc.normalise_archive(str(tmp_path / "a.gz"), str(tmp_path / "b.gz")) == []


def round_trip(spark, tmp_path, rows, **options):
    ship(spark)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    warc.write_monolithic(pages, str(tmp_path / "crawl"), "page_id", "url", text_bytes("html"), **options)
    index = settle(warc.normalise(spark, str(tmp_path / "crawl"), str(tmp_path / "out")), "index")
    return warc.read_records(index).collect()


def test_round_trip_with_revisits(spark, tmp_path):
    long = "ä" * 60
    html = {1: None, 2: "", 3: "small", 4: "small", 9: long, 5: long, 7: long, 8: "<p>\r\n\r\nWARC/1.1\r\n\r\n</p>" * 30, 6: "z" * 200_000}
    rows = [(k, f"http://h/{k}\r\nX: y", v, "clash") for k, v in html.items()] + [(5, None, long, "clash"), (None, "u", long, "clash"), (None, "u", "q", "clash")]
    got = round_trip(spark, tmp_path, rows)
    assert len(got) == len(rows)
    for r in got:
        full = (("q" if r.payload_bytes == 1 else long) if r.key is None else html[int(r.key)] or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(full), hashlib.sha256(full).hexdigest())
        revisit = full == long.encode() and r.key != "5"
        assert (r.record_type, r.refers_to) == (("revisit", "5") if revisit else ("response", None))
        assert r.payload == (None if revisit else full)


def test_many_files_and_an_empty_table(spark, tmp_path):
    rows = [(i, "u", f"page {i} " * 20, "") for i in range(57)]
    got = round_trip(spark, tmp_path / "a", rows, records_per_file=5)
    assert sorted(int(r.key) for r in got) == list(range(57))
    assert len(list((tmp_path / "a" / "out").glob("*.warc.gz"))) >= 12
    assert round_trip(spark, tmp_path / "b", []) == []
