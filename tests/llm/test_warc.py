import gzip
import hashlib
from collections import Counter

import pyarrow.fs as pafs
from pyspark.sql import functions as F

from ridgeline.llm import warc

BIG = "<p>" + "x" * 200 + "é</p>"
ROWS = [
    (3, "http://a/x y\r\nZ: 1", BIG), (1, "http://b/", BIG), (None, "http://c/", BIG), (1, "http://b/", BIG), (4, None, None),
    (5, "http://d/", ""), (6, "http://d/", "small"), (7, "http://d/", "small"), (8, "é%20", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n" * 9),
    (None, None, "only" * 40), (None, "http://e/", "only" * 40),
]


def made(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, offset int, file string").repartition(3)


def expected(rows):
    least = {}
    for i, _, html in rows:
        if i is not None:
            least[html] = min(i, least.get(html, i))
    out = []
    for i, url, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and html in least and i != least[html]
        out.append((i, url, hashlib.sha256(data).hexdigest(), len(data), "revisit" if again else "response", least[html] if again else None))
    return Counter(out)


def test_round_trip(spark, tmp_path):
    folder = str(tmp_path / "w")
    index = warc.write(made(spark), folder)
    got = warc.read(index, folder).collect()
    assert Counter((r.page_id, r.url, r.digest, r.payload_bytes, r.record_type, r.refers_to) for r in got) == expected(ROWS)
    by_id = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response" and r.page_id is not None}
    assert by_id[8].decode() == ROWS[8][2] and by_id[4] == b""


def test_files_are_warc(spark, tmp_path):
    """Every file is a row of gzip members at the places the index names, and reads as a whole too."""
    folder = tmp_path / "w"
    index = warc.write(made(spark), str(folder)).collect()
    files = sorted(p.name for p in folder.iterdir())
    assert files == sorted({r.file for r in index})
    for name in files:
        data = (folder / name).read_bytes()
        own = sorted((r.offset, r.length) for r in index if r.file == name)
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) == len(data)
        assert gzip.decompress(data).count(b"WARC-Record-ID") == len(own)
        for o, n in own:
            assert gzip.decompress(data[o:o + n]).startswith(b"WARC/1.1\r\nWARC-Type: re")


def test_selected_records_in_ranges(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://h/{i}", f"page {i} " * 40) for i in range(300)]
    folder = str(tmp_path / "w")
    index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    assert warc.ranges(index).select("file", "run").distinct().count() == 1
    monkeypatch.setattr(warc, "GAP_BYTES", 100)
    few = index.filter("page_id % 50 < 2")
    assert warc.ranges(few).select("run").distinct().count() == 6
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(few, folder).collect()}
    assert got == {i: rows[i][2] for i in range(300) if i % 50 < 2}


def test_left_over_volumes_go(spark, tmp_path):
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "volume-00000-999-0.warc.gz").write_bytes(b"half a record")
    index = warc.write(made(spark), str(folder))
    assert {p.name for p in folder.iterdir()} == {r.file for r in index.collect()}


def test_changed_archive_is_noticed(spark, tmp_path):
    import pytest

    folder = str(tmp_path / "w")
    index = warc.write(made(spark), folder)
    wrong = index.withColumn("digest", F.lit("0" * 64))
    with pytest.raises(Exception, match="digest differs"):
        warc.read(wrong, folder).collect()


def test_columns_come_from_the_archive(spark, tmp_path):
    """An index that knows only places and digests is enough, for revisits too."""
    folder = str(tmp_path / "w")
    index = warc.write(made(spark), folder).withColumns({
        "url": F.lit("http://wrong/"), "payload_bytes": F.lit(-1).cast("long"), "record_type": F.lit("x"), "refers_to": F.lit(99).cast("long"),
        "page_id": F.lit(-5).cast("long")})
    got = warc.read(index, folder).collect()
    assert Counter((r.page_id, r.url, r.digest, r.payload_bytes, r.record_type, r.refers_to) for r in got) == expected(ROWS)


def test_very_long_page(spark, tmp_path, monkeypatch):
    """A page far longer than a byte range or a volume."""
    monkeypatch.setattr(warc, "RANGE_BYTES", 1000)
    monkeypatch.setattr(warc, "VOLUME_BYTES", 5000)
    rows = [(1, "http://a/", "short"), (2, "http://b/", " ".join(str(i * 7919 % 100_003) for i in range(300_000))), (3, "http://c/", "end")]
    folder = str(tmp_path / "w")
    index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(index, folder).collect()}
    assert got == {i: html for i, _, html in rows}


def test_empty(spark, tmp_path):
    folder = str(tmp_path / "w")
    index = warc.write(made(spark).limit(0), folder)
    assert index.count() == 0 and warc.read(index, folder).count() == 0


def test_store_takes_addresses(tmp_path):
    assert isinstance(warc.store(f"file://{tmp_path}")[0], pafs.LocalFileSystem)
