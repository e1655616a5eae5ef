import hashlib
import io
import uuid

import duckdb
import pytest

from strandline.llm import warc


def rows_of():
    long = "<p>é€</p>" * 300
    rows = [(i, f"http://a/{i}", f"<html>{i}</html>\r\n\r\nWARC/1.1\r\n") for i in range(40)]
    rows += [(100 + i, "u", long) for i in range(30)] + [(200, None, None), (201, "u", ""), (202, "u\r\nX-Page-ID: 9", "short"), (203, "u", "short"), (None, "u", long), (204, "big", "x€" * 40_000), (205, "u", "y" * 999), (206, "u", "y" * 999), (207, "u", "z" * 1000), (208, "u", "z" * 1000)]
    return [*rows, rows[50], rows[50], rows[-1]]


def brute(rows):
    top = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            top[h] = max(top.get(h, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        ref = top.get(h) if i is not None and len(b) >= 1000 and top[h] != i else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if ref is not None else "response", ref))
    return out


def key(r):
    return tuple((x is None, str(x)) for x in r)


def test_round_trip_of_odd_pages(spark, tmp_path):
    rows = rows_of()
    pages = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, digest string, bytes int").repartition(3)
    manifest = warc.write_archives(warc.decide(pages), f"file://{tmp_path}/a", chunk=1000)
    table = warc.read_archives(spark, manifest, f"file://{tmp_path}/a", chunk=700)
    got = [tuple(r) for r in warc.payloads(table).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    parts = [r for r in table.collect() if r.page_id == 204]
    assert len(parts) > 1 and max(len(r.data) for r in parts) <= 700
    assert b"".join(r.data for r in sorted(parts, key=lambda r: r.chunk_no)).decode() == "x€" * 40_000
    assert sum(r["records"] for r in manifest.collect()) == len(rows)


def test_cut_off_archive_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "text " * 1000)], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.decide(pages), str(tmp_path / "b"))
    raw = open(manifest.first().archive, "rb").read()
    assert len(list(warc.parse(io.BytesIO(raw)))) == 1
    with pytest.raises(OSError):
        list(warc.parse(io.BytesIO(raw[:-40])))


def test_sql_gives_the_same(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    got = [tuple(r) for r in warc.op8_warc(spark, sf).collect()]
    assert sorted(got, key=key) == sorted(con.execute(warc.OP8_SQL).fetchall(), key=key)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = str(tmp_path / uuid.uuid4().hex)
    manifest = warc.write_archives(warc.decide(pages), folder)
    assert warc.payloads(warc.read_archives(spark, manifest, folder)).count() == 0
