import gzip
import hashlib

from shapeloom.llm.storage import run_dir
from shapeloom.llm.warc import archive_pages, parse_records, read_archives, warc_record, write_archives


def brute(rows, least=1000):
    """(page_id, bytes, digest, type, refers_to) of rows (page_id, url, html)."""
    groups = {}
    for i, (p, _, t) in enumerate(rows):
        b = (t or "").encode()
        if len(b) >= least and p is not None:
            groups.setdefault(b, []).append((p, -i))
    out = []
    for i, (p, _, t) in enumerate(rows):
        b = (t or "").encode()
        lead = max(groups[b]) if b in groups and p is not None else None
        again = lead is not None and lead != (p, -i)
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", lead[0] if again else None))
    return sorted(out, key=repr)


def shown(df):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()], key=repr)


def test_pages_round_trip(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    folder = run_dir(spark, "warc-test")
    manifest = write_archives(pages, folder, roll_bytes=20_000, part_bytes=200_000)
    assert manifest.count() > 10 and manifest.agg({"records": "sum"}).first()[0] == len(rows)
    got = read_archives(manifest, folder)
    assert shown(got) == brute(rows)
    html = {p: (t or "") for p, _, t in rows}
    assert all(r.payload.decode() == html[r.page_id] for r in got.collect() if r.record_type == "response")
    again = write_archives(pages.repartition(3), run_dir(spark, "warc-test"), roll_bytes=20_000, part_bytes=200_000)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, manifest.collect()))


def test_files_depend_on_the_rows_alone(spark):
    """Thousands of pages, so that a sampled split would move between runs; four ranges and more."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    size = pages.selectExpr("sum(octet_length(html))").first()[0]
    seen = []
    for mixed in (pages, pages, pages.repartition(13).orderBy("html")):
        manifest = write_archives(mixed, run_dir(spark, "warc-test"), part_bytes=size // 5)
        seen.append(sorted((r.file, r.records, r.bytes, r.sha256) for r in manifest.collect()))
    assert seen[0] == seen[1] == seen[2] and len({f.split("-")[0] for f, *_ in seen[0]}) >= 5


def test_urls_come_back_as_they_were(spark):
    urls = ["http://é.example/ü?q=%41 b#\r\nX: y", "", "%", "http://a/%C3%A9", None]
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, html string")
    folder = run_dir(spark, "warc-test")
    assert {r.page_id: r.url for r in read_archives(write_archives(pages, folder), folder).collect()} == dict(enumerate(urls))


def test_nulls_repeats_long_texts_and_extra_columns(spark):
    long = "é" * 600
    rows = [(1, None, None), (2, "http://a/\r\nX: y", ""), (3, "u", long), (9, "u", long), (9, "u", long), (5, "v", long), (None, "w", long),
            (None, None, long), (6, "s", "short"), (7, "s", "short"), (7, "s", "short"), (8, "b", "z" * 2_000_000), (8, "c", "y" * 2000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    assert shown(archive_pages(pages, roll_bytes=1000)) == brute(rows)
    assert archive_pages(pages.limit(0)).count() == 0


def test_record_layout():
    (head, block), = parse_records(gzip.compress(warc_record(4, "http://x/", b"<p>hi")))
    assert head["WARC-Type"] == "response" and block.startswith(b"HTTP/1.1 200 OK\r\n") and block.endswith(b"\r\n\r\n<p>hi")
    (head, block), = parse_records(gzip.compress(warc_record(3, "http://x/", b"<p>hi", 4, True)))
    (full, _), = parse_records(gzip.compress(warc_record(4, "http://x/", b"<p>hi")))
    assert head["WARC-Refers-To"] == full["WARC-Record-ID"] and head["WARC-Payload-Digest"] == full["WARC-Payload-Digest"]
    assert head["Refers-To-Page-ID"] == "4" and head["WARC-Record-ID"] != full["WARC-Record-ID"]
