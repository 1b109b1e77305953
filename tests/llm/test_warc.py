import base64
import gzip
import hashlib
import io

from tidemark.llm import warc
from tidemark.llm.common import new_folder

LONG = "<p>ünïcode \r\n\r\n body</p>" * 20000
PAGES = [
    (5, "https://www.b.example.com/x?q=1#top", "<p>same</p>"), (2, "http://a.example.com:80/y", "<p>same</p>"), (9, "http://a.example.com/y", "<p>same</p>"),
    (3, None, None), (4, "", ""), (7, "not a url \r\n X: 1", "<p>other</p>"), (8, "https://[bad/", LONG), (1, "https://ünï.example/ö", LONG),
    (None, "http://a.example.com/y", "<p>same</p>"), (10, "http://z.example/", "uniq"), (10, "http://z.example/", "uniq"),
]


def expected(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(i, first.get(h or "", i))
    for i, _, h in rows:
        data = (h or "").encode()
        again = i is not None and len(data) >= least and first[h or ""] != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        yield (i, len(data), digest, "revisit" if again else "response", first[h or ""] if again else None)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in PAGES], "page_id long, url string, html string, key string, offset int")
    for least, lines in ((0, 3000), (0, 2), (12, 1)):
        assert rows_of(warc.archive_and_read(df.repartition(3), least, lines)) == sorted(expected(PAGES, least), key=str)
    assert warc.archive_and_read(df.limit(0)).count() == 0


def test_many_pages_of_one_host_over_many_blocks(spark):
    rows = [(i, f"https://hot.example.com/{i % 700}", f"page {i % 300}") for i in range(2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert rows_of(warc.archive_and_read(df, 0, 50)) == sorted(expected(rows), key=str)


def test_keys_keep_a_site_together():
    key = warc.capture_key
    assert key("HTTPS://www.Example.com:443/A?b=C#d") == "com,example,www)/a?b=c"
    assert key("http://example.com") == "com,example)/" and key(None) == ")/"
    a, b, c = sorted(map(key, ("http://x.example.com/", "http://example.com/z", "http://example.org/")))
    assert a.startswith("com,example)") and b.startswith("com,example,x)") and c.startswith("org")


def test_archives_are_members_that_stand_alone(spark):
    folder = new_folder(spark, "archives")
    entries = warc.write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string"), folder).collect()
    fs, root = warc._open(folder)
    for e in entries:
        with fs.open_input_file(f"{root}/{e['file']}") as f:
            data = gzip.GzipFile(fileobj=io.BytesIO(f.read_at(e["length"], e["offset"]))).read()
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        head, http, payload = warc.parse_record(data)
        assert head["WARC-Type"] == e["record_type"] and "X" not in head
        assert int(http["Content-Length"]) == e["payload_bytes"] and (payload == b"" or len(payload) == e["payload_bytes"])
