"""WARC archives with a two-level capture index.

Tasks write archives of records compressed one by one, so that each can be read alone. The
index holds a line for every record under its key, the host reversed and then the path, so
that a site lies together. Lines are sorted over all tasks and cut into compressed blocks; a
sparse directory has the first and last key of each block. A lookup searches the directory by
halving, reads one block by its byte range, searches that, and reads the record by its range.

Files go to the shared folder through a file system that tasks open by its address. A task
that is repeated writes files of new names; only those that finished tasks report are used.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, new_folder, nullable

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: payloads shorter than this are always stored whole
MIN_REVISIT_BYTES = 0
#: bytes after which a task begins another archive, and lines of an index block
ARCHIVE_BYTES = 1 << 30
BLOCK_LINES = 3000
#: payload bytes that a task reads back, about
READ_BYTES = 64 << 20
LEVEL = 5

ENTRY = (
    "key string, page_id long, file string, offset long, length long, digest string, payload_bytes long, "
    "record_type string, refers_to long"
)
BLOCK = "first_key string, first_id long, last_key string, last_id long, file string, offset long, length long, lines long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def capture_key(url: str | None) -> str:
    """The sort key of an address: host reversed, path and query; scheme, port and fragment don't count."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").rstrip(".")
    except ValueError:  # not an address: under its own text
        return (url or "").lower()
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + path.lower()


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _record(page_id: int | None, url: str | None, html: str | None, digest: str, kind: str, refers: int | None, refers_url: str | None) -> bytes:
    payload = (html or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")

    def address(u: str | None) -> str:
        return quote(u or "", safe=":/?#[]@!$&'()*+,;=%~-._")

    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {address(url)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Refers-To-Target-URI: {address(refers_url)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record, headers of the response in it, and the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pd.DataFrame({n: nullable(list(c)) if t == "long" else list(c) for (n, t), c in zip(fields, columns)})


def _text_ids(df: DataFrame, *ids: str) -> DataFrame:
    """Ids as text, for the way to pandas: beside a null numbers would come out as floats."""
    return df.withColumns({i: F.col(i).cast("string") for i in ids})


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write a record for every row of ``page_id``, ``url``, ``html`` below ``folder``; return the index entries.

    Of rows with equal payloads of at least ``min_revisit_bytes``, those with the smallest
    ``page_id`` are responses and the others revisit it. Rows without an id are responses.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", "html", F.sha1(payload).alias("sha"), F.octet_length(payload).alias("size"))
    firsts = pages.where(F.col("page_id").isNotNull() & (F.col("size") >= min_revisit_bytes)).groupBy("sha")
    firsts = materialise(firsts.agg(F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url")), "payloads")
    # Every row meets one first at most; a payload that very many rows share is split by the join itself.
    rows = pages.join(firsts, "sha", "left").select("page_id", "url", "html", "first", "first_url", "size")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _open(folder)
        name, out, at = "", None, 0
        try:
            for b in batches:
                entries = []
                for page_id, url, html, first, first_url, size in b.itertuples(index=False):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    page_id, first = (None if x is None else int(x) for x in (page_id, first))
                    again = page_id is not None and size >= min_revisit_bytes and first is not None and first != page_id
                    kind, refers = ("revisit", first) if again else ("response", None)
                    digest = digest_of((html or "").encode())
                    packed = gzip.compress(_record(page_id, url, html, digest, kind, refers, first_url), LEVEL, mtime=0)
                    out.write(packed)
                    entries.append((capture_key(url), page_id, name, at, len(packed), digest, int(size), kind, refers))
                    at += len(packed)
                yield _frame(entries, ENTRY)
        finally:
            if out is not None:
                out.close()

    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)
    return materialise(_text_ids(rows, "page_id", "first").mapInPandas(run, ENTRY), "captures")


def _order(key: str, page_id: int | None) -> tuple[str, int]:
    return key, -(1 << 63) - 1 if page_id is None else page_id


def write_index(entries: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> str:
    """Write sorted, compressed blocks of ``entries`` below ``folder``; return the path of the directory table."""
    columns = [f.split()[0] for f in ENTRY.split(", ")]
    longs = {f.split()[0] for f in ENTRY.split(", ") if f.endswith(" long")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _open(folder)
        name, out, at, held = f"{uuid.uuid4().hex}.cdx.gz", None, 0, []

        def block(lines: list[list]) -> tuple:
            nonlocal out, at
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            packed = gzip.compress("\n".join(json.dumps(x) for x in lines).encode(), LEVEL, mtime=0)
            out.write(packed)
            at += len(packed)
            return (*lines[0][:2], *lines[-1][:2], name, at - len(packed), len(packed), len(lines))

        try:
            for b in batches:
                for r in b[columns].itertuples(index=False):
                    held.append([None if x is None else int(x) if n in longs else x for n, x in zip(columns, r)])
                done = []
                while len(held) >= block_lines:
                    done.append(block(held[:block_lines]))
                    held = held[block_lines:]
                if done:
                    yield _frame(done, BLOCK)
            if held:
                yield _frame([block(held)], BLOCK)
        finally:
            if out is not None:
                out.close()

    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)
    ordered = entries.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    path = new_folder(entries.sparkSession, "directory")
    _text_ids(ordered, *longs).mapInPandas(run, BLOCK).write.parquet(path)
    return path


class Index:
    """Lookups in an index from one task. Keeps the part of the directory last used, and one block."""

    def __init__(self, folder: str, directory: str, archives: str):
        self.fs, self.root = _open(folder)
        self.archive_fs, self.archives = _open(archives)
        fs, path = _open(directory)
        self.directory = pads.dataset(path, filesystem=fs, format="parquet")
        self.blocks: list[dict] = []
        self.ends: list[tuple[str, int]] = []
        self.files: dict[tuple, object] = {}
        self.block: tuple[tuple | None, list] = (None, [])

    def between(self, low: str, high: str) -> None:
        """Load the directory of blocks that may hold keys from ``low`` to ``high``."""
        part = self.directory.to_table(filter=(pads.field("first_key") <= high) & (pads.field("last_key") >= low))
        self.blocks = sorted(part.to_pylist(), key=lambda b: _order(b["first_key"], b["first_id"]))
        self.ends = [_order(b["last_key"], b["last_id"]) for b in self.blocks]

    def _read(self, fs: pafs.FileSystem, path: str, offset: int, length: int) -> bytes:
        if path not in self.files:
            if len(self.files) > 64:
                for f in self.files.values():
                    f.close()
                self.files.clear()
            self.files[path] = fs.open_input_file(path)
        return self.files[path].read_at(length, offset)

    def find(self, key: str, page_id: int | None) -> list[list]:
        """The index entries of a page under a key."""
        wanted, out = _order(key, page_id), []
        at = bisect_left(self.ends, wanted)
        while at < len(self.blocks) and _order(self.blocks[at]["first_key"], self.blocks[at]["first_id"]) <= wanted:
            b = self.blocks[at]
            place = b["file"], b["offset"]
            if self.block[0] != place:
                data = gzip.decompress(self._read(self.fs, f"{self.root}/{b['file']}", b["offset"], b["length"]))
                self.block = place, [json.loads(x) for x in data.decode().split("\n")]
            lines = self.block[1]
            i = bisect_left(lines, wanted, key=lambda x: _order(x[0], x[1]))
            while i < len(lines) and _order(lines[i][0], lines[i][1]) == wanted:
                out.append(lines[i])
                i += 1
            at += 1
        return out

    def record(self, entry: list) -> tuple[dict[str, str], dict[str, str], bytes]:
        """Read one record by its range."""
        packed = self._read(self.archive_fs, f"{self.archives}/{entry[2]}", entry[3], entry[4])
        return parse_record(zlib.decompress(packed, wbits=31))


def look_up(wanted: DataFrame, folder: str, directory: str, archives: str, tasks: int) -> DataFrame:
    """The records of each distinct (``url``, ``page_id``), read from the archives through the index by so many tasks.

    Keys are small, so their own size says nothing of the work behind them.

    A response's digest is computed from its payload and must be the one it states.
    """
    as_key = F.pandas_udf(lambda urls: urls.map(capture_key, na_action=None), "string")
    keys = wanted.select(as_key("url").alias("key"), F.col("page_id").cast("long")).distinct()
    keys = keys.repartitionByRange(tasks, "key", "page_id").sortWithinPartitions("key", "page_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = None
        for b in batches:
            index = index or Index(folder, directory, archives)
            index.between(b["key"].iloc[0], b["key"].iloc[-1])
            rows = []
            for key, page_id in b.itertuples(index=False):
                for entry in index.find(key, None if page_id is None else int(page_id)):
                    head, http, payload = index.record(entry)
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(http["Content-Length"])
                    if head["WARC-Type"] == "response" and (digest_of(payload), len(payload)) != (digest, size):
                        raise ValueError(f"damaged record in {entry[2]} at {entry[3]}")
                    own, refers = (re.fullmatch(r"<urn:page:(-?\d*)>", head.get(h, "<urn:page:>"))[1] for h in ("WARC-Record-ID", "WARC-Refers-To"))
                    rows.append((int(own) if own else None, size, digest, head["WARC-Type"], int(refers) if refers else None))
            yield _frame(rows, RECORD)

    return _text_ids(keys, "page_id").mapInPandas(run, RECORD)


def archive_and_read(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write ``pages`` as archives with an index, then read every page back through it.

    ``page_id``, ``payload_bytes``, ``payload_digest`` (SHA-1, upper-case base 32), ``record_type``
    and ``refers_to`` of each record. Other columns of ``pages`` are ignored. A null html is an
    empty payload, a null url has the key of an empty one. A row without a ``page_id`` is a
    response. Repeated rows are records each. An empty table writes nothing and gives no rows.
    """
    pages = pages.select(F.col("page_id").cast("long"), "url", "html")
    archives, folder = (new_folder(pages.sparkSession, n) for n in ("archives", "index"))
    entries = write_archives(pages, archives, min_revisit_bytes)
    directory = write_index(entries, folder, block_lines)
    n_bytes = entries.agg(F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("n")).first()["n"]
    tasks = max(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // READ_BYTES))
    return look_up(pages, folder, directory, archives, tasks)
