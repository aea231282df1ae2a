"""WARC archives: written with an index, read back by coalesced byte ranges of the selected records."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, scratch, small

#: A range read is at most this long, unless one record is longer; records closer than GAP bytes are read together.
RANGE, GAP = 8 << 20, 1 << 16
DATE = "2000-01-01T00:00:00Z"
#: Payloads that occur more than once, up to which number their list is broadcast: a digest of 40 characters and an id each.
SMALL = 200_000
INDEX = "file string, offset long, length long, url string, payload_digest string, page_id long, record_type string"


def record(page: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member with a response, or a revisit without its payload; both keep the HTTP head with the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    kind = "response" if refers_to is None else "revisit"
    name = f"urn:page:{page}" if page is not None else f"urn:uuid:{uuid.uuid4()}"
    fields = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(["WARC/1.1", *fields, "", ""]).encode() + block + b"\r\n\r\n") + z.flush()


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """WARC fields by lower-case name, HTTP head and payload of one gzip member."""
    head, _, rest = zlib.decompress(raw, 31).partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    return fields, http, payload


def write(pages: DataFrame, folder: str, least: int = 0, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write a record for each page into archives under folder (a URI that every executor reaches) and return their index.

    Of records with equal payloads of at least `least` bytes, that with the largest id is the response and the others are revisits of
    it. Null html is an empty payload, a null url an empty one; equal ids with equal payloads are all responses; a null id is smaller than
    any other, and a record without an id is named by a UUID. Pages are shuffled by digest only if more than SMALL payloads occur more than
    once; the list of those is broadcast otherwise. A task writes one archive under a name of its own; the index, written as a table, names only the archives of the attempts that counted.
    """
    size = F.octet_length(F.coalesce(F.col(html), F.lit("")))
    digest = F.sha1(F.coalesce(F.col(html), F.lit("")).cast("binary"))
    keys = pages.select(digest.alias("d"), F.col(id_col).alias("p"), size.alias("n"))
    first = keys.where(F.col("n") >= least).groupBy("d").agg(F.max("p").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    x = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("html"), digest.alias("d"))
    first = cut(first)
    x = x.join(small(first, SMALL), "d", "left")
    x = x.select("page_id", "url", "html", "d", F.when(F.col("page_id").isNull() | (F.col("_first") > F.col("page_id")), F.col("_first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs

        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        name, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for b in batches:
            rows: list[tuple] = []
            for page, u, body, d, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
                u = u.replace("\r", "%0D").replace("\n", "%0A")
                code = base64.b32encode(bytes.fromhex(d)).decode()
                raw = record(page, u, body, code, refers)
                out.write(raw)
                rows.append((name, at, len(raw), u, code, page, "response" if refers is None else "revisit"))
                at += len(raw)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["file", "offset", "length", "url", "payload_digest", "page_id", "record_type"])
        if out:
            out.close()

    return cut(x.mapInArrow(run, INDEX))


def read(index: DataFrame, folder: str, where: Column | None = None) -> DataFrame:
    """Records that the index rows name (those of `where`, if given), read back and checked against their digests.

    The selected rows are dealt by archive and stretch of RANGE bytes and sorted by offset; neighbours are read in one range. Returns
    page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload (null for a revisit).
    """
    chosen = index if where is None else index.where(where)
    chosen = chosen.select("file", "offset", "length", F.floor(F.col("offset") / RANGE).alias("stretch"))
    parts = max(1, chosen.sparkSession.conf.get("spark.sql.shuffle.partitions") and int(chosen.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chosen = chosen.repartition(parts, "file", "stretch").sortWithinPartitions("file", "offset").drop("stretch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs

        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def fetch(run: list[tuple[str, int, int]]) -> pa.RecordBatch:
            file, start, end = run[0][0], run[0][1], run[-1][1] + run[-1][2]
            with fs.open_input_file(f"{root}/{file}") as f:
                data = f.read_at(end - start, start)
            rows = []
            for _, at, n in run:
                fields, http, payload = parse(data[at - start : at - start + n])
                kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                size = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                if kind == "response" and (size != len(payload) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"damaged record at {file}:{at}")
                refers = fields.get("warc-refers-to")
                page = fields["warc-record-id"].strip("<>").removeprefix("urn:page:")
                rows.append((int(page) if page.lstrip("-").isdigit() else None, size, digest, kind, refers and int(refers.strip("<>").rpartition(":")[2]), fields["warc-target-uri"], payload if kind == "response" else None))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        wait: list[tuple[str, int, int]] = []
        for b in batches:
            for x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if wait and (x[0] != wait[0][0] or x[1] > wait[-1][1] + wait[-1][2] + GAP or x[1] + x[2] - wait[0][1] > RANGE):
                    yield fetch(wait)
                    wait = []
                wait.append(x)
        if wait:
            yield fetch(wait)

    return chosen.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def round_trip(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write pages and read all of them back."""
    folder = folder or scratch(pages.sparkSession)
    return read(write(pages, folder, least), folder)
