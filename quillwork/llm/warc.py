"""WARC archives: write, normalise monolithic gzip to one member per record with an offset index, read by index.

Writers first make a file that is one gzip stream, as careless tools do. The normaliser inflates such a stream once,
front to back, cuts it into records by their Content-Length, writes each record as a gzip member of its own, and
writes a sidecar index (offset and length of each member). Readers seek by the index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import listed, partitions, prepare, scratch, with_rid
from .store import published, random_access


@dataclass(frozen=True)
class Settings:
    least_bytes: int = 1000  # payloads of at least so many bytes are revisited, not repeated
    level: int = 6
    date: str = "2024-01-01T00:00:00Z"  # of all records, so that archives are reproducible


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Inflated:
    """A gzip file, of one member or many, as one stream of bytes, inflated once in blocks."""

    def __init__(self, f, block: int = 1 << 18):
        self.f, self.block, self.held = f, block, bytearray()
        self.z = zlib.decompressobj(31)
        self.over = False

    def _more(self) -> bool:
        while not self.over:
            data = self.z.unused_data or self.f.read(self.block) if self.z.eof else self.f.read(self.block)
            if not data:
                if not self.z.eof:
                    raise EOFError("the gzip stream is cut off")
                self.over = True
                return False
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            got = self.z.decompress(data)
            if got:
                self.held += got
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to the mark and with it; None at the end."""
        at = 0
        while (i := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark))
            if not self._more():
                if self.held.strip():
                    raise EOFError("a record is cut off")
                return None
        out = bytes(self.held[: i + len(mark)])
        del self.held[: i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise EOFError("a record is cut off")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def fields_of(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        if k:
            out[k.lower()] = v.strip()
    return out


def records(stream: Inflated) -> Iterator[tuple[bytes, bytes]]:
    """(head, block) of each record."""
    while (head := stream.until(b"\r\n\r\n")) is not None:
        block = stream.take(int(fields_of(head)["content-length"]))
        stream.take(4)
        yield head, block


def normalise(source, target, level: int = 6) -> list[tuple[int, int]]:
    """Rewrite each record of a gzip stream as a member of its own; returns the members' (offset, length)."""
    at, out = 0, []
    for head, block in records(Inflated(source)):
        member = gzip.compress(head + block + b"\r\n\r\n", level, mtime=0)
        target.write(member)
        out.append((at, len(member)))
        at += len(member)
    return out


def member(f, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record, by its place in the index."""
    f.seek(offset)
    raw = zlib.decompress(f.read(length), 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    got = fields_of(head + b"\r\n")
    return got, rest[: int(got["content-length"])]


def _write(s: Settings, base: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        uri = f"{base}/part-{part:06d}.warc.gz".replace("part-", "pages-")
        with tempfile.TemporaryFile() as raw:
            n = 0
            with gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=1, mtime=0) as z:  # one stream for the whole file
                z.write(record("warcinfo", {"WARC-Record-ID": f"<urn:page-file:{part}>", "WARC-Date": s.date, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))
                for b in batches:
                    for page, url, html, sha1, to in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "sha1", "refers_to")), strict=True):
                        body = html.encode()
                        digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                        address = "".join(c if " " < c < "\x7f" else f"%{c.encode().hex()}" for c in url or "about:blank")
                        f = {"WARC-Record-ID": f"<urn:page:{page}>", "WARC-Date": s.date, "WARC-Target-URI": address, "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response"}
                        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                        if to is None:
                            z.write(record("response", f, http + body))
                        else:  # a revisit keeps the HTTP head, whose length is the payload's, and no payload
                            f |= {"WARC-Refers-To": f"<urn:page:{to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
                            z.write(record("revisit", f, http))
                        n += 1
            raw.seek(0)
            with published(uri) as target:
                index = normalise(raw, target, s.level)
        at = np.array(index, "<i8").reshape(-1, 2)
        with published(f"{uri}.idx") as f:
            f.write(b"QWIX" + np.array([len(at)], "<i8").tobytes() + at.tobytes())
        yield pa.record_batch([pa.array([uri]), pa.array([n], pa.int64())], names=["uri", "records"])

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("uri").to_pylist():
            with random_access(f"{uri}.idx") as f:
                raw = f.read()
            at = np.frombuffer(raw[12:], "<i8").reshape(-1, 2)
            if raw[:4] != b"QWIX" or len(at) != int.from_bytes(raw[4:12], "little"):
                raise ValueError(f"{uri}.idx is damaged")
            rows: list[tuple] = []
            with random_access(uri) as f:
                for offset, length in at.tolist():
                    head, block = member(f, offset, length)
                    kind = head["warc-type"]
                    if kind == "warcinfo":
                        continue
                    http, _, body = block.partition(b"\r\n\r\n")
                    n = int(fields_of(http + b"\r\n")["content-length"])
                    digest = base64.b32decode(head["warc-payload-digest"][5:]).hex()
                    if kind == "response" and (len(body) != n or hashlib.sha1(body).hexdigest() != digest):
                        raise ValueError(f"{uri} at {offset}: the payload is damaged")
                    number = lambda x: None if x is None or x.endswith(":None>") else int(x[10:-1])
                    rows.append((number(head["warc-record-id"]), n, digest, kind, number(head.get("warc-refers-to")), offset, length))
                    if len(rows) >= 2000:
                        yield _rows(rows)
                        rows = []
            if rows:
                yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "member_offset", "member_bytes"]
    return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def revisits(pages: DataFrame, s: Settings = Settings()) -> DataFrame:
    """pages with sha1 and refers_to: null, or for a payload met again the largest page_id of its copies.

    Hot payloads: the largest id is aggregated before the shuffle; only ids and digests are joined, and the copies
    of one payload are dealt over several keys.
    """
    salts = 16
    d = with_rid(pages.select("page_id", "url", "html"), "page_id", "html").withColumn("html", F.coalesce("html", F.lit("")))
    d = d.withColumn("page_id", F.col("page_id").cast("long")).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    ids = d.filter(F.octet_length("html") >= s.least_bytes).select("_rid", "page_id", "sha1", F.octet_length("html").alias("n"), F.pmod(F.xxhash64("_rid"), F.lit(salts)).alias("salt"))
    top = ids.groupBy("sha1", "n").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("k")).filter("k > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    again = ids.join(top, ["sha1", "n", "salt"]).filter("page_id != top").select("_rid", F.col("top").alias("refers_to"))
    return d.join(again, "_rid", "left")


def write(pages: DataFrame, base: str, s: Settings = Settings()) -> DataFrame:
    """Write normalised archives with their indexes under base; returns the list of files (uri, records).

    A null html is an empty payload, a null url about:blank. Copies of a payload with one page_id are all responses if
    that is the largest. Null page_ids are written as such and read back as null. An empty table gives files without
    pages. Only page_id, url and html are read.
    """
    spark = pages.sparkSession
    prepare(spark)
    d = revisits(pages, s).repartition(partitions(spark), "_rid").select("page_id", "url", "html", "sha1", "refers_to")
    return listed(d.mapInArrow(_write(s, base), "uri string, records long"), "archives")


def read(files: DataFrame) -> DataFrame:
    """One row per record of the archives; payloads of responses are held against their digests."""
    prepare(files.sparkSession)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, member_offset long, member_bytes long"
    return files.select("uri").repartition(partitions(files.sparkSession), "uri").mapInArrow(_read, schema)


def query(spark, sf_dir: str) -> DataFrame:
    out = read(write(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch(spark)))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB: the query's rows.
SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, cast(octet_length(encode(h)) as bigint) as payload_bytes, sha1(h) as payload_digest, max(page_id) over (partition by h) as top from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> top then top end as refers_to
from q
"""
