"""A sharded WARC writer (WARC/1.1, one gzip member per record) and its reader.

Records are range-sorted by page id and cut into shards of equal size; every shard is one task's stream of records, which
rolls its file by compressed size. Files and each shard's manifest are written under temporary names and take their final
ones when complete, so a task that runs again replaces what it left. Only files that the manifests name are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.distributed import prefix_sums
from .common import stored

DATE = "2000-01-01T00:00:00Z"
_MANIFEST = "shard long, file string, records long, bytes long, sha256 string"


def digests(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    body = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    return pages.select(F.col(id_col).cast("long").alias("id"), body.alias("body"), F.sha2(body, 256).alias("digest"))


def _urn(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page: int | None, url: str | None, body: bytes, digest: str, first: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record with fresh headers. A revisit carries the HTTP header of the full payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if revisit else http + body
    head = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page)), ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\r\n]+", " ", url or "")), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if revisit:
        head[4:4] = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _urn(first))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def _gzip(raw: bytes) -> bytes:
    """A gzip member without time or name, so that equal records are equal bytes."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    return fs, path.rstrip("/")


def _commit(fs: pafs.FileSystem, path: str, data: bytes, attempt: str) -> None:
    temporary = f"{path}.{attempt}.tmp"
    with fs.open_output_stream(temporary, compression=None) as out:
        out.write(data)
    fs.move(temporary, path)


def _starts(pages: DataFrame, rows_per_shard: int) -> np.ndarray:
    """The first id of each shard. Shards have `rows_per_shard` rows in order of id, however ids are spread, and are the
    same in every run; rows of one id stay together. The driver gets one number for each shard."""
    ids = pages.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    shard = F.floor(F.col("n_before") / rows_per_shard)
    first = prefix_sums(ids, [], "id", ["n"]).groupBy(shard.alias("shard")).agg(F.min("id").alias("id")).select("id").toPandas()["id"]
    return np.sort(first.to_numpy(dtype=np.int64))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_from: int = 100, file_bytes: int = 8 << 20, rows_per_shard: int = 4000, date: str = DATE) -> DataFrame:
    """Writes the pages under `path` (any URI that Arrow opens on the executors) and returns the manifest (shard, file,
    records, bytes, sha256).

    A null html is an empty payload, a null url an empty URI. Of equal payloads of `revisit_from` bytes or more the
    smallest id is the response (repeated rows with that id all are) and the others revisit it; smaller payloads, and
    groups without any id, are responses. A record of any length fits, since a file is rolled once it has reached
    `file_bytes`. An empty table gives an empty manifest.
    """
    narrow = digests(pages, id_col, html_col).select("id", "digest", F.length("body").alias("n"))
    first = stored(narrow.where(F.col("n") >= revisit_from).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1 and first is not null"), "warc-firsts")
    body = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("body"))
    body = body.withColumn("digest", F.sha2("body", 256)).join(first.select(F.col("digest").alias("d"), "first"), F.col("digest") == F.col("d"), "left").drop("d")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    starts = _starts(narrow, rows_per_shard)

    @F.pandas_udf("long")
    def shard_of(i: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(starts, i.to_numpy(), side="right") - 1, 0))

    # null ids are the last shard; as many tasks as shards, so the largest task stays the same size
    shard = F.when(F.col("id").isNull(), len(starts)).otherwise(shard_of(F.coalesce("id", F.lit(0).cast("long"))))
    rows = body.select(shard.alias("shard"), "id", "url", "body", "digest", "first", revisit.alias("revisit"))
    rows = rows.repartition(len(starts) + 1, "shard").sortWithinPartitions("shard", F.col("id").asc_nulls_last(), "url", "digest")

    def write(batches):
        from pyspark import TaskContext

        fs, root = _open(path)
        fs.create_dir(root, recursive=True)
        attempt = str(TaskContext.get().taskAttemptId())
        shard, parts, size, done = None, [], 0, []

        def roll():
            nonlocal parts, size
            if parts:
                data = b"".join(parts)
                name = f"pages-{shard:08d}-{len(done):05d}.warc.gz"
                _commit(fs, f"{root}/{name}", data, attempt)
                done.append({"shard": shard, "file": name, "records": len(parts), "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()})
                parts, size = [], 0

        def close():
            nonlocal done
            roll()
            if done:
                _commit(fs, f"{root}/manifest-{shard:08d}.json", "".join(json.dumps(x) + "\n" for x in done).encode(), attempt)
                out = pa.RecordBatch.from_pylist(done, schema=kinds)
                done = []
                yield out

        kinds = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
        for b in batches:
            for lo in range(0, len(b), 256):
                for s, *fields in zip(*(c.slice(lo, 256).to_pylist() for c in b.columns), strict=True):
                    if s != shard:
                        yield from close()
                        shard = s
                    parts.append(_gzip(record(*fields, date)))
                    size += len(parts[-1])
                    if size >= file_bytes:
                        roll()
        yield from close()

    return stored(rows.mapInArrow(write, _MANIFEST), "warc-manifest")


def records(data: bytes) -> Iterator[dict]:
    """Headers (lower-case names), HTTP header and payload of each record of a file; checks every block digest."""
    at = 0
    view = memoryview(data)
    while at < len(data):
        z, out = zlib.decompressobj(31), []
        while not z.eof:  # a little at a time: what a member leaves unused is copied
            if at >= len(data):
                raise ValueError("a record is cut off")
            out.append(z.decompress(view[at : at + 4096]))
            at += len(view[at : at + 4096])
        at -= len(z.unused_data)
        raw = b"".join(out)
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])}
        block = rest[: int(fields["content-length"])]
        if f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["warc-block-digest"]:
            raise ValueError(f"damaged record {fields['warc-record-id']}")
        http, _, body = block.partition(b"\r\n\r\n")
        yield {"fields": fields, "http": http, "payload": body}


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """What the shards' manifests under `path` name; no rows if there are none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest-*.json")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
    if not found:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).json(f"{path}/manifest-*.json")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files that the manifests name: id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for a revisit). Sizes and digests are those of the full payload: counted and computed for a
    response, as the record states them for a revisit."""

    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def rows(data: bytes):
        for r in records(data):
            h, body = r["fields"], r["payload"]
            if h["warc-type"] == "revisit":
                n, digest, body = int(re.search(rb"Content-Length: (\d+)", r["http"])[1]), h["warc-payload-digest"].removeprefix("sha256:"), None
            else:
                n, digest = len(body), hashlib.sha256(body).hexdigest()
            yield page(h["warc-record-id"]), h["warc-target-uri"], n, digest, h["warc-type"], page(h.get("warc-refers-to")), body

    def read(batches):
        fs, root = _open(path)
        for b in batches:
            for name in b.column(0).to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
                    found = rows(f.read())
                while some := list(islice(found, 256)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names=names)

    # a task for each file or few
    named = stored(manifests(spark, path).select("file"), "warc-files")
    files = named.repartition(max(1, min(named.count(), 10_000)), "file")
    return files.mapInArrow(read, "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")
