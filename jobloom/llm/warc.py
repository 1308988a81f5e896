"""WARC archives: written as one gzip stream each, normalised to one member per record with a sidecar offset index.

``write_archives`` leaves the job to Spark's text writer with gzip, which gives archives that are a single stream: no
record can be read without inflating all before it.  ``normalise`` inflates each such archive once, as a stream, and
writes every record as a member of its own beside an index of offsets, from which ``read_records`` reads any record.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.common import written
from jobloom.session import shared_dir

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "record_id string, record_type string, archive string, offset long, length long"
_RECORD = (
    "record_id string, record_type string, uri string, refers_to string, payload_digest string, payload_bytes long, "
    "payload_sha256 string, payload binary"
)
_CHUNK = 1 << 20
#: One archive of a normalising task is given up beyond so large a header block; payloads have no limit.
_MOST_HEADER = 1 << 20


def _one_line(text: Column) -> Column:
    """A header value: percent signs and control characters percent-encoded, so it stays on its line and can be undone."""
    out = F.replace(text, F.lit("%"), F.lit("%25"))
    for code in [*range(0x20), 0x7F]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def records_of(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_revisit_bytes: int = 100,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """One WARC record per row, as text in the single column ``value``.

    The payload is the html in UTF-8, null as empty.  Of records with equal payloads (SHA-256) of at least
    ``least_revisit_bytes`` bytes the one with the smallest id is a response and the rest revisit it; smaller payloads
    are always responses.  Rows that share the smallest id are all responses.  A null id is larger than any other and
    written as ``null``.  A null URL is written as an empty one.  Other columns are not read.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    given = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(_one_line(F.col(url_col)), F.lit("")).alias("url"),
        html.alias("html"),
        F.octet_length(html).alias("n"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
    )
    # Sums per digest combine before the shuffle; only digests that occur again come back to the pages.
    first = (
        pages.select(F.col(id_col).cast("long").alias("id"), html.alias("html"))
        .where(F.octet_length("html") >= least_revisit_bytes)
        .select("id", F.sha2(F.col("html").cast("binary"), 256).alias("digest"))
        .groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n_same"))
        .where("n_same > 1 and first_id is not null")
        .select("digest", "first_id")
    )
    all_ = given.join(first, "digest", "left")
    revisit = F.coalesce((F.col("n") >= least_revisit_bytes) & ~F.col("first_id").eqNullSafe(F.col("id")) & F.col("first_id").isNotNull(), F.lit(False))
    http = F.concat(F.lit(_HTTP), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(http, F.col("html")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        name("id"),
        F.lit("\r\nWARC-Target-URI: "),
        F.col("url"),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.lit("\r\nWARC-Payload-Length: "),
        F.col("n").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), name("first_id"), F.lit(f"\r\nWARC-Profile: {_PROFILE}"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
    )
    # The writer ends each row with a line feed, the last byte of a record.
    return all_.select(F.concat(head, block, F.lit("\r\n\r")).alias("value"))


def write_archives(records: DataFrame, folder: str, records_per_archive: int = 20_000) -> None:
    """Archives of one gzip stream each, in any file system that Spark writes to."""
    options = {"compression": "gzip", "lineSep": "\n", "maxRecordsPerFile": str(records_per_archive)}
    records.write.options(**options).text(folder)


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Inflated:
    """Reads a gzip file, of one member or many, as one stream of bytes."""

    def __init__(self, raw):
        self.raw, self.engine, self.ready, self.at = raw, zlib.decompressobj(31), b"", 0

    def _more(self) -> bool:
        while True:
            if self.engine.eof:
                rest = self.engine.unused_data or self.raw.read(_CHUNK)
                if not rest:
                    return False
                self.engine = zlib.decompressobj(31)
            else:
                rest = self.engine.unconsumed_tail or self.raw.read(_CHUNK)
                if not rest:
                    raise EOFError("archive ends inside a member")
            got = self.engine.decompress(rest, _CHUNK)
            if got:
                self.ready = self.ready[self.at :] + got
                self.at = 0
                return True

    def until(self, mark: bytes, most: int) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the stream."""
        start = self.at
        while (found := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - self.at - len(mark) + 1)
            if len(self.ready) - self.at > most:
                raise ValueError("header too long")
            if not self._more():
                if len(self.ready) > self.at:
                    raise EOFError("archive ends inside a header")
                return None
        out = self.ready[self.at : found + len(mark)]
        self.at = found + len(mark)
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if self.at == len(self.ready) and not self._more():
                raise EOFError("archive ends inside a record")
            piece = self.ready[self.at : self.at + n]
            self.at += len(piece)
            n -= len(piece)
            yield piece


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def _normalise(folder: str, level: int):
    """Archives (path) to rows of their offset index; the new archive and its sidecar are written on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        for batch in batches:
            for path in batch.column(0).to_pylist():
                stem = path.rpartition("/")[2].split(".")[0]
                target = f"{folder}/{stem}-{zlib.crc32(path.encode()):08x}"
                source, at = _filesystem(path)
                out_fs, out_at = _filesystem(target)
                out_fs.create_dir(out_at.rpartition("/")[0], recursive=True)
                draft = f"{out_at}.{uuid.uuid4().hex}"
                rows, offset = [], 0
                with source.open_input_stream(at, compression=None) as raw, out_fs.open_output_stream(draft + ".gz", compression=None) as out:
                    stream = _Inflated(raw)
                    while (head := stream.until(b"\r\n\r\n", _MOST_HEADER)) is not None:
                        fields = _headers(head)
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                        length = 0

                        def put(data: bytes) -> int:
                            if data:
                                out.write(data)
                            return len(data)

                        length += put(packer.compress(head))
                        for piece in stream.exactly(int(fields["content-length"])):
                            length += put(packer.compress(piece))
                        end = b"".join(stream.exactly(4))
                        if end != b"\r\n\r\n":
                            raise ValueError(f"{path}: no record end at {offset}")
                        length += put(packer.compress(end)) + put(packer.flush())
                        rows.append((fields.get("warc-record-id", ""), fields.get("warc-type", ""), target + ".warc.gz", offset, length))
                        offset += length
                with out_fs.open_output_stream(draft + ".idx", compression=None) as side:
                    for name, kind, _, begin, length in rows:
                        side.write(f"{begin}\t{length}\t{kind}\t{name}\n".encode())
                out_fs.move(draft + ".gz", out_at + ".warc.gz")
                out_fs.move(draft + ".idx", out_at + ".idx")
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                    names=["record_id", "record_type", "archive", "offset", "length"],
                )

    return run


def normalise(spark: SparkSession, archives: str, folder: str, *, level: int = 6) -> DataFrame:
    """Rewrites all archives below ``archives`` into ``folder``; returns the index, a row per record.

    Each archive is inflated once, as a stream, so its size does not matter for memory.  An archive and its sidecar
    appear under their names when they are complete; a task that runs again writes the same files.  The index is also
    kept as a table, which is what is returned.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(archives).select("path")
    listed = listed.repartition(4 * spark.sparkContext.defaultParallelism, "path")
    return written(listed.mapInArrow(_normalise(folder, level), _INDEX), "warc-index")


def _parse(member: bytes, with_payload: bool) -> tuple:
    data = zlib.decompressobj(31).decompress(member)
    cut = data.index(b"\r\n\r\n") + 4
    fields = _headers(data[:cut])
    block = data[cut : cut + int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2] if fields["warc-type"] == "response" else None
    digest = fields.get("warc-payload-digest", "").partition(":")[2]
    n = len(payload) if payload is not None else int(fields.get("warc-payload-length", "0"))
    sha = hashlib.sha256(payload).hexdigest() if payload is not None else digest
    refers = fields.get("warc-refers-to")
    return (fields["warc-record-id"], fields["warc-type"], fields.get("warc-target-uri"), refers, digest, n, sha, payload if with_payload else None)


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "record_type", "uri", "refers_to", "payload_digest", "payload_bytes", "payload_sha256", "payload"]
        kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]
        opened, file = None, None
        for batch in batches:
            rows, held = [], 0
            for path, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != opened:
                    fs, at = _filesystem(path)
                    file, opened = fs.open_input_file(at), path
                rows.append(_parse(file.read_at(length, offset), with_payload))
                held += len(rows[-1][-1] or b"")
                if held > 32 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)

    return run


def read_records(index: DataFrame, *, payloads: bool = False) -> DataFrame:
    """The records an index points to, each read and inflated on its own.

    ``payload_bytes`` and ``payload_sha256`` are of the payload as read for a response; a revisit has none and gives
    what its header says of the payload it stands for.
    """
    places = index.select("archive", "offset", "length").repartition(F.col("archive"), F.floor(F.col("offset") / (8 << 20)))
    return places.sortWithinPartitions("archive", "offset").mapInArrow(_read(payloads), _RECORD)


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """The index as the sidecar files beside the archives have it."""
    lines = spark.read.option("pathGlobFilter", "*.idx").text(folder).select(F.split("value", "\t", 4).alias("f"), F.input_file_name().alias("side"))
    return lines.select(
        F.col("f")[3].alias("record_id"),
        F.col("f")[2].alias("record_type"),
        F.regexp_replace("side", r"\.idx$", ".warc.gz").alias("archive"),
        F.col("f")[0].cast("long").alias("offset"),
        F.col("f")[1].cast("long").alias("length"),
    )


def archive_pages(pages: DataFrame, *, records_per_archive: int = 20_000, **columns: str) -> tuple[str, str]:
    """Writes pages as single-stream archives and normalises them; returns the folders of both."""
    spark = pages.sparkSession
    raw, normal = shared_dir(spark, "warc-stream"), shared_dir(spark, "warc")
    write_archives(records_of(pages, **columns), raw, records_per_archive)
    normalise(spark, raw, normal)
    return raw, normal
