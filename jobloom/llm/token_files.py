"""Token-id files: whole documents as rANS-coded ids in ascending id order, written and read back in parallel.

A folder holds one frequency table (``table.rans``) and numbered files.  A file is

    ``RANSIDS1``, blocks, footer, footer length (u32), ``RANSIDS1``

A block codes up to 262,144 consecutive ids of the file and depends on the table alone.  The footer (zlib over JSON
head and arrays) lists per block offset, length, first token and the CRC-32 of its bytes - the checkpoints from which
blocks can be decoded independently - and per document its id and number of ids.  A document may span blocks.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm import rans
from jobloom.llm.common import setting, slices, written
from jobloom.llm.tokens import default_vocabulary, encoder
from jobloom.session import shared_dir

MAGIC = b"RANSIDS1"
_NO_ID = -(2**63)  # stands for a null id in the order: before all others
_COUNTS = -1
_PACKED = pa.schema(
    [
        ("bucket", pa.int64()),
        ("ids", pa.binary()),
        ("ties", pa.binary()),
        ("counts", pa.binary()),
        ("tokens", pa.binary()),
    ]
)
_MANIFEST = "bucket long, path string, n_docs long, n_tokens long, n_bytes long"
_DECODED = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _put(path: str, parts: list[bytes]) -> None:
    """Writes a whole file or nothing; a repeated task writes the same bytes over it."""
    import uuid

    files, place = _filesystem(path)
    files.create_dir(place.rpartition("/")[0], recursive=True)
    draft = f"{place}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    files.move(draft, place)


def _tokenise(vocabulary: str, bounds: list[int], end_id: int):
    """Batches of (doc_id, tie, text) to packed ids per bucket, and one row of id counts per task."""
    edges = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        coder = encoder(vocabulary)
        total = np.zeros(1 << 16, np.int64)
        end = np.array([end_id], np.uint16)
        for batch in slices(batches, lambda b: b.column(2), 4 << 20):
            ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            ties = batch.column(1).to_numpy(zero_copy_only=False)
            tokens = [np.concatenate([t, end]) for t in coder.encode(batch.column(2))]
            # An id that spans several bounds is spread over their buckets by its tie.
            lo, hi = np.searchsorted(edges, ids, "left"), np.searchsorted(edges, ids, "right")
            share = (ties.astype(np.float64) + 2.0**63) / 2.0**64
            bucket = lo + np.minimum((share * (hi - lo + 1)).astype(np.int64), hi - lo)
            rows = []
            for b in np.unique(bucket):
                at = np.flatnonzero(bucket == b)
                joined = np.concatenate([tokens[i] for i in at])
                total += np.bincount(joined, minlength=1 << 16)
                counts = np.array([len(tokens[i]) for i in at], np.int64)
                rows.append((int(b), ids[at].tobytes(), ties[at].tobytes(), counts.tobytes(), packer.compress(joined.tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PACKED, strict=True)], schema=_PACKED)
        row = (_COUNTS, b"", b"", b"", packer.compress(total.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _PACKED, strict=True)], schema=_PACKED)

    return run


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            total += np.frombuffer(zstandard.decompress(blob), np.int64)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["token", "n"])


def _write_bucket(folder: str, table: bytes):
    """All documents of one bucket, in order, as one file."""

    def run(key, rows):
        import zstandard

        coder = rans.Table.load(table)
        each = rows.to_pydict()
        join = lambda name: np.frombuffer(b"".join(each[name]), np.int64)
        ids, ties, counts = join("ids"), join("ties"), join("counts")
        tokens = np.concatenate([np.frombuffer(zstandard.decompress(x), np.uint16) for x in each["tokens"]])
        order = np.lexsort((ties, ids))
        begin = (np.cumsum(counts) - counts)[order]
        ids, counts, given = ids[order], counts[order], tokens
        tokens, filled = np.empty_like(given), 0
        for i, n in zip(begin.tolist(), counts.tolist(), strict=True):  # an index of all ids would take far more memory
            tokens[filled : filled + n] = given[i : i + n]
            filled += n
        del given
        parts, blocks, at = [MAGIC], [], len(MAGIC)
        for lo in range(0, len(tokens), rans.BLOCK_TOKENS):
            block = rans.encode_block(tokens[lo : lo + rans.BLOCK_TOKENS], coder)
            blocks.append((at, len(block), lo, zlib.crc32(block)))
            parts.append(block)
            at += len(block)
        head = json.dumps({"n_docs": len(ids), "n_tokens": len(tokens), "table_crc32": zlib.crc32(table), "blocks": blocks}).encode()
        footer = zlib.compress(struct.pack("<I", len(head)) + head + ids.tobytes() + counts.tobytes())
        parts += [footer, struct.pack("<I", len(footer)), MAGIC]
        bucket = key[0].as_py()
        path = f"{folder}/ids-{bucket:09d}.rans"
        _put(path, parts)
        return pa.table({"bucket": [bucket], "path": [path], "n_docs": [len(ids)], "n_tokens": [len(tokens)], "n_bytes": [sum(map(len, parts))]})

    return run


class IdFile:
    """One file opened for reading: footer at once, blocks on demand."""

    def __init__(self, path: str, table: bytes):
        files, place = _filesystem(path)
        self.file = files.open_input_file(place)
        self.table = rans.Table.load(table)
        size = self.file.size()
        length, magic = struct.unpack("<I8s", self.file.read_at(12, size - 12))
        footer = zlib.decompress(self.file.read_at(length, size - 12 - length))
        n = struct.unpack_from("<I", footer)[0]
        self.head = json.loads(footer[4 : 4 + n])
        if magic != MAGIC or self.head["table_crc32"] != zlib.crc32(table):
            raise ValueError(f"{path}: not written with this table")
        k = self.head["n_docs"]
        self.ids = np.frombuffer(footer, np.int64, k, 4 + n)
        self.counts = np.frombuffer(footer, np.int64, k, 4 + n + 8 * k)

    def block(self, i: int) -> np.ndarray:
        offset, length, _, crc = self.head["blocks"][i]
        data = self.file.read_at(length, offset)
        if zlib.crc32(data) != crc:
            raise ValueError("damaged block")
        return rans.decode_block(data, self.table)

    def tokens(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file, from the blocks that hold them alone."""
        first, last = start // rans.BLOCK_TOKENS, (start + n - 1) // rans.BLOCK_TOKENS
        if n <= 0:
            return np.empty(0, np.uint16)
        got = np.concatenate([self.block(i) for i in range(first, last + 1)])
        return got[start - first * rans.BLOCK_TOKENS :][:n]


def _decode(table: bytes):
    """Files (path, start) to one row per document; one block in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                f = IdFile(path, table)
                ends = np.cumsum(f.counts)
                crcs = np.zeros(len(f.ids), np.int64)
                doc, crc = 0, 0
                for i, (_, _, first, _) in enumerate(f.head["blocks"]):
                    data = memoryview(f.block(i).astype("<u4")).cast("B")
                    at, stop = 0, len(data)
                    while at < stop:
                        upto = min(stop, 4 * (int(ends[doc]) - first))
                        crc = zlib.crc32(data[at:upto], crc)
                        at = upto
                        if first + upto // 4 == ends[doc]:
                            crcs[doc], crc = crc, 0
                            doc += 1
                ids = pa.array(f.ids, pa.int64(), mask=f.ids == _NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(ends - f.counts + start), pa.array(f.counts), pa.array(crcs)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def write_ids(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = 0,
    bucket_bytes: int = 32 << 20,
) -> tuple[list[tuple[str, int]], bytes]:
    """Writes all documents; returns (path, first token's place among all ids) per file, in order, and the table.

    Every text is encoded once, null as empty, and ``end_id`` follows each.  Ids go to buckets by range of document id;
    a bucket is a file, so files and the documents inside them ascend.  Null ids come first; rows with one id stand in
    the order of a hash of their text, and an id with so many rows that it spans several quantiles is spread over
    several files by that hash, which keeps the order.  Frequencies are counted over all ids while encoding.

    The driver gets the quantiles (one number per file), the frequency table and one row per file.
    An empty table writes no file.  Ids have to be integers; columns other than the two are not read.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    n_bytes = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = int(n_bytes // bucket_bytes) + 1
    bounds = []
    if n_buckets > 1:
        cuts = [i / n_buckets for i in range(1, n_buckets)]
        key = F.coalesce("id", F.lit(_NO_ID))
        bounds = given.agg(F.percentile_approx(key, cuts, 20 * n_buckets)).first()[0] or []
    folder = shared_dir(spark, "token-ids")
    tokens = given.mapInArrow(_tokenise(vocabulary, list(bounds), end_id), "bucket long, ids binary, ties binary, counts binary, tokens binary")
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"):
        packed = written(tokens, "token-parts")
    counted = (
        packed.where(F.col("bucket") == _COUNTS)
        .select("tokens")
        .mapInArrow(_add_counts, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(1 << 16, np.int64)
    for row in counted:
        counts[row.token] = row.n
    table = rans.Table.of_counts(counts).dump()
    _put(f"{folder}/table.rans", [table])
    files = written(
        packed.where(F.col("bucket") != _COUNTS).groupBy("bucket").applyInArrow(_write_bucket(folder, table), _MANIFEST),
        "token-manifest",
    )
    placed, start = [], 0
    for row in files.orderBy("bucket").collect():
        placed.append((row.path, start))
        start += row.n_tokens
    return placed, table


def read_ids(spark: SparkSession, files: list[tuple[str, int]], table: bytes) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32`` of its ids as u32."""
    kind = T.StructType([T.StructField("path", T.StringType()), T.StructField("start", T.LongType())])
    listed = spark.createDataFrame(files, kind)
    return listed.repartition(max(1, len(files))).mapInArrow(_decode(table), _DECODED)
