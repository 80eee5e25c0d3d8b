"""Token ids in files of fixed-width bit packing, with block offsets for random access.

A file is: the blocks, each of ``block_ids`` ids (the last of fewer) at ``width`` bits an id, lowest
bit first; the blocks' offsets as little-endian unsigned 64-bit numbers, one more than there are
blocks; the documents as an Arrow stream of ``id, end`` (``end`` counts ids from the file's
beginning); and a tail of fixed length that says where those lie. A manifest, a Parquet table,
names a dataset's files in order. Files are opened through ``pyarrow.fs``, so the folder can be on
any store that it knows (``file``, ``hdfs``, ``s3``, ``gs``, ...).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship
from . import bpe
from .batches import by_bytes

MAGIC = b"IDSBITS1"
TAIL = struct.Struct("<8sIIQQQ")  # magic, width, ids a block, ids, where the offsets and the documents begin


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` at ``width`` bits each, lowest bit first. Eight ids fill ``width`` bytes, so eight lanes are packed at once."""
    n = len(ids)
    lanes = np.zeros((-(-n // 8), 8), np.uint64)
    lanes.reshape(-1)[:n] = ids
    out = np.zeros((len(lanes), width), np.uint8)
    for lane in range(8):
        byte, shift = divmod(lane * width, 8)
        value = lanes[:, lane] << np.uint64(shift)
        for k in range(-(-(width + shift) // 8)):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: -(-n * width // 8)]


def unpack(raw: bytes, n: int, width: int) -> np.ndarray:
    """The ``n`` ids that :func:`pack` wrote."""
    groups = -(-n // 8)
    full = np.zeros(groups * width, np.uint8)
    full[: len(raw)] = np.frombuffer(raw, np.uint8)
    full = full.reshape(groups, width)
    out = np.empty((groups, 8), np.uint32)
    for lane in range(8):
        byte, shift = divmod(lane * width, 8)
        value = np.zeros(groups, np.uint64)
        for k in range(-(-(width + shift) // 8)):
            value |= full[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (value >> np.uint64(shift)) & np.uint64((1 << width) - 1)
    return out.reshape(-1)[:n]


def ended(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` with ``end_id`` after each document, and where documents end then."""
    sizes = np.diff(ends, prepend=0)
    out = np.full(len(ids) + len(ends), end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(ends)), sizes)] = ids
    return out, ends + np.arange(1, len(ends) + 1)


class IdWriter:
    """Writes one file: ids come in any portions, blocks go out as they fill."""

    def __init__(self, sink, width: int, block_ids: int):
        self.sink, self.width, self.block = sink, width, block_ids
        self.held: list[np.ndarray] = []
        self.waiting = self.n_ids = self.at = 0
        self.offsets, self.ids, self.ends = array("Q", [0]), [], array("q")

    def add(self, docs: list, ids: np.ndarray, ends: np.ndarray) -> None:
        """Documents with their ids, one after the other, and where each one's end in ``ids``."""
        self.held.append(ids)
        self.waiting += len(ids)
        self.ids += docs
        self.ends.extend((ends + self.n_ids).tolist())
        self.n_ids += len(ids)
        if self.waiting >= self.block:
            every = np.concatenate(self.held)
            cut = len(every) - len(every) % self.block
            for a in range(0, cut, self.block):
                self._write(every[a : a + self.block])
            self.held, self.waiting = [every[cut:]], len(every) - cut

    def _write(self, ids: np.ndarray) -> None:
        raw = pack(ids, self.width)
        self.sink.write(raw)
        self.at += len(raw)
        self.offsets.append(self.at)

    def close(self, id_type: pa.DataType) -> None:
        if self.waiting:
            self._write(np.concatenate(self.held))
        self.sink.write(np.array(self.offsets, "<u8").tobytes())
        docs = pa.record_batch([pa.array(self.ids, id_type), pa.array(self.ends, pa.int64())], ["id", "end"])
        buffer = pa.BufferOutputStream()
        with pa.ipc.new_stream(buffer, docs.schema) as stream:
            stream.write_batch(docs)
        self.sink.write(buffer.getvalue())
        self.sink.write(TAIL.pack(MAGIC, self.width, self.block, self.n_ids, self.at, self.at + 8 * len(self.offsets)))


class IdReader:
    """Random access to one file: only the tail, the tables and the blocks asked for are read."""

    def __init__(self, uri: str):
        fs, path = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        magic, self.width, self.block, self.n_ids, self._offsets_at, self._docs_at = TAIL.unpack(self.file.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} holds no packed ids")
        self._end = size - TAIL.size
        self._offsets = np.frombuffer(self.file.read_at(self._docs_at - self._offsets_at, self._offsets_at), "<u8")

    def __enter__(self) -> IdReader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def documents(self) -> pa.RecordBatch:
        """``id, end`` of each document in order."""
        return pa.ipc.open_stream(self.file.read_at(self._end - self._docs_at, self._docs_at)).read_next_batch()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (not included) of the file."""
        start, stop = max(start, 0), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, (stop - 1) // self.block + 1
        first, last = int(self._offsets[a]), int(self._offsets[b])
        raw = self.file.read_at(last - first, first)
        if self.block % 8 == 0:
            out = unpack(raw, min(b * self.block, self.n_ids) - a * self.block, self.width)
        else:
            cuts = (self._offsets[a : b + 1] - self._offsets[a]).tolist()
            out = np.concatenate([unpack(raw[x:y], min(self.block, self.n_ids - (a + k) * self.block), self.width) for k, (x, y) in enumerate(zip(cuts, cuts[1:]))])
        return out[start - a * self.block : stop - a * self.block]


def shared_uri(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark reads it by."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def id_width(path: str, end_id: int) -> int:
    """Bits that hold every id of the vocabulary."""
    return max(bpe.word_encoder(path).most_id, end_id, 1).bit_length()


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    block_ids: int = 1 << 15,
    shard_bytes: int = 128 << 20,
    slice_bytes: int = 8 << 20,
) -> None:
    """Writes all documents' ids in ascending order of ``id_col`` to files under ``folder``, with their manifest.

    Texts are dealt out by ranges of id, each range to a task that encodes and writes one file:
    as many as ``shard_bytes`` of text ask for, and as Spark's shuffle partitions at least. A task
    holds one slice of texts, one block and its documents' ids and ends. A lost or repeated attempt
    writes a file of another name; the manifest, which Spark commits, names those that count.

    Null ids come first; rows that repeat an id are ordered by text. A null or empty text is the end
    id alone. Very long texts are encoded whole, one at a time. An empty table gives an empty
    manifest. Other columns are not read.
    """
    spark = ship(docs.sparkSession)
    uri, width = shared_uri(spark, folder), id_width(path, end_id)
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_bytes))
    fs, place = pafs.FileSystem.from_uri(uri)
    fs.create_dir(f"{place}/ids", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, writer = bpe.word_encoder(path), None
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ids"
        for batch in by_bytes(batches, 1, slice_bytes):
            if writer is None:
                store, where = pafs.FileSystem.from_uri(uri)
                sink = store.open_output_stream(f"{where}/ids/{name}")
                writer, kind = IdWriter(sink, width, block_ids), batch.column(0).type
            ids, ends = enc.ids(batch.column(1))
            writer.add(batch.column(0).to_pylist(), *ended(ids, ends, end_id))
        if writer:
            writer.close(kind)
            sink.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([TaskContext.get().partitionId()], pa.int64()), "file": [name], "n_ids": pa.array([writer.n_ids], pa.int64()), "n_docs": pa.array([len(writer.ids)], pa.int64())})

    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).repartitionByRange(shards, "id", F.xxhash64("text"), F.spark_partition_id()).sortWithinPartitions("id", "text")
    rows.mapInArrow(write, "shard long, file string, n_ids long, n_docs long").write.parquet(f"{folder}/files")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``shard, file, n_ids, n_docs, start``: a dataset's files; ``start`` counts the ids of earlier files."""
    files = spark.read.parquet(f"{folder}/files")
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, id_type: str = "bigint", most_ids: int = 1 << 20) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of every document, read back from the files.

    ``start`` counts the ids of all documents before, ``ids_crc32`` is unsigned and over the ids as
    little-endian unsigned 32-bit numbers. Files are dealt out over tasks; a task unpacks about
    ``most_ids`` ids at a time, a longer document in pieces.
    """
    ship(spark)
    uri, files = shared_uri(spark, folder), manifest(spark, folder)
    n = spark.read.parquet(f"{folder}/files").count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with IdReader(f"{uri}/ids/{name}") as file:
                    yield from _documents(file, start, most_ids)

    out = files.select("file", "start").repartition(max(n, 1)).mapInArrow(read, f"id {id_type}, start long, n_tokens long, ids_crc32 long")
    return out


def _documents(file: IdReader, start: int, most: int) -> Iterator[pa.RecordBatch]:
    docs = file.documents()
    ends = docs.column(1).to_numpy()
    begins = np.append(0, ends[:-1])
    k = 0
    while k < len(ends):
        # Documents that begin within the next ``most`` ids, one at least.
        stop = max(k + 1, int(np.searchsorted(ends, begins[k] + most, "right")))
        crcs = []
        if stop == k + 1:
            crc = 0
            for a in range(int(begins[k]), int(ends[k]), most):
                crc = zlib.crc32(_little(file.ids(a, min(a + most, int(ends[k])))), crc)
            crcs.append(crc)
        else:
            raw, base = _little(file.ids(int(begins[k]), int(ends[stop - 1]))), int(begins[k])
            crcs += [zlib.crc32(raw[4 * (a - base) : 4 * (b - base)]) for a, b in zip(begins[k:stop].tolist(), ends[k:stop].tolist())]
        yield pa.RecordBatch.from_arrays([docs.column(0).slice(k, stop - k), pa.array(begins[k:stop] + start, pa.int64()), pa.array(ends[k:stop] - begins[k:stop], pa.int64()), pa.array(crcs, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])
        k = stop


def _little(ids: np.ndarray) -> memoryview:
    return memoryview(ids.astype("<u4", copy=False).tobytes())


def drop_token_files(spark: SparkSession, folder: str) -> None:
    """Deletes a dataset, files of lost attempts among them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
