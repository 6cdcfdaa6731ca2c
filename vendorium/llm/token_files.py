"""Token ids in files of fixed-width bits, with block offsets for random access.

A file is: magic, blocks, block offsets, document ids, document starts, footer, magic. A block holds `BLOCK_IDS` ids
(the last one fewer), each in as many bits as the vocabulary's largest id needs, lowest bit first, filled up to a
byte. Block offsets are byte positions, so any id is found by one look-up, and blocks unpack with numpy alone.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vendorium.llm.shipping import ship
from vendorium.llm.tokens import default_vocabulary, encoder, read_vocabulary, vocabulary_size
from vendorium.session import scratch_path

BLOCK_IDS = 8192
END_ID = 2
MAGIC = b"BITTOK01"
_FOOTER = struct.Struct("<IIQQQQ")  # bits, ids in a block, blocks, documents, documents without id, ids
_READ_IDS = 1 << 20  # ids unpacked at a time


def bits_needed(ids_in_use: int) -> int:
    return max(1, (ids_in_use - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:  # whole bytes
        return raw[:, : bits // 8].tobytes()
    return np.packbits(np.unpackbits(raw, axis=1, count=bits, bitorder="little"), bitorder="little").tobytes()


def unpack_ids(raw: bytes, count: int, bits: int) -> np.ndarray:
    if bits % 8 == 0:
        filled = np.zeros((count, 4), dtype=np.uint8)
        filled[:, : bits // 8] = np.frombuffer(raw, dtype=np.uint8, count=count * bits // 8).reshape(count, bits // 8)
        return filled.view("<u4").ravel()
    flat = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=count * bits, bitorder="little")
    whole = np.zeros((count, 32), dtype=np.uint8)
    whole[:, :bits] = flat.reshape(count, bits)
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()


# Hadoop's names of file systems, and pyarrow's.
_SCHEMES = {"s3a://": "s3://", "s3n://": "s3://", "wasbs://": "abfs://", "dbfs:/": "/dbfs/"}


class TokenFileWriter:
    """Write one file; only ids of the open block and two numbers for each document are kept in memory."""

    def __init__(self, stream, bits: int):
        self._stream, self._bits, self._position = stream, bits, len(MAGIC)
        self._pending, self._pending_bytes = [], 0
        self._offsets: list[int] = []
        self._doc_ids: list[int | None] = []
        self._starts = [0]
        stream.write(MAGIC)

    @property
    def n_ids(self) -> int:
        return self._starts[-1]

    def add(self, doc_id: int | None, raw: bytes) -> None:
        self._doc_ids.append(doc_id)
        self._starts.append(self._starts[-1] + len(raw) // 4)
        self._pending.append(raw)
        self._pending_bytes += len(raw)
        if self._pending_bytes >= 4 * BLOCK_IDS:
            self._flush(whole_blocks=True)

    def _flush(self, whole_blocks: bool) -> None:
        ids = np.frombuffer(b"".join(self._pending), dtype="<u4")
        end = len(ids) // BLOCK_IDS * BLOCK_IDS if whole_blocks else len(ids)
        for at in range(0, end, BLOCK_IDS):
            block = pack_ids(ids[at : min(end, at + BLOCK_IDS)], self._bits)
            self._offsets.append(self._position)
            self._stream.write(block)
            self._position += len(block)
        self._pending = [ids[end:].tobytes()]
        self._pending_bytes = len(self._pending[0])

    def close(self) -> None:
        self._flush(whole_blocks=False)
        nulls = sum(doc is None for doc in self._doc_ids)  # they come first
        self._stream.write(np.array(self._offsets, dtype="<u8").tobytes())
        self._stream.write(np.array([doc or 0 for doc in self._doc_ids], dtype="<i8").tobytes())
        self._stream.write(np.array(self._starts, dtype="<u8").tobytes())
        self._stream.write(_FOOTER.pack(self._bits, BLOCK_IDS, len(self._offsets), len(self._doc_ids), nulls, self.n_ids))
        self._stream.write(MAGIC)


class TokenFile:
    """Read any range of ids of one file."""

    def __init__(self, stream):
        self._stream = stream
        tail = _FOOTER.size + len(MAGIC)
        size = stream.size()
        footer = self._at(size - tail, tail)
        if footer[-len(MAGIC) :] != MAGIC or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        self._bits, self._block_ids, blocks, docs, nulls, self.n_ids = _FOOTER.unpack(footer[: _FOOTER.size])
        index = self._at(size - tail - 8 * (blocks + 2 * docs + 1), 8 * (blocks + 2 * docs + 1))
        self._offsets = np.frombuffer(index, dtype="<u8", count=blocks)
        self.doc_ids = [None] * nulls + np.frombuffer(index, "<i8", docs, 8 * blocks)[nulls:].tolist()
        self.starts = np.frombuffer(index, dtype="<u8", offset=8 * (blocks + docs)).astype(np.int64)

    def _at(self, position: int, size: int) -> bytes:
        self._stream.seek(position)
        return self._stream.read(size)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start..end-1; only their blocks are read."""
        if start >= end:
            return np.empty(0, dtype="<u4")
        first, last = start // self._block_ids, (end - 1) // self._block_ids
        stop = min(self.n_ids, (last + 1) * self._block_ids)
        at, parts = int(self._offsets[first]), []
        size = -(-(stop - last * self._block_ids) * self._bits // 8)
        raw = self._at(at, int(self._offsets[last]) + size - at)
        for block in range(first, last + 1):
            begin = int(self._offsets[block]) - at
            count = min(stop, (block + 1) * self._block_ids) - block * self._block_ids
            parts.append(unpack_ids(raw[begin : begin + -(-count * self._bits // 8)], count, self._bits))
        return np.concatenate(parts)[start - first * self._block_ids : end - first * self._block_ids]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, its first id's place, its ids) in the file's order, about `_READ_IDS` ids in memory."""
        doc = 0
        while doc < len(self.doc_ids):
            last = max(doc + 1, int(np.searchsorted(self.starts, self.starts[doc] + _READ_IDS, side="right")) - 1)
            first_id = int(self.starts[doc])
            ids = self.ids(first_id, int(self.starts[last]))
            for each in range(doc, last):
                start, end = int(self.starts[each]), int(self.starts[each + 1])
                yield self.doc_ids[each], start, ids[start - first_id : end - first_id]
            doc = last


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a path, also by the names that Hadoop has for it."""
    for theirs, own in _SCHEMES.items():
        if path.startswith(theirs):
            path = own + path[len(theirs) :]
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, ids_in_use: int, end_id: int = END_ID) -> DataFrame:
    """Write `doc_id` and the ids of `text` in ascending doc_id order; one row for each file, with its id count.

    The folder must be shared by all executors and be one that pyarrow can write to. Nulls in doc_id come first; null
    and empty texts have the end id alone; rows with equal doc_id follow in the order of a hash of their texts. A
    folder whose file system pyarrow does not know is refused before anything is encoded. A task writes under a name of its own and then renames, so a repeated task replaces its file. An empty table gives no file.
    """
    ship(docs.sparkSession)
    _file_system(folder)  # raises for one that it does not know
    bits = bits_needed(ids_in_use)
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, stream, writer, rows = encoder(vocabulary).encode_many, None, None, 0
        task = TaskContext.get().partitionId()
        system, base = _file_system(folder)
        partial, final = f"{base}/_part-{task:06d}-{uuid.uuid4().hex}", f"{base}/part-{task:06d}.tok"
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), encode(text.as_py() for text in batch.column(1)), strict=True):
                if writer is None:
                    system.create_dir(base, recursive=True)
                    stream = system.open_output_stream(partial)
                    writer = TokenFileWriter(stream, bits)
                writer.add(doc, raw + end)
                rows += 1
        if writer is not None:
            writer.close()
            stream.close()
            if system.get_file_info(final).type != fs.FileType.NotFound:
                system.delete_file(final)
            system.move(partial, final)
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/part-{task:06d}.tok"], "task": pa.array([task], pa.int64()), "n_docs": pa.array([rows], pa.int64()), "n_ids": pa.array([writer.n_ids], pa.int64())})

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows that share a doc_id, even whole rows, go to several ranges.
    keyed = source.withColumn("_text", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    keys = ("doc_id", "_text", "_row")
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    manifest = f"{folder}/_files"
    ordered.mapInArrow(write, "file string, task long, n_docs long, n_ids long").write.parquet(manifest)
    return docs.sparkSession.read.parquet(manifest)


def read_token_files(files: DataFrame) -> DataFrame:
    """Read files back, one task for each: doc_id, place of its first id over all files, number of ids, their crc32."""
    ship(files.sparkSession)
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    placed = files.select("file", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, path = _file_system(file)
                columns: list[list] = [[], [], [], []]

                def rows(columns=columns) -> pa.RecordBatch:
                    arrays = [pa.array(column, pa.int64()) for column in columns]
                    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"])

                with system.open_input_file(path) as stream:
                    for doc, start, ids in TokenFile(stream).documents():
                        for column, value in zip(columns, (doc, before + start, len(ids), zlib.crc32(ids.tobytes())), strict=True):
                            column.append(value)
                        if len(columns[0]) >= 10_000:
                            yield rows()
                            for column in columns:
                                column.clear()
                yield rows()

    number = max(1, files.count())
    return placed.repartition(number, "file").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = read_vocabulary(default_vocabulary())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = write_token_files(docs, scratch_path(spark, "tokens"), vocabulary, vocabulary_size(vocabulary))
    return read_token_files(files)
