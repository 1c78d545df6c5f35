"""Token ids as Arrow files of equal-length sequences, read in place.

A data set is a folder of Arrow files (the stream of record batches with a
footer that gives random access) and ``index``, a Parquet table with one row
per document.  Each file holds the ids of a run of documents in ascending
``doc_id`` order, each document closed by ``end_id``, cut into sequences of
``seq_len``: column ``input_ids`` is a fixed-size list of unsigned 16- or
32-bit integers (16 where the vocabulary allows), ``mask`` a fixed-size list
of booleans, false only behind the last id of a file.  Because every list
has the same size, the ids of a batch are one flat buffer: a reader maps the
file and takes any sequence, or any document's ids, without copying.

Nulls, empty texts: only ``end_id``.  Repeated rows: each is written; rows
with one ``doc_id`` follow in the order of their texts' hashes.  A null
``doc_id`` comes first.  No rows: an index without rows.

Recovery: a task writes its own file under a name of its own, and the index
names only files of tasks that succeeded, so a task that runs again leaves a
file that nothing refers to.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .token_ids import WORD_ENDS, Encoder

INDEX = "index"
SEQUENCES_PER_BATCH = 64
_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, layout: str, end_id: int) -> Encoder:
    """One encoder for each Python worker, so that it remembers words."""
    key = (path, layout, end_id)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, layout, end_id)
    return _ENCODERS[key]


def schema(seq_len: int, wide: bool) -> pa.Schema:
    ids = pa.uint32() if wide else pa.uint16()
    return pa.schema([("input_ids", pa.list_(ids, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])


class _File:
    """Collects ids and writes them as batches of whole sequences."""

    def __init__(self, sink, seq_len: int, wide: bool) -> None:
        self.schema, self.seq_len = schema(seq_len, wide), seq_len
        self.dtype = np.uint32 if wide else np.uint16
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n = 0

    def add(self, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) > np.iinfo(self.dtype).max:
            raise ValueError(f"id {int(ids.max())} does not fit {np.dtype(self.dtype).name}: write with wide=True")
        self.held.append(ids.astype(self.dtype))
        self.n_held += len(ids)
        self.n += len(ids)
        if self.n_held >= (size := self.seq_len * SEQUENCES_PER_BATCH):
            flat = np.concatenate(self.held)
            for lo in range(0, len(flat) - size + 1, size):
                self._batch(flat[lo : lo + size], size)
            rest = flat[len(flat) // size * size :].copy()
            self.held, self.n_held = [rest], len(rest)

    def _batch(self, flat: np.ndarray, n: int) -> None:
        mask = pa.array(np.arange(len(flat)) < n)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(flat), self.seq_len), pa.FixedSizeListArray.from_arrays(mask, self.seq_len)]
        self.writer.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            self._batch(np.pad(flat, (0, -len(flat) % self.seq_len)), len(flat))
        self.writer.close()


def write_token_files(
    docs: DataFrame, out: str, tokenizer: str, layout: str = WORD_ENDS, seq_len: int = 2048, end_id: int = 1, wide: bool = False
) -> DataFrame:
    """Writes the data set under ``out`` (a folder all executors share) and
    returns its index: file_no, file, doc_id, start_in_file, n_tokens.

    One shuffle: texts are dealt by ranges of ``doc_id`` and sorted in each
    task; ids are never shuffled.  A task holds one Arrow batch of texts and
    one batch of sequences."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(out)
        name = f"ids-{task:06d}-{uuid.uuid4().hex}.arrow"
        encode, file, sink = encoder(tokenizer, layout, end_id), None, None
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                if file is None:
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(f"{root}/{name}")
                    file = _File(sink, seq_len, wide)
                ids, at = encode(part.column(1).to_pylist())
                before = file.n
                file.add(ids)
                n = part.num_rows
                yield pa.record_batch(
                    [pa.array([task] * n, pa.int32()), pa.array([name] * n), part.column(0), pa.array(before + at[:-1]), pa.array(np.diff(at))],
                    names=["file_no", "file", "doc_id", "start_in_file", "n_tokens"],
                )
        if file is not None:
            file.close()
            sink.close()

    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    index = ordered.mapInArrow(write, f"file_no int, file string, doc_id {kind}, start_in_file bigint, n_tokens bigint")
    index.write.parquet(f"{out}/{INDEX}")
    return docs.sparkSession.read.parquet(f"{out}/{INDEX}")


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """One row per document from the files themselves: doc_id, start (ids of
    all documents before it), n_tokens, ids_crc32, file."""
    index = spark.read.parquet(f"{out}/{INDEX}")
    # one row per file, as many as tasks wrote; their running sum is small
    files = index.groupBy("file_no", "file").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("file_no", "file").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("file", F.coalesce(before, F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(out)
        opened = None
        for b in batches:
            crc = []
            for name, start, n in zip(b.column("file").to_pylist(), b.column("start_in_file").to_pylist(), b.column("n_tokens").to_pylist(), strict=True):
                if opened is None or opened.name != name:
                    opened = TokenFile(fs, root, name)
                crc.append(opened.crc32(start, n))
            yield pa.record_batch(
                [b.column("doc_id"), b.column("file"), b.column("start_in_file"), b.column("n_tokens"), pa.array(crc, pa.int64())],
                names=["doc_id", "file", "start_in_file", "n_tokens", "ids_crc32"],
            )

    kind = index.schema["doc_id"].dataType.simpleString()
    # a file's documents together, so that it is opened once
    rows = index.repartition("file").sortWithinPartitions("file", "start_in_file")
    rows = rows.mapInArrow(read, f"doc_id {kind}, file string, start_in_file bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(files, "file").select(
        "doc_id", (F.col("base") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32", "file"
    )


class TokenFile:
    """Random access to one file; on a local path its pages are mapped."""

    def __init__(self, fs: pafs.FileSystem, root: str, name: str) -> None:
        self.name, path = name, f"{root}/{name}"
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        self.seq_len = self.reader.schema.field("input_ids").type.list_size
        self.step = self.seq_len * SEQUENCES_PER_BATCH

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """The ids of sequence ``k`` (a view) and its mask."""
        batch = self.reader.get_batch(k // SEQUENCES_PER_BATCH)
        row = k % SEQUENCES_PER_BATCH
        ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
        return ids[row * self.seq_len : (row + 1) * self.seq_len], batch.column(1)[row].values

    def pieces(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as views of the batches they lie in."""
        end = start + n
        while start < end:
            batch = start // self.step
            flat = self.reader.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)
            stop = min(end, (batch + 1) * self.step)
            yield flat[start - batch * self.step : stop - batch * self.step]
            start = stop

    def crc32(self, start: int, n: int) -> int:
        """Of the ids as little-endian unsigned 32-bit integers."""
        crc = 0
        for ids in self.pieces(start, n):
            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
        return crc
