"""Token ids in Arrow stream files of fixed-size lists.

Documents in ascending order form one stream of ids. A file is an Arrow IPC
stream of record batches; each row is one training sequence:

* ``ids``: fixed_size_list<uint16 or uint32>[length], the tokens
* ``mask``: fixed_size_list<bool>[length], true for tokens, false for padding

Batches hold the same number of sequences and no nulls, so sequence ``n`` of a
memory-mapped file is at a fixed place and is read without copying
(``SequenceFile``). Only the last sequence of a file is padded. A stream of its own
behind the first lists the documents (doc_id, n_tokens); the last eight bytes of a
file are its number of sequences.

Documents are range-partitioned by doc_id before they are encoded (null ids
last; equal ids by text), one file for each partition. A file is written under a
name of its own attempt and renamed, so a lost executor's task is just run again.

Defined results: a null text is an empty document of one token; repeated rows
are documents of their own; very long texts are encoded whole, over as many
sequences as they take; documents of one doc_id are ordered by a hash of their text;
an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorecard.llm.bpe import encoder
from scorecard.llm.common import prepare, texts_of
from scorecard.operators.staging import shared_dir, stage

SEQUENCE_TOKENS = 2048
BATCH_SEQUENCES = 64
# Text in one file, so that a task's memory and a file's size are bounded.
FILE_CHARS = 32 << 20
INDEX_ROWS = 4096


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file; plain paths are local."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def stream_schema(length: int, wide: bool) -> pa.Schema:
    ids = pa.list_(pa.field("item", pa.uint32() if wide else pa.uint16(), nullable=False), length)
    mask = pa.list_(pa.field("item", pa.bool_(), nullable=False), length)
    return pa.schema([pa.field("ids", ids, nullable=False), pa.field("mask", mask, nullable=False)])


# The number of sequences, last in a file.
TAIL = struct.Struct("<q")
# An end mark of a stream: a continuation and a length of zero.
END_BYTES = 8

INDEX = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes full batches as they fill."""

    def __init__(self, sink, length: int = SEQUENCE_TOKENS, wide: bool = False):
        self.length, self.kind = length, np.uint32 if wide else np.uint16
        self.schema = stream_schema(length, wide)
        self.sink = sink
        self.writer = ipc.new_stream(sink, self.schema)
        self.buffer = np.zeros(BATCH_SEQUENCES * length, self.kind)
        self.used = self.sequences = 0
        self.documents: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id, len(ids)))
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, len(self.buffer) - self.used)
            self.buffer[self.used : self.used + take] = ids[at : at + take]
            self.used += take
            at += take
            if self.used == len(self.buffer):
                self._flush()

    def _flush(self) -> None:
        rows = -(-self.used // self.length)
        count = rows * self.length
        self.buffer[self.used : count] = 0
        mask = np.zeros(count, np.uint8)
        mask[: self.used] = 1
        bits = pa.Array.from_buffers(
            pa.bool_(), count, [None, pa.py_buffer(np.packbits(mask, bitorder="little"))]
        )
        ids = pa.array(self.buffer[:count].copy())
        columns = [
            pa.FixedSizeListArray.from_arrays(ids, type=self.schema.field("ids").type),
            pa.FixedSizeListArray.from_arrays(bits, type=self.schema.field("mask").type),
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.used = 0
        self.sequences += rows

    def close(self) -> None:
        if self.used:
            self._flush()
        self.writer.close()
        with ipc.new_stream(self.sink, INDEX) as index:
            for at in range(0, len(self.documents), INDEX_ROWS):
                some = self.documents[at : at + INDEX_ROWS]
                index.write_batch(
                    pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*some, strict=True)], schema=INDEX
                    )
                )
        self.sink.write(TAIL.pack(self.sequences))


class SequenceFile:
    """Sequences of a token file by number. Full batches have one size, so each is
    found by its number; of a memory-mapped file the results are views."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        source.seek(source.size() - TAIL.size)
        (self.sequences,) = TAIL.unpack(source.read(TAIL.size))
        self.batches = -(-self.sequences // BATCH_SEQUENCES)
        source.seek(0)
        self.schema = ipc.read_schema(ipc.read_message(source))
        self.first = source.tell()
        if self.batches:
            ipc.read_message(source)
        self.size = source.tell() - self.first

    def __len__(self) -> int:
        return self.sequences

    def batch(self, number: int) -> pa.RecordBatch:
        self.source.seek(self.first + number * self.size)
        return ipc.read_record_batch(ipc.read_message(self.source), self.schema)

    def __getitem__(self, n: int) -> tuple[pa.Array, pa.Array]:
        """Ids and mask of sequence ``n``."""
        if not 0 <= n < self.sequences:
            raise IndexError(f"sequence {n} of {self.sequences}")
        batch, row = self.batch(n // BATCH_SEQUENCES), n % BATCH_SEQUENCES
        return batch.column(0)[row].values, batch.column(1)[row].values

    def index(self) -> pa.Table:
        """doc_id and n_tokens of the documents, which stand behind the last batch."""
        self.source.seek(self.first)
        if self.batches:
            self.batch(self.batches - 1)
        self.source.seek(self.source.tell() + END_BYTES)
        return ipc.open_stream(self.source).read_all()


def _open(uri: str) -> pa.NativeFile:
    """A file to read from: mapped where it is local."""
    store, name = _place(uri)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(name)
    return store.open_input_file(name)


def read_documents(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of each document of a file, batch by batch.

    The index is read first (it stands behind the sequences), then the ids,
    of which only the current batches are held.
    """
    file = SequenceFile(source)
    index = file.index()
    batches = map(file.batch, range(file.batches))
    held, at = np.empty(0, np.uint32), 0
    for doc_id, count in zip(*[c.to_pylist() for c in index.columns], strict=True):
        parts, need = [], count
        while need:
            if at == len(held):
                batch = next(batches)
                # Views of the file's buffers: no value is copied here.
                held = batch.column(0).flatten().to_numpy()
                mask = batch.column(1).flatten()
                held, at = held[: mask.true_count], 0
            part = held[at : at + need]
            parts.append(part)
            at += len(part)
            need -= len(part)
        yield doc_id, parts[0] if len(parts) == 1 else np.concatenate([held[:0], *parts])


def write_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = 0,
    length: int = SEQUENCE_TOKENS,
    file_chars: int = FILE_CHARS,
) -> DataFrame:
    """Write ``docs`` as token files under ``folder``; one row for each file."""
    prepare(docs.sparkSession)
    texts = texts_of(docs)
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    files = max(1, -(-chars // file_chars))
    # Characters of a document break ties of equal ids, then the text itself.
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ordered = texts.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool = encoder(tokenizer_path)
        wide = max(tool.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1) > 1 << 16
        store, base = _place(folder)
        number = TaskContext.get().partitionId()
        name = f"{base}/tokens-{number:06d}.arrows"
        writer = temporary = None
        tokens = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                store.create_dir(base, recursive=True)
                temporary = f"{base}/.{number:06d}-{uuid.uuid4().hex}"
                sink = store.open_output_stream(temporary)
                writer = SequenceWriter(sink, length, wide)
            doc_ids, texts = (c.to_pylist() for c in batch.columns)
            for doc_id, data in zip(doc_ids, tool.encode_batch(texts), strict=True):
                ids = np.append(np.frombuffer(data, np.uint32), np.uint32(end_id))
                tokens += len(ids)
                writer.add(doc_id, ids)
        if writer is not None:
            writer.close()
            sink.close()
            store.move(temporary, name)
            yield pa.RecordBatch.from_pydict(
                {
                    "number": pa.array([number], pa.int32()),
                    "path": [f"{folder}/tokens-{number:06d}.arrows"],
                    "tokens": pa.array([tokens], pa.int64()),
                }
            )

    return stage(ordered.mapInArrow(write, "number int, path string, tokens long"), "token-files")


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    # One row for each file, at most a few hundred thousand of them.
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select(
        "number", "path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")
    )
    count = max(1, files.count())
    dealt = placed.repartition(count, "number").select("path", "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                out: list[list] = [[], [], [], []]
                with _open(path) as source:
                    for doc_id, ids in read_documents(source):
                        crc = zlib.crc32(ids.astype("<u4").tobytes())
                        for column, value in zip(out, (doc_id, start, len(ids), crc), strict=True):
                            column.append(value)
                        start += len(ids)
                        if len(out[0]) == INDEX_ROWS:
                            yield _rows(out)
                            out = [[], [], [], []]
                yield _rows(out)

    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(columns: list[list]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def new_folder(docs: DataFrame) -> str:
    return f"{shared_dir(docs.sparkSession)}/token-files/{uuid.uuid4().hex}"
