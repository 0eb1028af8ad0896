"""Token ids in seekable zstandard files: write, read back, and fetch single documents.

A file is a row of independent zstandard frames, a skippable frame with the span of ids of each
frame, and last the seek table of the public seekable format: per frame its size packed and unpacked
and a checksum. A reader that wants some documents reads the tables at the end and unpacks only the
frames that can hold them.

A frame unpacked is: number of documents (8 bytes), their ids (8 each), whether an id is null (1
each), their numbers of tokens (8 each), and all token ids (4 each); everything little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.workspace import Workspace
from .tokenize import default_vocabulary, document_ids

# Fixed values of the zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 1 << 7

#: The skippable frame of our own, with the span of ids of each frame.
SPANS_MAGIC = 0x184D2A50


class DamagedFile(ValueError):
    """A frame or table does not hold what its checksum or size says."""


def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class TokenFileWriter:
    """Writes documents in the order given to a binary stream; ``close`` adds the tables."""

    def __init__(self, stream, frame_tokens: int = 1 << 16, level: int = 3):
        import zstandard

        self._stream, self._frame_tokens = stream, frame_tokens
        self._packer = zstandard.ZstdCompressor(level=level)
        self._entries: list[tuple[int, int, int]] = []
        self._spans: list[tuple[int, int, int, int]] = []
        self._held: list[tuple[int | None, bytes]] = []
        self._tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._held.append((doc_id, ids))
        self._tokens += len(ids) // 4
        if self._tokens >= self._frame_tokens:
            self._flush()

    def _flush(self) -> None:
        if not self._held:
            return
        known = [d for d, _ in self._held if d is not None]
        data = b"".join(
            [
                struct.pack("<Q", len(self._held)),
                np.array([d or 0 for d, _ in self._held], "<i8").tobytes(),
                bytes(d is None for d, _ in self._held),
                np.array([len(i) // 4 for _, i in self._held], "<i8").tobytes(),
                *[i for _, i in self._held],
            ]
        )
        packed = self._packer.compress(data)
        self._stream.write(packed)
        self._entries.append((len(packed), len(data), _checksum(data)))
        # Without a known id the span is empty.
        self._spans.append((min(known, default=1), max(known, default=0), len(known) < len(self._held), self._tokens))
        self._held, self._tokens = [], 0

    def close(self) -> None:
        self._flush()
        spans = b"".join(struct.pack("<qqqq", *s) for s in self._spans)
        spans = struct.pack("<II", SPANS_MAGIC, len(spans)) + spans
        self._stream.write(spans)
        self._entries.append((len(spans), 0, _checksum(b"")))
        table = b"".join(struct.pack("<III", *e) for e in self._entries)
        table += struct.pack("<IBI", len(self._entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


@dataclass
class Frame:
    offset: int
    packed: int
    unpacked: int
    checksum: int
    first: int
    last: int
    nulls: bool
    tokens: int


class TokenFileReader:
    """Reads a seekable binary stream; ``frames_read`` counts the frames unpacked."""

    def __init__(self, stream):
        self._stream, self.frames_read = stream, 0
        end = stream.seek(0, 2)
        count, _, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_MAGIC or count * 12 + 17 > end:
            raise DamagedFile("no seek table")
        rows = np.frombuffer(self._at(end - 9 - 12 * count, 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(rows[:, 0])]).tolist()
        if offsets[-1] + count * 12 + 17 != end:
            raise DamagedFile("sizes in the seek table do not add up")
        spans = np.frombuffer(self._at(offsets[-2] + 8, int(rows[-1, 0]) - 8), "<i8").reshape(-1, 4).tolist()
        self.frames = [
            Frame(o, *row, first, last, bool(nulls), tokens)
            for o, row, (first, last, nulls, tokens) in zip(offsets, rows.tolist(), spans)
        ]

    def _at(self, offset: int, size: int) -> bytes:
        self._stream.seek(offset)
        return self._stream.read(size)

    def unpack(self, frame: Frame) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """Ids, numbers of tokens and all tokens of a frame whose checksum holds."""
        import zstandard

        self.frames_read += 1
        try:
            data = zstandard.ZstdDecompressor().decompress(self._at(frame.offset, frame.packed), max_output_size=frame.unpacked)
        except zstandard.ZstdError as error:
            raise DamagedFile(str(error)) from error
        if len(data) != frame.unpacked or _checksum(data) != frame.checksum:
            raise DamagedFile(f"frame at {frame.offset} does not match its checksum")
        count = struct.unpack_from("<Q", data)[0]
        ids = np.frombuffer(data, "<i8", count, 8).tolist()
        nulls = data[8 + 8 * count : 8 + 9 * count]
        lengths = np.frombuffer(data, "<i8", count, 8 + 9 * count)
        tokens = np.frombuffer(data, "<u4", offset=8 + 17 * count)
        return [None if n else d for d, n in zip(ids, nulls)], lengths, tokens

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """(id, token ids) in the order written: of all documents, or of the ids wanted only."""
        sought = None if wanted is None else set(wanted)
        ordered = None if sought is None else np.sort(np.fromiter(sought, np.int64, len(sought)))
        for frame in self.frames:
            if ordered is not None:
                k = np.searchsorted(ordered, frame.first)
                if k == len(ordered) or ordered[k] > frame.last:
                    continue
            ids, lengths, tokens = self.unpack(frame)
            ends = np.cumsum(lengths)
            for doc_id, end, length in zip(ids, ends.tolist(), lengths.tolist()):
                if sought is None or doc_id in sought:
                    yield doc_id, tokens[end - length : end]


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder: file, hdfs, s3 or gs address, or a plain path."""
    return fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    frame_tokens: int = 1 << 16,
) -> DataFrame:
    """Write all documents by ascending id and return the manifest (part, file, documents, tokens).

    Rows are sorted by ranges of ids, one file per range; null ids come first, rows with the same id by
    text. A document is the ids of its text and the end id; null and empty texts are the end id alone.
    Ids are whole numbers. A task that is run again writes a file of another name, and only the
    manifest says which files count. It is stored at ``folder``/manifest. No rows give no files.
    """
    vocabulary = vocabulary or default_vocabulary()
    filesystem, path = _opened(folder)
    filesystem.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(folder)
        part, documents, tokens, writer = TaskContext.get().partitionId(), 0, 0, None
        name = f"tokens-{part:06d}-{uuid.uuid4().hex}.zst"
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if writer is None:
                    stream = store.open_output_stream(f"{base}/{name}", compression=None)
                    writer = TokenFileWriter(stream, frame_tokens)
                ids = document_ids(vocabulary, text.as_py())
                writer.add(doc_id.as_py(), ids)
                documents, tokens = documents + 1, tokens + len(ids) // 4
        if writer is not None:
            writer.close()
            stream.close()
            columns = [pa.array([part], pa.int64()), pa.array([name]), pa.array([documents], pa.int64()), pa.array([tokens], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "file", "documents", "tokens"])

    used = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    order = [F.col("_id").asc_nulls_first(), F.xxhash64("_text")]
    ordered = used.repartitionByRange(*order).sortWithinPartitions(*order, "_text")
    manifest = ordered.mapInArrow(write, "part bigint, file string, documents bigint, tokens bigint")
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the files of the manifest.

    ``start`` is the number of ids of all documents before it.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.select("part", "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    files = max(1, placed.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(folder)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist()):
                with store.open_input_file(f"{base}/{file}") as stream:
                    reader = TokenFileReader(stream)
                    for frame in reader.frames:
                        ids, lengths, tokens = reader.unpack(frame)
                        ends = np.cumsum(lengths)
                        starts = ends - lengths
                        crc = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                        columns = [pa.array(ids, pa.int64()), pa.array(starts + start), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())]
                        yield pa.RecordBatch.from_arrays(columns, names=[id_col, "start", "n_tokens", "ids_crc32"])
                        start += int(ends[-1])

    dealt = placed.repartitionByRange(files, "part")
    return dealt.mapInArrow(read, f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokenize_to_files(docs: DataFrame, workspace: Workspace, vocabulary: str | None = None) -> DataFrame:
    """Write the files to the workspace and return what :func:`read_token_files` reads from them."""
    folder = workspace.path("token-files")
    write_token_files(docs, folder, vocabulary)
    return read_token_files(docs.sparkSession, folder)
