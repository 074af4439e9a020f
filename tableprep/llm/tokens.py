"""Token ids in zstandard files that a reader opens in the middle (operator 4).

A file is a row of independent zstandard frames: frames of ids (unsigned 32-bit,
little-endian), one frame that indexes the documents, and, in a skippable frame at
the end, the public seekable-format table with each frame's compressed size, size
and checksum (low 32 bits of xxh64). Every zstandard reader can read the file; one
that knows the table reads the last bytes and then only the frames it needs.
"""

from __future__ import annotations

import io
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableprep.llm.common import Encoder, slices
from tableprep.session import scratch_dir

# Fixed values of the public seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

#: Ids in a frame; a longer document gets frames of its own.
FRAME_IDS = 65_536
_INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("n", "<u8")])


def _xxh(data: bytes) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Writes documents' ids to a binary stream, frame by frame."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = 3):
        import zstandard
        self.out, self.frame_ids = out, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.table: list[tuple[int, int, int]] = []
        self.docs, self.buffer, self.held = [], [], 0

    def _frame(self, data: bytes):
        packed = self.zstd.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), _xxh(data)))

    def _flush(self):
        if self.held:
            ids = np.concatenate(self.buffer).astype("<u4")
            for i in range(0, len(ids), self.frame_ids):
                self._frame(ids[i:i + self.frame_ids].tobytes())
            self.buffer, self.held = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray):
        if self.held and self.held + len(ids) > self.frame_ids:
            self._flush()
        self.docs.append((doc_id or 0, doc_id is not None, len(ids)))
        if len(ids):
            self.buffer.append(ids)
            self.held += len(ids)

    def close(self) -> int:
        """Ends the file; its number of ids."""
        self._flush()
        index = np.array(self.docs, _INDEX)
        self._frame(index.tobytes())
        body = b"".join(struct.pack("<III", *x) for x in self.table)
        foot = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body) + len(foot)) + body + foot)
        return int(index["n"].sum())


class FrameReader:
    """Reads a file of FrameWriter from a seekable stream; checks every checksum."""

    def __init__(self, src):
        self.src = src
        src.seek(0, io.SEEK_END)
        size = src.tell()
        src.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", src.read(9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("not a seekable file of this format")
        src.seek(size - 9 - 12 * n - 8)
        head, length = struct.unpack("<II", src.read(8))
        if head != SKIPPABLE_MAGIC or length != 12 * n + 9:
            raise ValueError("broken seek table")
        self.table = np.frombuffer(src.read(12 * n), "<u4").reshape(n, 3)
        self.place = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        self.first = np.concatenate([[0], np.cumsum(self.table[:-1, 1] // 4, dtype=np.int64)])
        self.index = np.frombuffer(self.frame(n - 1), _INDEX)
        self.start = np.concatenate([[0], np.cumsum(self.index["n"].astype(np.int64))])
        self.frames_read = 0
        self._last = (-1, b"")

    def frame(self, k: int) -> bytes:
        import zstandard
        self.src.seek(int(self.place[k]))
        data = zstandard.ZstdDecompressor().decompress(self.src.read(int(self.table[k, 0])),
                                                       max_output_size=int(self.table[k, 1]))
        if len(data) != self.table[k, 1] or _xxh(data) != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return data

    def ids(self, i: int) -> bytes:
        """Ids of the i-th document of the file, little-endian; reads its frames only."""
        lo, hi = int(self.start[i]), int(self.start[i + 1])
        if lo == hi:
            return b""
        k = int(np.searchsorted(self.first, lo, side="right")) - 1
        parts = []
        while lo < hi:
            if self._last[0] != k:
                self._last = (k, self.frame(k))
                self.frames_read += 1
            end = min(hi, int(self.first[k + 1]))
            parts.append(self._last[1][4 * (lo - int(self.first[k])):4 * (end - int(self.first[k]))])
            lo, k = end, k + 1
        return b"".join(parts)


def write_token_files(df: DataFrame, tokenizer: str, out_dir: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", frame_ids: int = FRAME_IDS) -> DataFrame:
    """Encodes every whole text and writes one file per range of ``id_col`` (nulls
    first, then ascending; rows that repeat an id in the order of their texts).
    Returns the manifest (file, docs, tokens), file names ascending with the ids,
    which is also kept as Parquet in ``out_dir``. ``out_dir`` is a URI that all
    executors reach. A task writes under a name of its own attempt and renames at
    the end, so a lost or repeated task leaves no half file. Null texts count as
    empty; a document always gets ``end_id``; an empty table gives no file."""
    rows = (df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))

    def write(batches):
        from pyarrow import fs
        from pyspark import TaskContext
        context, writer, enc = TaskContext.get(), None, Encoder.of(tokenizer)
        store, root = fs.FileSystem.from_uri(out_dir)
        for batch, texts in slices(batches, "text"):
            if writer is None:
                store.create_dir(root, recursive=True)
                name = f"part-{context.partitionId():06d}.zst"
                temp = f"{root}/.{name}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
                stream = store.open_output_stream(temp)
                writer = FrameWriter(stream, frame_ids)
            ids, ends = enc.encode(texts)
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                writer.add(doc_id, np.append(ids[ends[i]:ends[i + 1]], np.uint32(end_id)))
        if writer is not None:
            tokens = writer.close()
            stream.close()
            store.move(temp, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [f"{out_dir}/{name}"], "docs": [len(writer.docs)], "tokens": [tokens]})

    manifest = f"{out_dir}/manifest"
    rows.mapInArrow(write, "file string, docs long, tokens long").write.parquet(manifest)
    return df.sparkSession.read.parquet(manifest)


def read_tokens(spark: SparkSession, out_dir: str, wanted: list[int] | None = None) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents
    before it), n_tokens, ids (binary, little-endian unsigned 32-bit). With
    ``wanted``, a caller's list of ids, only these documents' frames are read."""
    manifest = spark.read.parquet(f"{out_dir}/manifest")
    files = manifest.count()  # one row per file: the window below is over the files' table
    placed = manifest.select("file", (F.sum("tokens").over(Window.orderBy("file")) - F.col("tokens")).alias("base"))
    only = None if wanted is None else np.array(sorted(wanted), np.int64)

    def read(batches):
        from pyarrow import fs
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                store, path = fs.FileSystem.from_uri(file)
                with store.open_input_file(path) as src:
                    r = FrameReader(src)
                    known = r.index["known"].astype(bool)
                    take = np.arange(len(r.index)) if only is None else np.flatnonzero(known & np.isin(r.index["doc_id"], only))
                    out, held = ([], [], [], []), 0
                    for i in take:
                        ids = r.ids(int(i))
                        for x, v in zip(out, (int(r.index["doc_id"][i]) if known[i] else None, base + int(r.start[i]), len(ids) // 4, ids), strict=True):
                            x.append(v)
                        held += len(ids)
                        if held > 4_000_000:
                            yield _rows(out)
                            out, held = ([], [], [], []), 0
                    if out[0]:
                        yield _rows(out)

    return (placed.repartition(max(1, files), "file")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary"))


def _rows(out) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                       pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
                                      names=["doc_id", "start", "n_tokens", "ids"])


def token_folder(spark: SparkSession) -> str:
    """A new folder for token files under the shared checkpoint folder."""
    return scratch_dir(spark, f"llm-tokens-{uuid.uuid4().hex[:12]}")
