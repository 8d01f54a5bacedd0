"""Token-id files of independent zstandard frames with a trailing seek table.

A file is a row of zstandard frames, an index frame and a seek table, the last two in skippable
frames, so that any zstandard decoder reads the file whole. A frame holds whole documents: their
number, whether each has an id, their ids, their token counts, then the token ids (16 bits each
where the vocabulary allows, else 32; the index says which). The seek table has each frame's two
sizes and the low 32 bits of the XXH64 of its content; the index has each frame's first document
id. A reader of some documents finds their frames by bisection and decompresses no others.

Files follow each other in ascending order of doc_id, and so do the documents in them.

Defined cases: a null text is empty; every document has at least the end id; null ids come first;
rows with one id stay rows, ordered by the hash of the text; an empty table gives no file; other
columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane.llm.common import pieces, written
from quotelane.llm.files import open_fs, put
from quotelane.llm.tokens import VOCABULARY, encoder
from quotelane.session import work_dir

FRAME_IDS = 1 << 18
FILE_CHARS = 24 << 20
LEVEL = 3
# The skippable and seekable formats of zstandard.
INDEX_MAGIC = 0x184D2A50
TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

MANIFEST = "part int, path string, documents long, ids long"


def frame_payload(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    kind = "<u2" if width == 2 else "<u4"
    return b"".join(
        (
            struct.pack("<I", len(doc_ids)),
            bytes(d is not None for d in doc_ids),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([len(x) for x in ids], "<u8").tobytes(),
            *(x.astype(kind).tobytes() for x in ids),
        )
    )


def read_payload(raw: bytes, width: int) -> Iterator[tuple[int | None, np.ndarray]]:
    (n,) = struct.unpack_from("<I", raw)
    known = raw[4 : 4 + n]
    doc_ids = np.frombuffer(raw, "<i8", n, 4 + n)
    counts = np.frombuffer(raw, "<u8", n, 4 + 9 * n).astype(np.int64)
    ids = np.frombuffer(raw, "<u2" if width == 2 else "<u4", offset=4 + 17 * n)
    for has, doc, part in zip(known, doc_ids.tolist(), np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        yield (doc if has else None), part


def file_content(frames: Iterator[bytes], firsts: list[int | None], width: int, level: int) -> Iterator[bytes]:
    """The bytes of a file; ``firsts`` may still grow while the frames are taken."""
    import xxhash
    import zstandard

    coder = zstandard.ZstdCompressor(level=level)
    table = []
    for raw in frames:
        packed = coder.compress(raw)
        table.append(struct.pack("<III", len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        yield packed
    index = struct.pack("<B", width) + b"".join(struct.pack("<Bq", f is not None, f or 0) for f in firsts)
    yield struct.pack("<II", INDEX_MAGIC, len(index)) + index
    entries = b"".join(table)
    yield struct.pack("<II", TABLE_MAGIC, len(entries) + 9) + entries
    yield struct.pack("<IBI", len(table), CHECKSUM_FLAG, FOOTER_MAGIC)


class FrameFile:
    """Reads a file of frames by seeking."""

    def __init__(self, path: str):
        system, place = open_fs(path)
        self.path = path
        self.file = system.open_input_file(place)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError(f"{path}: no seek table")
        table = np.frombuffer(self._at(size - 9 - 12 * count, 12 * count), "<u4").reshape(-1, 3)
        self.packed, self.raw, self.sums = (table[:, i].astype(np.int64) for i in range(3))
        self.offsets = np.cumsum(self.packed) - self.packed
        index = self._at(int(self.packed.sum()) + 8, 1 + 9 * count)
        self.width = index[0]
        self.firsts = [
            struct.unpack_from("<Bq", index, 1 + 9 * i) for i in range(count)
        ]  # (0, 0) for a null id sorts first
        self.decompressed = 0

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def frame(self, i: int) -> Iterator[tuple[int | None, np.ndarray]]:
        import xxhash
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(
            self._at(int(self.offsets[i]), int(self.packed[i])), max_output_size=int(self.raw[i])
        )
        self.decompressed += 1
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
            raise ValueError(f"{self.path}: frame {i} is damaged")
        return read_payload(raw, self.width)

    def documents(self, wanted: set[int]) -> Iterator[tuple[int, np.ndarray]]:
        """The wanted documents; only frames that may hold one are decompressed."""
        from bisect import bisect_left, bisect_right

        todo = set()
        for doc in wanted:
            key = (1, doc)
            todo.update(range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)))
        for i in sorted(todo):
            yield from ((d, ids) for d, ids in self.frame(i) if d in wanted)

    def close(self) -> None:
        self.file.close()


def _write(folder: str, vocabulary: str, frame_ids: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        coder = encoder(vocabulary)
        width = 2 if coder.size <= 1 << 16 else 4
        firsts: list[int | None] = []
        totals = [0, 0]

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    some = batch.slice(at, 256)
                    flat, ends = coder.encode(some.column(1).to_pylist())
                    yield from zip(some.column(0).to_pylist(), np.split(flat, ends[:-1]), strict=True)

        def frames() -> Iterator[bytes]:
            docs, parts, size = [], [], 0
            for doc, ids in documents():
                docs.append(doc)
                parts.append(ids)
                size += len(ids)
                totals[0] += 1
                totals[1] += len(ids)
                if size >= frame_ids:
                    firsts.append(docs[0])
                    yield frame_payload(docs, parts, width)
                    docs, parts, size = [], [], 0
            if docs:
                firsts.append(docs[0])
                yield frame_payload(docs, parts, width)

        path = f"{folder}/ids-{part:06d}.zst"
        taken = frames()
        one = next(taken, None)
        if one is None:
            return

        def all_frames() -> Iterator[bytes]:
            yield one
            yield from taken

        put(path, file_content(all_frames(), firsts, width, level))
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "path": [path], "documents": totals[:1], "ids": totals[1:]},
            schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]),
        )

    return run


def write_frames(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    frame_ids: int = FRAME_IDS,
    file_chars: int = FILE_CHARS,
    level: int = LEVEL,
) -> DataFrame:
    """Write files of about ``file_chars`` characters' tokens each; returns the manifest, a row per file."""
    folder = work_dir(docs.sparkSession, "ids")
    files = pieces(docs.agg(F.sum(F.length("text") + 1)).first()[0], file_chars)
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("_row")]
    ranged = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
        .repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .select(F.col("doc_id").cast("long"), "text")
    )
    return written(ranged.mapInArrow(_write(folder, vocabulary, frame_ids, level), MANIFEST), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for batch in batches:
        for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            file = FrameFile(path)
            for i in range(len(file.packed)):
                rows: tuple[list, ...] = ([], [], [], [])
                for doc, ids in file.frame(i):
                    for column, value in zip(
                        rows, (doc, base, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True
                    ):
                        column.append(value)
                    base += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in rows], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                )
            file.close()


def read_frames(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files.

    The driver sees a row per file, to give each the number of ids in the files before it.
    """
    base, rows = 0, []
    for row in sorted(manifest.select("part", "path", "ids").collect()):
        rows.append((row["path"], base))
        base += row["ids"]
    listed = spark.createDataFrame(rows, "path string, base long")
    return listed.repartition(max(1, len(rows)), "path").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def read_documents(spark: SparkSession, manifest: DataFrame, wanted: list[int]) -> DataFrame:
    """doc_id and ids of the wanted documents; other frames stay compressed."""
    ask = set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                file = FrameFile(path)
                rows = list(file.documents(ask))
                file.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in rows], pa.int64()), pa.array([i.tolist() for _, i in rows], pa.list_(pa.int64()))],
                    names=["doc_id", "ids"],
                )

    return manifest.select("path").mapInArrow(run, "doc_id long, ids array<bigint>")
