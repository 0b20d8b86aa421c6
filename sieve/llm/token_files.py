"""Token-ID files of independent zstandard frames with a seek table.

A file follows the public seekable zstandard format: independent frames, then a
skippable frame (magic 0x184D2A5E) with a table of ``compressed size,
decompressed size, checksum`` (low 32 bits of XXH64 of the content) by frame
and a 9-byte footer ``frames, flags, 0x8F92EAB1``.  Any zstandard reader can
decompress it front to back.  Here the first frames hold token ids
(little-endian unsigned 32-bit), whole documents each, about ``FRAME_IDS`` ids;
the last one is the index: ids of documents, their token counts, frames and
places.  A reader takes the footer, the seek table and the index from the end
of the file and then only the frames it needs, each checked by its checksum.

Documents are dealt to files by a range partitioning on the id and a hash of
the text, or on columns of the caller, so files and the documents in them stand
in ascending order; a task streams its documents
into frames and never holds more than one frame, its index and one batch.
Every attempt writes a file of its own name; only the files named in the
manifest, which Spark commits, belong to the result, so a lost executor or a
second attempt does no harm.  The files lie in a folder that all executors
share (below ``spark.checkpoint.dir`` by default).

Edge cases: a null or empty text is the end id alone; rows with a null id come
first, rows with equal ids stand beside each other, by a hash of the text; long texts get a
frame of their own; an empty table gives no file and an empty result.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import TEXT_BATCH, python_ready, saved, shared_path
from .encoding import default_tokenizer, encoder

FRAME_IDS = 1 << 16
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
_NULL = -(1 << 63)
_INDEX = np.dtype([("doc", "<i8"), ("n", "<u8"), ("frame", "<u4"), ("at", "<u8")])
_MANIFEST = "part int, path string, n_docs long, n_tokens long"


class FrameWriter:
    """Writes one file; ``add`` takes documents in order, ``close`` the tables."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = 3):
        self.out, self.frame_ids = out, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.frames, self.docs, self.held, self.size = [], [], [], 0

    def _frame(self, raw: bytes) -> None:
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def _flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
            self.held, self.size = [], 0

    def add(self, doc: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > 4 * self.frame_ids:
            self._flush()
        self.docs.append((_NULL if doc is None else doc, len(ids) // 4, len(self.frames), self.size // 4))
        self.held.append(ids)
        self.size += len(ids)

    def close(self) -> None:
        self._flush()
        self._frame(np.array(self.docs, _INDEX).tobytes())
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0x80, FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)


class FrameReader:
    """Reads a file by ranges; frames are decompressed only when asked for."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != FOOTER or flags != 0x80:
            raise ValueError("not a seekable zstandard file with checksums")
        table = self._at(end - 9 - 12 * n, 12 * n)
        self.frames = [struct.unpack_from("<III", table, 12 * i) for i in range(n)]
        self.start = np.concatenate(([0], np.cumsum([f[0] for f in self.frames], dtype=np.int64)))
        self.docs = np.frombuffer(self.frame(n - 1), _INDEX)
        self.last: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def frame(self, k: int) -> bytes:
        packed, size, check = self.frames[k]
        raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.start[k]), packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def ids(self, row: int) -> np.ndarray:
        """Token ids of the file's ``row``-th document."""
        d = self.docs[row]
        if self.last[0] != d["frame"]:
            self.last = (int(d["frame"]), self.frame(int(d["frame"])))
        return np.frombuffer(self.last[1], "<u4", int(d["n"]), 4 * int(d["at"]))


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text", frame_ids: int = FRAME_IDS, order: list[Column] | None = None,
                      cache: int | None = None) -> DataFrame:
    """Encode ``docs`` into files below ``folder``; the manifest ``part, path, n_docs, n_tokens`` in order.

    Documents stand in ascending order of the id, or of the columns ``order``.
    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library
    that every executor can read; special tokens aren't added, ``end_id`` ends
    each document.  A worker keeps the ids of about ``cache`` chunks of text."""
    spark = docs.sparkSession
    python_ready(spark)
    folder = folder or shared_path(spark, "token-files")
    tokenizer = tokenizer or default_tokenizer()
    end = struct.pack("<I", end_id)
    order = order or [F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))]  # rows that share an id are dealt out too
    by = [f"_by{i}" for i in range(len(order))]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[c.alias(b) for c, b in zip(order, by)])
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        writer = out = None
        total = 0
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                part = b.column(0)[0].as_py()
                path = f"{base}/ids-{part:06d}-{uuid.uuid4().hex}.zst"
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(path, compression=None)
                writer = FrameWriter(out, frame_ids)
                enc = encoder(tokenizer, cache)
            for doc, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                ids = enc.ids(text) + end
                total += len(ids) // 4
                writer.add(doc, ids)
        if writer is not None:
            writer.close()
            out.close()
            name = f"{folder.rstrip('/')}/{path.rpartition('/')[2]}"
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(writer.docs)], pa.int64()),
                                   pa.array([total], pa.int64())], names=["part", "path", "n_docs", "n_tokens"])

    return saved(rows.mapInArrow(run, _MANIFEST), "token-manifest", TEXT_BATCH)


def read_token_files(manifest: DataFrame, doc_ids: set[int] | None = None, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) by document, read from the files.

    ``start`` counts the ids of all documents before.  With ``doc_ids`` only
    the frames that hold those documents are decompressed."""
    python_ready(manifest.sparkSession)
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), np.int64)
    files = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("path", "before")
    files = files.repartition(max(1, manifest.count()), "path")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        for b in batches:
            for path, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as f:
                    reader = FrameReader(f)
                    start = before + np.concatenate(([0], np.cumsum(reader.docs["n"].astype(np.int64))))
                    rows = np.arange(len(reader.docs))
                    if wanted is not None:
                        rows = rows[np.isin(reader.docs["doc"], wanted)]
                    for lo in range(0, len(rows), 1000):
                        out = [[], [], [], [], []]
                        for r in rows[lo:lo + 1000].tolist():
                            ids, doc = reader.ids(r), int(reader.docs["doc"][r])
                            for c, v in zip(out, (None if doc == _NULL else doc, int(start[r]), len(ids), zlib.crc32(ids.tobytes()))):
                                c.append(v)
                            if with_ids:
                                out[4].append(ids.astype(np.int64))
                        cols = [pa.array(c, pa.int64()) for c in out[:4]] + [pa.array(out[4], pa.list_(pa.int64()))] * with_ids
                        yield pa.record_batch(cols, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return files.mapInArrow(run, schema)
