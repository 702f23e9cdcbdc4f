"""Token-id output: independent zstandard frames with a trailing seek table and per-frame checksums.

A file is a sequence of zstandard frames. The first holds the file's place in the output and its
documents' ids; each other one holds the ids of one document, 2 bytes each if the vocabulary allows it, else
4, little-endian. A skippable frame at the end lists every frame's compressed and plain size and the low 32
bits of XXH64 of its plain bytes (zstandard's seekable format, so other tools read it too). A reader takes
the table, then decompresses only the frames of the documents it was asked for.

Documents are put in order by ranges of doc_id, encoded in that order and packed into files of about
``FILE_BYTES``; Spark's own committer writes them, so a lost task is done again without a trace.

Texts are cut where the tokenizer's own pattern always cuts (before a space between words, at punctuation
after a letter, at a newline). Each different piece is encoded by the tokenizers library once while it stays
in the worker's cache.

Defined results: null or empty text has the end id alone; equal doc_ids stand side by side, ordered by text,
null ids first; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchcredit.llm.common import cut, shared_dir, slices, span_hashes, table, text_bytes

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
FILE_BYTES = 8 << 20
FRAMES_MOST = 1 << 20
LEVEL = 3
MOST_PIECES = 2_000_000
# fixed values of zstandard's seekable format
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
#: Spark's text writer ends a record with this: the last four bytes of the seek table.
LAST = struct.pack("<I", SEEKABLE).decode("latin-1")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


# ---- encoding -------------------------------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?")] = True


def piece_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte places where a piece starts: row starts and places at which the byte-level pattern always cuts.

    Letters are ASCII's and those of U+00C0 to U+00FF; beside other characters nothing is cut, which gives
    longer pieces and the same ids.
    """
    n = len(raw)
    at = np.zeros(n + 3, bool)
    pad = np.concatenate([[0, 0], raw, [0, 0]]).astype(np.uint8)
    before2, before, here, after = pad[:n], pad[1 : n + 1], pad[2 : n + 2], pad[3 : n + 3]
    lead = before == 0xC3
    wide = lead & (here >= 0x80) & (here != 0x97) & (here != 0xB7)
    letter = _LETTER[here] | wide
    solid = _SIGN[here] | wide
    opens = _SIGN | (np.arange(256) == 0xC3)
    was_letter = np.concatenate([[False], letter[:-1]])
    was_solid = np.concatenate([[False], solid[:-1]])
    was_solid2 = np.concatenate([[False, False], solid[:-2]])[:n]
    at[:n] = ((here == 0x20) & was_solid & opens[after]) | ((here == 0x0A) & was_solid) | (_STOP[here] & was_letter)
    at[:n] |= (before == 0x0A) & was_solid2 & opens[here]
    at[offsets[:-1]] = True
    return np.flatnonzero(at[:n])


class Encoder:
    """Ids of texts; keeps the ids of the pieces it has met, at most ``MOST_PIECES``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        if len(self.keys) + len(hashes) > MOST_PIECES:
            self.clear()
        said = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, said), np.int64, len(said))
        new = np.fromiter((i for ids in said for i in ids), np.uint32, int(count.sum()))
        begin = len(self.ids) + np.cumsum(count) - count
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys, self.ids = keys[order], np.concatenate([self.ids, new])
        self.begin = np.concatenate([self.begin, begin])[order]
        self.count = np.concatenate([self.count, count])[order]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the offsets of rows in them."""
        raw, offsets = text_bytes(column)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = piece_starts(raw, offsets)
        ends = np.append(starts[1:], len(raw))
        keys, first, each = np.unique(span_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        known = self.find(keys)
        if (~known).any():
            data, new = raw.tobytes(), first[~known]
            if len(self.keys) + len(new) > MOST_PIECES:
                self.clear()
                known[:] = False
                new = first
            self.learn(keys[~known], [data[s:e].decode() for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
        at = np.searchsorted(self.keys, keys)
        count, begin = self.count[at][each], self.begin[at][each]
        run = np.cumsum(count)
        ids = self.ids[np.repeat(begin - (run - count), count) + np.arange(run[-1])]
        rows = np.concatenate([[0], run])[np.searchsorted(starts, offsets)]
        return ids, rows

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ---- the file format ------------------------------------------------------------------------------------


class FileBuilder:
    """Frames of one file; ``finish`` gives its bytes but for the last four, which the writer adds."""

    def __init__(self, part: int, number: int, width: int):
        self.part, self.number, self.width = part, number, width
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.frames: list[bytes] = []
        self.table: list[bytes] = []
        self.docs: list[int | None] = []
        self.size = 0

    def frame(self, plain: bytes) -> tuple[bytes, bytes]:
        packed = self.pack.compress(plain)
        return packed, struct.pack("<III", len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        packed, entry = self.frame(ids.astype(f"<u{self.width}").tobytes())
        self.frames.append(packed)
        self.table.append(entry)
        self.docs.append(doc_id)
        self.size += len(packed) + len(entry)

    def finish(self) -> bytes:
        ids = np.array([x or 0 for x in self.docs], "<i8").tobytes()
        null = np.packbits([x is None for x in self.docs]).tobytes()
        head, entry = self.frame(struct.pack("<QQII", self.part, self.number, self.width, len(self.docs)) + ids + null)
        entries = entry + b"".join(self.table)
        tail = struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IB", len(self.docs) + 1, CHECKSUMS)
        return head + b"".join(self.frames) + tail


class TokenFile:
    """Reads a file's bytes; decompresses only the frames asked for and checks their checksums."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        n, flags, magic = struct.unpack("<IBI", self.data[-9:])
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError("not a token file: no seek table with checksums at its end")
        self.entries = np.frombuffer(self.data[-9 - 12 * n : -9], "<u4").reshape(n, 3)
        self.at = np.concatenate([[0], np.cumsum(self.entries[:, 0], dtype=np.int64)])
        self.unpack = zstandard.ZstdDecompressor()
        head = self.plain(0)
        self.part, self.number, self.width, docs = struct.unpack("<QQII", head[:24])
        ids = np.frombuffer(head, "<i8", docs, 24).tolist()
        null = np.unpackbits(np.frombuffer(head, np.uint8, -1, 24 + 8 * docs), count=docs)
        self.docs = [None if no else i for i, no in zip(ids, null, strict=True)]
        #: Ids before each document in this file, then all of them.
        self.starts = np.concatenate([[0], np.cumsum(self.entries[1:, 1], dtype=np.int64)]) // self.width

    def plain(self, frame: int) -> bytes:
        _, size, check = (int(x) for x in self.entries[frame])
        out = self.unpack.decompress(self.data[self.at[frame] : self.at[frame + 1]], max_output_size=size)
        if len(out) != size or xxhash.xxh64_intdigest(out) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {frame} does not match its checksum")
        return out

    def ids(self, k: int) -> np.ndarray:
        """The ids of the file's k-th document."""
        return np.frombuffer(self.plain(k + 1), f"<u{self.width}").astype("<u4")


# ---- Spark jobs -----------------------------------------------------------------------------------------


def _files(path: str, file_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path), TaskContext.get().partitionId()
        end = np.array([END_ID], np.uint32)
        file = FileBuilder(part, 0, enc.width)
        for batch in batches:
            for piece in slices(batch, "text"):
                ids, rows = enc.encode(piece.column(1))
                for k, doc in enumerate(piece.column(0).to_pylist()):
                    file.add(doc, np.append(ids[rows[k] : rows[k + 1]], end))
                    if file.size >= file_bytes or len(file.docs) >= FRAMES_MOST:
                        yield pa.RecordBatch.from_arrays([pa.array([file.finish()], pa.binary())], ["file"])
                        file = FileBuilder(part, file.number + 1, enc.width)
        if file.docs:
            yield pa.RecordBatch.from_arrays([pa.array([file.finish()], pa.binary())], ["file"])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) and write token files in ascending doc_id order below ``path``."""
    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "text"))
    files = ordered.mapInArrow(_files(tokenizer or tokenizer_path(), file_bytes), "file binary")
    (files.select(F.col("file").cast("string")).write.option("compression", "none")
     .option("encoding", "ISO-8859-1").option("lineSep", LAST).option("maxRecordsPerFile", 1).text(path))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0):
            data = value.as_buffer()
            if not data.size:
                continue
            file = TokenFile(data)
            n = len(file.docs)
            crc = [zlib.crc32(file.ids(k).tobytes()) for k in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, file.part, np.int64)), pa.array(np.full(n, file.number, np.int64)),
                 pa.array(file.docs, pa.int64()), pa.array(file.starts[:-1], pa.int64()),
                 pa.array(np.diff(file.starts), pa.int64()), pa.array(crc, pa.int64())],
                ["part", "number", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files."""
    rows = cut(read_files(spark, path).mapInArrow(
        _digests, "part bigint, number bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"))
    # offsets: of a part by all parts before (one row a task of the write), of a file by the part's files before
    files = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    parts = files.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("base"))
    files = files.join(parts, "part").select(
        "part", "number", (F.col("base") + F.coalesce(F.sum("n").over(
            Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("base"))
    return rows.join(files, ["part", "number"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _chosen(wanted: frozenset[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                if value.as_buffer().size:
                    file = TokenFile(value.as_buffer())
                    for k, doc in enumerate(file.docs):
                        if doc in wanted:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([doc], pa.int64()), pa.array([file.ids(k).astype(np.int64)])], ["doc_id", "ids"])

    return run


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of the documents asked for; no other frame is decompressed."""
    return read_files(spark, path).mapInArrow(_chosen(frozenset(doc_ids)), "doc_id bigint, ids array<bigint>")


def encode_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = shared_dir(spark)
    write_tokens(docs, path)
    return token_digests(spark, path)


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark, table(spark, sf_dir, "documents"))
