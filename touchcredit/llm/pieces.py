"""SentencePiece encoding and decoding with a table of distinct chunks.

In the piece model no piece holds a white-space marker after another character, and none holds a newline
(``check_model`` looks at every piece and refuses a model where this is not so). So merging never crosses the place
before a run of markers or a newline, and a text is the sequence of its chunks: each begins with its markers
or a newline and ends before the next. A task cuts its documents into blocks of about ``BLOCK_BYTES``, lists the
distinct chunks of a block (exactly, by their bytes), has the sentencepiece library encode each of them once and
decode its ids once, and puts ids and surfaces back by position. Nothing is shuffled, so a chunk is segmented once a block.
(A table of the whole corpus, joined back by block and place, took 4.5 times its input in shuffled dictionaries; README has the
figures.)

The library puts one marker before a text; here every text gets one space in front, which makes each text
begin with a marker, and the chunk's own first marker is left to the library. Its decoding takes the first
marker off again, and so does this.

Defined results: null and empty text have the end id alone and decode to empty text; a text's own U+2581 is a
marker like a space, and decodes to a space, as in the library; equal doc_ids keep a row each, null ids too; an
empty table gives no rows; extra columns are not read. ``decode_ids`` decodes null ids to empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm.blocks import tiled
from touchcredit.llm.common import slices, table, text_bytes

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Bytes of text in a block; a longer document is a block of its own.
BLOCK_BYTES = 16 << 20

_models: dict = {}


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def processor(path: str):
    """The library's processor, loaded once a worker."""
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def check_model(path: str) -> None:
    """Raise unless texts may be cut before runs of markers and before newlines."""
    sp = processor(path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
        raise ValueError("a piece crosses a marker or a newline: encode whole texts with this model")
    # the same normalisation everywhere: one marker in front, no other change
    if sp.encode(" a  b ", out_type=str) != sp.encode(" a", out_type=str) + sp.encode(" b", out_type=str) + [MARK]:
        raise ValueError("the model changes white space: encode whole texts with it")


def chunk_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte places where a chunk starts: row starts, runs of markers, newlines."""
    n = len(raw)
    after = np.concatenate([raw, np.zeros(2, np.uint8)])
    wide = np.flatnonzero(raw == 0xE2)
    wide = wide[(after[wide + 1] == 0x96) & (after[wide + 2] == 0x81)]
    mark = raw == 0x20
    opens = mark.copy()
    opens[wide] = True
    for k in range(3):
        mark[wide + k] = True
    at = opens & ~np.concatenate([[False], mark[:-1]]) | (raw == 0x0A)
    begin = offsets[:-1]
    at[begin[begin < offsets[1:]]] = True
    return np.flatnonzero(at[:n])


def split_chunks(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts, a space put before each text that is not empty, and each text's number of chunks."""
    text = pc.fill_null(text, "")
    spaced = pc.if_else(pc.equal(pc.binary_length(text), 0), "", pc.binary_join_element_wise(" ", text, ""))
    raw, offsets = text_bytes(spaced)
    if not len(raw):
        return pa.array([], pa.large_string()), np.zeros(len(text), np.int64)
    starts = chunk_starts(raw, offsets)
    return tiled(raw, starts), np.diff(np.searchsorted(starts, offsets))


def segment(sp, chunks: list[str]) -> tuple[pa.ListArray, pa.Array]:
    """Ids and surface (what the ids decode to) of each chunk, by the library."""
    mark = sp.piece_to_id(MARK)
    said = sp.encode([c if c[0] == "\n" else c[1:] for c in chunks], num_threads=1)
    # the marker that the library put before a newline is not the chunk's; a lone marker is empty text to it
    ids = [i[1:] if c[0] == "\n" else i or [mark] for c, i in zip(chunks, said, strict=True)]
    surface = [s if c[0] == "\n" else " " + s for c, s in zip(chunks, sp.decode(ids, num_threads=1), strict=True)]
    return pa.array(ids, pa.list_(pa.int32())), pa.array(surface, pa.large_string())


def put(codes: np.ndarray, counts: np.ndarray, ids: pa.ListArray, surface: pa.Array, end: int | None) -> tuple[pa.Array, pa.Array]:
    """Ids and decoded text of each document from its chunks' places in the table; ``end`` closes each."""
    values = pc.list_flatten(ids).to_numpy(zero_copy_only=False).astype(np.int32)
    sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
    if end is not None:
        codes = np.insert(codes, np.cumsum(counts), len(sizes))
        counts = counts + 1
        values, sizes = np.append(values, np.int32(end)), np.append(sizes, 1)
        surface = pa.concat_arrays([surface, pa.array([""], surface.type)])
    ends = np.concatenate([[0], np.cumsum(counts)])
    count = sizes[codes]
    run = np.concatenate([[0], np.cumsum(count)])
    begin = (np.cumsum(sizes) - sizes)[codes]
    rows = pa.ListArray.from_arrays(pa.array(run[ends], pa.int32()),
                                    pa.array(values[np.repeat(begin - run[:-1], count) + np.arange(run[-1])], pa.int32()))
    _, at, data = surface.take(pa.array(codes, pa.int32())).buffers()
    at = np.frombuffer(at, np.int64)[ends] if len(codes) else np.zeros(len(ends), np.int64)
    text = pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(at), data)
    return rows, pc.utf8_slice_codeunits(text, 1).cast(pa.string())


def _encode(path: str, add_end: bool, block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(path)
        for batch in batches:
            for piece in slices(batch, "text", block_bytes):
                chunks, counts = split_chunks(piece.column("text"))
                found = chunks.dictionary_encode()
                ids, surface = segment(sp, found.dictionary.to_pylist())
                ids, text = put(np.asarray(found.indices, np.int64), counts, ids, surface, sp.eos_id() if add_end else None)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), ids, text], ["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str | None = None, add_end: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, ids, decoded of every row of ``docs`` (doc_id, text)."""
    path = path or model_path()
    check_model(path)
    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(
        _encode(path, add_end, block_bytes), "doc_id bigint, ids array<int>, decoded string")


def _decode(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(path)
        for batch in batches:
            text = [sp.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    return run


def decode_ids(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of rows (doc_id, ids) from anywhere: the library's own decoding of each."""
    return rows.selectExpr("cast(doc_id as bigint) as doc_id", "cast(ids as array<int>) as ids").mapInArrow(
        _decode(path or model_path()), "doc_id bigint, text string")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
