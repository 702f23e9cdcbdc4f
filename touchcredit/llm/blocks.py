"""Dictionary blocks: texts as codes into a list of the distinct parts that a block of documents has.

A task cuts its documents' texts into parts and packs them into blocks of about ``BLOCK_BYTES``. A block has
one row for each document (its parts as places in the block's dictionary, in order) and one row for each
distinct part. Parts of all blocks then meet in one table of distinct parts, where the work on a part is done
once; its result goes back by (block, place), and a block's documents are put together again beside the
results of their own parts. Only the distinct parts of each block are shuffled, never the running text, and
a part that every document holds has one row a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.llm.common import cut, slices

#: Bytes of text in a block; a longer document is a block of its own.
BLOCK_BYTES = 8 << 20
DOCUMENT, PART = 0, 1


def tiled(raw: np.ndarray, starts: np.ndarray) -> pa.LargeStringArray:
    """The parts of ``raw`` that begin at ``starts`` (ascending, the first at 0), each up to the next, uncopied."""
    ends = np.append(starts, len(raw)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw)))


def _rows(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch of ``n`` rows; columns not given are null."""
    return pa.RecordBatch.from_arrays(
        [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def dictionary_blocks(docs: DataFrame, split: Callable, part_type: str, extra: str = "",
                      block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Document rows (block, doc_id, codes, extra columns) and part rows (block, k, part), both written.

    ``docs`` has doc_id and text. ``split`` takes a batch of them and returns an array with the parts of all its
    rows, the number of parts of each row, and a dict of the extra columns.
    """
    fields = f"block bigint, doc_id bigint, codes binary, {extra + ', ' if extra else ''}k int, part {part_type}"
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in f"kind int, {fields}".split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in slices(batch, "text", block_bytes):
                parts, counts, more = split(piece)
                found = parts.dictionary_encode()
                codes = np.asarray(found.indices, np.int32)
                ends = np.cumsum(counts)
                spelled = pa.array([codes[e - c : e].tobytes() for c, e in zip(counts.tolist(), ends.tolist(), strict=True)],
                                   pa.binary())
                n, m = piece.num_rows, len(found.dictionary)
                yield _rows(schema, n, kind=pa.array(np.full(n, DOCUMENT)), block=pa.array(np.full(n, block)),
                            doc_id=piece.column("doc_id"), codes=spelled, **more)
                yield _rows(schema, m, kind=pa.array(np.full(m, PART)), block=pa.array(np.full(m, block)),
                            k=pa.array(np.arange(m)), part=found.dictionary)
                block += 1

    rows = cut(docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, f"kind int, {fields}"),
               partition_by="kind")
    names = [f.split()[0] for f in extra.split(", ")] if extra else []
    return (rows.where(f"kind = {DOCUMENT}").select("block", "doc_id", "codes", *names),
            rows.where(f"kind = {PART}").select("block", "k", "part"))


def codes_of(documents: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all rows one after the other, and the number of codes of each row."""
    each = [np.frombuffer(x.as_buffer(), np.int32) for x in documents.column("codes").combine_chunks()]
    return (np.concatenate(each) if each else np.zeros(0, np.int32)), np.array([len(x) for x in each], np.int64)


def assemble(documents: DataFrame, results: DataFrame, put: Callable, schema: str) -> DataFrame:
    """Each block's document rows beside its parts' results (block, k, ...): ``put`` takes both as Arrow tables,
    the results in the order of k, and returns a table of ``schema``."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return put(left, right.sort_by("k"))

    results = results.withColumn("of", F.col("block")).drop("block")
    return documents.groupBy("block").cogroup(results.groupBy("of")).applyInArrow(run, schema)
