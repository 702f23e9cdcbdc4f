"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. A document is cut into short
windows; each is compressed with the ordinary dictionary alone and with the toxic one before it (toxic text
holds ordinary language too), so that the lengths of an ordinary window hardly differ and those of a toxic one
do. The gains of its windows, calibrated by logistic regression, give the document's score.

Only some words of a toxic document are toxic. The toxic dictionary is trained on snippets around words that
documents labelled 1 have far more often than those labelled 0, counted once for each group of near copies.

Training takes a bounded sample of labelled rows in one task: ``SAMPLE`` ids of each label at most, chosen by a hash
from the labels alone, before any text is read; those few ids are sent to the scan of documents, so
no other text moves. Their texts are taken whole. Everything else covers all rows. Scores take texts alone.

Defined results: null and empty text are scored as a text without gains; rows of equal doc_id are scored each;
a label null or other than 0 and 1 is not learned from; with labels of one kind only, or none, every document
gets the share of ones (0 without labels); an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm.common import fold, table
from touchcredit.llm.minhash import shingle_sets

SAMPLE = 4000
WINDOW, STRIDE = 64, 48
LEVEL = 6
TOXIC_BYTES, ORDINARY_BYTES = 2048, 32768
MARGIN = 1
SNIPPETS = 20_000
#: A word stands out if at least so many toxic documents have it, and their share lies so many standard deviations above chance.
FEWEST = 3
CONTRAST = 6.0
THRESHOLD = 0.7


def _words(text: bytes) -> list[re.Match]:
    return list(re.finditer(rb"[a-z\x80-\xff]+", text))


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; of too few samples, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[:size]


def _sizer(content: bytes) -> Callable[[bytes], int]:
    if not content:
        pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    else:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
    compress = pack.compress
    return lambda w: len(compress(w))


class Gains:
    """Features of a text from the gains of its windows."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.plain, self.toxic = _sizer(ordinary), _sizer(toxic + ordinary)

    def features(self, text: bytes) -> tuple[float, ...]:
        plain, toxic = self.plain, self.toxic
        ends = range(0, max(1, len(text) - (WINDOW - STRIDE)), STRIDE)
        windows = [text[k : k + WINDOW] for k in ends]
        d = np.sort(np.array([plain(w) - toxic(w) for w in windows], float))
        return (d[-1], d[-2:].mean(), d[-4:].mean(), d.mean(), np.log(len(d)),
                np.maximum(d - np.median(d) - 5, 0).sum())


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    b = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (w * (y - p)) - ridge * b
        hess = (x.T * (w * p * (1 - p))) @ x + ridge * np.eye(len(b))
        b = b + np.linalg.solve(hess, grad)
    return b


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row: dictionaries and calibration, from the sampled rows (text, label, share of its label)."""
    pdf = pdf.sort_values(["h", "text"], kind="stable")
    texts = [t.lower().encode() for t in pdf["text"]]
    label = pdf["label"].to_numpy()
    weight = pdf["weight"].to_numpy()
    rate = float(np.average(label, weights=weight)) if len(label) else 0.0
    if len(set(label.tolist())) < 2:
        return pd.DataFrame([{"toxic": b"", "ordinary": b"", "model": json.dumps({"rate": rate})}])
    rows, h = shingle_sets(pa.array(pdf["text"].tolist(), pa.string()))
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(h) else []
    _, lone = np.unique(h[first], return_index=True)
    own = sorted(rows[first][lone].tolist()) if len(h) else []
    seen: tuple[Counter, Counter] = Counter(), Counter()
    n = [0, 0]
    for k in own:
        n[label[k]] += 1
        seen[label[k]].update({m.group() for m in _words(texts[k])})
    total, toxic_words = max(1, sum(n)), set()
    for word, a in seen[1].items():
        e = (a + seen[0][word]) / total * n[1]
        if a >= FEWEST and (a - e) / np.sqrt(max(1e-9, e * (1 - n[1] / total))) >= CONTRAST:
            toxic_words.add(word)
    rng = np.random.default_rng(1)
    toxic, ordinary = [], []
    for k in own:
        t = texts[k]
        if label[k]:
            toxic += [t[max(0, m.start() - MARGIN) : m.end() + MARGIN] for m in _words(t) if m.group() in toxic_words]
        else:
            ordinary += [t[j : j + WINDOW] for j in rng.integers(0, max(1, len(t) - WINDOW), 6)]
    if not toxic:  # no word stands out: whole windows
        toxic = [texts[k][j : j + WINDOW] for k in own if label[k] for j in range(0, max(1, len(texts[k])), WINDOW)]
    pick = lambda s: [s[i] for i in rng.permutation(len(s))[:SNIPPETS]]
    toxic, ordinary = _dictionary(TOXIC_BYTES, pick(toxic)), _dictionary(ORDINARY_BYTES, pick(ordinary))
    gains = Gains(toxic, ordinary)
    x = np.array([gains.features(t) for t in texts])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    b = _logistic(np.c_[np.ones(len(x)), (x - mean) / scale], label.astype(float), weight / weight.mean())
    model = {"mean": mean.tolist(), "scale": scale.tolist(), "b": b.tolist(), "rate": rate}
    return pd.DataFrame([{"toxic": toxic, "ordinary": ordinary, "model": json.dumps(model)}])


def choose(labels: DataFrame, counts: dict[int, int], sample: int = SAMPLE) -> DataFrame:
    """doc_id, label, weight, h: ``sample`` ids of each label at most. A threshold on the ids' hash, set from the
    counts, leaves little more than the sample before it is ordered."""
    h = F.xxhash64("doc_id")
    parts = []
    for k in (0, 1):
        share = min(1.0, 1.2 * sample / max(1, counts.get(k, 0)) + 1e-9)
        few = labels.where((F.col("label") == k) & (F.pmod(h, F.lit(1 << 30)) < int(share * (1 << 30)) + 1))
        parts.append(few.select("doc_id", "label", F.lit(max(1.0, counts.get(k, 0) / sample)).alias("weight"), h.alias("h"))
                     .orderBy("h").limit(sample))
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The model from documents (doc_id, text) and labels (doc_id, label: one row an id); a few KB, whatever the input."""
    labels = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("label").cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # at most two samples of ids: that bound, not the input, sizes what is broadcast
    chosen = F.broadcast(choose(labels, counts, sample))
    rows = docs.where("text is not null").join(chosen, "doc_id").groupBy("doc_id", "label", "weight", "h").agg(F.min("text").alias("text"))
    rows = rows.select("text", "label", "weight", "h", F.lit(1).alias("one"))
    found = rows.groupBy("one").applyInPandas(_fit, "toxic binary, ordinary binary, model string").collect()
    if not found:
        return {"toxic": b"", "ordinary": b"", "rate": 0.0}
    return json.loads(found[0]["model"]) | {"toxic": bytes(found[0]["toxic"]), "ordinary": bytes(found[0]["ordinary"])}


def _scorer(model: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model["toxic"], model["ordinary"]) if "b" in model else None
        for batch in batches:
            score = np.full(batch.num_rows, model["rate"])
            if gains and batch.num_rows:
                x = np.array([gains.features((t.as_py() or "").lower().encode()) for t in batch.column(1)])
                z = (x - model["mean"]) / model["scale"] @ np.array(model["b"][1:]) + model["b"][0]
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score of every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scorer(model), "doc_id bigint, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    learn = labels.where(fold(F.col("doc_id"), 3) != 1)
    out = score(docs, fit(docs, learn))
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
