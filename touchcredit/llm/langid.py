"""Language identification in two steps: family first, then languages within it.

Features are shares of hashed byte n-grams (1 to 3 bytes, A-Z lower-cased) of the whole text. Linear support
vector machines, one for each pair of families, vote for a family; within it, one for each pair of its
languages vote for the language. Pairs vote with calibrated probabilities; the score is the family's mean vote
times the language's.

The models are fitted in one task on a bounded sample: ``SAMPLE`` labelled documents shared equally by the
languages, whole texts and one short piece of each. Everything else covers all rows and whole texts.

Some language always wins, so whether a text is in it at all is judged apart: ``evidence`` is the share of its
4-byte runs that training texts of the predicted language have, and a text is ``known`` if that is at least
``FLOOR`` of the median of training texts kept out of the table, less 1 / sqrt(runs) for short ones.

Defined results: text that is null or has no letter is ``und`` with score 0; so is all text if nothing could
be learned; with one language learned, it has score 1; rows of equal doc_id are judged each; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm.common import LOWER, fold, mix, slices, table, text_bytes

DIM = 1 << 13
PARTS, HELD = 4, 2
SAMPLE = 1600
UNKNOWN = "und"
#: Bytes of text that a task takes at once: some 100 bytes of arrays a byte of text.
PIECE = 1 << 18
#: Bits of a language's table of 4-byte runs; every so manieth training text is kept out of it, to measure.
RUN_BITS = 18
KEPT_OUT = 5
FLOOR = 0.5
#: Families of common languages by ISO 639-1 code; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi fo",
    "romance": "fr es it pt ro ca gl oc la rm sc ast",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "uralic": "fi et hu se",
    "turkic": "tr az kk ky uz tt tk",
    "indo-aryan": "hi ur bn pa gu mr ne si or as",
    "semitic": "ar he am mt ti",
    "celtic": "ga gd cy br kw gv",
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"only {lang}")


def ngrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of the n-gram that starts at each byte for n of 1 to 3 (DIM: leaves its row), and each row's count."""
    n = len(raw)
    low = LOWER[raw].astype(np.uint64)
    end = np.repeat(offsets[1:], np.diff(offsets))
    at, out, code = np.arange(n), np.empty((3, n), np.int32), np.zeros(n, np.uint64)
    for k in range(3):
        code = code << np.uint64(8) | np.concatenate([low[k:], np.zeros(min(k, n), np.uint64)])[:n]
        out[k] = np.where(at + k < end, (mix(code, 71 + k) % np.uint64(DIM)).astype(np.int32), DIM)
    size = np.diff(offsets)
    return out, size + np.maximum(size - 1, 0) + np.maximum(size - 2, 0)


def runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table place and row of every 4-byte run inside a row."""
    n = len(raw)
    low = LOWER[raw].astype(np.uint64)
    code = np.zeros(n, np.uint64)
    for k in range(4):
        code = code << np.uint64(8) | np.concatenate([low[k:], np.zeros(min(k, n), np.uint64)])[:n]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    on = np.arange(n) + 4 <= offsets[1:][row]
    return (mix(code[on], 97) & np.uint64((1 << RUN_BITS) - 1)).astype(np.int64), row[on]


def known_runs(texts: list[bytes], langs: np.ndarray, names: list[str]) -> tuple[bytes, dict[str, float]]:
    """Each language's table of runs, packed, and the floor of its evidence."""
    blob, floors = b"", {}
    for name in names:
        own = [t for t, lang in zip(texts, langs.tolist(), strict=True) if lang == name]
        seen = np.zeros(1 << RUN_BITS, bool)
        places = [runs(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in own]
        for k, at in enumerate(places):
            if k % KEPT_OUT:
                seen[at] = True
        shares = [seen[at].mean() for at in places[::KEPT_OUT] if len(at)]
        floors[name] = FLOOR * float(np.median(shares)) if len(shares) >= KEPT_OUT else 0.0
        for at in places:
            seen[at] = True
        blob += np.packbits(seen).tobytes()
    return blob, floors


def features(texts: list[bytes]) -> np.ndarray:
    """Dense shares of n-grams, for training."""
    x = np.zeros((len(texts), DIM), np.float32)
    for k, t in enumerate(texts):
        f, n = ngrams(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        x[k] = np.bincount(f.ravel(), minlength=DIM + 1)[:DIM] / max(1, n[0])
    return x


def linear_svm(x: np.ndarray, y: np.ndarray, steps: int = 100, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2 SVM with squared hinge, by accelerated gradient; classes weigh the same. y: -1, 1."""
    w = v = np.zeros(x.shape[1], np.float32)
    b = c = 0.0
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    step = 1.0 / (2 * float(np.einsum("ij,ij->i", x, x).max()) + 2 + ridge)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v + c)).astype(np.float32) * y * share
        w2, b2 = v + step * (2 * (x.T @ slack) - ridge * v), c + step * 2 * float(slack.sum())
        m = k / (k + 3)
        v, c = w2 + m * (w2 - w), b2 + m * (b2 - b)
        w, b = w2, b2
    return w, b


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["lang", "h", "text"], kind="stable")
    rng = np.random.default_rng(3)
    texts, langs = [], []
    for t, lang in zip(pdf["text"], pdf["lang"], strict=True):
        raw = t.encode()
        size = int(rng.integers(12, 120))
        at = int(rng.integers(0, max(1, len(raw) - size)))
        texts += [raw, raw[at : at + size]]
        langs += [lang, lang]
    x, langs = features(texts), np.array(langs)
    scale = 1 / np.sqrt(x.mean(axis=0) + 1e-5)
    x *= scale
    norm = float(np.sqrt(np.einsum("ij,ij->i", x, x).mean()))
    x /= norm
    names = sorted(set(langs.tolist()))
    fams = sorted({family(n) for n in names})
    members = {f: [n for n in names if family(n) == f] for f in fams}
    tasks = [("", a, b, members[a], members[b]) for a, b in combinations(fams, 2)]
    tasks += [(f, a, b, [a], [b]) for f in fams for a, b in combinations(members[f], 2)]
    out, weights = [], []
    for level, a, b, left, right in tasks:
        is_a, is_b = np.isin(langs, left), np.isin(langs, right)
        on = is_a | is_b
        y = np.where(is_a[on], 1.0, -1.0).astype(np.float32)
        own = x if on.all() else x[on]
        w, bias = linear_svm(own, y)
        margin = own @ w + bias
        del own  # else it stays while the next pair's rows are copied
        # slope of a logistic curve through the margins
        slope = 1.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(slope * margin, -30, 30)))
            g, hess = float((margin * ((y + 1) / 2 - p)).mean()), float((margin**2 * p * (1 - p)).mean()) + 1e-6
            slope = min(20.0, max(0.5, slope + np.clip(g / hess, -1, 1)))
        out.append({"level": level, "a": a, "b": b, "bias": float(bias), "slope": float(slope)})
        weights.append((w * scale / norm).astype(np.float32))
    blob = np.array(weights, np.float32).reshape(-1, DIM).tobytes()
    table_of_runs, floors = known_runs(texts[::2], langs[::2], names)
    return pd.DataFrame([{"model": json.dumps({"members": members, "tasks": out, "floors": floors}), "weights": blob, "runs": table_of_runs}])


def fit(labelled: DataFrame) -> dict:
    """The model from rows (doc_id, text, lang): DIM weights for each pair of families and of related languages.

    Two scans: one counts the languages (no text is read), one takes each language's rows whose hash lies under
    its threshold, about SAMPLE of all. A model has weights for pairs of languages: their number, not the input, bounds it."""
    rows = labelled.where(F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    each = max(1, SAMPLE // max(1, len(counts)))
    limit = F.lit(0).cast("bigint")
    for lang, n in sorted(counts.items()):
        limit = F.when(F.col("lang") == lang, F.lit(min(1 << 30, int(each / n * (1 << 30)) + 1)).cast("bigint")).otherwise(limit)
    h = F.xxhash64("doc_id", "text")
    sample = rows.where((F.pmod(h, F.lit(1 << 30)) < limit) & has_letter(F.col("text"))).select("text", "lang", h.alias("h"))
    found = sample.distinct().withColumn("one", F.lit(1)).groupBy("one").applyInPandas(_fit, "model string, weights binary, runs binary").collect()
    if not found:
        return {"members": {}, "tasks": [], "weights": b"", "floors": {}, "runs": b""}
    return json.loads(found[0]["model"]) | {"weights": bytes(found[0]["weights"]), "runs": bytes(found[0]["runs"])}


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _vote(names: list[str], pairs: list[tuple[str, str, np.ndarray]], n: int) -> np.ndarray:
    """Mean probability of each name against each other, as (n, names)."""
    at, out = {x: k for k, x in enumerate(names)}, np.zeros((n, len(names)))
    for a, b, p in pairs:
        out[:, at[a]] += p
        out[:, at[b]] += 1 - p
    return out / (len(names) - 1) if len(names) > 1 else np.ones((n, 1))


def _predictor(model: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tasks, members = model["tasks"], model["members"]
        w = np.zeros((DIM + 1, max(1, len(tasks))), np.float32)
        if tasks:
            w[:DIM] = np.frombuffer(model["weights"], np.float32).reshape(-1, DIM).T
        fams, names = sorted(members), sorted(model["floors"])
        number = {name: k for k, name in enumerate(names)}
        floor = np.array([*model["floors"].values()] and [model["floors"][x] for x in names] + [2.0])
        seen = np.unpackbits(np.frombuffer(model["runs"], np.uint8)).reshape(len(names), -1).astype(bool) if names else None
        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                n = piece.num_rows
                raw, offsets = text_bytes(piece.column(1))
                sums = np.zeros((n, w.shape[1]))
                f, count = ngrams(raw, offsets)
                full = np.flatnonzero(np.diff(offsets))
                if len(full) and tasks:
                    for g in f:
                        sums[full] += np.add.reduceat(w[g], offsets[full], axis=0, dtype=np.float64)
                share = sums / np.maximum(count, 1)[:, None]
                prob = [1 / (1 + np.exp(-np.clip(t["slope"] * (share[:, k] + t["bias"]), -30, 30))) for k, t in enumerate(tasks)]
                votes = lambda level: [(t["a"], t["b"], p) for t, p in zip(tasks, prob, strict=True) if t["level"] == level]
                lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
                if fams:
                    by_family = _vote(fams, votes(""), n)
                    best = by_family.argmax(axis=1)
                    for k, name in enumerate(fams):
                        own = _vote(members[name], votes(name), n)
                        on = best == k
                        lang[on] = np.array(members[name], object)[own.argmax(axis=1)[on]]
                        score[on] = by_family[on, k] * own.max(axis=1)[on]
                letter = piece.column(2).to_numpy(zero_copy_only=False).astype(bool)
                lang[~letter], score[~letter] = UNKNOWN, 0.0
                evidence, known = np.zeros(n), np.zeros(n, bool)
                if names and len(raw):
                    of = np.array([number.get(x, len(names)) for x in lang])
                    at, row = runs(raw, offsets)
                    on = of[row] < len(names)
                    total = np.maximum(np.bincount(row, minlength=n), 1)
                    evidence = np.bincount(row[on], seen[of[row[on]], at[on]], n) / total
                    known = evidence >= floor[of] - 1 / np.sqrt(total)
                    known &= letter & (of < len(names))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(evidence), pa.array(known)],
                    ["doc_id", "lang_pred", "score", "evidence", "known"])

    return run


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score, evidence, known of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", has_letter(F.col("text")).alias("letter"))
    return rows.mapInArrow(_predictor(model), "doc_id bigint, lang_pred string, score double, evidence double, known boolean")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), PARTS) == HELD
    out = predict(docs, fit(docs.where(~held)))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "evidence", "known")


def keep_known(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` without the rows whose language is not known: no letter, or too little evidence of any learned one.
    Without learned languages no row stays."""
    run = _predictor(model)

    @F.arrow_udf("boolean")  # texts stay in Arrow: as pandas objects a batch takes its size twice more
    def known(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, letter in parts:
            batch = pa.RecordBatch.from_arrays([pa.nulls(len(text), pa.int64()), text, letter], ["doc_id", "text", "letter"])
            found = [b.column(b.schema.get_field_index("known")) for b in run(iter([batch]))]
            yield pa.concat_arrays(found) if found else pa.array([], pa.bool_())

    return docs.where(known(F.col("text"), has_letter(F.col("text"))))
