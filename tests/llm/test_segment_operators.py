"""SentencePiece chunks, segment-deduplicated resampling and the filter audit: against the library, brute force
and DuckDB, on nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib
import itertools
import math
import random
import re
import tempfile
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from touchcredit.llm import audit, pieces, registry, resample
from touchcredit.llm.common import text_bytes

PARTS = [" ", "  ", "\n", "\t", "▁", "a", "The", "é", "漢", "🙂", "1", "23", " x", "\u0000", "�", "\r\n", "<s>", "</s>",
         "<0x41>", "▁▁", "　", "zzq", "ing", ".", " <unk>", "Z", "#", "abcdefghi", "abcdefghj", "x" * 40]


def texts(n, seed=3):
    rng = random.Random(seed)
    some = ["".join(rng.choices(PARTS, k=rng.choice([0, 1, 4, 12, 60]))) for _ in range(n)]
    shared = "the same first line\nand the same second line of text"
    plain = [" ".join(rng.choices(["alder", "birch", "Cedar", "fir", "x1", "été"], k=30)) for _ in range(40)]
    return some + plain + [shared + "\n" + t for t in plain[:20]] + [shared] * 3 + \
        ["w " * 20_000, "y" * 2000, "\n" * 500, " " * 3000, ("line of words\n" * 400), "one\ntwo\nthree\n\nfour five"]


def write(rows):
    d = tempfile.mkdtemp(prefix="llm-test-")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()),
                        ("n_chars", pa.int64()), ("block", pa.string()), ("weight", pa.string()), ("copy", pa.string()),
                        ("words", pa.int64()), ("line", pa.int64()), ("part", pa.string()), ("ids", pa.string())])
    docs = [{"doc_id": k, "text": t, "lang": [None, "en", "de", ""][hash(k) % 4], "copy": "c", "words": -1, "part": "p"} for k, t in rows]
    pq.write_table(pa.Table.from_pylist(docs, schema=schema), f"{d}/documents.parquet")
    labels = [{"doc_id": k, "quality": q, "toxic": x} for k, q, x in
              [(1, 1, 0), (1, None, 1), (2, 0, None), (3, 7, 1), (None, 1, 1), (10**6, 1, 1)] + [(k, 1, k % 2) for k in range(20, 60)]]
    pq.write_table(pa.Table.from_pylist(labels if rows else [], schema=pa.schema([
        ("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())])), f"{d}/labels.parquet")
    bench = [(1, "alder birch x1\nx1 x1"), (2, None), (2, "")] if rows else []
    pq.write_table(pa.table({"item_id": pa.array([i for i, _ in bench], pa.int64()),
                             "text": pa.array([t for _, t in bench], pa.string())}), f"{d}/benchmark.parquet")
    return d


ROWS = list(enumerate(texts(300)))
ROWS += [(None, "null id text " * 9), (None, None), (-5, None), (-6, ""), ROWS[310], ROWS[310], (-7, ROWS[310][1])]


@pytest.fixture(scope="module")
def sf_dir():
    return write(ROWS)


def test_chunks_encode_as_the_library(spark, sf_dir):
    sp = pieces.processor(pieces.model_path())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    want = Counter()
    for k, t in ROWS:
        ids = sp.encode(t or "", add_eos=True)
        want[k, tuple(ids), sp.decode(ids)] += 1
    out = pieces.encode(docs, block_bytes=5000).persist()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in out.collect()) == want
    again = pieces.decode_ids(out.select("doc_id", "ids"))
    assert Counter((r.doc_id, r.text) for r in again.collect()) == Counter({(k, t): 0 for k, _, t in want}) + Counter(
        (k, t) for (k, _, t), n in want.items() for _ in range(n))
    digests = registry.queries()["op11_sentencepiece"](spark, sf_dir).collect()
    assert Counter(tuple(r) for r in digests) == Counter({
        (k, len(i), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()): n
        for (k, i, t), n in want.items()})


def test_each_distinct_chunk_of_a_block_is_segmented_once(monkeypatch):
    seen = []
    sp = pieces.processor(pieces.model_path())
    monkeypatch.setattr(pieces, "segment", lambda sp, chunks: seen.append(chunks) or (pa.array([[1]] * len(chunks), pa.list_(pa.int32())),
                                                                                   pa.array(chunks, pa.large_string())))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([k for k, _ in ROWS], pa.int64()), "text": pa.array([t for _, t in ROWS])})
    out = list(pieces._encode(pieces.model_path(), True, 1 << 30)([batch]))
    assert sp and len(seen) == 1 and len(seen[0]) == len(set(seen[0])) and out[0].num_rows == len(ROWS)


def test_run_buckets_are_crc32(spark):
    rng = random.Random(1)
    ws = ["".join(rng.choices("abcz09é漢", k=rng.choice([1, 2, 5, 9, 63, 64, 65, 66, 130, 1000]))) for _ in range(200)]
    raw, starts, ends, _, _ = resample.words(pa.array([" ".join(ws)]))
    for n, bucket in enumerate(resample.run_buckets(raw, starts, ends)):
        assert [zlib.crc32(" ".join(ws[i - n : i + 1]).encode()) % 10_000 for i in range(n, len(ws))] == bucket[n:].tolist()


def brute_weights(rows, bench):
    def features(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return len(w), Counter(zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1))

    s, t = Counter(), Counter()
    for _, x in rows:
        s += features(x)[1]
    for x in bench:
        t += features(x)[1]
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10_000.0) / ((s[b] + 1.0) * (big_t + 10_000.0)))) for b in range(10_000)}
    out = []
    for k, x in rows:
        n, f = features(x)
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] * c for b, c in f.items())
        out.append((k, n, sum(f.values()), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return out


def test_weights_and_draw_equal_brute_force(spark, sf_dir):
    want = brute_weights(ROWS, ["alder birch x1\nx1 x1", None, ""])
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    weighed = resample.weights(docs.repartition(3), bench, block_bytes=5000)
    assert Counter(tuple(r) for r in weighed.select("doc_id", "n_words", "n_features", "weight").collect()) == Counter(r[:4] for r in want)
    open_rows = sorted((r for r in want if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = len(open_rows) * 5 // 100
    rank = [(*r[:1], *r[2:], n + 1 if n < drawn else None) for n, r in enumerate(open_rows)]
    rank += [(*r[:1], *r[2:], None) for r in want if r[1] < 20]
    got = registry.queries()["op12_importance_resampling"](spark, sf_dir).collect()
    assert drawn > 2 and Counter(tuple(r) for r in got) == Counter(rank)
    taken = resample.resample(docs.where("doc_id >= 0"), bench)
    assert "rank" in taken.columns and set(docs.columns) <= set(taken.columns)


def test_lines_are_counted_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    lines, _ = resample.line_table(docs)
    # empty lines have no features: whether a text starts with one is not counted
    want = Counter(line for _, t in ROWS if t for line in t.split("\n") if line)
    assert {r.line: r.n for r in lines.collect() if r.line} == dict(want)


def test_transducer_and_verified_table():
    some = [t for _, t in ROWS]
    raw, offsets = text_bytes(pa.array(some))
    counts, starts, ends = audit.transduce(raw, offsets)
    rows = np.searchsorted(offsets, starts, "right") - 1
    # also with hashes that all collide: only the bytes decide
    few = rows < 60
    for chosen, hashes in ((np.ones(len(rows), bool), None), (few, np.zeros(few.sum(), np.uint64))):
        own = audit.first_of_each(raw, starts[chosen], ends[chosen], rows[chosen], hashes)
        different = np.bincount(rows[chosen][own == np.arange(chosen.sum())], minlength=len(some))
        for k, t in enumerate(some[:60] if hashes is not None else some):
            w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            assert (len(w), len(set(w))) == (counts["words"][k], different[k])
    for k, t in enumerate(some):
        t = t or ""
        assert (len(t), len(re.findall("[A-Z]", t)), len(re.findall(r"[#$%&*|]", t))) == \
            (counts["points"][k], counts["capitals"][k], counts["symbols"][k])


@pytest.mark.parametrize("name", ["op12_importance_resampling", "op13_filter_audit"])
def test_equals_sql(spark, sf_dir, name):
    if name.startswith("op12"):  # its SQL takes a step for each byte of the longest run
        sf_dir = write([(k, t) for k, t in ROWS if max(len(w.encode()) for w in re.split("[\x00-\x2F]", t or "")) < 20])
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want = con.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    got = registry.queries()[name](spark, sf_dir).select(*cols).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


def test_audit_adds_up(spark, sf_dir):
    rows = registry.queries()["op13_filter_audit"](spark, sf_dir).collect()
    parts = {r.part for r in rows}
    assert len(rows) == 600 * len(parts) and {r.filter_order for r in rows} == {"".join(p) for p in itertools.permutations("ABCDE")}
    for part in parts:
        n = sum([None, "en", "de", ""][hash(k) % 4] in ((part,) if part else (None, "")) for k, _ in ROWS)
        for order in ("ABCDE", "EDCBA"):
            steps = sorted((r for r in rows if r.part == part and r.filter_order == order), key=lambda r: r.step)
            assert sum(r.removed for r in steps) + steps[-1].kept == n
            assert sum(r.shapley for r in steps) == 120 * (n - steps[-1].kept)


def test_empty_tables(spark):
    d = write([])
    for name in ("op11_sentencepiece", "op12_importance_resampling", "op13_filter_audit"):
        assert registry.queries()[name](spark, d).count() == 0
