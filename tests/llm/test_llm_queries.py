"""Every operator on small tables with nulls, empty and long texts, ties, repeated rows and clashing extra
columns, against brute force or DuckDB; and on empty tables."""

import math
import re
import tempfile
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from touchcredit.llm import registry

WORDS = "alder birch cedar dogwood elm fir ginkgo hazel iris juniper kapok larch maple nutmeg oak pine quince rowan".split()
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


def documents():
    base = sentence(1, 60)
    texts = [None, "", " \t\n", "one two", "One two", base, base, base + " tail", sentence(2, 3000), "x" * 5000,
             "12 34 !!", sentence(4, 40) + "\nshared line here\n" + sentence(5, 8), "  "]
    texts += [sentence(100 + k, 30) + "\nShared line here \n" + sentence(200 + k, 20) for k in range(12)]
    texts += [f"du bist ein {w} und das ist nicht gut für {w}" for w in WORDS[:8]]
    texts += [sentence(300 + k, 20) + " stupid idiot trash " + sentence(400 + k, 10) for k in range(8)]
    item = sentence(900, 25)
    texts += [sentence(901, 10) + " " + item.upper() + ". " + sentence(902, 10)]
    rows = [{"doc_id": k, "text": t, "lang": None if k % 7 == 0 else ("de" if t and t.startswith("du") else "en"),
             "source": None if k % 5 == 0 else f"s{k % 3}", "n_chars": len(t or ""), "size": "x", "score": "y", "h": k, "key": "k"}
            for k, t in enumerate(texts)]
    return rows + [rows[5], rows[0]], item


def tables(empty):
    rows, item = documents()
    docs = pa.Table.from_pylist(rows)
    rng = np.random.default_rng(0)
    vec = [{"vec_id": k, "embedding": rng.normal(size=8).astype(np.float32).tolist(), "node": 1} for k in range(120)]
    vec[3]["embedding"] = None
    vec[4]["embedding"] = [0.0] * 8
    vec[5]["embedding"] = [float("nan")] * 8
    vec[60]["embedding"] = vec[61]["embedding"] = vec[50]["embedding"]
    schema = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("node", pa.int64())])
    conv = [{"conv_id": c, "turn": t, "role": r, "text": x, "segments": 0} for c, t, r, x in [
        (1, 0, "user", "a <|end|> b <\\| c"), (1, 1, "assistant", "ok <"), (2, 0, "assistant", None), (2, 0, "user", "tie"),
        (3, 1, "user", "x"), (3, 1, "user", "x"), (4, 0, "system", ""), (4, 1, "user", "é\n"), (4, 2, "assistant", "<|turn|>")]]
    out = {
        "documents": docs,
        "benchmark": pa.table({"item_id": [1, 2, 2], "text": [item, None, ""]}),
        "labels": pa.table({"doc_id": [r["doc_id"] for r in rows[:-2]], "quality": [1] * (len(rows) - 2),
                            "toxic": [int("idiot" in (r["text"] or "")) for r in rows[:-2]]}),
        "embeddings": pa.Table.from_pylist(vec, schema=schema),
        "conversations": pa.Table.from_pylist(conv),
    }
    return {k: v.slice(0, 0) if empty else v for k, v in out.items()}


def write(empty=False):
    d = tempfile.mkdtemp(prefix="llm-test-")
    for name, t in tables(empty).items():
        pq.write_table(t, f"{d}/{name}.parquet")
    return d


@pytest.fixture(scope="module")
def sf_dir():
    return write()


def rows_of(spark, d, name):
    return registry.queries()[name](spark, d).collect()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in tables(False):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want = con.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    got = registry.queries()[name](spark, sf_dir).select(*cols).collect()
    assert Counter(map(key, got)) == Counter(map(key, want.fetchall()))


def test_toxicity_and_language_rows(spark, sf_dir):
    docs, _ = documents()
    tox = rows_of(spark, sf_dir, "op1_toxicity")
    assert len(tox) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in tox)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in tox)
    lang = rows_of(spark, sf_dir, "op2_language_id")
    text = {r["doc_id"]: r["text"] for r in docs}
    assert len(lang) == len(docs)
    for r in lang:
        letter = any(c.isalpha() for c in text[r.doc_id] or "")
        assert (r.lang_pred == "und") == (not letter) and 0 <= r.score <= 1
    by_id = {r.doc_id: r.lang_pred for r in lang}
    german = [k for k, t in text.items() if t and t.startswith("du bist")]
    assert sum(by_id[k] == "de" for k in german) >= len(german) - 1


def test_context_mixing_base_and_bits(spark, sf_dir):
    docs, _ = documents()
    held = [zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in docs]
    tokens = [[*words(r["text"]), "\n"] for r in docs]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = Counter((r["doc_id"], h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6))
                   for r, h, t in zip(docs, held, tokens, strict=True))
    got = rows_of(spark, sf_dir, "op4_context_mixing")
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_near_dedup_equals_brute_force(spark, sf_dir):
    docs, _ = documents()
    sets = {}
    for r in docs:
        w = words(r["text"])
        sets[r["doc_id"]] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, x in sets.items():
            for b, y in sets.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = rows_of(spark, sf_dir, "op6_near_dedup")
    assert len(got) == len(docs)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (i, len(s), root[i], root[i] == i) for i, s in sets.items()}


def test_neighbours_equal_brute_force(spark, sf_dir):
    vec = {r["vec_id"]: np.array(r["embedding"], float) for r in tables(False)["embeddings"].to_pylist() if r["embedding"]}
    vec = {k: x / np.linalg.norm(x) for k, x in vec.items() if np.isfinite(x).all() and np.linalg.norm(x) > 0}
    got = {(r.query_id, r.rank): (r.vec_id, round(r.score, 9)) for r in rows_of(spark, sf_dir, "op7_nn_descent")}
    want = {}
    for q in (k for k in vec if k % 50 == 0):
        best = sorted((-round(float(x @ vec[q]), 9), k) for k, x in vec.items() if k != q)[:5]
        want |= {(q, n + 1): (k, -s) for n, (s, k) in enumerate(best)}
    assert got == want


def test_token_files_round_trip(spark, sf_dir):
    from tokenizers import Tokenizer

    from touchcredit.llm import tokens
    from touchcredit.llm.common import shared_dir, table

    tok = Tokenizer.from_file(tokens.tokenizer_path())
    docs, _ = documents()
    ids = {r["doc_id"]: [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0] for r in docs}
    at, want = 0, []
    for i in sorted(r["doc_id"] for r in docs):
        want.append((i, at, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes())))
        at += len(ids[i])
    got = rows_of(spark, sf_dir, "op8_token_output")
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
    path = shared_dir(spark)
    tokens.write_tokens(table(spark, sf_dir, "documents"), path)
    some = tokens.read_documents(spark, path, [3, 8]).collect()
    assert {r.doc_id: list(r.ids) for r in some} == {3: ids[3], 8: ids[8]}
    data = bytearray(tokens.read_files(spark, path).first()[0])
    data[len(data) // 3] ^= 1
    with pytest.raises(Exception):  # noqa: B017 - zstandard or checksum
        f = tokens.TokenFile(bytes(data))
        [f.ids(k) for k in range(len(f.docs))]


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language ID"](spark, docs, sf_dir)
    assert known.columns == docs.columns
    assert {r.doc_id for r in known.collect()} == {r["doc_id"] for r in documents()[0] if any(c.isalpha() for c in r["text"] or "")}
    kept = sorted(r.doc_id for r in stages["near-dedup"](spark, known, sf_dir).collect())
    assert kept.count(5) == 1 and 6 not in kept and 7 not in kept and 3 in kept and 4 not in kept
    clean = stages["decontamination"](spark, docs, sf_dir)
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in clean.collect()}
    assert clean.columns == docs.columns and gone == {max(r["doc_id"] for r in documents()[0])}
    mixed = stages["mixing"](spark, docs, sf_dir)
    assert mixed.columns == docs.columns
    assert max(Counter(r.doc_id for r in mixed.where("doc_id not in (0, 5)").collect()).values()) <= 3


def test_empty_tables(spark):
    d = write(empty=True)
    for name, query in registry.queries().items():
        n = query(spark, d).count()
        assert n == (1 if name.startswith("op9") else 0), name
    assert corpus_pipeline.run(spark, d).count() == 0
