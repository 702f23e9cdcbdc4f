"""Documents shorter than a benchmark item, short items and repeated words, against brute force and the query's own SQL."""

import random
import tempfile
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from touchcredit.llm import registry

ITEM = " ".join(f"word{k}" for k in range(25)).split()
ROUND = "to be or not to be or not to be or not to be that is".split()
DOCS = {
    1: ITEM[:-1],  # 20 of 21 shingles
    2: ITEM[4:],  # 17 of 21: a fifth cut off
    3: ITEM[5:],  # 16 of 21: under 0.8
    4: ITEM,
    5: ["before", *ITEM, "after"],
    6: ITEM[:12] + ["other"] + ITEM[13:-1],  # short, and a word changed
    7: ROUND[:-1],
    8: ["to", "be"],
    9: ITEM[1:-2],
}


def brute_force(docs, items):
    count = lambda s: Counter(tuple(s))
    runs = lambda w, k: [tuple(w[at : at + k]) for at in range(len(w) - k + 1)]
    out = {}
    for d, text in docs.items():
        for i, item in items.items():
            x, y = (runs(w, min(5, len(item))) for w in (text, item))
            size = min(len(x), len(y))
            for at in range(len(x) - size + 1) if size else ():
                a, b = count(x[at : at + size]), count(y)
                s = (a & b).total() / (a | b).total()
                if s >= 0.8 and s > out.get((d, i), (0, 0))[0]:
                    out[d, i] = (s, at)
    return out


def test_documents_shorter_than_the_item(spark):
    d = tempfile.mkdtemp(prefix="llm-test-")
    texts = [(k, " ".join(w)) for k, w in DOCS.items()] + [(1, " ".join(DOCS[1])), (10, None)]
    pq.write_table(pa.table({"doc_id": [k for k, _ in texts], "text": pa.array([t for _, t in texts], pa.string())}), f"{d}/documents.parquet")
    pq.write_table(pa.table({"item_id": [1, 2], "text": [" ".join(ITEM), " ".join(ROUND)]}), f"{d}/benchmark.parquet")
    want = brute_force(DOCS, {1: ITEM, 2: ROUND})
    assert {(1, 1), (2, 1), (7, 2), (9, 1)} <= set(want) and (3, 1) not in want
    got = registry.queries()["op3_decontamination"](spark, d).collect()
    assert {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in got} == {
        k: (round(s, 9), at) for k, (s, at) in want.items()}
    assert len(got) == len(want)
    stage = dict(corpus_pipeline.STAGES)["decontamination"]
    left = {r.doc_id for r in stage(spark, spark.read.parquet(f"{d}/documents.parquet"), d).collect()}
    assert left == ({*DOCS, 10} - {k for k, _ in want})


def written(docs, items):
    d = tempfile.mkdtemp(prefix="llm-test-")
    pq.write_table(pa.table({"doc_id": pa.array([k for k, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string())}),
                   f"{d}/documents.parquet")
    pq.write_table(pa.table({"item_id": [k for k, _ in items], "text": [t for _, t in items]}), f"{d}/benchmark.parquet")
    return d


def sql_rows(d):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{d}/{name}.parquet'")
    return sorted(con.execute(registry.oracle_sql()["op3_decontamination"]).fetchall(), key=str)


def test_short_items_and_repeated_words(spark):
    """Few words, so that shingles repeat within windows and items; items of one word and more."""
    r = random.Random(11)
    word = lambda: r.choice(["to", "be", "or", "not"])
    items = {k: [word() for _ in range(n)] for k, n in enumerate([1, 2, 3, 4, 5, 6, 9, 14, 14, 30, 30])}
    docs = {k: [word() for _ in range(r.choice([0, 1, 3, 5, 9, 40]))] for k in range(40)}
    for k in range(100, 130):  # copies with a word changed, cut or put in
        copy = list(r.choice(list(items.values())))
        for _ in range(r.randint(0, 2)):
            at = r.randrange(len(copy))
            copy[at : at + r.randint(0, 1)] = [word()] * r.randint(0, 2)
            copy = copy or ["be"]
        docs[k] = [word() for _ in range(r.randint(0, 4))] + copy + [word() for _ in range(r.randint(0, 4))]
    rows = [(k, " ".join(w)) for k, w in docs.items()]
    d = written([*rows, *rows[:20], (None, " ".join(items[10]))], [(k, " ".join(w)) for k, w in items.items()])
    got = registry.queries()["op3_decontamination"](spark, d).select("doc_id", "item_id", "similarity", "start").collect()
    want = brute_force({**docs, None: items[10]}, items)
    have = {(x.doc_id, x.item_id): (round(x.similarity, 9), x.start) for x in got}
    assert len(have) == len(got) and len(want) > 60
    # a tie within the radius of the fingerprints only: no row more, none less
    assert have == {k: (round(s, 9), at) for k, (s, at) in want.items()}
    assert sorted([tuple(x) for x in got], key=str) == sql_rows(d)


def test_a_long_item_costs_no_square(spark):
    """An item of 4000 words within a longer text: 4000 x 400 windows would be spread over places."""
    words = [f"w{k}" for k in range(6000)]
    d = written([(1, " ".join(words)), (2, " ".join(words[1000:4700])), (3, " ".join(words[:1500]))], [(7, " ".join(words[1000:5000]))])
    got = registry.queries()["op3_decontamination"](spark, d).collect()
    assert [(x.doc_id, x.item_id, x.start) for x in sorted(got)] == [(1, 7, 1000), (2, 7, 0)]
