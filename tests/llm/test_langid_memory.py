"""Language ID holds its training matrix once and takes texts in small pieces, whatever the batch."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from touchcredit.llm import langid

WORDS = {
    "en": "the and of house water night reads where",
    "de": "der und von haus wasser nacht liest wohin",
    "fr": "le et de maison eau nuit lire dans",
    "es": "el y de casa agua noche leer donde",
}


def _texts(each: int) -> pd.DataFrame:
    rng = np.random.default_rng(5)
    rows = [(" ".join(rng.choice(words.split(), 60)), lang) for lang, words in WORDS.items() for _ in range(each)]
    return pd.DataFrame({"text": [t for t, _ in rows], "lang": [lang for _, lang in rows], "h": np.arange(len(rows))})


def _peak(call) -> int:
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_training_holds_its_matrix_once():
    texts = _texts(50)
    matrix = 2 * len(texts) * langid.DIM * 4
    # half of the matrix again for two languages of one family
    assert _peak(lambda: langid._fit(texts)) < 1.9 * matrix


def test_prediction_holds_a_piece_not_a_batch():
    model = langid._fit(_texts(20)).iloc[0]
    model = langid.json.loads(model["model"]) | {"weights": model["weights"], "runs": model["runs"]}
    text = (" ".join(list(WORDS.values())) + " ") * 60
    n = (4 << 20) // len(text)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([text] * n), pa.array([True] * n)], ["doc_id", "text", "letter"])

    def whole():
        assert sum(b.num_rows for b in langid._predictor(model)(iter([batch]))) == n

    assert _peak(whole) < 45e6


def test_known_rows_as_predicted(spark):
    texts = _texts(30)
    docs = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(zip(texts["text"], texts["lang"], strict=True))]
                                 + [(900, None, None), (901, "", None), (902, "12 34", None), (903, "zzqx " * 300, None)],
                                 "doc_id bigint, text string, lang string")
    model = langid.fit(docs)
    known = {r[0] for r in langid.predict(docs, model).where("known").select("doc_id").collect()}
    kept = langid.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.collect()} == known
    assert not known & {900, 901, 902}
    assert len(known) >= 100
    assert langid.keep_known(docs.limit(0), model).count() == 0
