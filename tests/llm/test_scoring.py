import math
import random

import numpy as np
from pyspark.sql import functions as F

from gaugeflow.llm import langid, toxicity
from gaugeflow.llm.common import crc_fold


def plain_segments(scores):
    """Repeatedly the best-scoring stretch, then left and right of it."""
    out = []

    def split(a, b):
        best = None
        for i in range(a, b):
            for j in range(i + 1, b + 1):
                s = sum(scores[i:j])
                if s > 1e-12 and (best is None or s > best[2] + 1e-9):
                    best = (i, j, s)
        if best:
            split(a, best[0])
            out.append(best)
            split(best[1], b)
    split(0, len(scores))
    return out


def test_maximal_segments():
    rng = random.Random(2)
    for _ in range(60):
        scores = [rng.uniform(-2, 1.5) for _ in range(rng.randint(0, 14))]
        got = toxicity.segments(np.array(scores))
        want = plain_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_lambda_solves_its_equation():
    s, p = np.array([3.0, -0.1]), np.array([0.01, 0.99])
    lam = toxicity.solve_lambda(s, p)
    assert lam > 0 and math.isclose((p * np.exp(lam * s)).sum(), 1, rel_tol=1e-6)
    assert toxicity.solve_lambda(np.array([-1.0]), np.array([1.0])) == 1.0


def labelled(spark, n=400):
    rng = random.Random(4)
    words = [f"w{i}x" for i in range(200)]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=60)
        if i % 4 == 0:
            for at in rng.sample(range(60), 3):
                text[at] = rng.choice(["foulbad", "vilebad", "nastybad"]) + rng.choice(["", "!", ","])
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_learns_and_scores(spark, docs, empty):
    rows = labelled(spark)
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"), crc_fold(F.col("doc_id"), 5) != 0)
    got = rows.select("toxic", toxicity.score_column(model, F.col("text")).alias("s")).collect()
    assert all((r.s >= 0.5) == bool(r.toxic) and 0 <= r.s <= 1 for r in got)
    found = toxicity.toxic_passages(rows, model).groupBy("doc_id").count().collect()
    assert {r.doc_id for r in found} == {r.doc_id for r in rows.where("toxic = 1").collect()}
    clean = docs.select(toxicity.score_column(model, F.col("text")).alias("s")).collect()
    assert len(clean) == docs.count() and all(r.s < 0.5 for r in clean)
    none = toxicity.fit(docs, rows.select("doc_id", "toxic").limit(0))
    assert none.odds == {} and none.probability(none.excess("any text")) < 0.5
    assert toxicity.fit(empty, rows.select("doc_id", "toxic")).odds == {}


def test_network_learns_languages(spark, docs, empty):
    rng = random.Random(6)
    parts = {"aa": ["ka", "to", "mi", "ru"], "bb": ["szcz", "rzy", "prz", "wie"], "cc": ["ñan", "dé", "çu", "é"]}
    rows = [(i, " ".join("".join(rng.choices(parts[g], k=3)) for _ in range(40)), g)
            for i, g in enumerate(list(parts) * 60)]
    texts = spark.createDataFrame(rows + [(900, "x y", None)], "doc_id long, text string, lang string")
    net = langid.fit(texts, crc_fold(F.col("doc_id"), 4) != 2, epochs=8)
    got = texts.where("lang is not null").select("lang", langid.predict_column(net, F.col("text")).alias("p")).collect()
    assert sum(r.lang == r.p.lang_pred for r in got) >= 0.95 * len(got)
    odd = docs.select("text", langid.predict_column(net, F.col("text")).alias("p")).collect()
    assert all((r.p.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in odd)
    blank = langid.fit(empty)
    assert blank.predict(["some text", None]) == [("und", 0.0)] * 2


def test_tables_equal_convolution():
    net = langid.ByteCnn.initial(["a", "b"], np.random.default_rng(0))
    x = np.random.default_rng(1).integers(0, 256, (3, langid.WINDOW)).astype(np.uint8)
    want = []
    for width, block, offset in zip(langid.WIDTHS, net.filters, net.offsets):
        span = langid.WINDOW - width + 1
        answers = sum(net.embed[x][:, k:k + span] @ block[k] for k in range(width))
        want.append(np.maximum(answers.max(axis=1) + offset, 0))
    assert np.allclose(net.pooled(x), np.concatenate(want, axis=1), atol=1e-4)


def test_all_of_a_text_is_read():
    data = bytes(range(1, 200)) * 7
    w = langid.windows(data)
    assert w.tobytes().rstrip(b"\0") == data and w.shape[1] == langid.WINDOW
