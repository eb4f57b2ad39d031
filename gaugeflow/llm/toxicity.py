"""Toxicity by maximum-scoring segments.

Words and four-letter stems get log-odds between toxic and clean documents
under an informative Dirichlet prior; those whose likelihood-ratio z-score
stands out among all tokens keep theirs. Every token of a text scores its log-odds less a drift, a linear
scan finds all maximal scoring segments, and extreme-value statistics of such
segments (Karlin and Altschul) say which are significant for a text of that
length. Their summed excess, calibrated on labelled documents, is the score.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each class that a fit uses at most, chosen by hash of the key.
SAMPLE_ROWS = 8_000
#: Weight of the prior as a part of all tokens, and what each token costs.
PRIOR, DRIFT = 0.02, 0.1
#: A token stands out when fewer than this many of all tokens would by chance.
CHANCE_TOKENS = 0.1
#: A segment is significant when at most this many as good are expected in a clean text of the length.
MOST_EXPECTED = 0.05
SHINGLE, STEM, WORD = 5, 4, re.compile(r"[^\W_]+")
#: Token scores that a worker keeps.
CACHED = 100_000


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in
    order: linear in its length. Each contains a positive score, none can be
    extended or joined for a higher one."""
    after = np.cumsum(scores)
    at = np.flatnonzero(scores > 0)
    stack: list[list] = []  # start, end, sum before, sum after, place of the last one with a lower sum before
    for i in at.tolist():
        start, before, upto = i, float(after[i] - scores[i]), float(after[i])
        k = len(stack) - 1
        while True:
            while k >= 0 and stack[k][2] >= before:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= upto:
                stack.append([start, i + 1, before, upto, k])
                break
            start, _, before, _, lower = stack[k]
            del stack[k:]
            k = lower
    return [(a, b, high - low) for a, b, low, high, _ in stack]


@dataclass
class ToxicityModel:
    """Token log-odds, extreme-value parameters and calibration of a fit."""

    odds: dict[str, float]
    lam: float = 1.0
    k: float = 1.0
    slope: float = 1.0
    bias: float = -4.0
    kept: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"kept": {}}

    def token(self, part: str) -> float:
        total = -DRIFT
        for word in WORD.findall(part):
            total += self.odds.get(word) or self.odds.get("~" + word[:STEM], 0.0)
        return total

    def scores(self, text: str) -> np.ndarray:
        parts, kept = text.lower().split(), self.kept
        if len(kept) > CACHED:
            kept.clear()
        for part in set(parts).difference(kept):
            kept[part] = self.token(part)
        return np.fromiter(map(kept.__getitem__, parts), float, len(parts))

    def passages(self, text: str | None) -> list[tuple[int, int, float]]:
        """Significant segments: first token, token after the last, and how far
        the score exceeds what a clean text of the length would hold."""
        scores = self.scores(text or "")
        if not (scores > 0).any():
            return []
        base = math.log(max(self.k * len(scores), 1e-9))
        return [(a, b, e) for a, b, s in segments(scores)
                if (e := self.lam * s - base) >= -math.log(MOST_EXPECTED)]

    def excess(self, text: str | None) -> float:
        return sum(e for _, _, e in self.passages(text))

    def probability(self, excess: float) -> float:
        return 1 / (1 + math.exp(-min(max(self.slope * excess + self.bias, -500), 500)))


def solve_lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum p e^(lambda s) = 1 for a score distribution
    with negative mean and some positive score; 1 where there is none."""
    p = weights / weights.sum()
    if (p * scores).sum() >= 0 or not ((scores > 0) & (p > 0)).any():
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * scores, 500))).sum() < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * scores, 500))).sum() < 1 else (low, mid)
    return high


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a one-feature logistic fit with smoothed targets."""
    pos = max(float(y.sum()), 0.0)
    neg = len(y) - pos
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(float(np.abs(x).max(initial=0.0)), 1.0)
    z = np.clip(x / scale, None, 1.0)
    w = np.array([1.0, -1.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w[0] * z + w[1], -30, 30)))
        g = np.array([((p - t) * z).sum() + 1e-3 * w[0], (p - t).sum() + 1e-3 * w[1]])
        h = p * (1 - p) + 1e-9
        m = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(m, g)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return float(w[0] / scale), float(w[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Column | None, key_col: str, text_col: str,
                    label_col: str, rows: int) -> DataFrame:
    """(key, text, y) of at most ``rows`` labelled documents of each class, by
    key hash; rows that repeat key, text and label count once."""
    given = labels.where(F.col(key_col).isNotNull() if train is None else train & F.col(key_col).isNotNull()).select(key_col, F.col(label_col).cast("int").alias("y"))
    order = [F.xxhash64(key_col), key_col]
    chosen = (given.where("y = 1").distinct().orderBy(*order).limit(rows)
              .union(given.where("y = 0").distinct().orderBy(*order).limit(rows)))
    found = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen.withColumnRenamed(key_col, "key")), "key").where(F.col("text").isNotNull())  # at most 2 * rows keys
    # a key may stand for any number of rows: repeated rows count once, and each class keeps ``rows`` of the others
    found = found.dropDuplicates(["key", "text", "y"])
    some = lambda y: found.where(F.col("y") == y).orderBy(F.xxhash64("key"), "key", F.xxhash64("text")).limit(rows)
    return some(1).union(some(0))


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, key_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from documents whose ``labels`` row satisfies ``train``.

    Only texts and labels are used, at most ``sample_rows`` documents of each
    class; null keys are not learned from, null texts neither, repeated rows
    count once, and a key with both labels counts in both classes. Near copies count once: of documents of one class that share the
    least hash of their shingles of five words one is used for the odds. Without a label of both classes, as
    in empty tables, the model has no odds and finds every text clean.
    """
    from gaugeflow.llm.common import shared_table

    sample = shared_table(labelled_sample(docs, labels, train, key_col, text_col, label_col, sample_rows), "toxicity")
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - SHINGLE + 1))
    least = F.array_min(F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, SHINGLE))))
    texts = (sample.select("y", words.alias("words")).select("y", F.array_distinct("words").alias("words"), least.alias("least"))
             .dropDuplicates(["y", "least"]))
    tokens = texts.select("y", F.explode(F.array_distinct(F.concat(
        "words", F.transform("words", lambda w: F.concat(F.lit("~"), F.substring(w, 1, STEM)))))).alias("token"))
    counts = shared_table(tokens.groupBy("token").agg(
        F.sum(F.col("y")).alias("toxic"), F.sum(1 - F.col("y")).alias("clean")), "tokens")
    n1, n0 = counts.where(~F.col("token").startswith("~")).agg(
        F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    if not n1 or not n0:
        return ToxicityModel({})
    total, distinct = float(n1 + n0), counts.count()
    both = F.col("toxic") + F.col("clean")
    a1, a0 = F.col("toxic") + PRIOR * both, F.col("clean") + PRIOR * both
    share = lambda seen, n: F.when(seen > 0, seen * F.log(seen * total / (both * n))).otherwise(0.0)
    scored = counts.select(
        "token", (F.log(a1 / (n1 + PRIOR * total - a1)) - F.log(a0 / (n0 + PRIOR * total - a0))).alias("odds"),
        (share(F.col("toxic"), n1) + share(F.col("clean"), n0)).alias("weight"),  # half of the squared z-score
        (a0 / (n0 + PRIOR * total)).alias("p"))
    table = (scored.where(F.col("weight") >= math.log(distinct / CHANCE_TOKENS))
             .toPandas())  # significant tokens of a bounded sample
    model = ToxicityModel(dict(zip(table["token"], table["odds"])))
    known = table[~table["token"].str.startswith("~")]
    model.lam = solve_lambda(np.append(known["odds"].to_numpy() - DRIFT, -DRIFT),
                             np.append(known["p"].to_numpy(), max(1e-9, 1 - known["p"].sum())))

    def measure(batches):
        for batch in batches:
            best = [(len(s), max((x for _, _, x in segments(s)), default=0.0))
                    for s in map(model.scores, batch["text"])]
            yield pd.DataFrame({"y": batch["y"], "n": [n for n, _ in best], "best": [b for _, b in best]})

    clean = sample.mapInPandas(measure, "y int, n long, best double").where("y = 0 and n > 0").agg(
        F.count("*"), F.sum(F.col("n") * F.exp(-model.lam * F.col("best")))).first()
    model.k = clean[0] / clean[1] if clean[0] else 1.0

    def weigh(batches):
        for batch in batches:
            yield pd.DataFrame({"y": batch["y"], "x": [model.excess(t) for t in batch["text"]]})

    seen = sample.mapInPandas(weigh, "y int, x double").toPandas()  # at most 2 * sample_rows pairs
    model.slope, model.bias = fit_logistic(seen["x"].to_numpy(float), seen["y"].to_numpy(float))
    return model


def score_column(model: ToxicityModel, text: Column) -> Column:
    """Probability that a whole text is toxic; null and empty texts get that
    of a text without any significant passage."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.probability(model.excess(t)) for t in texts], dtype=float)

    return score(text)


def toxic_passages(docs: DataFrame, model: ToxicityModel, key_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Every significant passage of every text: the key, ``first_token``,
    ``end_token`` (white-space tokens, end exclusive) and ``excess``."""
    @F.pandas_udf("array<struct<first_token:int,end_token:int,excess:double>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"first_token": a, "end_token": b, "excess": e} for a, b, e in model.passages(t)]
                          for t in texts])

    return docs.select(key_col, F.explode(find(F.col(text_col))).alias("p")).select(key_col, "p.*")
