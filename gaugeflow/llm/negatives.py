"""Hard negatives by exact inner-product search over anchor-clustered shared lists.

Anchors are clustered by direction. For a cluster with centre c whose members
lie within the angle w of it, no member scores more with a candidate x than
``|member| |x| cos(max(0, angle(x, c) - w))``. Each part of the candidates is
sorted once for a cluster by that bound without ``|member|``; every member
walks this shared list from the top and stops as soon as the bound of what is
left can change nothing it still looks for. The first walk finds each anchor's
best rows of its label (positives), the second the best rows of other labels
whose score lies in each positive's range. Scores are integers, compared
exactly; bounds carry an allowance for rounding.

Anchors meet all candidates in blocks: one task holds some clusters and one
part of the candidates, and gives back at most k rows for each thing sought.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import shared_table

#: Components are multiplied by this before they are rounded down.
SCALE = 256
#: Anchors that the clustering is fitted on at most, anchors of a cluster about, and most clusters.
FIT_ROWS, CLUSTER_ROWS, CLUSTERS = 20_000, 64, 1024
#: Candidates of a part and anchors of a group, about; list entries read at a time.
PART_ROWS, GROUP_ROWS, STEP = 8_192, 8_192, 256
#: Allowance for rounding in bounds, as a part of the product of the lengths.
SLACK = 1e-9
#: Integers up to here are exact as doubles.
EXACT = 2 ** 53


def usable(rows: DataFrame, key_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows with a label and a vector of finite numbers: a row number, ``id``,
    ``label`` as a string and ``v``, the vector's integers."""
    v = F.col(vector_col)
    whole = F.transform(v, lambda x: F.when(F.abs(SCALE * x.cast("double")) < EXACT, F.floor(SCALE * x.cast("double")))
                        .otherwise(F.raise_error(F.lit("a component is too large for an integer score"))))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where(F.col(label_col).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("row"), F.col(key_col).cast("long").alias("id"),
                    F.col(label_col).cast("string").alias("label"), whole.alias("v")))


def unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a zero vector has direction zero."""
    lengths = np.sqrt((v * v).sum(axis=1))
    return v / np.where(lengths > 0, lengths, 1)[:, None], lengths


def centres(vectors: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from evenly spread rows."""
    x, _ = unit(vectors)
    c = x[np.linspace(0, len(x) - 1, clusters).astype(int)]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        moved, lengths = unit(sums)
        c = np.where(lengths[:, None] > 0, moved, c)
    return c


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows, as 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T  # raises where a score leaves 64 bits
    return exact.astype(np.int64)


class SharedList:
    """One part of the candidates, sorted for one cluster of anchors."""

    def __init__(self, candidates: dict, centre: np.ndarray, width: float):
        x, lengths = unit(candidates["v"].astype(float))
        angle = np.arccos(np.clip(x @ centre, -1, 1))
        bound = lengths * (np.cos(np.maximum(0, angle - width)) + SLACK)
        bound[lengths == 0] = 0
        order = np.argsort(-bound, kind="stable")
        self.bound = bound[order]
        self.rows = {k: x[order] for k, x in candidates.items()}

    def walk(self, anchors: np.ndarray, seekers: list) -> int:
        """Lead every anchor down the list until its seeker is certain of its
        result; the number of scores worked out."""
        n, spent = len(self.bound), 0
        _, lengths = unit(anchors.astype(float))
        active = np.arange(len(anchors))
        for at in range(0, n, STEP):
            to = min(at + STEP, n)
            active = np.array([i for i in active.tolist() if not seekers[i].certain(lengths[i] * self.bound[at])], int)
            if not len(active):
                break
            scores = products(anchors[active], self.rows["v"][at:to])
            spent += scores.size
            part = {k: x[at:to] for k, x in self.rows.items() if k != "v"}
            for i, found in zip(active.tolist(), scores):
                seekers[i].take(found, part)
        return spent


class Best:
    """The k best rows of one kind whose score lies in [low, high]."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.held: list[tuple] = []  # (-score, order of id, row)

    def certain(self, bound: float) -> bool:
        bound += abs(bound) * SLACK
        return (self.low is not None and bound < self.low
                or len(self.held) == self.k and bound < -self.held[-1][0])

    def take(self, scores, order, rows) -> None:
        keep = np.ones(len(scores), bool)
        if self.low is not None:
            keep &= (scores >= self.low) & (scores <= self.high)
        if len(self.held) == self.k:
            keep &= scores >= -self.held[-1][0]
        at = np.flatnonzero(keep)
        if len(at):
            new = zip((-scores[at]).tolist(), order[at].tolist(), rows[at].tolist())
            self.held = sorted([*self.held, *new])[:self.k]


class Positives:
    """Seeks the best other rows of an anchor's label."""

    def __init__(self, row: int, label: int, k: int):
        self.row, self.label, self.best = row, label, Best(k)

    def certain(self, bound: float) -> bool:
        return self.best.certain(bound)

    def take(self, scores, part) -> None:
        at = np.flatnonzero((part["label"] == self.label) & (part["row"] != self.row))
        self.best.take(scores[at], part["order"][at], part["row"][at])


class Negatives:
    """Seeks the best rows of other labels within each positive's range."""

    def __init__(self, label: int, ranges: list[tuple[int, int]], k: int):
        self.label, self.best = label, [Best(k, low, high) for low, high in ranges]

    def certain(self, bound: float) -> bool:
        return all(b.certain(bound) for b in self.best)

    def take(self, scores, part) -> None:
        at = np.flatnonzero(part["label"] != self.label)
        for b in self.best:
            b.take(scores[at], part["order"][at], part["row"][at])


def candidate_part(t: pa.Table, dim: int) -> dict:
    """Columns of a part: ``order`` puts smaller ids first and null ids last,
    labels are numbered as in ``names``."""
    ids = t.column("id").combine_chunks()
    rank = np.zeros(len(ids), np.int64)
    keys = np.asarray(ids.fill_null(0)), np.asarray(ids.is_null())
    rank[np.lexsort((np.asarray(t.column("row")), *keys))] = np.arange(len(ids))
    labels = t.column("label").combine_chunks().dictionary_encode()
    return {"v": np.asarray(t.column("v").combine_chunks().flatten(), np.int64).reshape(len(ids), dim),
            "row": np.asarray(t.column("row")), "order": rank, "label": np.asarray(labels.indices),
            "names": {x: i for i, x in enumerate(labels.dictionary.to_pylist())}}


def walk_lists(anchors: DataFrame, candidates: DataFrame, seeker, gives, schema: str, rows: int) -> DataFrame:
    """Cogroups of (dimension, group of clusters, part of candidates): shared
    lists are built and walked, and what the seekers hold is given back."""
    group = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    left = anchors.select("*", group)
    right = candidates.select("*", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("in_group"))

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(asked) and len(held):
            dim = asked.column("dim")[0].as_py()
            part, mine = candidate_part(held, dim), asked.to_pylist()
            names = part.pop("names")
            vectors = np.array([a["v"] for a in mine], np.int64).reshape(len(mine), dim)
            x, lengths = unit(vectors.astype(float))
            for cluster in sorted({a["cluster"] for a in mine}):
                at = np.array([i for i, a in enumerate(mine) if a["cluster"] == cluster])
                centre, _ = unit(x[at].sum(axis=0)[None])
                turned = np.arccos(np.clip(x[at][lengths[at] > 0] @ centre[0], -1, 1))
                shared = SharedList(part, centre[0], float(turned.max(initial=0)) + SLACK)
                seekers = [seeker(mine[i], names.get(mine[i]["label"], -1)) for i in at.tolist()]
                shared.walk(vectors[at], seekers)
                for i, s in zip(at.tolist(), seekers):
                    out += gives(mine[i], s)
        columns = list(zip(*out)) or [[]] * rows
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in schema.split(", ")])

    return (left.groupBy("dim", "group", "part").cogroup(right.groupBy("dim", F.col("in_group"), "part"))
            .applyInArrow(run, schema))


def cluster_anchors(anchors: DataFrame) -> DataFrame:
    """Anchors with ``cluster``: that of the nearest centre of their dimension,
    large clusters dealt over parts. At most ``FIT_ROWS`` anchors reach the
    driver for the fit; the others only find their nearest centre."""
    n = anchors.count()
    sample = anchors.orderBy(F.xxhash64("row")).limit(FIT_ROWS).select("v", "dim").toArrow().to_pylist()
    found = {}
    for dim in {s["dim"] for s in sample}:
        vectors = np.array([s["v"] for s in sample if s["dim"] == dim], float).reshape(-1, dim) if dim else np.zeros((1, 0))
        wanted = max(1, min(CLUSTERS, -(-n // CLUSTER_ROWS), len(vectors)))
        found[dim] = centres(vectors, wanted)

    @F.pandas_udf("int")
    def nearest(vs):
        return vs.map(lambda v: int(np.argmax(found[len(v)] @ np.asarray(v, float))) if len(v) in found and len(v) else 0)

    clusters = max((len(c) for c in found.values()), default=1)
    groups = max(1, -(-n // GROUP_ROWS))
    most = max(1, -(-n // (clusters * CLUSTER_ROWS)))  # tasks that share a cluster, were they all of one size
    cluster = (nearest("v") * F.lit(most) + F.pmod(F.xxhash64("row"), F.lit(most))).cast("int")
    return anchors.withColumn("cluster", cluster).withColumn("groups", F.lit(groups)).withColumn(
        "group", (F.col("cluster") % groups).cast("int"))


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         key_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``): for every row that satisfies
    ``is_anchor`` (over ``id``) and each of its best ``positives`` other rows
    of its label, the best ``negatives`` rows of other labels whose score is
    ``low`` to ``high`` hundredths of the positive's. Scores are inner products
    of floor(256 x); higher first, ties by smaller id.

    Rows with a null label or vector, or a null or non-finite component, take
    no part; vectors of different lengths do not meet; zero vectors score zero;
    a component of 2**53 / 256 or more raises.
    A null id is no anchor and comes last among ties. Repeated rows are each a
    row of their own, also as anchors. An empty table gives an empty result;
    other columns are not read.
    """
    table = shared_table(usable(rows, key_col, vector_col, label_col).withColumn("dim", F.size("v")), "vectors")
    n = table.count()
    parts = max(1, -(-n // PART_ROWS))
    anchors = shared_table(cluster_anchors(table.where(is_anchor)).withColumn("parts", F.lit(parts)), "anchors")
    groups = (anchors.select("groups").first() or [1])[0]
    candidates = table.withColumn("groups", F.lit(groups)).withColumn(
        "part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))

    # `order` holds within a part only, so ids come back by a join on the row before parts are merged
    ids = table.select("row", "id")
    near = walk_lists(
        anchors, candidates, lambda a, label: Positives(a["row"], label, positives),
        lambda a, s: [(a["row"], row, -score) for score, _, row in s.best.held],
        "anchor long, row long, score long", 3)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    pairs = shared_table(near.join(ids, "row").withColumn("at", F.row_number().over(first)).where(F.col("at") <= positives)
                         .select("anchor", "at", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                         "positives")
    # 30 p <= 100 s <= 90 p in integers; a negative p has no such s
    ranges = pairs.where("positive_score >= 0").groupBy(F.col("anchor").alias("row")).agg(  # at most `positives` of an anchor
        F.sort_array(F.collect_list(F.struct("at", "positive_score"))).alias("seeks"))

    def seek(a: dict, label: int) -> Negatives:
        return Negatives(label, [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100)
                                      for p in a["seeks"]], negatives)

    far = walk_lists(
        anchors.join(ranges, "row"), candidates, seek,
        lambda a, s: [(a["row"], p["at"], row, -score) for p, b in zip(a["seeks"], s.best) for score, _, row in b.held],
        "anchor long, at long, row long, score long", 4)
    order = Window.partitionBy("anchor", "at").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    best = (far.join(ids, "row").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor", "at", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (best.join(pairs, ["anchor", "at"]).join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
