"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is filed in the leaf that
it reaches by the nearest centre at each level. A query visits leaves best bin
first: a priority queue over tree nodes by the distance to their centre. How
many leaves are enough is calibrated: for some queries the true neighbours are
found by brute force against all rows, and visits widen until the wanted part
of them lies in visited leaves. Visited leaves are searched exactly. Leaves and
their visitors are dealt over parts of bounded size, so a leaf that holds a
third of all rows is many tasks' work.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import shared_table

#: Vectors that the tree is fitted on at most, children of a node, sample vectors below which a node is a leaf.
SAMPLE_ROWS, BRANCH, LEAF_ROWS = 20_000, 12, 64
#: Queries that calibrate the visits, and the part of their true neighbours to be reached.
CALIBRATION_ROWS, RECALL = 200, 0.97
#: Vectors and queries of one leaf that one group holds at most, about.
PART_ROWS, PART_QUERIES = 4_096, 512


@dataclass
class Node:
    centers: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


@dataclass
class Tree:
    root: Node
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node.leaf >= 0:
                out[rows] = node.leaf
                continue
            nearest = squared(x[rows], node.centers).argmin(axis=1)
            todo += [(child, rows[nearest == i]) for i, child in enumerate(node.children) if (nearest == i).any()]
        return out

    def best_bins(self, q: np.ndarray):
        """Leaves in the order of a best-bin-first traversal."""
        heap, n = [(0.0, 0, self.root)], 1
        while heap:
            _, _, node = heapq.heappop(heap)
            if node.leaf >= 0:
                yield node.leaf
                continue
            for d, child in zip(squared(q[None], node.centers)[0].tolist(), node.children):
                heapq.heappush(heap, (d, n, child))
                n += 1


@dataclass
class Forest:
    """A tree for every vector length of the sample; leaves are numbered
    through. Vectors of another length lie in one leaf of their length, whose
    number is negative."""

    trees: dict[int, tuple[Tree, int]]

    @classmethod
    def fit(cls, vectors) -> Forest:
        trees, first = {}, 0
        for dim in sorted({len(v) for v in vectors}):
            tree = fit_tree(matrix([v for v in vectors if len(v) == dim]))
            trees[dim] = tree, first
            first += tree.leaves
        return cls(trees)

    def leaf_of(self, vectors) -> np.ndarray:
        out = -np.array([len(v) for v in vectors], np.int64)
        for dim, (tree, first) in self.trees.items():
            at = np.flatnonzero(out == -dim)
            if len(at):
                out[at] = tree.leaf_of(matrix([vectors[i] for i in at])) + first
        return out

    def best_bins(self, q: np.ndarray):
        tree, first = self.trees.get(len(q), (None, 0))
        return (first + leaf for leaf in tree.best_bins(q)) if tree else iter([-len(q)])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def fit_tree(x: np.ndarray, branch: int = BRANCH, leaf_rows: int = LEAF_ROWS, rounds: int = 8, seed: int = 5) -> Tree:
    """Lloyd's k-means at every node until a node has few or only equal rows."""
    rng, count = np.random.default_rng(seed), 0

    def grow(rows: np.ndarray) -> Node:
        nonlocal count
        distinct = np.unique(x[rows], axis=0) if len(rows) > leaf_rows else x[:0]
        if len(rows) <= leaf_rows or len(distinct) < 2:
            count += 1
            return Node(leaf=count - 1)
        k = min(branch, len(distinct))
        centers = distinct[rng.choice(len(distinct), k, replace=False)]
        for _ in range(rounds):
            near = squared(x[rows], centers).argmin(axis=1)
            centers = np.stack([x[rows[near == i]].mean(axis=0) if (near == i).any() else centers[i] for i in range(k)])
        near = squared(x[rows], centers).argmin(axis=1)
        used = [i for i in range(k) if (near == i).any()]
        if len(used) < 2:
            count += 1
            return Node(leaf=count - 1)
        return Node(centers[used], [grow(rows[near == i]) for i in used])

    root = grow(np.arange(len(x)))
    return Tree(root, count)


#: Stands for a null id where rows are put in order: null ids come last.
LAST = 2 ** 63 - 1


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(``row``, ``vec_id``, ``key``, ``vec``) of the rows that take part: a
    vector of finite components, not all zero. Rows are told apart by a number
    of their own, so ids may repeat or be null."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = rows.where((F.size("vec") > 0) & ~F.exists("vec", bad) & F.exists("vec", lambda v: v != 0))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.coalesce("vec_id", F.lit(LAST)).alias("key"), "vec")


def matrix(vecs) -> np.ndarray:
    return np.stack([np.asarray(v, float) for v in vecs]) if len(vecs) else np.zeros((0, 0))


FOUND = "query long, row long, key long, score double"


def nearest(asking: pd.DataFrame, held: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of ``held`` to each row asking, itself left out:
    exact Euclidean distances in double precision, ties to the smaller id.
    Rows of another vector length are no neighbours."""
    none = np.zeros(0, np.int64)
    parts = [pd.DataFrame({"query": none, "row": none, "key": none, "score": np.zeros(0)})]
    dims = held["vec"].map(len)
    for dim, some in asking.groupby(asking["vec"].map(len)):
        here = held[dims == dim]
        x, rows, keys = matrix(here["vec"]), here["row"].to_numpy(), here["key"].to_numpy()
        for own, vec in zip(some["row"], some["vec"]):
            if not len(x):
                break
            d = np.sqrt(((x - np.asarray(vec, float)) ** 2).sum(axis=1))
            d[rows == own] = np.inf
            best = np.argpartition(d, k)[:k + 1] if len(d) > k + 1 else np.arange(len(d))
            at = np.flatnonzero(d <= d[best].max()) if len(d) > k + 1 else best
            at = at[np.lexsort((rows[at], keys[at], d[at]))][:k]
            at = at[np.isfinite(d[at])]
            parts.append(pd.DataFrame({"query": own, "row": rows[at], "key": keys[at], "score": d[at]}))
    return pd.concat(parts)


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("score", "key", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def true_neighbours(members: DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Brute force of a bounded set of queries against all members; also the
    leaf of each neighbour."""
    def run(batches):
        for batch in batches:
            if len(batch):
                yield nearest(queries, batch, k).merge(batch[["row", "leaf"]], on="row")

    return top(members.mapInPandas(run, FOUND + ", leaf long"), k).toPandas()


def calibrated_visits(forest: Forest, queries: pd.DataFrame, truth: pd.DataFrame, recall: float) -> int:
    """The least number of leaf visits, best bin first, at which the wanted
    part of the true neighbours lies in visited leaves."""
    place = []
    leaves = truth.groupby("query")["leaf"].apply(list).to_dict()
    for own, vec in zip(queries["row"], queries["vec"]):
        wanted = leaves.get(own, [])
        order = {leaf: n for n, leaf in enumerate(forest.best_bins(np.asarray(vec, float)), 1)}
        place += [order[leaf] for leaf in wanted]
    if not place:
        return 1
    return int(np.sort(place)[min(len(place) - 1, int(np.ceil(recall * len(place))) - 1)])


def neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
               recall: float = RECALL, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for every row that
    satisfies ``is_query`` (over ``vec_id``) its k nearest other rows found,
    nearest first, ties to the smaller id; all of them where there are fewer.

    Vectors that are null, zero or hold a null or non-finite component are
    neither queries nor candidates. Repeated ids and rows are each a row of
    their own, also as queries; null ids are candidates and come last among
    ties; vectors of different lengths are no neighbours. An empty table, or
    one usable row, gives an empty result; other columns are not read.
    """
    rows = shared_table(usable(vectors, id_col, vec_col), "vectors")
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(sample_rows).toPandas()
    forest = Forest.fit(sample["vec"].tolist())

    def file(batches):
        for batch in batches:
            if len(batch):
                yield batch.assign(leaf=forest.leaf_of(batch["vec"].tolist()))

    members = shared_table(rows.select("row", "key", "vec").mapInPandas(file, "row long, key long, vec array<double>, leaf long"),
                           "members")
    queries = rows.where(is_query & F.col("vec_id").isNotNull()).select("row", "vec")
    some = queries.orderBy(F.xxhash64("row", F.lit(1)), "row").limit(CALIBRATION_ROWS).toPandas()
    visits = calibrated_visits(forest, some, true_neighbours(members, some, k), recall) if len(some) else 1
    held = {r[0]: r[1] for r in members.groupBy("leaf").count().collect()}  # one row for each leaf

    def visit(batches):
        for batch in batches:
            out = []
            for own, vec in zip(batch["row"], batch["vec"]):
                seen = reached = 0
                for leaf in forest.best_bins(np.asarray(vec, float)):
                    if seen >= visits and reached > k:
                        break
                    seen += 1
                    reached += held.get(leaf, 0)
                    if leaf in held:
                        out.append((own, vec, leaf))
            yield pd.DataFrame(out, columns=["row", "vec", "leaf"])

    visiting = shared_table(queries.mapInPandas(visit, "row long, vec array<double>, leaf long"), "visits")
    asked = {r[0]: r[1] for r in visiting.groupBy("leaf").count().collect()}
    sizes = members.sparkSession.createDataFrame(
        [(leaf, -(-n // PART_ROWS), -(-asked.get(leaf, 0) // PART_QUERIES)) for leaf, n in held.items()],
        "leaf long, parts int, q_parts int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (members.join(F.broadcast(sizes.where("q_parts > 0")), "leaf")  # one row for each leaf
            .withColumn("part", F.pmod(F.xxhash64("row"), "parts").cast("int"))
            .select("leaf", "part", upto("q_parts").alias("q_part"), "row", "key", "vec"))
    right = (visiting.join(F.broadcast(sizes), "leaf")
             .withColumn("q_part", F.pmod(F.xxhash64("row"), "q_parts").cast("int"))
             .select("leaf", upto("parts").alias("part"), "q_part", "row", "vec"))
    keys = ["leaf", "part", "q_part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda held, asking: nearest(asking, held, k), FOUND)
    ids = rows.select("row", "vec_id")
    best = top(found, k).join(ids, "row").drop("row", "key")
    return (best.join(ids.withColumnRenamed("vec_id", "query_id"), F.col("query") == F.col("row"))
            .select("query_id", "rank", "vec_id", "score"))
