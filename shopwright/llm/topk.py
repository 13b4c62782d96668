"""Exact top-k inner-product search: ball trees per shard, branch and bound.

A bounded sample of the vectors serves as pivots; every vector joins the cell
of its nearest pivot, and a cell beyond ``shard_rows`` is split by a hash of the
id, so shards hold near vectors and none grows with a hot vector.  A task
streams one shard: its vectors first, of which it builds a ball tree once, then
the queries, one batch at a time.  A batch goes down the tree together, every
query first to the leaf that its bounds  <q, centre> + |q| * radius  lead to,
then all to the nodes whose bound reaches their k-th score; a leaf is scored by
one matrix product.  A first round searches each query in the shard that it
lies in; the k-th score found there is shared with the second round, which
sends a query only to the cells whose ball (pivot, largest distance) can hold
an equal or higher score.  Candidates are copied once for each ``block_rows``
queries.

Nulls and edge cases: vectors that are null or hold null or non-finite
components, and rows with a null id, take no part; vectors whose length
differs from the query's are no candidates; repeated ids are searched as
they come (rows of the query's own id are skipped); ties go to the smaller
id; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

LEAF, HITS = 512, 8192


def build(x: np.ndarray, rows: np.ndarray) -> tuple:
    """(centre, radius, rows in order or None, children)."""
    centre = x[rows].mean(0)
    radius = float(np.sqrt(((x[rows] - centre) ** 2).sum(1).max()))
    if len(rows) <= LEAF or radius == 0:
        return centre, radius, np.sort(rows), ()
    far = x[rows[((x[rows] - centre) ** 2).sum(1).argmax()]]
    other = x[rows[((x[rows] - far) ** 2).sum(1).argmax()]]
    side = x[rows] @ (other - far)
    cut = np.argsort(side, kind="stable")
    half = len(rows) // 2
    return centre, radius, None, (build(x, rows[cut[:half]]), build(x, rows[cut[half:]]))


class Search:
    """The best ``k`` of a tree's vectors ``x``, in the order of their ``ids``,
    for a batch of queries ``q``; only scores from a query's ``floor`` on.

    The queries go down the tree together; at a node those stay whose bound
    reaches their k-th score so far, and a leaf is one matrix product.
    """

    def __init__(self, x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray):
        self.x, self.ids, self.q, self.own, self.k = x, ids, q, own, k
        self.norm = np.sqrt((q * q).sum(1))
        self.least = floor.astype(np.float64)
        self.last = np.full(len(q), np.iinfo(np.int64).max)  # a score that equals ``least`` counts below this id
        self.home: dict[int, np.ndarray] = {}
        self.best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))  # query, score, id
        self.new, self.n_new = [], 0

    def bound(self, node: tuple, at: np.ndarray) -> np.ndarray:
        return self.q[at] @ node[0] + self.norm[at] * node[1]

    def first(self, node: tuple, at: np.ndarray) -> None:
        """Each query in the leaf that its bounds lead to."""
        if not len(at):
            return
        if node[2] is None:
            left = self.bound(node[3][0], at) >= self.bound(node[3][1], at)
            self.first(node[3][0], at[left])
            self.first(node[3][1], at[~left])
            return
        self.home[id(node)] = at
        self.leaf(node, at)

    def rest(self, node: tuple, at: np.ndarray) -> None:
        b = self.bound(node, at)
        at = at[b + 1e-6 * (1 + np.abs(b)) >= self.least[at]]
        if not len(at):
            return
        if node[2] is None:
            for child in sorted(node[3], key=lambda c: -float(self.bound(c, at).mean())):
                self.rest(child, at)
            return
        self.leaf(node, np.setdiff1d(at, self.home.get(id(node), at[:0]), assume_unique=True))

    def leaf(self, node: tuple, at: np.ndarray) -> None:
        for k in range(0, len(node[2]), LEAF):
            rows = node[2][k:k + LEAF]
            scores, ids = self.q[at] @ self.x[rows].T, self.ids[rows]
            least = self.least[at][:, None]
            i, j = np.nonzero(scores >= least)
            s, who, found = scores[i, j], at[i], ids[j]
            good = (found != self.own[who]) & ((s > self.least[who]) | (found < self.last[who]))
            if good.any():
                self.new.append((who[good], s[good], found[good]))
                self.n_new += int(good.sum())
                if self.n_new >= HITS:
                    self.keep()

    def keep(self) -> None:
        who, s, found = (np.concatenate(c) for c in zip(self.best, *self.new))
        order = np.lexsort((found, -s, who))
        who, s, found = who[order], s[order], found[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        good = place < self.k
        self.best = who[good], s[good], found[good]
        full = place == self.k - 1
        self.least[who[full]], self.last[who[full]] = s[full], found[full]
        self.new, self.n_new = [], 0

    def run(self, tree: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's number, id, score)."""
        every = np.arange(len(self.q))
        self.first(tree, every)
        self.keep()
        self.rest(tree, every)
        self.keep()
        return self.best[0], self.best[2], self.best[1]


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    v = F.col("embedding")
    good = F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.where(F.coalesce(good, F.lit(False)))
            .select(F.col("vec_id").cast("long"), F.transform(v, lambda c: F.floor(c.cast("double") * scale)).alias("v"), F.size(v).alias("dims")))


def located(base: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """base with the number of the nearest pivot of the same length and the distance to it."""
    def run(batches):
        for df in batches:
            df["cell"], df["far"] = 0, 0.0
            for d, part in df.groupby("dims"):
                x, p = np.array(part["v"].tolist(), np.float64).reshape(len(part), -1), pivots.get(d)
                if p is None or d == 0:
                    continue
                square = (x * x).sum(1)[:, None] - 2 * (x @ p.T) + (p * p).sum(1)
                df.loc[part.index, "cell"] = square.argmin(1)
                df.loc[part.index, "far"] = np.sqrt(np.maximum(square.min(1), 0))
            yield df
    return base.mapInPandas(run, "vec_id long, v array<long>, dims int, cell int, far double")


def streamed(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): each query's best in the shard it was sent to.

    Both sides carry (shard, block); a shard's candidates come before its queries.
    """
    def run(batches):
        at, ids, vectors, tree, x = None, [], [], None, None
        for df in batches:
            out = [np.zeros((0, 3), np.int64)]
            for (shard, block, kind), part in df.groupby(["shard", "block", "kind"], sort=False):
                if (shard, block) != at:
                    at, ids, vectors, tree = (shard, block), [], [], None
                rows = np.array(part["v"].tolist(), np.float64).reshape(len(part), -1)
                if kind == 0:
                    ids.append(part["vec_id"].to_numpy())
                    vectors.append(rows)
                    continue
                if tree is None and ids:
                    own = np.concatenate(ids)
                    order = np.argsort(own, kind="stable")
                    x = np.concatenate(vectors)[order]
                    tree, ids, vectors = build(x, np.arange(len(x))), [own[order]], []
                if tree is not None:
                    asked = part["vec_id"].to_numpy()
                    who, found, scores = Search(x, ids[0], rows, asked, k, part["floor"].to_numpy()).run(tree)
                    out.append(np.stack([asked[who], found, scores.astype(np.int64)], 1))
            yield pd.DataFrame(np.concatenate(out), columns=["query_id", "vec_id", "score"])
    both = (candidates.select("shard", "block", F.lit(0).alias("kind"), "vec_id", "v", F.lit(0).cast("long").alias("floor"))
            .unionByName(queries.select("shard", "block", F.lit(1).alias("kind"), "vec_id", "v", "floor")))
    return (both.repartition("shard", "block").sortWithinPartitions("shard", "block", "kind")
            .mapInPandas(run, "query_id long, vec_id long, score long"))


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, shard_rows: int = 20_000, block_rows: int = 200_000,
          max_pivots: int = 1_000) -> DataFrame:
    """query_id, rank, vec_id, score of the rows whose id is divisible by ``every`` against all other rows.

    Scores are exact while they stay below 2**53.
    """
    spark = vectors.sparkSession
    common.prepare(spark)
    base = common.cut(quantised(vectors, scale))
    n = base.count()
    lowest = -(1 << 62)
    wanted = min(max_pivots, max(1, math.ceil(n / shard_rows)))
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()  # at most max_pivots rows
    pivots: dict[int, np.ndarray] = {}
    for r in sample:
        pivots.setdefault(r["dims"], []).append(r["v"])
    pivots = {d: np.array(p, np.float64).reshape(len(p), -1) for d, p in pivots.items()}
    cells = common.cut(located(base, pivots))
    # at most one row a pivot and a row a further length
    found = cells.groupBy("dims", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).orderBy("dims", "cell").collect()
    parts = [math.ceil(r["n"] / shard_rows) for r in found]
    first = np.cumsum([0, *parts]).tolist()
    places = spark.createDataFrame([(r["dims"], r["cell"], at, m) for r, at, m in zip(found, first, parts)], "dims int, cell int, start int, parts int")
    shard = (F.col("start") + F.pmod(F.xxhash64("vec_id", F.lit(11)), F.col("parts"))).cast("int")
    blocks = max(1, math.ceil(n / every / block_rows))
    placed = cells.join(F.broadcast(places), ["dims", "cell"]).select("vec_id", "v", "dims", shard.alias("shard"))
    candidates = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = (placed.where(F.pmod("vec_id", F.lit(every)) == 0)
               .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).cast("int")))
    home = common.cut(streamed(queries.withColumn("floor", F.lit(lowest).cast("long")), candidates, k))
    kth = home.groupBy("query_id").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("kth"))

    def elsewhere(batches):
        for df in batches:
            out = []
            for d, part in df.groupby("dims"):
                q = np.array(part["v"].tolist(), np.float64).reshape(len(part), -1)
                norm = np.sqrt((q * q).sum(1))
                for r, at, m in zip(found, first, parts):
                    if r["dims"] != d:
                        continue
                    if d in pivots:
                        bound = q @ pivots[d][r["cell"]] + norm * r["far"]
                        hit = bound + 1e-6 * (1 + np.abs(bound)) >= part["floor"].to_numpy()
                    else:
                        hit = np.ones(len(part), bool)
                    for s in range(at, at + m):
                        out.append(part[hit & (part["shard"].to_numpy() != s)].assign(shard=s))
            yield pd.concat(out) if out else df.iloc[:0]
    floor = F.when(F.col("found") >= k, F.col("kth")).otherwise(lowest).cast("long")
    far = (queries.join(kth, queries["vec_id"] == kth["query_id"], "left").select("vec_id", "v", "dims", "shard", "block", floor.alias("floor"))
           .mapInPandas(elsewhere, "vec_id long, v array<long>, dims int, shard int, block int, floor long"))
    every_hit = home.unionByName(streamed(far, candidates, k)) if first[-1] > 1 else home
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (every_hit.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
