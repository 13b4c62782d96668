"""Exact continuous percentiles from counted values.

``percentile(x, p)`` keeps a value -> count map per group and merges it in
one task, so a group holding a third of the rows (or a global median over a
whole table) lands in one task's memory.  Here equal values are counted first
(a partial aggregate: a value that fills 95 % of a group is one row after the
map side).  The distinct (group, metric, value) rows are range-partitioned, so
a group of many distinct values spans many partitions, and written once with
their partition number below the checkpoint folder.  One sum per (partition,
group), carried over the group's partitions, says in which partition each
wanted rank ``(n - 1) * p`` lies; only those (partition, group) blocks are read
again, and a running sum inside the block finds the value.

The interpolation is the one of Spark's ``percentile`` (and of DuckDB's
``quantile_cont``): ``(hi - h) * v_lo + (h - lo) * v_hi`` with ``h = (n-1) p``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def exact_percentiles(df: DataFrame, group_cols: list[str], values: dict[str, Column | str],
                      probs: tuple[float, ...], bounded_groups: bool = False) -> DataFrame:
    """Rows ``(group_cols..., metric, q0, .., q{k-1})``, one per group and
    value column with at least one non-NULL value.

    ``bounded_groups``: the (group, metric) set is a fixed small domain (the
    columns of a profile, one describe row), so the rank lookups are
    broadcast instead of shuffled against the sorted values.
    """
    keys = [*group_cols, "metric"]
    cells = F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"),
                 (F.col(c) if isinstance(c, str) else c).cast("double").alias("_v"))
        for name, c in values.items()])).alias("_c")
    stacked = df.select(*group_cols, cells).select(*group_cols, "_c.metric", "_c._v")
    return cell_percentiles(stacked, keys, probs, bounded_groups)


def cell_percentiles(cells: DataFrame, keys: list[str], probs: tuple[float, ...],
                     bounded_groups: bool = False) -> DataFrame:
    """``(keys..., q0, ..)`` over a long frame of ``(keys..., _v double)``
    cells (NULL values ignored, NULL keys are a group); several tables'
    columns can be stacked into one frame so a single sort serves them all."""
    counted = counted_values(cells, keys)
    block = Window.partitionBy(*keys)
    carried = F.coalesce(F.sum("_rows").over(block.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = (counted.groupBy("_pid", *keys).agg(F.sum("_c").alias("_rows"))  # one row per partition and group in it
              .withColumn("_before", carried).withColumn("_n", F.sum("_rows").over(block)))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("_n") - 1).cast("double") * F.lit(float(p))).alias("h"))
                                 for i, p in enumerate(probs)]))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("hi"), F.floor("_p.h").alias("at")), F.struct(F.lit(1).alias("hi"), F.ceil("_p.h").alias("at"))))
    ranks = (blocks.withColumn("_p", wanted).withColumn("_r", ends)
             .where((F.col("_r.at") >= F.col("_before")) & (F.col("_r.at") < F.col("_before") + F.col("_rows")))
             .select(*[F.col(k).alias(f"_g_{k}") for k in keys], F.col("_pid").alias("_block"), "_before", F.col("_p.i").alias("_i"),
                     F.col("_p.h").alias("_h"), F.col("_r.hi").alias("_hi"), F.col("_r.at").alias("_at")))
    if bounded_groups:
        ranks = F.broadcast(ranks)
    on = F.col("_pid") == F.col("_block")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    # a window holds the rows of one group in one partition
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_i", "_hi").orderBy("_v")) + F.col("_before")
    found = (counted.join(ranks, on).withColumn("_upto", upto)
             .where((F.col("_at") < F.col("_upto")) & (F.col("_at") >= F.col("_upto") - F.col("_c"))))

    lo, hi = F.floor("_h"), F.ceil("_h")
    v_lo = F.max(F.when(F.col("_hi") == 0, F.col("_v")))
    v_hi = F.max(F.when(F.col("_hi") == 1, F.col("_v")))
    per_prob = (found.groupBy(*keys, "_i", "_h")
                .agg(v_lo.alias("_lo"), v_hi.alias("_hv"))
                .select(*keys, "_i", F.when((lo == hi) | (F.col("_lo") == F.col("_hv")), F.col("_lo"))
                        .otherwise((hi - F.col("_h")) * F.col("_lo") + (F.col("_h") - lo) * F.col("_hv"))
                        .alias("_q")))
    return per_prob.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(f"q{i}")
                                          for i in range(len(probs))])


def counted_values(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., _v, _c, _pid): distinct values with their counts, range-partitioned and written once."""
    counts = cells.where(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    return stored(counts.repartitionByRange(*keys, "_v").withColumn("_pid", F.spark_partition_id()), "counted_values")


def exact_medians(df: DataFrame, group_cols: list[str], values: dict[str, Column | str],
                  bounded_groups: bool = False) -> DataFrame:
    """``(group_cols..., <name>...)``: the exact median of each value column
    per group (NULL when a group has no value in that column; a group with
    no value at all is absent)."""
    q = exact_percentiles(df, group_cols, values, (0.5,), bounded_groups)
    return q.groupBy(*group_cols).agg(*[F.max(F.when(F.col("metric") == n, F.col("q0"))).alias(n)
                                        for n in values])


def join_on_groups(left: DataFrame, right: DataFrame, group_cols: list[str]) -> DataFrame:
    """Left join on the group columns with NULL-safe equality (a NULL group
    is a group of its own, as in GROUP BY)."""
    if not group_cols:
        return left.crossJoin(F.broadcast(right))  # both sides are one row
    r = right.select(*[F.col(c).alias(f"_g_{c}") for c in group_cols],
                     *[c for c in right.columns if c not in group_cols])
    cond = None
    for c in group_cols:
        e = left[c].eqNullSafe(r[f"_g_{c}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left").drop(*[f"_g_{c}" for c in group_cols])
