"""Profiling (P-01..P-08), generic over any named DataFrames.

Exact distinct counts and duplicate rows never shuffle values: every cell (or
row) is reduced to a 128-bit key where it is read, and one narrow aggregate
counts the keys of all datasets.  A third hash beside each key shows whether
two different values ever shared one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import pct, ratio, round_half_up
from ..functions.quantiles import cell_percentiles

DATE_KEYWORDS = ("date", "timestamp", "time")  # fixed values
ID_PATTERN = r"(_id|key)$"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def dataset_inventory(datasets: dict[str, DataFrame]) -> DataFrame:
    """P-01: rows and columns per dataset, largest first."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows",
                                                             F.lit(len(df.columns)).alias("columns"))
             for name, df in datasets.items()]
    return _union(parts).orderBy(F.desc("rows"), "dataset")


def _plain(c: Column, dt: T.DataType) -> Column:
    """The column as it is hashed: equal values hash alike (a map has no hash, its sorted entries do)."""
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, F.lit(0.0).cast(dt)).otherwise(c)  # -0.0 equals 0.0
    if isinstance(dt, T.MapType):
        return F.sort_array(F.map_entries(c))
    return c


def _key(cols: list[Column]) -> list[Column]:
    """A 128-bit key of some values, and an independent check of it."""
    return [F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit("second"), *cols).alias("k2"), F.hash(*cols).alias("check")]


def cell_keys(datasets: dict[str, DataFrame]) -> DataFrame:
    """(dataset, at, filled, k1, k2, n, shared): one row per distinct value of
    the at-th column of a dataset, counted; ``shared`` is true where two
    values met under one key."""
    parts = []
    for name, df in datasets.items():
        cells = [F.struct(F.lit(i).alias("at"), c.isNotNull().alias("filled"), *_key([_plain(c, f.dataType)]))
                 for i, f in enumerate(df.schema.fields) for c in [F.col(f"`{f.name}`")]]
        parts.append(df.select(F.lit(name).alias("dataset"), F.explode(F.array(*cells)).alias("x")).select("dataset", "x.*"))
    return (_union(parts).groupBy("dataset", "at", "filled", "k1", "k2")
            .agg(F.count(F.lit(1)).alias("n"), (F.min("check") != F.max("check")).alias("shared")))


def column_profile(datasets: dict[str, DataFrame]) -> DataFrame:
    """P-02: dtype, non-null, null, null %, distinct, distinct % (2 dp, 0 when empty).

    One scan per dataset and one shuffle of keys for all; a key that two
    values share counts as two."""
    filled = F.col("filled")
    found = (cell_keys(datasets).groupBy("dataset", "at")
             .agg(F.sum("n").alias("_rows"), F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("non_null_count"),
                  F.coalesce(F.sum(F.when(filled, 1 + F.col("shared").cast("int"))), F.lit(0)).cast("long").alias("unique_count")))
    spark = found.sparkSession
    names = spark.createDataFrame([(d, i, f.name, f.dataType.simpleString()) for d, df in datasets.items() for i, f in enumerate(df.schema.fields)],
                                  "dataset string, at int, column string, dtype string")
    out = (names.join(F.broadcast(found), ["dataset", "at"], "left")  # one row a column
           .fillna(0, ["_rows", "non_null_count", "unique_count"]).withColumn("null_count", F.col("_rows") - F.col("non_null_count")))
    zero_safe = lambda n: F.coalesce(pct(n, F.col("_rows")), F.lit(0.0))
    return out.select("dataset", "column", "dtype", "non_null_count", "null_count",
                      zero_safe(F.col("null_count")).alias("null_pct"), "unique_count",
                      zero_safe(F.col("unique_count")).alias("unique_pct"), "_rows")


def missing_summary(profile: DataFrame) -> DataFrame:
    """P-03: columns with NULLs, highest share first."""
    return (profile.filter(F.col("null_count") > 0)
            .select("dataset", "column", "null_count", "null_pct")
            .orderBy(F.desc("null_pct"), "dataset", "column"))


def row_keys(df: DataFrame) -> list[Column]:
    """The 128-bit key of a whole row (NULLs are equal)."""
    return _key([_plain(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])[:2]


def duplicate_rows(df: DataFrame, keys: Callable[[DataFrame], list[Column]] = row_keys) -> DataFrame:
    """One row (rows, exact_duplicate_rows) of a dataset.

    Keys are counted first, a narrow shuffle.  Only rows whose key occurs
    more than once are read again and compared as a whole, combined
    map-side, so a row repeated a billion times sends one row per task and
    different rows under one key are told apart.
    """
    names = [f"_k{i}" for i in range(len(keys(df)))]
    marked = df.select("*", *[k.alias(n) for k, n in zip(keys(df), names)])
    groups = marked.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    rows = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"))
    again = marked.join(groups.where("_n > 1").select(*names), names, "left_semi")
    whole = again.groupBy(*names, *[_plain(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]).agg(F.count(F.lit(1)).alias("_c"))
    copies = whole.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("exact_duplicate_rows"))
    return rows.crossJoin(copies)  # two one-row relations


def duplicate_summary(datasets: dict[str, DataFrame]) -> DataFrame:
    """P-04: exact duplicate rows beyond the first copy (NULLs are equal, like ``duplicated()``)."""
    out = _union([duplicate_rows(df).select(F.lit(name).alias("dataset"), "rows", "exact_duplicate_rows") for name, df in datasets.items()])
    return (out.withColumn("duplicate_pct", F.coalesce(pct("exact_duplicate_rows", "rows", 4), F.lit(0.0)))
            .orderBy(F.desc("exact_duplicate_rows"), "dataset"))


def candidate_keys(profile: DataFrame) -> DataFrame:
    """P-05: columns with no NULLs whose distinct count equals the row count."""
    return (profile.filter((F.col("null_count") == 0) & (F.col("unique_count") == F.col("_rows")))
            .select("dataset", F.col("column").alias("candidate_key")))


def id_columns(profile: DataFrame, pattern: str = ID_PATTERN) -> DataFrame:
    """P-06: identifier columns (by name): rows, distinct values, NULLs."""
    return (profile.filter(F.col("column").rlike(pattern))
            .select("dataset", "column", F.col("_rows").alias("rows"), F.col("unique_count").alias("unique_values"),
                    "null_count"))


def date_columns(datasets: dict[str, DataFrame]) -> DataFrame:
    """P-07: date-like columns by name: type, days with a value, first and
    last day; one aggregate per dataset that has any."""
    parts = []
    for name, df in datasets.items():
        found = [f for f in df.schema.fields if is_date_like(f.name)]
        if not found:
            continue
        day = {f.name: F.col(f"`{f.name}`").try_cast("date") if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`").cast("date") for f in found}
        row = df.agg(*[a for i, c in enumerate(day.values()) for a in (F.count(c).alias(f"n{i}"), F.min(c).alias(f"a{i}"), F.max(c).alias(f"z{i}"))])
        cells = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("source_dtype"), F.col(f"n{i}").alias("dated_rows"),
                          F.col(f"a{i}").alias("first_day"), F.col(f"z{i}").alias("last_day")) for i, f in enumerate(found)]
        parts.append(row.select(F.lit(name).alias("dataset"), F.explode(F.array(*cells)).alias("x")).select("dataset", "x.*"))
    return _union(parts)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_profile(datasets: dict[str, DataFrame], exact_median: bool = True) -> DataFrame:
    """P-08: count, min, max, mean, median, sample std, zeros, negatives.

    The other statistics are one partial aggregate per table.  Exact
    medians: every table's numeric cells are stacked into one long
    (dataset, column, value) frame and served by a single global sort
    (:mod:`quantiles`), so no column's values are buffered in one task.
    ``exact_median=False`` uses a bounded sketch per column instead.
    """
    parts, cells = [], []
    for name, df in datasets.items():
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]
        if not cols:
            continue
        aggs = []
        for i, c in enumerate(cols):
            x = F.col(f"`{c}`").cast("double")
            med = F.lit(None).cast("double") if exact_median else F.percentile_approx(x, 0.5, 10000)
            aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
                     ratio(F.sum(x), F.count(x), 6).alias(f"mean{i}"), round_half_up(med, 6).alias(f"med{i}"),
                     round_half_up(F.stddev_samp(x), 6).alias(f"sd{i}"),
                     F.count_if(x == 0).cast("long").alias(f"z{i}"), F.count_if(x < 0).cast("long").alias(f"neg{i}")]
        row = df.agg(*aggs)
        items = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"mn{i}").alias("min"),
                          F.col(f"mx{i}").alias("max"), F.col(f"mean{i}").alias("mean"),
                          F.col(f"med{i}").alias("median"), F.col(f"sd{i}").alias("std"),
                          F.col(f"z{i}").alias("zero_count"), F.col(f"neg{i}").alias("negative_count"))
                 for i, c in enumerate(cols)]
        parts.append(row.select(F.lit(name).alias("dataset"), F.explode(F.array(*items)).alias("x"))
                     .select("dataset", "x.*"))
        cells.append(df.select(F.lit(name).alias("dataset"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("_v")) for c in cols]))
            .alias("_c")).select("dataset", "_c.column", "_c._v"))
    stats = _union(parts)
    if not exact_median or not cells:
        return stats
    # one row per (dataset, column): a fixed domain, so the rank lookups broadcast
    med = cell_percentiles(_union(cells), ["dataset", "column"], (0.5,), bounded_groups=True)
    return (stats.drop("median")
            .join(F.broadcast(med.select("dataset", "column", round_half_up("q0", 6).alias("median"))),
                  ["dataset", "column"], "left")
            .select(*stats.columns))


def is_date_like(name: str) -> bool:
    return any(k in name.lower() for k in DATE_KEYWORDS)
