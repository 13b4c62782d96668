"""Dense surrogate keys (D-09) without an unpartitioned window.

``ROW_NUMBER() OVER (ORDER BY k)`` moves every row into one task.  Here the
rows are range-partitioned and sorted on ``k``; each partition numbers its
rows locally, a tiny per-partition count table (one row per partition, so
its size is bounded by the partition count) gives running offsets, and the
key is ``offset + local index``.  The sorted frame is written as Parquet to
the cluster's checkpoint folder in between, with its partition and position
as columns, so both passes see the same numbering even if an executor is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored


def with_dense_key(df: DataFrame, order_cols: list[str | Column], key: str,
                   num_partitions: int | None = None) -> DataFrame:
    """Append ``key`` = 1..n following ``order_cols`` (the global row number).

    Equals ``row_number() over (order by order_cols)`` when the order
    columns are unique.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    # Without an explicit count the range exchange follows the cluster's
    # spark.sql.shuffle.partitions and AQE may merge adjacent small ranges;
    # the numbering below uses the partition ids the data really lands in.
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    ordered = (ranged
               .sortWithinPartitions(*cols)
               .withColumn("_dk_pid", F.spark_partition_id())
               .withColumn("_dk_pos", F.monotonically_increasing_id()
                           - F.shiftleft(F.col("_dk_pid").cast("long"), 33)))
    ordered = stored(ordered, key)
    counts = ordered.groupBy("_dk_pid").agg(F.count(F.lit(1)).alias("_dk_n"))
    before = Window.orderBy("_dk_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition; written once so consumers never rescan the data
    offsets = counts.select(
        "_dk_pid", F.coalesce(F.sum("_dk_n").over(before), F.lit(0)).alias("_dk_off"))
    offsets = stored(offsets, f"{key}_offsets")
    return (ordered.join(F.broadcast(offsets), "_dk_pid")
            .withColumn(key, (F.col("_dk_off") + F.col("_dk_pos") + 1).cast("long"))
            .drop("_dk_pid", "_dk_pos", "_dk_off"))


def with_calendar_key(df: DataFrame, few: list[str], many: str, key: str, drop: list[str],
                      then: Callable[[DataFrame], DataFrame] = lambda df: df, place: Column | None = None) -> DataFrame:
    """Append ``key`` = 1..n in the order ``few``, ``many`` and drop ``drop``,
    where the ``few`` columns have a bounded set of values (months x stores)
    and are unique together with ``many``, so that a value of ``many`` has a
    bounded number of rows.

    Rows are range-partitioned on ``many`` alone and sorted inside each
    partition; ``then`` runs between (it may add rows, such as the quiet months
    of a run, that so never travel).  Inside a partition the rows of one
    combination of ``few`` lie together, so a row's key is its position plus
    one number per (partition, combination), a broadcast of that bounded size.

    ``place``: a whole number with the order of ``few``, ``many``, which is
    sorted by without comparing column after column.
    """
    # a fixed number of ranges: rows added by ``then`` are not in the sizes that AQE merges by
    ranges = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [place] if place is not None else [*few, many]
    ordered = (then(df.repartitionByRange(ranges, F.col(many))).sortWithinPartitions(*by)
               .withColumn("_dk_pid", F.spark_partition_id())
               .withColumn("_dk_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_dk_pid").cast("long"), 33)))
    ordered = stored(ordered.drop(*[c for c in drop if c not in few]), key)
    groups = ordered.groupBy("_dk_pid", *few).agg(F.count(F.lit(1)).alias("_dk_n"), F.min("_dk_pos").alias("_dk_first"))
    before = Window.orderBy(*few, "_dk_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_dk_n").over(before), F.lit(0)) - F.col("_dk_first")).alias("_dk_shift")
    shifts = stored(groups.select(F.col("_dk_pid").alias("_dk_p"), *[F.col(c).alias(f"_dk_{c}") for c in few], shift), f"{key}_offsets")
    same = F.col("_dk_pid") == F.col("_dk_p")
    for c in few:
        same = same & F.col(c).eqNullSafe(F.col(f"_dk_{c}"))
    return (ordered.join(F.broadcast(shifts), same).withColumn(key, (F.col("_dk_shift") + F.col("_dk_pos") + 1).cast("long"))
            .drop("_dk_pid", "_dk_pos", "_dk_shift", "_dk_p", *[f"_dk_{c}" for c in few], *drop))


MOST_GROUPS = 5_000_000  # (month, few, range) whose first keys are held at once


def with_run_keys(runs: DataFrame, month: str, months: str, few: str, many: str, keys: str, calendar: DataFrame) -> DataFrame | None:
    """Append ``keys``, the list of the dense keys of a run's ``months``
    months: 1..n in the order month, ``few``, ``many`` over all months of all
    runs.  Runs of a (``few``, ``many``) do not overlap.  None where this
    does not hold the bounds below, or a month is not in ``calendar`` (days).

    The months are not unfolded into rows, sorted or written: runs are dealt
    by ranges of ``many`` and read in its order, so a month's key is the first
    key of its (month, ``few``, range), a list of bounded size, plus the
    number of months with the same that were read before it.  ``few`` and
    ``many`` are whole numbers from 0 on, ``few`` has a bounded set of values.
    """
    spark = runs.sparkSession
    index = F.year(month) * 12 + F.month(month)
    whole = all(isinstance(runs.schema[c].dataType, T.IntegralType) for c in (few, many))
    unfit = F.lit(not whole) | (F.dayofmonth(month) != 1) | (F.least(few, many) < 0)
    unfit = F.coalesce(unfit, F.lit(True)) | F.col(few).isNull() | F.col(many).isNull() | F.col(months).isNull()
    runs = runs.where(F.coalesce(F.col(months), F.lit(1)) > 0)
    lo, end, few_end, many_end, odd = runs.agg(F.min(index), F.max(index + F.col(months)), F.max(few) + 1, F.max(many) + 1, F.count_if(unfit)).first()
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if odd or lo is None or (end - lo + 1) * few_end * ranges > MOST_GROUPS:
        return None
    at, part = (index - lo).cast("int"), F.least(F.floor(F.col(many).cast("double") * ranges / many_end), F.lit(ranges - 1)).cast("int")
    ends = F.array(F.struct(at.alias("at"), F.lit(1).alias("n")), F.struct((at + F.col(months)).cast("int").alias("at"), F.lit(-1).alias("n")))
    steps = (runs.select(part.alias("part"), F.col(few).cast("int").alias("few"), F.explode(ends).alias("x"))
             .groupBy("x.at", "few", "part").agg(F.sum("x.n").cast("long").alias("n")).toArrow())  # at most MOST_GROUPS rows
    import numpy as np
    shape = (end - lo + 1, few_end, ranges)
    alive = np.zeros(shape, np.int64)
    alive[tuple(steps[c].to_numpy() for c in ("at", "few", "part"))] = steps["n"].to_numpy()
    alive = alive.cumsum(axis=0)
    known = {r[0] for r in calendar.select(F.col(calendar.columns[0]).alias(month)).where(F.dayofmonth(month) == 1).select(index - lo).distinct().collect()}
    if set(np.flatnonzero(alive.any(axis=(1, 2))).tolist()) - known:
        return None
    flat = alive.ravel()
    first = spark.sparkContext.broadcast((flat.cumsum() - flat + 1).reshape(shape))
    dealt = runs.withColumn("_rk_part", part).withColumn("_rk_at", at).repartitionById(ranges, F.col("_rk_part")).sortWithinPartitions("_rk_part", many)
    out = T.StructType([*runs.schema.fields, T.StructField(keys, T.ArrayType(T.LongType(), False))])
    return dealt.mapInArrow(_number_months(first, months, few, keys), out)


def _number_months(first, months: str, few: str, keys: str):
    def number(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        now, after = None, None
        for batch in batches:
            part, at, length, group = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_rk_part", "_rk_at", months, few)]
            offsets = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])
            out = np.empty(offsets[-1], np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(cuts, cuts[1:]):  # the runs of one range
                if a == b:
                    continue
                if part[a] != now:
                    now, after = part[a], first.value[:, :, part[a]].ravel().copy()
                width, size = first.value.shape[1], length[a:b]
                begin = offsets[a:b] - offsets[a]
                later = np.arange(offsets[b] - offsets[a]) - np.repeat(begin, size)
                cell = (np.repeat(at[a:b], size) + later) * width + np.repeat(group[a:b], size)
                order = np.argsort(cell.astype(np.uint16) if len(after) <= 1 << 16 else cell, kind="stable")
                cells = cell[order]
                starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
                counts = np.diff(np.append(starts, len(cells)))
                found = np.empty(len(cells), np.int64)
                found[order] = after[cells] + np.arange(len(cells)) - np.repeat(starts, counts)
                after[cells[starts]] += counts
                out[offsets[a]:offsets[b]] = found
            kept = [c for c in batch.schema.names if not c.startswith("_rk_")]
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(out))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], names=[*kept, keys])
    return number


def with_small_key(df: DataFrame, order_cols: list[str | Column], key: str, most: int = 10_000) -> DataFrame:
    """Row number for a closed list (order statuses, channels, a store list):
    one task numbers at most ``most`` rows; a longer list is an error, so the
    result may be broadcast."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    place = F.row_number().over(Window.orderBy(*cols)).cast("long")
    numbered = df.limit(most + 1).withColumn(key, place)
    too_long = F.raise_error(F.lit(f"{key}: more than {most} rows in a closed list")).cast("long")
    return numbered.withColumn(key, F.when(F.col(key) > most, too_long).otherwise(F.col(key)))


HOT = 100_000  # rows of a group that one task may number or gather, at most


def split_hot(df: DataFrame, group_cols: list[str], most: int = HOT) -> tuple[DataFrame, DataFrame | None]:
    """(rows of usual groups, rows of hot groups or None).

    A group is hot with more rows than a fourth of a task's even share (not
    below 1,000 rows) or than ``most``.  One count per group is shuffled; the
    list of hot groups is a broadcast of at most four per task or rows /
    ``most``.  NULL groups are a group."""
    sizes = df.groupBy(*[F.col(c).alias(f"_h_{c}") for c in group_cols]).agg(F.count(F.lit(1)).alias("_h_n"))
    rows, largest = sizes.agg(F.coalesce(F.sum("_h_n"), F.lit(0)), F.coalesce(F.max("_h_n"), F.lit(0))).first()
    share = rows // (4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    limit = min(most, max(share, 1_000))
    if largest <= limit:
        return df, None
    hot = F.broadcast(stored(sizes.where(F.col("_h_n") > limit).drop("_h_n"), "hot_groups"))
    same = F.lit(True)
    for c in group_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def with_group_sequence(df: DataFrame, group_cols: list[str], order_cols: list[str | Column],
                        name: str, most: int = HOT) -> DataFrame:
    """1..n inside each group in ``order_cols`` order, skew-safe: usual groups
    by one window, hot ones over many tasks.  Equal rows in the order columns
    are numbered in any order; NULL groups are a group."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    usual, hot = split_hot(df, group_cols, most)
    place = F.row_number().over(Window.partitionBy(*group_cols).orderBy(*cols))
    numbered = usual.withColumn(name, place)
    return numbered if hot is None else numbered.unionByName(_hot_group_sequence(hot, group_cols, cols, name))


def _hot_group_sequence(df: DataFrame, group_cols: list[str], cols: list[Column], name: str) -> DataFrame:
    """The numbering of groups that are too large for a task.

    A window partitioned by the group would put a hot group in one task.
    Instead the rows are range-partitioned on (group, order) and written once
    with their partition number; a window numbers each group inside each
    partition, and the rows that the group has in earlier partitions are added
    from a carry table.  Only a partition's first group can continue from an
    earlier one, so the carry holds at most one row per partition (broadcast).
    """
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # more ranges than tasks: the pieces of a hot group spread evenly over them
    ranged = df.repartitionByRange(4 * shuffles, *[F.col(c) for c in group_cols], *cols)
    ranged = stored(ranged.withColumn("_gs_pid", F.spark_partition_id()), name)
    group = [F.col(c) for c in group_cols]
    sizes = ranged.groupBy("_gs_pid", *group).agg(F.count(F.lit(1)).alias("_gs_n"))
    first = sizes.groupBy("_gs_pid").agg(F.min(F.struct(*group)).alias("g"))
    # ranges are in order, so a partition's last group is its greatest one
    last = sizes.groupBy("_gs_pid").agg(F.max(F.struct(F.struct(*group).alias("g"), "_gs_n")).alias("x")).select("_gs_pid", "x.g", "x._gs_n")
    carry = (last.join(first.select(F.col("_gs_pid").alias("_gs_at"), F.col("g").alias("_gs_g")),
                       F.col("g").eqNullSafe(F.col("_gs_g")) & (F.col("_gs_pid") < F.col("_gs_at")))
             .groupBy("_gs_at", "_gs_g").agg(F.sum("_gs_n").alias("_gs_before")))  # one row per partition on each side
    local = F.row_number().over(Window.partitionBy("_gs_pid", *group).orderBy(*cols))
    numbered = ranged.withColumn("_gs_local", local)
    return (numbered.join(F.broadcast(carry), (F.col("_gs_pid") == F.col("_gs_at")) & F.struct(*group).eqNullSafe(F.col("_gs_g")), "left")
            .withColumn(name, (F.col("_gs_local") + F.coalesce("_gs_before", F.lit(0))).cast("int"))
            .drop("_gs_pid", "_gs_local", "_gs_at", "_gs_g", "_gs_before"))
