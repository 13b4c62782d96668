"""File sources and sinks (S-01..S-11; S-10, publishing, is :func:`..operators.publish.publish_all`).

File listing goes through the Hadoop FileSystem of the session (works for
HDFS, S3A, GCS, local), is metadata only, and never reads data on the
driver.  Reads use explicit schemas (no ``inferSchema`` pass).  Writes are
plain DataFrame writes, partitioned by the caller's columns; row counts are
taken with an ``Observation`` during the write instead of a second scan.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def _fs_glob(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path) or []
    return sorted(str(s.getPath().toString()) for s in found if s.isFile())


def discover(spark: SparkSession, folders: Iterable[str], pattern: str = "*.csv", expected: int | None = 11) -> list[str]:
    """S-01: list source files in several folders, sorted; warn on count."""
    files = sorted(f for d in folders for f in _fs_glob(spark, f"{d.rstrip('/')}/{pattern}"))
    if expected is not None and len(files) != expected:
        log.warning("expected %d source files, found %d", expected, len(files))
    return files


def read_csv(spark: SparkSession, path: str, schema: T.StructType, corrupt_column: str | None = None) -> DataFrame:
    """S-02: header CSV with an explicit schema; malformed rows are kept
    (PERMISSIVE) and their raw text lands in ``corrupt_column`` if given."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def source_registry(spark: SparkSession, mapping: dict[str, str]) -> dict[str, str]:
    """S-03: file -> table map; fail early naming every missing file."""
    missing = [p for p in mapping if not _fs_glob(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing source files: {missing}")
    return dict(mapping)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet") -> int:
    """Write and return the number of rows written (observed during the write)."""
    obs = Observation(f"rows_{abs(hash(path))}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"])


class Loaded(NamedTuple):
    """A loaded table and the rows observed on its source while it was written."""
    table: DataFrame
    rows: int


def load_raw(spark: SparkSession, sources: dict[str, DataFrame], target_dir: str) -> dict[str, Loaded]:
    """S-04: replace each raw table (overwrite) and return the written tables."""
    out = {}
    for name, df in sources.items():
        path = f"{target_dir.rstrip('/')}/{name}"
        rows = write_table(df, path)
        out[name] = Loaded(spark.read.parquet(path), rows)
    return out


def verify_load(loaded: dict[str, Loaded]) -> DataFrame:
    """S-05: (table, source_rows, database_rows, row_count_match); the source
    was counted while it was loaded, so only the written tables are read."""
    parts = [t.table.agg(F.count(F.lit(1)).alias("database_rows"))
             .select(F.lit(name).alias("table_name"), F.lit(t.rows).cast("long").alias("source_rows"), "database_rows",
                     (F.lit(t.rows) == F.col("database_rows")).alias("row_count_match")) for name, t in loaded.items()]
    return reduce(DataFrame.unionByName, parts)


def assert_loaded(report: DataFrame) -> None:
    bad = [r.table_name for r in report.filter(~F.col("row_count_match")).collect()]
    if bad:
        raise RuntimeError(f"row counts differ after load: {bad}")


def load_enterprise(spark: SparkSession, config: dict[str, tuple[str, T.StructType, list[str]]],
                    target_dir: str) -> dict[str, DataFrame]:
    """S-06: read planning CSVs, parse the listed date columns, overwrite."""
    out = {}
    for name, (path, schema, dates) in config.items():
        df = read_csv(spark, path, schema)
        for c in dates:
            df = df.withColumn(c, F.to_date(F.col(c)))
        out[name] = df
    return {name: t.table for name, t in load_raw(spark, out, target_dir).items()}


def read_query(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """S-07: a SQL query over registered views."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def write_outputs(outputs: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> list[tuple[str, int]]:
    """S-08: write result datasets, return (name, rows)."""
    return [(name, write_table(df, f"{out_dir.rstrip('/')}/{name}", fmt=fmt)) for name, df in outputs.items()]


def write_report(df: DataFrame, out_dir: str, name: str) -> int:
    """S-09: small report as one CSV file (reports have a handful of rows)."""
    return write_table(df.coalesce(1), f"{out_dir.rstrip('/')}/{name}", fmt="csv")


def rebuild(spark: SparkSession, order: list[tuple[str, Callable[[], DataFrame]]], out_dir: str) -> list[tuple[str, int]]:
    """S-11: drop-and-create tables in dependency order; (table, rows).

    A table that was finished (its commit marker is there) is not built
    again, so a rebuild that was broken off goes on after the last finished
    table; a new folder starts afresh.
    """
    root = out_dir.rstrip("/")
    done = {p.split("/")[-2] for p in _fs_glob(spark, f"{root}/*/_SUCCESS")}
    out = []
    for name, build in order:
        path = f"{root}/{name}"
        out.append((name, spark.read.parquet(path).count() if name in done else write_table(build(), path)))
    return out


def load_with_quarantine(spark: SparkSession, path: str, schema: T.StructType, required: list[str], good_dir: str, bad_dir: str,
                         header: bool = True) -> DataFrame:
    """S-02: typed rows to ``good_dir``, malformed lines to ``bad_dir`` by reason.

    A line is bad if it has too many or too few fields (``malformed``), a
    field that its type cannot read (``<column> unreadable``) or an empty
    required field (``<column> missing``); the first reason in this order
    counts.  Returns (reason, lines, rows_written, input_lines): the lines
    by reason (``good`` included), the rows read back from the outputs, and
    the lines of the input counted on their own.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields] + [T.StructField("_line", T.StringType(), True)])
    # every field is parsed whichever columns a step reads: a pruned field count would hide malformed lines
    rows = (spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("columnNameOfCorruptRecord", "_line").schema(raw).csv(path))
    typed = {f.name: F.col(f"`{f.name}`") if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    reason = F.when(F.col("_line").isNotNull(), "malformed")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(c.isNotNull() & (F.trim(c) != "") & typed[f.name].isNull(), f"{f.name} unreadable")
    for name in required:
        reason = reason.when(F.col(f"`{name}`").isNull() | (F.trim(f"`{name}`") == ""), f"{name} missing")
    checked = rows.withColumn("_reason", reason)
    write_table(checked.where("_reason IS NULL").select(*[c.alias(n) for n, c in typed.items()]), good_dir)
    fields = F.coalesce("_line", F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields])))
    write_table(checked.where("_reason IS NOT NULL").select(F.col("_reason").alias("reason"), fields.alias("line")), bad_dir, partition_by=["reason"])
    lines = checked.groupBy(F.coalesce("_reason", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("lines"))
    good = spark.read.schema(schema).parquet(good_dir).agg(F.count(F.lit(1)).alias("rows_written")).select(F.lit("good").alias("reason"), "rows_written")
    bad = spark.read.schema("line string, reason string").parquet(bad_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("rows_written"))
    given = spark.read.text(path).where("trim(value) <> ''").agg(F.count(F.lit(1)).alias("input_lines"))
    if header:
        files = spark.read.text(path).select(F.input_file_name()).distinct().count()
        given = given.select((F.col("input_lines") - files).alias("input_lines"))
    return (lines.join(good.unionByName(bad), "reason", "full").crossJoin(F.broadcast(given))  # one-row relation
            .select("reason", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("rows_written", F.lit(0)).alias("rows_written"), "input_lines"))
