"""Publication and validation (V-01..V-10): table inventory, schema
introspection and type mapping, normalisation, publish with counts, and
structure / NULL-pattern / control-total reconciliation of a published copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import round_half_up
from ..sources.files import _fs_glob, write_table

TOLERANCE = 0.01  # fixed value: control totals agree within 0.01


def check_table_inventory(found: list[str], expected: list[str]) -> list[tuple[str, str]]:
    """V-01: (table, status) for expected-and-found, missing, unexpected."""
    f, e = set(found), set(expected)
    return ([(t, "found") for t in sorted(e & f)] + [(t, "missing") for t in sorted(e - f)]
            + [(t, "unexpected") for t in sorted(f - e)])


def describe_schema(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """V-02: one row per column: position, name, type, precision, scale, nullability."""
    rows = []
    for i, f in enumerate(df.schema.fields, start=1):
        p = f.dataType.precision if isinstance(f.dataType, T.DecimalType) else None
        s = f.dataType.scale if isinstance(f.dataType, T.DecimalType) else None
        rows.append((table, i, f.name, f.dataType.simpleString(), p, s, f.nullable))
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, data_type string, "
                                       "numeric_precision int, numeric_scale int, is_nullable boolean")


_SIMPLE = {T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.ByteType: "NUMBER(3,0)", T.ShortType: "NUMBER(5,0)",
           T.IntegerType: "NUMBER(10,0)", T.LongType: "NUMBER(19,0)", T.FloatType: "FLOAT", T.DoubleType: "FLOAT",
           T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP_NTZ", T.TimestampType: "TIMESTAMP_TZ",
           T.BinaryType: "BINARY"}


def map_type(dt: T.DataType) -> str:
    """V-03: target type of a column; decimals clamp to precision <= 38 and
    scale <= precision; unknown types are an error."""
    if isinstance(dt, T.DecimalType):
        p = min(dt.precision, 38)
        return f"NUMBER({p},{min(dt.scale, p)})"
    for k, v in _SIMPLE.items():
        if isinstance(dt, k):
            return v
    if isinstance(dt, (T.MapType, T.StructType, T.ArrayType, T.VariantType)):
        return "VARIANT"
    raise TypeError(f"no target type for {dt.simpleString()}")


def normalize(df: DataFrame) -> DataFrame:
    """V-04: upper-case column names, timestamps/dates coerced (bad values to NULL)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType) and any(k in f.name.lower() for k in ("date", "timestamp")):
            c = F.coalesce(F.try_to_timestamp(c), F.lit(None).cast("timestamp"))
        cols.append(c.alias(f.name.upper()))
    return df.select(*cols)


_SPARK_TYPE = {"VARCHAR": "string", "BOOLEAN": "boolean", "FLOAT": "double", "DATE": "date",
               "TIMESTAMP_NTZ": "timestamp_ntz", "TIMESTAMP_TZ": "timestamp", "BINARY": "binary", "VARIANT": "string"}
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def typed_target(df: DataFrame) -> DataFrame:
    """V-03 + V-04: the normalised frame, each column cast to what its target type holds.

    Whole numbers keep their width, decimals are clamped, nested columns
    become JSON text.
    """
    flat = normalize(df)
    cols = []
    for f in flat.schema.fields:
        target, c = map_type(f.dataType), F.col(f"`{f.name}`")
        if target == "VARIANT":
            c = c.cast("string") if isinstance(f.dataType, T.VariantType) else F.to_json(c)
        elif target.startswith("NUMBER"):
            c = c if isinstance(f.dataType, _EXACT) else c.cast("decimal" + target[len("NUMBER"):])
        else:
            c = c.cast(_SPARK_TYPE[target])
        cols.append(c.alias(f.name))
    return flat.select(*cols)


def _versions(spark: SparkSession, target_dir: str) -> list[int]:
    """Finished manifests of a publication folder, oldest first."""
    done = _fs_glob(spark, f"{target_dir.rstrip('/')}/_manifest/*/_SUCCESS")
    return sorted(int(p.split("/")[-2]) for p in done)


def current(spark: SparkSession, target_dir: str) -> dict[str, str]:
    """table -> path of the copy that readers see (the newest finished manifest)."""
    found = _versions(spark, target_dir)
    if not found:
        return {}
    rows = spark.read.schema("table_name string, path string").json(f"{target_dir.rstrip('/')}/_manifest/{found[-1]}").collect()
    return {r.table_name: r.path for r in rows}  # one row a table


def publish_all(tables: dict[str, DataFrame], target_dir: str, prepare: Callable[[DataFrame], DataFrame] = typed_target,
                parallel: int = 4) -> DataFrame:
    """S-10 / V-05, two phases; (table, source_rows, loaded_rows, target_rows, status).

    First every table is made ready by ``prepare`` (the typed target) and
    written to a path of its own, ``parallel`` at a time.  Three counts must
    agree: the source's rows, observed before ``prepare``; the rows that
    reach the writer; the rows of the written files.  An empty table is
    refused (EMPTY), differing counts FAIL.  Only when all tables PASS does a
    new manifest name the new paths; it is written last, so readers
    (``current``) see the old copies until then and after any failure.
    """
    spark = next(iter(tables.values())).sparkSession
    root, run = target_dir.rstrip("/"), uuid.uuid4().hex[:12]

    def load(item: tuple[str, DataFrame]) -> tuple:
        name, df = item
        path = f"{root}/{name}/{run}"
        source = Observation(f"source_{run}_{name}")
        loaded = write_table(prepare(df.observe(source, F.count(F.lit(1)).alias("rows"))), path)
        target = spark.read.parquet(path).count()
        rows = int(source.get["rows"])
        status = "EMPTY" if rows == 0 else ("PASS" if rows == loaded == target else "FAIL")
        return name, rows, loaded, target, status
    with ThreadPoolExecutor(parallel) as pool:
        report = list(pool.map(load, tables.items()))
    if all(r[-1] == "PASS" for r in report):
        number = max(_versions(spark, root), default=0) + 1
        known = current(spark, root) | {name: f"{root}/{name}/{run}" for name in tables}
        spark.createDataFrame(sorted(known.items()), "table_name string, path string").coalesce(1).write.json(f"{root}/_manifest/{number}")
    return spark.createDataFrame(report, "table_name string, source_rows long, loaded_rows long, target_rows long, "
                                         "status string")


_FAMILY = [((T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType), "number"),
           ((T.FloatType, T.DoubleType), "float"), ((T.StringType,), "text"), ((T.BooleanType,), "boolean"),
           ((T.DateType,), "date"), ((T.TimestampType, T.TimestampNTZType), "timestamp")]


def type_family(dt: T.DataType) -> str:
    for kinds, fam in _FAMILY:
        if isinstance(dt, kinds):
            return fam
    return dt.typeName()


def compare_schemas(a: T.StructType, b: T.StructType) -> tuple[bool, list[str]]:
    """V-06: same columns in the same order and the same type family."""
    issues = []
    if len(a.fields) != len(b.fields):
        issues.append(f"column count {len(a.fields)} != {len(b.fields)}")
    for i, (x, y) in enumerate(zip(a.fields, b.fields), start=1):
        if x.name.lower() != y.name.lower():
            issues.append(f"position {i}: {x.name} != {y.name}")
        elif type_family(x.dataType) != type_family(y.dataType):
            issues.append(f"{x.name}: {type_family(x.dataType)} != {type_family(y.dataType)}")
    return not issues, issues


def null_pattern(df: DataFrame) -> DataFrame:
    """NULL count per column, one aggregate, unpivoted."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).cast("long").alias(f"_n{i}") for i, c in enumerate(df.columns)])
    items = [F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nulls")) for i, c in enumerate(df.columns)]
    return row.select(F.explode(F.array(*items)).alias("x")).select("x.*")


#: reads Parquet through the reader that answers counts from the files' footers
_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_null_pattern(spark: SparkSession, path: str) -> DataFrame:
    """(column_name, nulls) of a written table, counted by its Parquet footers: no data page is read
    (columns whose footers hold no counts are scanned)."""
    before = {k: spark.conf.get(k, None) for k in _FOOTERS}
    try:
        for k, v in _FOOTERS.items():
            spark.conf.set(k, v)
        df = spark.read.parquet(path)
        row = df.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")) for c in df.columns]).first()  # one row
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.createDataFrame([(c, row[0] - n) for c, n in zip(df.columns, row[1:])], "column_name string, nulls long")


def compare_nulls(source: DataFrame, target: DataFrame, table: str) -> DataFrame:
    """V-07: NULL pattern of the source (a frame) vs the published copy (its
    :func:`footer_null_pattern`, or a frame to be scanned) per column."""
    s = null_pattern(source).select(F.lower("column_name").alias("column_name"), F.col("nulls").alias("source_nulls"))
    t = target if target.columns == ["column_name", "nulls"] else null_pattern(target)
    t = t.select(F.lower("column_name").alias("column_name"), F.col("nulls").alias("target_nulls"))
    return (s.join(t, "column_name", "full")
            .select(F.lit(table).alias("table_name"), "column_name", "source_nulls", "target_nulls",
                    F.coalesce(F.col("source_nulls") == F.col("target_nulls"), F.lit(False)).alias("match")))


def control_totals(df: DataFrame, metrics: dict[str, object], table: str) -> DataFrame:
    """V-08: named aggregate metrics of a table as (table, metric, value text)."""
    row = df.agg(*[(F.expr(m) if isinstance(m, str) else m).alias(f"_m{i}") for i, m in enumerate(metrics.values())])
    items = [F.struct(F.lit(n).alias("metric"), F.col(f"_m{i}").cast("string").alias("value"))
             for i, n in enumerate(metrics)]
    return row.select(F.lit(table).alias("table_name"), F.explode(F.array(*items)).alias("x")).select("table_name", "x.*")


def compare_totals(source: DataFrame, target: DataFrame, tol: float = TOLERANCE) -> DataFrame:
    """V-08: numbers equal within ``tol``, dates and text exactly."""
    s = source.withColumnRenamed("value", "source_value")
    t = target.withColumnRenamed("value", "target_value")
    a, b = F.col("source_value").try_cast("decimal(38,6)"), F.col("target_value").try_cast("decimal(38,6)")
    passed = F.when(a.isNotNull() & b.isNotNull(), F.abs(a - b) <= tol).otherwise(
        F.col("source_value").eqNullSafe(F.col("target_value")))
    return s.join(t, ["table_name", "metric"], "full").withColumn("passed", passed)


def verdict(results: DataFrame, flag: str = "passed", label: tuple[str, ...] = ("table_name", "metric")) -> None:
    """V-09: list every failure (a small result) and raise if there is any."""
    bad = [tuple(r[c] for c in label) for r in results.filter(~F.coalesce(F.col(flag), F.lit(False))).collect()]
    if bad:
        raise RuntimeError(f"validation failed: {bad}")


def check_ratio(df: DataFrame, num: str, den: str, ratio: str, scale: int = 2, factor: float = 1.0) -> DataFrame:
    """V-10: a published ratio recomputed from its parts; difference must be 0."""
    recomputed = round_half_up(F.lit(factor) * F.col(num).cast("double") / F.nullif(F.col(den).cast("double"),
                                                                                     F.lit(0.0)), scale)
    return df.select(F.col(ratio).alias("published"), recomputed.alias("recomputed"),
                     round_half_up(F.col(ratio) - recomputed, scale).alias("difference"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
