"""Column-expression helpers shared by all operators (F-01..F-11).

All helpers return ``Column`` objects, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """NULLIF(TRIM(c), '') for text columns."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def to_ts(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Blank-safe timestamp (NTZ) cast: ``try_cast(nullif(trim(c), ''))``.

    ANSI casts raise on ``''``; already-typed timestamps pass through.
    """
    if isinstance(dtype, (T.TimestampNTZType,)):
        return col(c)
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return col(c).cast("timestamp_ntz")
    return blank_to_null(col(c).cast("string")).try_cast("timestamp_ntz")


def to_date(c: str | Column, dtype: T.DataType | None = None) -> Column:
    if isinstance(dtype, T.DateType):
        return col(c)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return col(c).cast("date")
    return blank_to_null(col(c).cast("string")).try_cast("date")


def to_int(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """Float -> int with half-even rounding (what a float8 -> integer cast does)."""
    if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
        return col(c).cast("int")
    if isinstance(dtype, T.StringType):
        return F.bround(blank_to_null(col(c)).try_cast("double")).cast("int")
    return F.bround(col(c).cast("double")).cast("int")


def money(c: str | Column, precision: int = 12, scale: int = 2) -> Column:
    """ROUND(x::numeric, 2)::numeric(p, 2).

    The double goes through decimal(20,6) first so the half-up rounding
    acts on the decimal value, not on the binary fraction.
    """
    return F.round(col(c).cast("decimal(20,6)"), scale).cast(f"decimal({precision},{scale})")


def zip5(c: str | Column) -> Column:
    """LPAD(zip::text, 5, '0'): restores leading zeros lost by numeric loads."""
    return F.lpad(col(c).cast("string"), 5, "0")


def date_key(c: str | Column) -> Column:
    """TO_CHAR(ts, 'YYYYMMDD')::integer, NULL when the date is NULL."""
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def pct(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """ROUND(100.0 * num / NULLIF(den, 0), scale) as double.

    Division is done in double; rounding goes through a decimal so that
    half-up acts on the printed value.
    """
    q = F.lit(100.0) * col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))
    return round_half_up(q, scale)


def ratio(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    q = col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))
    return round_half_up(q, scale)


def round_half_up(c: str | Column, scale: int = 2) -> Column:
    """ROUND(x, n) half away from zero, returned as double."""
    return F.round(col(c).cast("decimal(38,10)"), scale).cast("double")


def as_double(c: str | Column) -> Column:
    return col(c).cast("double")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """EXTRACT(EPOCH FROM end - start) with microsecond precision."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)).cast("double") / F.lit(1e6)


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = 6371.0088) -> Column:
    """Great-circle distance (M-01) as a native expression."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dphi = p2 - p1
    dlmb = F.radians(col(lon2)) - F.radians(col(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def unfold_months(runs: DataFrame) -> DataFrame:
    """One row per month of each inventory run: the run's row, then ``months``
    - 1 months that open and close with its closing stock and move nothing."""
    changed = months_later()
    unfolded = runs.where("months > 0").withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("months") - 1)))
    return unfolded.select(*[changed[c].alias(c) if c in changed else c for c in runs.columns if c != "months"])


def months_later() -> dict[str, Column]:
    """The columns of a run that differ ``_i`` months after its first."""
    later = F.col("_i") > 0
    return {"snapshot_month": F.add_months("snapshot_month", F.col("_i")),
            "opening_stock_qty": F.when(later, F.col("closing_stock_qty")).otherwise(F.col("opening_stock_qty")),
            **{c: F.when(later, F.lit(0)).otherwise(F.col(c)) for c in ("received_qty", "sold_qty", "stockout_days")}}


def quiet_spans(runs: DataFrame) -> DataFrame:
    """:func:`unfold_months` with the quiet months of a run, which are alike
    but for their date, kept in one row: ``months`` is the number of months
    that a row stands for, ``snapshot_month`` the first and ``last_month`` the last."""
    later = F.col("_i") > 0
    changed = {**months_later(), "months": F.when(later, F.col("months") - 1).otherwise(F.lit(1))}
    both = F.when(F.col("months") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spans = runs.where("months > 0").withColumn("_i", F.explode(both))
    last = F.when(later, F.add_months("snapshot_month", F.col("months") - 1)).otherwise(F.col("snapshot_month"))
    return spans.select(*[changed[c].alias(c) if c in changed else c for c in runs.columns], last.alias("last_month"))
