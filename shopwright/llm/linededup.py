"""Line dedup by site-relative frequency.

Per host, the distinct page texts that contain a line are divided by the
host's distinct page texts (copies of one page count once on both sides, so a
group of copies does not make its own lines boilerplate); a line above the
ratio (and on at least ``min_pages`` texts) is boilerplate and is dropped from
that host's pages.  Fewer than (mean lines of a page / ratio) lines of a host
can exceed the ratio, so the host's list is bounded however many pages it has.
Texts and lines are counted by their SHA-256, so neither is shuffled to be
counted.  Counting is a partial aggregate on (host, line), so a hot host or
line is combined before the shuffle; the pages are joined with the short
lists, which AQE broadcasts when their measured size allows and otherwise
joins with skew splitting (no aggregate follows that join).

Nulls and edge cases: a null text stays null; a null host is a host of its
own; lines are compared as they stand after trimming, empty lines are kept;
null texts of a host count as one page; a line repeated on one page counts
once; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines(text):
    return F.split(text, "\n")


def _key(text):
    return F.unhex(F.sha2(text, 256))


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = 0.1, min_pages: int = 5) -> DataFrame:
    """(h, drop_lines): per host the keys of its boilerplate lines."""
    found = F.array_distinct(F.transform(F.filter(F.transform(lines(F.col("text")), F.trim), lambda x: x != ""), _key))
    texts = docs.select(F.col(host).alias("h"), _key(F.col("text")).alias("page"), found.alias("lines")).distinct()
    pages = texts.groupBy("h").agg(F.count(F.lit(1)).alias("pages"))
    seen = (texts.select("h", F.explode("lines").alias("line"))
            .groupBy("h", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages))
    return (seen.join(pages.withColumnRenamed("h", "h2"), F.col("h").eqNullSafe(F.col("h2")))
            .where(F.col("n") > F.lit(ratio) * F.col("pages"))
            .groupBy("h").agg(F.collect_list("line").alias("drop_lines")))


def clean(docs: DataFrame, host: str = "source", ratio: float = 0.1, min_pages: int = 5) -> DataFrame:
    """The documents with boilerplate lines dropped, and n_lines, n_dropped."""
    docs = docs.drop("n_lines", "n_dropped")
    fresh = [next(f"{x}{k or ''}" for k in range(len(docs.columns) + 1) if f"{x}{k or ''}" not in docs.columns) for x in ("h", "drop_lines", "all", "kept")]
    on, drops, all_lines, kept = fresh
    lists = boilerplate(docs, host, ratio, min_pages).toDF(on, drops)
    left = F.filter(F.col(all_lines), lambda x: ~F.coalesce(F.array_contains(drops, _key(F.trim(x))), F.lit(False)))
    out = (docs.join(lists, F.col(host).eqNullSafe(F.col(on)), "left")
           .withColumn(all_lines, lines(F.col("text"))).withColumn(kept, left))

    def size(name: str):
        return F.coalesce(F.size(name), F.lit(0))
    return out.select(*[F.array_join(kept, "\n").alias(c) if c == "text" else F.col(c) for c in docs.columns],
                      size(all_lines).cast("long").alias("n_lines"), (size(all_lines) - size(kept)).cast("long").alias("n_dropped"))
