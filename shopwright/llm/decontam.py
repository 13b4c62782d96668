"""Benchmark decontamination by spaced seeds.

A document is contaminated by an item when a window of ``WINDOW`` tokens of the
item stands in it with at most ``MAX_SUBST`` substituted tokens; items shorter
than the window must occur whole, without substitutions.

The seed is a fixed mask over ``SPAN`` token positions that ignores some of
them, so a substituted token at an ignored position does not break the hit.
Each way to substitute two of thirteen tokens leaves some placement of the mask
intact.  Masked hashes of benchmark items and documents are equality-joined;
every window that contains the hit is compared position by position.  Items
shorter than the mask are joined by a hash of the whole item, one more key at
each document position for each such length that the benchmark holds.

Tokens are runs of letters and digits of the lower-cased text.  The hashes of
the benchmark are broadcast by Spark only when their measured size is below
the session's threshold; beyond it the same join shuffles.

Nulls and edge cases: null or token-less texts have no windows and are
clean, and items without tokens report nothing; repeated rows and items each
report once; null ids are left out; an empty benchmark leaves every document clean;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: positions that the seed compares
SEED = (0, 1, 3, 6, 7)
SPAN, WINDOW, MAX_SUBST = 8, 13, 2
LEFT = WINDOW - SPAN  # tokens of a window that may stand before its seed


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _at(words: str, pos: str, k: int) -> Column:
    return F.get(F.col(words), F.col(pos) + k)


def hits(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(doc_id, item_id): verified overlaps, once each."""
    item = (bench.where("item_id is not null").select("item_id", tokens(F.col("text")).alias("iw"))
            .select("item_id", "iw", F.posexplode("iw").alias("ip", "_t")).drop("_t"))
    doc = (docs.where("doc_id is not null").select("doc_id", tokens(F.col("text")).alias("dw"))
           .select("doc_id", "dw", F.posexplode("dw").alias("dp", "_t")).drop("_t"))

    short = sorted(r[0] for r in bench.where("item_id is not null").select(F.size(tokens(F.col("text"))).alias("n"))
                   .where(F.col("n").between(1, SPAN - 1)).distinct().collect())  # at most SPAN - 1 rows

    def key(words: str, pos: str, at: tuple, kind: int) -> Column:
        return F.xxhash64(*[_at(words, pos, k) for k in at], F.lit(kind))

    def around(words: str, pos: str, name: str) -> tuple[Column, Column]:
        """The tokens from LEFT before the position on, and how many of them stand before it."""
        lead = F.least(F.col(pos), F.lit(LEFT))
        return F.slice(words, F.col(pos) - lead + 1, lead + WINDOW).alias(name), lead.alias(name + "_lead")

    n = F.size("iw")
    whole = F.when(n >= SPAN, key("iw", "ip", SEED, 0))
    for k in short:
        whole = whole.when(n == k, key("iw", "ip", tuple(range(k)), k))
    b = (item.where((n >= WINDOW) & (n >= F.col("ip") + SPAN) | (F.col("ip") == 0))
         .select(whole.alias("h"), "item_id", n.alias("n"), *around("iw", "ip", "need")))
    left = F.size("dw") - F.col("dp")
    if short:  # an item shorter than the seed fits where the seed does not
        keys = [F.when(left >= SPAN, key("dw", "dp", SEED, 0))] + [F.when(left >= k, key("dw", "dp", tuple(range(k)), k)) for k in short]
        doc = doc.select("doc_id", "dw", "dp", F.explode(F.array(*keys)).alias("h")).where("h is not null")
    else:
        doc = doc.where(left >= SPAN).withColumn("h", key("dw", "dp", SEED, 0))
    d = doc.select("h", "doc_id", *around("dw", "dp", "have"))

    def unlike(k: Column) -> Column:
        x, y = F.get("need", F.col("need_lead") + k), F.get("have", F.col("have_lead") + k)
        return F.when(x.isNull() | y.isNull(), WINDOW).otherwise((x != y).cast("int"))  # no window leaves a text

    subst = F.transform(F.sequence(F.lit(-LEFT), F.lit(WINDOW - 1)), unlike)
    slides = F.exists(F.array(subst), lambda m: F.exists(
        F.sequence(F.lit(1), F.lit(LEFT + 1)), lambda t: F.aggregate(F.slice(m, t, WINDOW), F.lit(0), lambda a, x: a + x) <= MAX_SUBST))
    same = F.slice("have", F.col("have_lead") + 1, F.col("n")) == F.col("need")
    return d.join(b, "h").where(F.when(F.col("n") >= WINDOW, slides).otherwise(same)).select("doc_id", "item_id").distinct()


def flags(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items): one row per distinct doc_id."""
    found = hits(docs, bench).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return (docs.where("doc_id is not null").select("doc_id").distinct().join(found, "doc_id", "left")
            .select("doc_id", F.col("n").isNotNull().alias("contaminated"), F.coalesce("n", F.lit(0)).cast("long").alias("n_items")))
