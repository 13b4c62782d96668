"""Embedding whitening from bit-sliced cross-products.

Entries become long integers; each dimension is shifted by its least value, so
it needs few bit planes.  Sixty-four rows of a partition share a word: one bit
aggregate per (word, dimension) packs each bit plane of the 64 values into a
long.  For every two dimensions the AND of two planes has as many set bits as
rows that hold both, so the sums of those popcounts, weighted by powers of
two, are the exact cross-products.  They are centred as integers
(n * sum(xy) - sum(x) * sum(y)) before the matrix, whose size depends on the
dimensions alone, is divided by n**2 and decomposed on the driver.  Rows are
projected where they are; the identity check is an aggregate over the
whitened values themselves.  The integers are written once below the
checkpoint folder, so a lost task packs the same rows into the same words.

Nulls and edge cases: vectors that are null, empty, or hold a null, a
non-finite entry or one beyond 2**41 / scale (no exact 38-digit product) are
dropped; rows with a null or repeated vec_id stay, one by one; vectors of
another length are fitted with those of their own length, so n, the
components and identity_error are those of the length; components whose
eigenvalue is not above 1e-12 of the trace (equal rows, fewer rows than
dimensions) have a null ``whitened`` and stay out of the check; a deviation
beyond a long is null; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

LIMIT = 2.0 ** 41


def integers(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """(vec_id, x, dims): floor(scale * c) + shift of every usable vector."""
    v = F.col("embedding")
    usable = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < LIMIT))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("long"))
    return (vectors.where(v.isNotNull()).where(F.coalesce(usable, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), F.size(v).alias("dims")))


def bounds(rows: DataFrame) -> dict[int, list]:
    """dims -> per dimension (n, sum, least, greatest): one row per dimension."""
    cells = rows.select("dims", F.posexplode("x").alias("d", "c"))
    found = cells.groupBy("dims", "d").agg(F.count(F.lit(1)), F.sum(F.col("c").cast("decimal(20,0)")), F.min("c"), F.max("c")).collect()
    out: dict[int, list] = {}
    for dims, _, n, total, low, high in sorted(found):
        out.setdefault(dims, []).append((n, int(total), low, high))
    return out


def planes(rows: DataFrame, low: list[int], depth: int) -> DataFrame:
    """(word, d, w): the bit planes of 64 rows' values in dimension d."""
    place = rows.select("x", F.monotonically_increasing_id().alias("at"))
    least = F.array(*[F.lit(v).cast("long") for v in low])
    cells = place.select(F.shiftright("at", 6).alias("word"), (F.col("at") % 64).cast("int").alias("bit"),
                         F.posexplode(F.zip_with("x", least, lambda c, m: c - m)).alias("d", "c"))
    bit = F.expr
    packed = cells.groupBy("word", "d").agg(*[bit(f"bit_or(shiftleft(shiftright(c, {p}) & 1L, bit))").alias(f"p{p}") for p in range(depth)])
    return packed.select("word", "d", F.array(*[f"p{p}" for p in range(depth)]).alias("w"))


def cross_products(rows: DataFrame, low: list[int], depth: int) -> np.ndarray:
    """Exact sums over the rows of (x_i - low_i) * (x_j - low_j), as Python integers."""
    d = len(low)
    word = planes(rows, low, depth).groupBy("word").agg(F.sort_array(F.collect_list(F.struct("d", "w"))).alias("s"))  # d entries a word
    left = word.select("s", F.explode("s").alias("a")).select(
        F.col("a.d").alias("i"), F.posexplode("a.w").alias("p", "u"), F.expr("slice(s, a.d + 1, size(s))").alias("rest"))
    # one row per (word, dimension pair, left plane); each counts the right dimension's planes
    pairs = left.where("u <> 0").select("i", "p", "u", F.explode("rest").alias("b")).select("i", "p", "u", F.col("b.d").alias("j"), F.col("b.w").alias("w"))
    hits = pairs.groupBy("i", "j", "p").agg(*[F.sum(F.expr(f"bit_count(u & w[{q}])").cast("long")).alias(f"n{q}") for q in range(depth)])
    weighted = sum((F.col(f"n{q}").cast("decimal(38,0)") * F.lit(1 << q).cast("decimal(38,0)") for q in range(1, depth)), F.col("n0").cast("decimal(38,0)"))
    weight = F.element_at(F.array(*[F.lit(str(1 << p)).cast("decimal(38,0)") for p in range(depth)]), F.col("p") + 1)
    cells = hits.groupBy("i", "j").agg(F.sum((weighted * weight).cast("decimal(38,0)")).alias("s")).collect()  # at most d * (d + 1) / 2
    out = np.zeros((d, d), object)
    for i, j, s in cells:
        out[i, j] = out[j, i] = int(s)
    return out


def decompose(products: np.ndarray, totals: list[int], n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling), unit eigenvectors (rows) and trace of the covariance; totals are those of the shifted values."""
    d = len(totals)
    centred = [[n * products[i, j] - totals[i] * totals[j] for j in range(d)] for i in range(d)]
    cov = np.array([[c / n ** 2 for c in row] for row in centred], np.float64)
    values, vectors = np.linalg.eigh(cov)
    return values[::-1], vectors[:, ::-1].T, sum(centred[i][i] for i in range(d)) / n ** 2


def _dot(centred: Column, direction: np.ndarray) -> Column:
    u = F.array(*[F.lit(float(v)) for v in direction])
    return F.aggregate(F.zip_with(centred, u, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def _fit(rows: DataFrame, stats: list, components: int) -> DataFrame:
    n, low = stats[0][0], [s[2] for s in stats]
    depth = max(1, max(s[3] - s[2] for s in stats).bit_length())
    totals = [s[1] - n * s[2] for s in stats]
    values, vectors, trace = decompose(cross_products(rows, low, depth), totals, n)
    count = min(components, len(stats))
    sound = [bool(values[k] > 1e-12 * trace) for k in range(count)]

    means = F.array(*[F.lit(t / n) for t in totals])
    shifted = F.zip_with("x", F.array(*[F.lit(v).cast("long") for v in low]), lambda c, m: (c - m).cast("double"))
    centred = F.zip_with(shifted, means, lambda c, m: c - m)
    whitened = [_dot(F.col("centred"), vectors[k] / np.sqrt(values[k])).alias(f"w{k}") if sound[k] else F.lit(None).cast("double").alias(f"w{k}")
                for k in range(count)]
    projected = rows.select("vec_id", "x", centred.alias("centred")).select("vec_id", "x", *whitened)

    good = [k for k in range(count) if sound[k]]
    error = None
    if good:
        pairs = [(a, b) for a in good for b in good if a <= b]
        got = projected.agg(*[F.avg(f"w{k}").alias(f"m{k}") for k in good],
                            *[F.avg(F.col(f"w{a}") * F.col(f"w{b}")).alias(f"c{a}_{b}") for a, b in pairs]).first()
        error = max(abs(got[f"c{a}_{b}"] - got[f"m{a}"] * got[f"m{b}"] - (a == b)) for a, b in pairs)

    # n*x - S per dimension, squared and summed as decimals
    sums = F.array(*[F.lit(str(s[1])).cast("decimal(38,0)") for s in stats])
    gaps = F.zip_with("x", sums, lambda c, s: F.try_subtract(F.try_multiply(c.cast("decimal(19,0)"), F.lit(str(n)).cast("decimal(19,0)")).cast("decimal(38,0)"), s).cast("decimal(38,0)"))
    squares = F.transform(gaps, lambda g: F.try_multiply(g, g).cast("decimal(38,0)"))
    deviation = F.aggregate(squares, F.lit(0).cast("decimal(38,0)"), lambda a, b: F.try_add(a, b).cast("decimal(38,0)")).try_cast("long")
    entry = F.explode(F.array(*[
        F.struct(F.lit(k + 1).alias("component"), F.col(f"w{k}").alias("whitened"),
                 F.lit(float(values[k] / trace) if trace else None).cast("double").alias("explained")) for k in range(count)])).alias("e")
    return (projected.withColumn("deviation", deviation)
            .select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", entry)
            .select("vec_id", "e.component", "n", "deviation", "e.whitened", "e.explained", F.lit(error).cast("double").alias("identity_error")))


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: one row per usable vector and component."""
    rows = stored(integers(vectors, scale, shift), "whitening_integers")
    out = None
    for dims, stats in bounds(rows).items():
        part = _fit(rows.where(F.col("dims") == dims), stats, components)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out
