"""Source audit (A-01..A-05) and constraints as checks (C-01..C-03).

The audit functions return DataFrames; the ``assert_*`` functions run one
small job each and raise ``ConstraintViolation`` on failure.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import pct
from ..session import stored


class ConstraintViolation(AssertionError):
    pass


def foreign_key_check(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                      relationship: str) -> DataFrame:
    """A-01: non-null child values absent from the parent."""
    return relationship_audit([(relationship, child, child_col, parent, parent_col)])


def relationship_audit(specs: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """A-02: A-01 over a list of (name, child, col, parent, col), each distinct frame scanned once."""
    tables, names = {}, {}
    for _, child, _, parent, _ in specs:
        for df in (child, parent):
            names.setdefault(id(df), f"t{len(names)}")
            tables[names[id(df)]] = df
    refs = [Reference(n, names[id(c)], (cc,), names[id(p)], (pc,)) for n, c, cc, p, pc in specs]
    found = reference_counts(tables, refs)
    return found.select(F.col("name").alias("relationship"), "child_rows", "unmatched_rows",
                        F.coalesce(pct("unmatched_rows", "child_rows", 4), F.lit(0.0)).alias("unmatched_pct"))


def composite_key_test(df: DataFrame, columns: list[str], dataset: str) -> DataFrame:
    """A-03: rows repeating an earlier key."""
    g = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("duplicate_keys")).select(
        F.lit(dataset).alias("dataset"), F.lit(" + ".join(columns)).alias("columns"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.coalesce("duplicate_keys", F.lit(0)).cast("long").alias("duplicate_keys"),
        (F.coalesce("duplicate_keys", F.lit(0)) == 0).alias("is_unique"))


def customer_identity(customers: DataFrame) -> DataFrame:
    """A-04: ids per person, persons with several ids, the maximum."""
    per = customers.groupBy("customer_unique_id").agg(F.countDistinct("customer_id").alias("n"))
    totals = customers.agg(F.count(F.lit(1)).alias("customer_rows"),
                           F.countDistinct("customer_id").alias("unique_customer_ids"))
    persons = per.agg(F.count(F.lit(1)).alias("unique_real_customers"),
                      F.count_if(F.col("n") > 1).cast("long").alias("repeat_customer_count"),
                      F.max("n").alias("max_customer_ids_for_one_person"))
    return totals.crossJoin(persons)


def order_multiplicity(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """A-05: (metric, value) rows."""
    ni = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    np_ = payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    o = orders.agg(F.countDistinct("order_id").cast("long").alias("orders"))
    i = ni.agg(F.count_if(F.col("n") > 1).cast("long").alias("orders_with_multiple_items"),
               F.max("n").cast("long").alias("max_items_in_single_order"))
    p = np_.agg(F.count_if(F.col("n") > 1).cast("long").alias("orders_with_multiple_payments"),
                F.max("n").cast("long").alias("max_payment_records_single_order"))
    wide = o.crossJoin(i).crossJoin(p)
    names = ["orders", "orders_with_multiple_items", "max_items_in_single_order",
             "orders_with_multiple_payments", "max_payment_records_single_order"]
    return wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"))
                                             for n in names])).alias("x")).select("x.*")


# ------------------------------------------------------------------ one-pass constraint engine

class Reference(NamedTuple):
    """A foreign key: non-null ``columns`` of ``table`` must occur in ``parent_columns`` of ``parent``."""
    name: str
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


class Unique(NamedTuple):
    """A primary key or unique constraint; a NULL part is a violation."""
    name: str
    table: str
    columns: tuple[str, ...]


def _key_spaces(uniques: list[Unique], refs: list[Reference]) -> dict[tuple, int]:
    """(table, columns) that are unique or referenced -> number."""
    spaces: dict[tuple, int] = {}
    for t, cols in [(u.table, u.columns) for u in uniques] + [(r.parent, r.parent_columns) for r in refs]:
        spaces.setdefault((t, tuple(cols)), len(spaces))
    return spaces


def _key_holders(uniques: list[Unique], refs: list[Reference]) -> list[tuple[str, tuple[str, ...], int, int]]:
    """(table, columns, key space, slot) of every owner of a key space (slot -1) and every reference into one."""
    spaces = _key_spaces(uniques, refs)
    return ([(t, cols, space, -1) for (t, cols), space in spaces.items()]
            + [(r.table, tuple(r.columns), spaces[r.parent, tuple(r.parent_columns)], slot) for r, slot in zip(refs, reference_slots(refs))])


def _exploded(tables: dict[str, DataFrame], cells: list[tuple[str, Column]]) -> DataFrame:
    """The cells of all tables as rows; each table is scanned once."""
    emitted: dict[str, list[Column]] = {}
    for t, c in cells:
        emitted.setdefault(t, []).append(c)
    return reduce(DataFrame.unionByName, [tables[t].select(F.explode(F.array(*cs)).alias("x")).select("x.*") for t, cs in emitted.items()])


def _null_key(cols: tuple[str, ...]) -> Column:
    return reduce(lambda x, y: x | y, [F.col(c).isNull() for c in cols])


def key_groups(tables: dict[str, DataFrame], uniques: list[Unique], refs: list[Reference], suspects: DataFrame | None = None) -> DataFrame:
    """(space, k1, k2, null_key, owners, c0, c1, ...): one row per key value of a key space.

    A key space is a (table, columns) that is unique or referenced.  Each
    table is scanned once and emits a row per key space it owns and per
    reference it holds; key values travel as 128-bit hashes.  All rows meet in
    one aggregate on (space, key), combined map-side, so a hot key or a widely
    referenced parent is never gathered.  ``owners`` counts the owner's rows,
    ``cJ`` the rows of the J-th reference into that space (references with a
    NULL part hold).  With ``suspects``, only the keys of these buckets
    (:func:`_buckets`).
    """
    holders = _key_holders(uniques, refs)
    if suspects is not None:
        wanted = {r.space for r in suspects.select("space").distinct().collect()}  # one row a key space at most
        holders = [h for h in holders if h[2] in wanted]
    kinds = _space_kinds(tables, uniques, refs)

    def cell(t: str, cols: tuple[str, ...], space: int, slot: int) -> Column:
        # -1 in slot: the owner of the key space; whole numbers of any width hash alike
        values = []
        for c, kind in zip(cols, kinds[space]):
            values += [F.col(c).cast("long" if kind == "whole" else "string"), F.col(c).isNull()]
        bucket = _bucket(cols, kinds[space])[:2] if suspects is not None else []
        return F.struct(F.lit(space).alias("space"), F.xxhash64(*values).alias("k1"), F.xxhash64(F.lit("second"), *values).alias("k2"),
                        _null_key(cols).alias("null_key"), F.lit(slot).alias("slot"), *bucket)
    used = _exploded(tables, [(h[0], cell(*h)) for h in holders]).where((F.col("slot") < 0) | ~F.col("null_key"))
    if suspects is not None:
        used = used.join(suspects, ["space", "null_key", "b1", "b2"], "left_semi")
    return used.groupBy("space", "k1", "k2", "null_key").agg(
        F.count_if(F.col("slot") < 0).alias("owners"),
        *[F.count_if(F.col("slot") == j).alias(f"c{j}") for j in range(max(reference_slots(refs), default=-1) + 1)])


def _space_kinds(tables: dict[str, DataFrame], uniques: list[Unique], refs: list[Reference]) -> dict[int, list[str]]:
    """Per key space and column ``whole``, ``date`` or ``text``: whole numbers and dates only where owner and references agree."""
    kinds: dict[int, list[str]] = {}
    for t, cols, space, _ in _key_holders(uniques, refs):
        types = [tables[t].schema[c].dataType for c in cols]
        mine = ["whole" if isinstance(x, T.IntegralType) else "date" if isinstance(x, T.DateType) else "text" for x in types]
        kinds[space] = [a if a == b else "text" for a, b in zip(kinds.get(space, mine), mine)]
    return kinds


def _bucket(cols: tuple[str, ...], kinds: list[str]) -> list[Column]:
    """(b1, b2, bits): a bucket of up to 64 keys and the bit of the row's key in it.

    The bit is taken from a date's month, or else from the last whole number;
    keys without either are a bucket each.  One or two whole numbers name
    their bucket themselves, anything else does by a 128-bit hash."""
    at = kinds.index("date") if "date" in kinds else max((i for i, k in enumerate(kinds) if k == "whole"), default=None)
    names, bits = [], F.lit(1).cast("long")
    for i, (c, kind) in enumerate(zip(cols, kinds)):
        value = F.col(c).cast("string") if kind == "text" else F.unix_date(c).cast("long") if kind == "date" else F.col(c).cast("long")
        if i == at:
            place = value if kind == "whole" else (F.year(c) * 12 + F.month(c)).cast("long")
            bits = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))
            value = F.shiftright(place, 6) if kind == "whole" else F.shiftright(place, 6) * 32 + F.dayofmonth(c)
        names.append(value)
    if len(names) <= 2 and "text" not in kinds:
        b1, b2 = [*names, F.lit(0).cast("long")][:2]
    else:
        nulls = [F.col(c).isNull() for c in cols]
        b1, b2 = F.xxhash64(*names, *nulls), F.xxhash64(F.lit("second"), *names, *nulls)
    zero = F.lit(0).cast("long")
    return [F.coalesce(b1, zero).alias("b1"), F.coalesce(b2, zero).alias("b2"), F.coalesce(bits, zero).alias("bits")]


def _buckets(tables: dict[str, DataFrame], uniques: list[Unique], refs: list[Reference]) -> DataFrame:
    """(space, null_key, b1, b2, bad, c0, c1, ...): the buckets of the referenced key spaces, and of the others those that may break a rule.

    Each table is scanned once; the rows of a bucket's holder become a count
    and 64 bits, combined map-side, so what is shuffled is a small part of the
    keys where these are dense, and one narrow row a key where they are not.
    A bucket is ``bad`` if its owner's rows are not as many as its bits, if a
    reference has a bit that the owner has not, or if a key has a NULL part:
    the others hold no violation.
    """
    holders, kinds = _key_holders(uniques, refs), _space_kinds(tables, uniques, refs)
    referenced = {h[2] for h in holders if h[3] >= 0}

    def cell(i: int, t: str, cols: tuple[str, ...], space: int, slot: int) -> Column:
        lost = F.lit(None).cast("int") if slot >= 0 else F.lit(2 * i + 1)  # a NULL part: an owner's fault, no reference
        return F.struct(F.when(_null_key(cols), lost).otherwise(F.lit(2 * i)).alias("cell"), *_bucket(cols, kinds[space]))
    rows = _exploded(tables, [(h[0], cell(i, *h)) for i, h in enumerate(holders)]).where("cell IS NOT NULL")
    found = rows.groupBy("cell", "b1", "b2").agg(F.count(F.lit(1)).alias("rows"), F.bit_or("bits").alias("bits"))

    def of_holder(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.shiftright("cell", 1) + 1)
    odd = (F.col("cell") % 2 == 1) | (F.col("rows") != F.bit_count("bits"))
    alone = of_holder([0 if h[2] in referenced else 1 for h in holders]) == 1
    found = (found.where(~alone | odd)
             .select(of_holder([h[2] for h in holders]).alias("space"), (F.col("cell") % 2 == 1).alias("null_key"), "b1", "b2",
                     of_holder([h[3] for h in holders]).alias("slot"), "rows", "bits", odd.alias("odd")))
    slots = range(max((h[3] for h in holders), default=-1) + 1)
    owner, none = F.col("slot") < 0, F.lit(0).cast("long")

    def bits_of(which: Column) -> Column:
        return F.coalesce(F.bit_or(F.when(which, F.col("bits"))), none)
    per = found.groupBy("space", "null_key", "b1", "b2").agg(
        F.max(owner & F.col("odd")).alias("_odd"), bits_of(owner).alias("_owned"), bits_of(~owner).alias("_referred"),
        *[F.coalesce(F.sum(F.when(F.col("slot") == j, F.col("rows"))), none).alias(f"c{j}") for j in slots])
    lost = F.col("_referred").bitwiseAND(F.bitwise_not("_owned")) != 0
    return per.select("space", "null_key", "b1", "b2", (F.col("_odd") | lost).alias("bad"), *[f"c{j}" for j in slots])


def reference_slots(refs: list[Reference]) -> list[int]:
    """The number of each reference among those into the same key space."""
    seen: dict[tuple, int] = {}
    out = []
    for r in refs:
        space = (r.parent, tuple(r.parent_columns))
        out.append(seen.get(space, 0))
        seen[space] = out[-1] + 1
    return out


def _space_totals(tables: dict[str, DataFrame], uniques: list[Unique], refs: list[Reference]) -> DataFrame:
    """One row per key space: bad owner keys, and per slot the rows and those without an owner.

    Buckets of keys are checked first; only the keys of bad buckets are counted one by one."""
    slots = range(max(reference_slots(refs), default=-1) + 1)
    buckets = stored(_buckets(tables, uniques, refs), "key_buckets")

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    def gathered(lost) -> Column:
        return F.array(*[F.struct(total(F.col(f"c{j}")).alias("rows"), lost(j).alias("lost")) for j in slots]
                       or [F.struct(F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("lost"))])
    zero = F.lit(0).cast("long")
    suspects = buckets.where("bad").select("space", "null_key", "b1", "b2")
    all_good = buckets.groupBy("space").agg(zero.alias("bad"), gathered(lambda j: zero).alias("slots"))
    if suspects.isEmpty():
        return all_good
    bad = (F.col("owners") > 1) | (F.col("null_key") & (F.col("owners") > 0))
    lost = key_groups(tables, uniques, refs, suspects).groupBy("space").agg(
        F.count_if(bad).alias("bad"), *[total(F.when(F.col("owners") == 0, F.col(f"c{j}"))).alias(f"l{j}") for j in slots])
    rows = buckets.groupBy("space").agg(*[total(F.col(f"c{j}")).alias(f"c{j}") for j in slots] or [zero.alias("_none")])
    # one row a key space on both sides
    return rows.join(F.broadcast(lost), "space", "left").select(
        "space", F.coalesce("bad", zero).alias("bad"),
        F.array(*[F.struct(F.col(f"c{j}").alias("rows"), F.coalesce(f"l{j}", zero).alias("lost")) for j in slots]
                or [F.struct(zero.alias("rows"), zero.alias("lost"))]).alias("slots"))


def _labelled(totals: DataFrame, uniques: list[Unique], refs: list[Reference]) -> DataFrame:
    """(name, table_name, kind, child_rows, found) per constraint from the totals per key space; a space without rows counts zero."""
    spark, spaces = totals.sparkSession, _key_spaces(uniques, refs)
    rows = [(u.name, u.table, "pk", spaces[u.table, tuple(u.columns)], 0) for u in uniques]
    rows += [(r.name, r.table, "fk", spaces[r.parent, tuple(r.parent_columns)], slot) for r, slot in zip(refs, reference_slots(refs))]
    wanted = spark.createDataFrame(rows, "name string, table_name string, kind string, space int, slot int")  # the registry
    at = F.get("slots", F.col("slot"))
    zero = F.lit(0).cast("long")
    return (wanted.join(F.broadcast(totals), "space", "left")  # one row a key space
            .select("name", "table_name", "kind", F.coalesce(at["rows"], zero).alias("child_rows"),
                    F.coalesce(F.when(F.col("kind") == "pk", F.col("bad")).otherwise(at["lost"]), zero).alias("found")))


def reference_counts(tables: dict[str, DataFrame], refs: list[Reference]) -> DataFrame:
    """(name, child_rows, unmatched_rows) of each reference."""
    return _labelled(_space_totals(tables, [], refs), [], refs).select("name", "child_rows", F.col("found").alias("unmatched_rows"))


def constraint_report(tables: dict[str, DataFrame], uniques: list[Unique], refs: list[Reference]) -> DataFrame:
    """C-01/C-02 as data: (table_name, constraint_name, violations) of a registry.

    A violated key counts its key groups (repeated or with a NULL part), a
    violated reference its child rows without a parent.
    """
    return _labelled(_space_totals(tables, uniques, refs), uniques, refs).select(
        "table_name", F.col("name").alias("constraint_name"), F.col("found").alias("violations"))


# ------------------------------------------------------------------ single constraints

def unique_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of C-01 failures: key groups with more than one row or a NULL key part."""
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return g.filter((F.col("_n") > 1) | null_key)


def fk_violations(child: DataFrame, cols: list[str], parent: DataFrame, pcols: list[str]) -> DataFrame:
    """Rows of C-02 failures: non-null child keys absent from the parent."""
    c = child.select(*[F.col(a).alias(f"_k{i}") for i, a in enumerate(cols)])
    c = c.filter(reduce(lambda a, b: a & b, [F.col(f"_k{i}").isNotNull() for i in range(len(cols))]))
    p = parent.select(*[F.col(a).alias(f"_k{i}") for i, a in enumerate(pcols)])
    return c.join(p, [f"_k{i}" for i in range(len(cols))], "left_anti")


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """C-03 in one job for all columns: one row of NULL counts."""
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])


def assert_unique(df: DataFrame, cols: list[str], name: str = "") -> None:
    if not unique_violations(df, cols).isEmpty():
        raise ConstraintViolation(f"{name}: key {cols} is not unique or has NULLs")


def assert_fk(child: DataFrame, cols: list[str], parent: DataFrame, pcols: list[str], name: str = "") -> None:
    if not fk_violations(child, cols, parent, pcols).isEmpty():
        raise ConstraintViolation(f"{name}: {cols} -> {pcols} has unmatched keys")


def assert_not_null(df: DataFrame, cols: list[str], name: str = "") -> None:
    row = null_counts(df, cols).first()
    bad = {c: row[c] for c in cols if row[c]}
    if bad:
        raise ConstraintViolation(f"{name}: NULLs in {bad}")


def null_report(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """C-03 as data: (table_name, column_name, nulls), one scan per table."""
    parts = []
    for t, cols in columns.items():
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in cols])).alias("x")
        parts.append(null_counts(tables[t], cols).select(F.lit(t).alias("table_name"), cells).select("table_name", "x.*"))
    return reduce(DataFrame.unionByName, parts)
