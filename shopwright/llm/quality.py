"""Quality classifier: interpolated modified Kneser-Ney character 4-grams.

The model is estimated per language from trusted text over the characters as
they stand (but for the ASCII digits, which count as one).  Spark holds every count in sharded tables: 4-gram counts, the
continuation counts of the lower orders, totals and counts-of-counts of each
context.  Joins of those tables on the context and on the suffix give the
interpolated probability of every seen n-gram and the back-off weight of every
seen context.  All trusted text is used: every second trusted id, in hash
order, estimates the model, the others the thresholds: the ``quantile`` of their
perplexities per language.  Finished tables of at most ``MOST`` entries are a
bounded broadcast: a document's n-grams meet them where the text is, and no text
is shuffled.  Larger ones stay sharded and are joined with the n-grams of the
documents.

Nulls and edge cases: a null or empty text has a null perplexity and is
rejected; a null language, or one with less than ``min_chars`` characters to
learn from, uses the model and threshold of all languages together; characters
that a model has not met share the weight left for unseen ones; with no trusted
text at all every non-empty document is kept; repeated rows are scored one by
one; a text of any length is scored whole; extra columns pass through, those
named like a result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from ..functions.keys import with_dense_key

ORDER, POOL, PAD = 4, "*", "\n\n\n"
#: characters counted or scored at a time
BLOCK = 250_000
#: entries of the finished tables that are broadcast, at most
MOST = 2_000_000
#: trusted ids that are broadcast, at most
FEW = 1_000_000


def points(text: str) -> np.ndarray:
    """Code points of the text behind its padding; the ASCII digits are one character."""
    chars = np.frombuffer((PAD + text).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where((chars >= 48) & (chars <= 57), np.uint32(48), chars)


def blocks(texts: list[np.ndarray]):
    """Lists of (text's number, its points or a slice of them) of about BLOCK characters in all.

    A longer text is cut into slices, each behind the characters before it."""
    held, size = [], 0
    for i, t in enumerate(texts):
        for s in range(0, len(t) - len(PAD), BLOCK):
            part = t[s:s + BLOCK + len(PAD)]
            if held and size + len(part) > BLOCK:
                yield held
                held, size = [], 0
            held.append((i, part))
            size += len(part)
    if held:
        yield held


def _codes(ids: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` 16-bit character numbers up to each position after the padding, in one word."""
    out = np.zeros(len(ids) - len(PAD), np.uint64)
    for k in range(len(PAD) - order + 1, len(PAD) + 1):
        out = (out << np.uint64(16)) | ids[k:k + len(out)]
    return out


# ---------------------------------------------------------------------- estimation

def grams_of(part: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
    """The different 4-grams of some texts' points and how often each occurs."""
    alphabet, ids = np.unique(np.concatenate(part), return_inverse=True)
    rows = np.lib.stride_tricks.sliding_window_view(ids, ORDER)
    inside = np.ones(len(rows), bool)  # no window reaches from one text into the next
    for k in range(1, ORDER):
        inside[np.cumsum([len(t) for t in part])[:-1] - k] = False
    rows = rows[inside]
    seen, n = np.unique(rows, axis=0, return_counts=True) if len(alphabet) > 0xFFFF else _unique(rows)
    grams = np.ascontiguousarray(alphabet[seen].astype("<u4")).tobytes().decode("utf-32-le", "surrogatepass")
    return [grams[k:k + ORDER].encode("utf-8", "replace").decode() for k in range(0, len(grams), ORDER)], n


def count_grams(trusted: DataFrame) -> DataFrame:
    """(lang, gram, n): 4-gram counts per language and for all together."""
    def count(batches):
        for b in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    by_lang.setdefault(lang, []).append(points(text))
            for lang, texts in by_lang.items():
                for block in blocks(texts):
                    grams, n = grams_of([t for _, t in block])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(grams, pa.string()), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])
    rows = (trusted.where("text is not null").select(F.coalesce("lang", F.lit(POOL)).alias("lang"), "text")
            .mapInArrow(count, "lang string, gram string, n long"))
    both = rows.select(F.explode(F.array_distinct(F.array("lang", F.lit(POOL)))).alias("lang"), "gram", "n")
    return both.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _unique(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of numbers below 2**16 and how often each occurs."""
    codes = np.zeros(len(rows), np.uint64)
    for k in range(ORDER):
        codes = (codes << np.uint64(16)) | rows[:, k].astype(np.uint64)
    codes, n = np.unique(codes, return_counts=True)
    return np.stack([(codes >> np.uint64(16 * (ORDER - 1 - k))) & np.uint64(0xFFFF) for k in range(ORDER)], 1).astype(np.int64), n


def discounts(counts_of_counts: list[float]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more from the numbers of n-grams counted 1 to 4 times."""
    n = [0.0, *counts_of_counts]
    y = n[1] / max(1.0, n[1] + 2 * n[2])
    return [min(max(j - (j + 1) * y * n[j + 1] / n[j], 0.1), float(j)) if n[j] else 0.5 for j in (1, 2, 3)]


def estimate(counts: DataFrame, min_chars: int = 20_000) -> list[DataFrame]:
    """Per order k = 0..ORDER a frame (lang, gram, p, back): the probability of
    each seen k-gram's last character after the others (null: not seen as
    such), and the k-gram's weight as a context of the next order (null: it is
    none); order 0 holds the probability of a character not seen.  Languages
    with enough text, and all together."""
    spark = counts.sparkSession
    enough = (counts.groupBy("lang").agg(F.sum("n").alias("chars"))
              .where((F.col("chars") >= min_chars) | (F.col("lang") == POOL)).select("lang"))  # one row a language
    tables = {ORDER: common.cut(counts.join(F.broadcast(enough), "lang", "left_semi").select("lang", "gram", F.col("n").alias("c")))}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: how many different characters stand before
        rest = F.expr(f"substring(gram, 2, {k})")
        tables[k] = common.cut(tables[k + 1].groupBy("lang", rest.alias("gram")).agg(F.count(F.lit(1)).alias("c")))

    out: list[DataFrame] = []
    p = None
    for k in range(1, ORDER + 1):
        of = [F.count_if(F.col("c") == j).cast("double").alias(f"n{j}") for j in (1, 2, 3, 4)]
        found = tables[k].groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *of).collect()  # one row a language
        steps = spark.createDataFrame([(r["lang"], 1.0 / (r["n"] + 1), *discounts([r[f"n{j}"] for j in (1, 2, 3, 4)])) for r in found],
                                      "lang string, even double, d1 double, d2 double, d3 double")
        off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        t = (tables[k].join(F.broadcast(steps), "lang")
             .select("lang", "gram", F.expr(f"substring(gram, 1, {k - 1})").alias("ctx"), "c", F.least(off, F.col("c").cast("double")).alias("off"), "even"))
        contexts = common.cut(t.groupBy("lang", "ctx").agg(F.sum("c").cast("double").alias("total"), F.sum("off").alias("freed"), F.first("even").alias("even")))
        weight = F.col("freed") / F.col("total")
        if k == 1:  # below the single characters each, and one more for those not seen, is as likely
            out.append(contexts.select("lang", F.lit("").alias("gram"), (weight * F.col("even")).alias("p"), F.lit(None).cast("double").alias("back")))
            lower = t.drop("even").join(contexts, ["lang", "ctx"]).withColumn("low", F.col("even"))
        else:
            # a context that only stands at the start of texts has no probability of its own
            out.append(p.join(contexts.select("lang", F.col("ctx").alias("gram"), weight.alias("back")), ["lang", "gram"], "full"))
            low = p.select("lang", F.col("gram").alias("rest"), F.col("p").alias("low"))
            lower = (t.drop("even").join(contexts, ["lang", "ctx"])
                     .withColumn("rest", F.expr(f"substring(gram, 2, {k - 1})")).join(low, ["lang", "rest"]))
        p = common.cut(lower.select("lang", "gram", ((F.col("c") - F.col("off")) / F.col("total") + weight * F.col("low")).alias("p")))
    return [*out, p.withColumn("back", F.lit(None).cast("double"))]


class Model:
    """A language's tables as sorted codes, to look n-grams up by binary search."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """Per order from 0: the k-grams' characters one after the other, p and back."""
        # beyond 65,535 different characters the others count as not met
        self.letters = np.unique(np.concatenate([chars for chars, _, _ in orders]))[:0xFFFF]
        self.unseen = float(np.log10(orders[0][1][0]))
        self.codes, self.p, self.back = [], [], []
        for n, (chars, p, back) in enumerate(orders[1:], 1):
            ids = self.number(chars).reshape(-1, n)
            met = (ids > 0).all(1)
            code = np.zeros(int(met.sum()), np.uint64)
            for j in range(n):
                code = (code << np.uint64(16)) | ids[met, j]
            order = np.argsort(code)
            self.codes.append(code[order])
            self.p.append(np.log10(p[met][order]))
            weight = back[met][order]
            self.back.append(np.where(np.isnan(weight), 0.0, np.log10(np.where(np.isnan(weight) | (weight <= 0), 1.0, weight))))

    def number(self, chars: np.ndarray) -> np.ndarray:
        """16-bit numbers of characters; 0: not met."""
        at = np.minimum(np.searchsorted(self.letters, chars), len(self.letters) - 1)
        return np.where(self.letters[at] == chars, at + 1, 0).astype(np.uint64)

    def find(self, n: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        table = self.codes[n - 1]
        at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
        return at, table[at] == codes

    def log10(self, chars: np.ndarray) -> np.ndarray:
        """log10 P of each character after the padding, given the three before."""
        ids = self.number(chars)
        out = np.zeros(len(chars) - len(PAD))
        left = np.arange(len(out))
        for n in range(ORDER, 0, -1):
            codes = _codes(ids, n)[left]
            at, hit = self.find(n, codes)
            hit &= ~np.isnan(self.p[n - 1][at])
            out[left[hit]] += self.p[n - 1][at[hit]]
            left = left[~hit]
            if not len(left):
                return out
            if n > 1:  # back off by the context's weight, if it is a context
                at, known = self.find(n - 1, codes[~hit] >> np.uint64(16))
                out[left[known]] += self.back[n - 2][at[known]]
        out[left] += self.unseen
        return out


def train(trusted: DataFrame, min_chars: int = 20_000) -> dict[str, Model]:
    """language -> model; ``*`` holds all languages together."""
    return load(estimate(common.cut(count_grams(trusted)), min_chars))


def load(tables: list[DataFrame]) -> dict[str, Model]:
    """The models of :func:`estimate`'s frames, on the driver (at most MOST entries: see :func:`scorer`)."""
    orders: dict[str, list] = {}
    for frame in tables:
        table = frame.toArrow()
        for lang in table["lang"].unique().to_pylist():
            part = table.filter(pc.equal(table["lang"], lang))
            text = pa.concat_arrays([c.cast(pa.binary()) for c in part["gram"].chunks])
            ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1]
            chars = text.buffers()[2].to_pybytes()[ends[0]:ends[-1]].decode() if text.buffers()[2] is not None else ""
            number = lambda c: part[c].to_numpy().astype(np.float64)
            orders.setdefault(lang, []).append((np.frombuffer(chars.encode("utf-32-le"), np.uint32), number("p"), number("back")))
    return {lang: Model(parts) for lang, parts in orders.items()}


# ---------------------------------------------------------------------- scoring

def score(docs: DataFrame, held) -> DataFrame:
    """The documents' columns and ``perplexity`` (per character); ``held``: the broadcast of train()'s models."""
    schema = docs.select("*", F.lit(None).cast("double").alias("perplexity")).schema
    at, lang_at = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        models = held.value
        for b in batches:
            by_model: dict[str, list] = {}
            for i, (lang, text) in enumerate(zip(b.column(lang_at).to_pylist(), b.column(at).to_pylist())):
                name = lang if lang in models else POOL
                if text and name in models:
                    by_model.setdefault(name, []).append((i, text))
            total, size = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            for name, rows in by_model.items():
                for held_rows in np.array_split(np.arange(len(rows)), max(1, sum(len(t) for _, t in rows) // BLOCK)):
                    part = [rows[j] for j in held_rows]
                    for block in blocks([points(t) for _, t in part]):
                        # the padding of each piece stands between it and the one before
                        logs, start = models[name].log10(np.concatenate([t for _, t in block])), 0
                        for j, t in block:
                            own = len(t) - len(PAD)
                            total[part[j][0]] += logs[start:start + own].sum()
                            size[part[j][0]] += own
                            start += len(t)
            out = [float(10 ** (-t / n)) if n else None for t, n in zip(total.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*b.schema.names, "perplexity"])
    return docs.mapInArrow(run, schema)


def score_sharded(docs: DataFrame, tables: list[DataFrame], names: list[str]) -> DataFrame:
    """:func:`score` by joins with the tables of :func:`estimate`, of any size:
    the different n-grams of the documents meet each order once, then the
    documents that hold them.  Equal texts are scored once."""
    name = F.when(F.col("lang").isin(names), F.col("lang")).when(F.lit(POOL in names), F.lit(POOL))
    marked = docs.withColumn("_model", name).withColumn("_text", F.md5("text"))

    def count(batches):
        for b in batches:
            for model, key, text in zip(*[b.column(i).to_pylist() for i in range(3)]):
                for block in blocks([points(text)]):
                    grams, n = grams_of([t for _, t in block])
                    yield pa.RecordBatch.from_arrays([pa.array([model] * len(n), pa.string()), pa.array([key] * len(n), pa.string()),
                                                      pa.array(grams, pa.string()), pa.array(n.astype(np.int64))], ["_model", "_text", "gram", "n"])
    texts = marked.where("_model is not null and text <> ''").select("_model", "_text", "text").dropDuplicates(["_model", "_text"])
    held = common.cut(texts.mapInArrow(count, "_model string, _text string, gram string, n long"))
    logs = held.select("_model", "gram").distinct()
    for k in range(1, ORDER + 1):  # p of the last k characters, weight of the k - 1 before the last one
        t = tables[k].select(F.col("lang").alias("_model"), F.col("gram").alias(f"_g{k}"), F.log10("p").alias(f"_p{k}"))
        logs = logs.withColumn(f"_g{k}", F.expr(f"substring(gram, {ORDER + 1 - k}, {k})")).join(t, ["_model", f"_g{k}"], "left")
        if k > 1:
            w = tables[k - 1].select(F.col("lang").alias("_model"), F.col("gram").alias(f"_c{k}"), F.when(F.col("back") > 0, F.log10("back")).alias(f"_b{k}"))
            logs = logs.withColumn(f"_c{k}", F.expr(f"substring(gram, {ORDER + 1 - k}, {k - 1})")).join(w, ["_model", f"_c{k}"], "left")
    unseen = tables[0].select(F.col("lang").alias("_model"), F.log10("p").alias("_log"))  # one row a language
    logs = logs.join(F.broadcast(unseen), "_model")
    value = F.coalesce("_p1", "_log")
    for k in range(2, ORDER + 1):
        value = F.coalesce(F.col(f"_p{k}"), F.coalesce(f"_b{k}", F.lit(0.0)) + value)
    sums = (held.join(logs.select("_model", "gram", value.alias("_v")), ["_model", "gram"]).groupBy("_model", "_text")
            .agg(F.sum(F.col("n") * F.col("_v")).alias("_sum"), F.sum("n").alias("_n")))
    found = sums.select("_model", "_text", F.pow(F.lit(10.0), -F.col("_sum") / F.col("_n")).alias("perplexity"))
    return marked.join(found, ["_model", "_text"], "left").select(*docs.columns, "perplexity")


def scorer(spark: SparkSession, tables: list[DataFrame]) -> tuple[Callable[[DataFrame], DataFrame], list[str]]:
    """(documents -> documents with perplexity, the models' names) for the frames of :func:`estimate`."""
    tables = [common.cut(t) for t in tables]
    sizes = [t.count() for t in tables]
    names = [r[0] for r in tables[0].select("lang").collect()] if tables else []  # one row a language
    if sum(sizes) <= MOST and (not tables or tables[1].select("gram").distinct().count() < 0xFFFF):
        held = spark.sparkContext.broadcast(load(tables))
        return lambda docs: score(docs, held), names
    return lambda docs: score_sharded(docs, tables, names), names


def sample(docs: DataFrame, labels: DataFrame, max_trusted: int, max_chars: int) -> list[int]:
    """Trusted ids, in hash order, to look at: at most max_trusted and, beyond
    the first, max_chars characters (:func:`classify` uses all: :func:`trusted_ids`)."""
    good = (labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_good")).distinct()
            .orderBy(F.xxhash64("_good"), "_good").limit(max_trusted))
    texts = docs.select(F.col("doc_id").alias("_id"), "text")
    sizes = (texts.join(F.broadcast(good), F.col("_id") == F.col("_good"))  # at most max_trusted ids
             .groupBy("_good").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("n"), F.first(F.xxhash64("_good")).alias("h"))
             .orderBy("h", "_good").select("_good", "n").collect())
    out, total = [], 0
    for i, n in sizes:
        total += n
        if out and total > max_chars:
            break
        out.append(i)
    return out


def trusted_ids(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(_good, _learn): all ids of documents that ``labels`` gives quality 1; in
    hash order every second one, from the first on, is to be learned from."""
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_good")).distinct()
    held = good.join(docs.select(F.col("doc_id").alias("_good")), "_good", "left_semi").withColumn("_h", F.xxhash64("_good"))
    return with_dense_key(held, ["_h", "_good"], "_place").select("_good", (F.col("_place") % 2 == 1).alias("_learn"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.995) -> DataFrame:
    """The documents with perplexity, threshold and ``keep``.

    Trusted text: all documents that ``labels`` gives quality 1.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    docs = docs.drop("perplexity", "threshold", "keep")
    ids = common.cut(trusted_ids(docs, labels))
    n = ids.count()
    few = n <= FEW
    texts = docs.select(F.col("doc_id").alias("_id"), "lang", "text")

    def trusted(rows: DataFrame, which: DataFrame) -> DataFrame:
        wanted = which.select("_good")
        return rows.join(F.broadcast(wanted) if few else wanted, F.col("_id") == F.col("_good"), "left_semi").drop("_id")
    learn, judge = ids.where("_learn"), ids.where("not _learn") if n > 1 else ids
    scored, names = scorer(spark, estimate(common.cut(count_grams(trusted(texts, learn)))) if n else [])
    q = F.percentile_approx("perplexity", quantile, 10_000)
    # many ids are joined with the scores, not with the texts
    known = scored(trusted(texts, judge)) if few else trusted(scored(texts).select("_id", "lang", "perplexity"), judge)
    known = common.cut(known.select("lang", "perplexity"))
    by_lang = {r[0]: r[1] for r in known.where("lang is not null").groupBy("lang").agg(q.alias("q")).collect() if r[0] in names}  # one row a language
    limit = F.lit(known.agg(q.alias("q")).first()[0]).cast("double")
    for lang, v in by_lang.items():
        limit = F.when(F.col("lang") == lang, F.lit(v)).otherwise(limit)
    return (scored(docs).withColumn("threshold", limit)
            .withColumn("keep", F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, False)
                        .otherwise(F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))))
