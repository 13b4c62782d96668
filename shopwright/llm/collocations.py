"""Phrase collocation mining over sorted count streams.

``counts`` gives one stream of (lang, phrase, f) rows: every word and phrase
with at least ``min_count`` occurrences, per language.  Tasks cut their texts
into pieces and words, number the words of a buffer and combine equal n-grams
by sorting their codes; Spark sums the partial counts.  Orders above two are
counted order by order: an n-gram can only reach ``min_count`` if both
(n-1)-grams in it do, so a bit table of fixed size that marks the frequent
(n-1)-grams (built by a bitwise aggregate) tells the tasks which n-grams are
worth sending.  A marked bit set by another phrase only sends a phrase too
many; no frequent phrase is lost.

The statistics come from merge joins of sorted streams, never from a hash
table of phrases: the candidates in prefix order (by their first part) are
joined in lockstep with the counts for the left counts, in suffix order (by
the rest) for the right counts, and the longer candidates' extension counts
(a maximum per inner phrase) meet the candidates in phrase order.  A hot first
part or rest is a skewed merge join that AQE splits; the extension maxima and
the counts are partial aggregates.  The ranking first keeps the best of each
of some parts of a language (``SPREAD``), so no task ranks a whole language.

Nulls and edge cases: a null text is empty and has no words; a null language
is ``und``; doc_id is not used, so null and repeated ids count like any row;
repeated rows count each time; an empty table gives no row; words are compared
as bytes; a text of any length is counted whole (a text longer than a buffer
fills a buffer of its own); extra columns are not read; fewer candidates than
``top`` give all of them.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from ..session import stored

#: fixed values: characters that end a piece
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
#: words buffered before equal n-grams are combined and sent
BUFFER = 1_000_000
#: log2 of the bits of the table of frequent (n-1)-grams (8 MB)
BITS = 26
#: parts of a language that are ranked apart before the language is, round by round
SPREAD = (64, 8)

_TO_BREAK = bytes.maketrans(BREAKS, b"." * len(BREAKS))


def words(text: bytes) -> list[bytes]:
    """The words of a text, a ``.`` standing for each end of a piece (no word holds one)."""
    return text.lower().translate(_TO_BREAK).replace(b".", b" . ").split()


def mixed(hashes: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one more word."""
    h = (hashes ^ new) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _hash(words_: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words_), np.uint64, len(words_))


class _Buffer:
    """Words of some documents as numbers; 0 stands for the end of a piece."""

    def __init__(self):
        self.ids, self.langs, self.texts, self.size = defaultdict(), [], [], 0
        self.ids.default_factory = self.ids.__len__
        self.ids[b"."]

    def add(self, lang: bytes, found: list[bytes]) -> None:
        self.texts.append(np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found)))
        self.langs.append(lang)
        self.size += len(found)

    def tokens(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Word numbers with a break after each text, language numbers, languages."""
        names = sorted(set(self.langs))
        at = {x: k for k, x in enumerate(names)}
        w = np.concatenate([x for t in self.texts for x in (t, np.zeros(1, np.int64))])
        lang = np.repeat([at[x] for x in self.langs], [len(t) + 1 for t in self.texts])
        return w, lang.astype(np.int64), names


def _rows(schema: pa.Schema, langs: pa.Array, lang: np.ndarray, vocab: pa.Array, parts: list[np.ndarray], n: np.ndarray):
    """Record batches of (lang, phrase, n); a phrase without parts is the language's total."""
    loose = pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True)
    for k in range(0, len(n), 65_536):
        s = slice(k, k + 65_536)
        if parts:
            phrase = pc.binary_join_element_wise(*[vocab.take(pa.array(p[s])) for p in parts], pa.scalar(b" ", pa.binary()))
            phrase = pc.cast(phrase, options=loose)
        else:
            phrase = pa.nulls(len(n[s]), pa.string())
        yield pa.RecordBatch.from_arrays([pc.cast(langs.take(pa.array(lang[s])), options=loose), phrase, pa.array(n[s].astype(np.int64))], schema=schema)


def _grams(buffer: _Buffer, orders: range, bits: np.ndarray | None, schema: pa.Schema):
    """Combined n-gram counts of a buffer for each order (and the totals if order 1 is asked for)."""
    w, lang, names = buffer.tokens()
    vocab_words = list(buffer.ids)
    vocab, langs, size = pa.array(vocab_words, pa.binary()), pa.array(names, pa.binary()), len(vocab_words)
    if 1 in orders:
        total = np.bincount(lang[w > 0], minlength=len(names))
        yield from _rows(schema, langs, np.arange(len(names)), vocab, [], total)
    word_hash = _hash(vocab_words)
    lang_hash = _hash(names)
    starts = np.flatnonzero(w > 0)              # where an n-gram of the current order starts
    group = lang[starts] * size + w[starts]     # a number for its words so far
    for order in range(1, max(orders) + 1):
        if order > 1:
            ends = starts + order - 1
            ok = w[np.minimum(ends, len(w) - 1)] > 0
            ok &= ends < len(w)
            starts, group = starts[ok], group[ok]
            _, group = np.unique(group, return_inverse=True)
            group = group * size + w[starts + order - 1]
        if order in orders:
            _, first, n = np.unique(group, return_index=True, return_counts=True)
            at = starts[first]
            yield from _rows(schema, langs, lang[at], vocab, [w[at + k] for k in range(order)], n)
        elif bits is not None and order == max(orders) - 1:
            h = lang_hash[lang[starts]]
            for k in range(order):
                h = mixed(h, word_hash[w[starts + k]])
            spot = h >> np.uint64(64 - BITS)
            hit = (bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) > 0
            marked = np.zeros(len(w) + 1, bool)
            marked[starts[hit]] = True
            both = marked[starts] & marked[starts + 1]
            starts, group = starts[both], group[both]


def partial_counts(docs: DataFrame, orders: range, bits=None, size: int = BUFFER) -> DataFrame:
    """(lang, phrase, n) combined per task; ``bits``: broadcast marks of the frequent phrases one word shorter."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def run(batches):
        marks, buffer = None if bits is None else bits.value, _Buffer()
        for b in batches:
            for lang, text in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                found = words(text)
                if buffer.size and buffer.size + len(found) > size:
                    yield from _grams(buffer, orders, marks, schema)
                    buffer = _Buffer()
                if found:
                    buffer.add(lang, found)
        if buffer.size:
            yield from _grams(buffer, orders, marks, schema)
    source = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, "lang string, phrase string, n long")


def frequent_bits(phrases: DataFrame) -> np.ndarray:
    """The bit table that marks the given (lang, phrase) rows: at most 2**(BITS - 6) words whatever their number."""
    def run(batches):
        for b in batches:
            lang = np.array(_hash(b.column(0).cast(pa.binary()).to_pylist()), np.uint64)
            parts = [x.split(b" ") for x in b.column(1).cast(pa.binary()).to_pylist()]
            h = lang
            for k in range(len(parts[0]) if parts else 0):
                h = mixed(h, _hash([p[k] for p in parts]))
            spot = h >> np.uint64(64 - BITS)
            bit = (np.uint64(1) << (spot & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((spot >> np.uint64(6)).astype(np.int64)), pa.array(bit)], ["at", "bits"])
    table = (phrases.select("lang", "phrase").mapInArrow(run, "at long, bits long")
             .groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas())  # bounded: see above
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[table["at"].to_numpy(np.int64)] = table["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, buffer: int = BUFFER) -> DataFrame:
    """(lang, phrase, m, f): phrases of m <= max_words words with f >= min_count, and each language's
    total (a null phrase, m = 0); written once below the checkpoint folder."""
    common.prepare(docs.sparkSession)
    n_words = F.coalesce(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1, F.lit(0)).cast("int")

    def kept(part: DataFrame, name: str) -> DataFrame:
        f = part.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        return stored(f.where(F.col("phrase").isNull() | (F.col("f") >= min_count)).withColumn("m", n_words), name)
    out = kept(partial_counts(docs, range(1, min(2, max_words) + 1), size=buffer), "phrases")
    for order in range(3, max_words + 1):
        bits = docs.sparkSession.sparkContext.broadcast(frequent_bits(out.where(F.col("m") == order - 1)))
        out = out.unionByName(kept(partial_counts(docs, range(order, order + 1), bits, buffer), "phrases"))
    return out


def scored(stream: DataFrame, max_words: int = 3) -> DataFrame:
    """(lang, phrase, a, l, r, score): the lowest-scoring cut of each candidate."""
    cand = stream.where("m >= 2")
    cuts = F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    parts = cand.select("lang", "phrase", F.col("f").alias("a"), "m", cuts).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("head"),
        F.expr("substring_index(phrase, ' ', k - m)").alias("tail"))

    def part(name: str, value: str) -> DataFrame:
        # no candidate part has more than max_words - 1 words
        return stream.where((F.col("m") > 0) & (F.col("m") < max_words)).select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    prefix = parts.join(part("head", "l").hint("merge"), ["lang", "head"])
    suffix = prefix.join(part("tail", "r").hint("merge"), ["lang", "tail"])
    wide = [f"CAST({x} AS DECIMAL(19,0))" for x in ("a", "l", "r")]
    score = F.expr(f"({wide[0]} * {wide[0]} * CAST(1000000 AS DECIMAL(7,0))) div ({wide[1]} * {wide[2]})")
    best = suffix.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))
    return best.select("lang", "phrase", "a", "x.l", "x.r", "x.score")


def extensions(stream: DataFrame, max_words: int = 3) -> DataFrame:
    """(lang, phrase, longest): the highest count of a longer candidate that holds the phrase."""
    longer = stream.where("m >= 3")
    spans = F.expr("flatten(transform(sequence(2, m - 1), s -> transform(sequence(0, m - s), i -> array_join(slice(split(phrase, ' '), i + 1, s), ' '))))")
    inner = longer.select("lang", "f", F.explode(F.array_distinct(spans)).alias("phrase"))
    return inner.groupBy("lang", "phrase").agg(F.max("f").alias("longest"))


def mine(docs: DataFrame, max_words: int = 3, min_count: int = 10, share: int = 50, top: int = 2000,
         buffer: int = BUFFER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` candidates.

    A candidate goes if a longer one that holds it has at least ``share`` % of its count.
    """
    stream = counts(docs, max_words, min_count, buffer)
    longer = extensions(stream, max_words).hint("merge")
    kept = (scored(stream, max_words).join(longer, ["lang", "phrase"], "left")
            .where(F.coalesce(F.lit(100) * F.col("longest") < F.lit(share) * F.col("a"), F.lit(True))))
    totals = stream.where("m = 0").select("lang", F.col("f").alias("n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = kept
    for parts in SPREAD:  # a task ranks at most the best `top` of each part of the round before
        piece = F.pmod(F.xxhash64("phrase"), F.lit(parts)).cast("int")
        first = (first.withColumn("piece", piece)
                 .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "piece").orderBy(*order)))
                 .where(F.col("rank") <= top).drop("piece", "rank"))
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
