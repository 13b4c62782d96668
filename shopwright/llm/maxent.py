"""Hashed maximum-entropy language model with a class-factored softmax.

P(token | context) = P(class | context) * P(token | class).  Every token has a
class: the most frequent training tokens (a fixed number) are classes of their
own, all others share classes by a hash of their last two bytes, so the
context's n-gram and skip features (previous token, the one before, both, and
the pair one and three back; a token stands for its class) say which kind of
rare word is due.  The class softmax is factored into group and member.
Weights are trained by distributed updates: in each round every task takes
gradient steps over its part of the training texts and Spark averages the
changes.  Inside a shared class, Good-Turing mass goes to unseen tokens
(counted as one outcome) and the rest follows the counts of the whole training
vocabulary.

Token counts cover all training texts.  Only the list of tokens above a share
of the training tokens is broadcast, which bounds its length; the other tokens
of a text are joined with their counts by a shuffle and summed per document.

Nulls and edge cases: a null text is empty (one end token); a null doc_id
belongs to no fold: it is scored and not trained on; repeated rows are scored
one by one; an empty table gives an empty result; with no training text
every token is unseen.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

END = b"\n"  # no word holds white space
GROUPS, MEMBERS, BITS = 16, 16, 12
HEAD = 127  # tokens that are a class of their own
SHARED = GROUPS * MEMBERS - HEAD  # classes of the others
BATCH = 16_384
#: shared class by the number that a word's last two bytes make
_CLASS = ((np.arange(1 << 16, dtype=np.int64) * 40_503) >> 4) % SHARED


def tokens(text: bytes | None) -> list[bytes]:
    words = (text or b"").lower().split()
    words.append(END)
    return words


def context(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashed features (n, 4) of each token; ``first`` marks the starts of texts."""
    at = np.arange(len(ids))
    begin = np.maximum.accumulate(np.where(first, at, 0))
    back = [np.where(at - k >= begin, ids[np.maximum(at - k, 0)], 300).astype(np.int64) for k in (1, 2, 3)]
    mask = (1 << BITS) - 1
    f = [back[0], 512 + back[1], (back[0] * 7919 + back[1] * 104_729 + 1) * 2_654_435_761 >> 15, (back[0] * 15_485_863 + back[2] * 32_452_843 + 5) * 2_654_435_761 >> 13]
    return np.stack([x & mask for x in f], axis=1)


def softmax(z: np.ndarray) -> np.ndarray:
    """In place, over a power of two of columns: z belongs to the caller no more."""
    def fold(f, part: np.ndarray) -> np.ndarray:
        while part.shape[1] > 1:  # halves against each other: short rows reduce slowly
            half = part.shape[1] // 2
            part = f(part[:, :half], part[:, half:])
        return part
    z -= fold(np.maximum, z)
    np.exp(z, out=z)
    z /= fold(np.add, z)
    return z


class Model:
    """Weights: group logits per feature, member logits per (feature, group)."""

    def __init__(self, counts: np.ndarray):
        p = (counts + 1.0) / (counts.sum() + len(counts))
        p = p.reshape(GROUPS, MEMBERS)
        self.b1, self.b2 = np.log(p.sum(1)).astype(np.float32), np.log(p / p.sum(1, keepdims=True)).astype(np.float32)
        self.w1 = np.zeros((1 << BITS, GROUPS), np.float32)
        self.w2 = np.zeros(((1 << BITS) * GROUPS, MEMBERS), np.float32)

    def parts(self, feats: np.ndarray, ids: np.ndarray):
        g, m = ids // MEMBERS, ids % MEMBERS
        rows = feats * GROUPS + g[:, None]
        z1, z2 = np.tile(self.b1, (len(g), 1)), self.b2.take(g, 0)
        for k in range(feats.shape[1]):
            z1 += self.w1.take(feats[:, k], 0)
            z2 += self.w2.take(rows[:, k], 0)
        return g, m, rows, softmax(z1), softmax(z2)

    def log10(self, feats: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.empty(len(ids))
        for s in range(0, len(ids), BATCH):
            i = ids[s:s + BATCH]
            g, m, _, p1, p2 = self.parts(feats[s:s + BATCH], i)
            n = np.arange(len(i))
            out[s:s + BATCH] = np.log10(np.maximum(p1[n, g].astype(np.float64) * p2[n, m], 1e-12))
        return out

    def learn(self, feats: np.ndarray, ids: np.ndarray, rate: float) -> None:
        for s in range(0, len(ids), BATCH):
            f, i = feats[s:s + BATCH], ids[s:s + BATCH]
            g, m, rows, p1, p2 = self.parts(f, i)
            n = np.arange(len(i))
            p1[n, g] -= 1
            p2[n, m] -= 1
            for k in range(f.shape[1]):
                # 16 bits sort by radix; the order by (feature, group) is one by feature too
                order = np.argsort(rows[:, k].astype(np.uint16), kind="stable")
                at = rows[order, k]
                for w, part, d in ((self.w1, at // GROUPS, p1), (self.w2, at, p2)):
                    cut = np.flatnonzero(np.diff(part, prepend=-1))
                    size = np.diff(cut, append=len(order))[:, None]
                    w[part[cut]] -= np.add.reduceat(d.take(order, 0), cut, axis=0) * (rate / np.sqrt(size + 1.0)).astype(np.float32)


def shared_class(words: list[bytes]) -> np.ndarray:
    """The shared class of each word (none is empty)."""
    if not words:
        return np.zeros(0, np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    raw, end = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size)
    return _CLASS[raw[end - 1] * np.int64(256) + np.where(size > 1, raw[end - 2], 0)]


def shared_class_of(word: str) -> Column:
    """:func:`shared_class` of a binary column."""
    def byte(k: int) -> Column:
        return F.conv(F.hex(F.expr(f"substring({word}, -{k}, 1)")), 16, 10).cast("long")
    tail = byte(1) * 256 + F.when(F.octet_length(word) > 1, byte(2)).otherwise(0)
    return F.pmod(F.shiftright(tail * 40_503, 4), F.lit(SHARED)).cast("int")


def encoded(texts: list, index: dict[bytes, int], classes: np.ndarray):
    """The texts' tokens one after the other: positions in ``index`` (-1: not there), class ids
    (``classes``: by position), starts, sizes, words."""
    words = [tokens(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = list(chain.from_iterable(words))
    at = np.fromiter(map(index.get, flat, repeat(-1)), np.int64, len(flat))
    ids, other = classes[at], np.flatnonzero(at < 0)
    ids[other] = HEAD + shared_class([flat[j] for j in other.tolist()])
    first = np.zeros(len(flat), bool)
    first[np.cumsum(sizes) - sizes] = True
    return at, ids, first, sizes, flat


def word_counts(train: DataFrame) -> DataFrame:
    def run(batches):
        sums: Counter = Counter()

        def flush():
            rows = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())], ["word", "c"])
            sums.clear()
            return rows
        for b in batches:
            for t in b.column(0).to_pylist():
                sums.update(tokens(t))
            if len(sums) > 500_000:
                yield flush()
        if sums:
            yield flush()
    return train.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def log_probability(docs: DataFrame, held: int = 2, folds: int = 7, rounds: int = 2, rate: float = 0.08,
                    common_share: float = 4e-7, common_bytes: int = 64) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words of at most ``common_bytes`` bytes that make up at least
    ``common_share`` of the training tokens (so at most 1 / common_share words)
    are looked up where the texts are; all others are joined by a shuffle.
    ``docs`` should be a scan or a checkpoint: its rows are numbered in place.
    """
    common.prepare(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    text = F.col("text").cast("string").cast("binary").alias("t")
    train = docs.where(fold != held)
    counts = common.cut(word_counts(train.select(text)))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("c"), "word").limit(HEAD).collect()  # at most HEAD rows
    head = {bytes(r["word"]): i for i, r in enumerate(top)}
    often = counts.where((F.col("c") >= F.lit(common_share) * F.lit(total)) & (F.octet_length("word") <= common_bytes)).collect()  # at most 1 / common_share rows
    often = sorted((bytes(r["word"]), r["c"]) for r in often if bytes(r["word"]) not in head)
    index = head | {w: HEAD + i for i, (w, _) in enumerate(often)}
    known = np.zeros(GROUPS * MEMBERS)
    known[:len(top)] = [r["c"] for r in top]
    rest = counts.where(~F.col("word").isin(*[F.lit(w) for w in head])) if head else counts
    once = np.zeros(SHARED)  # words of each shared class that were met once
    for r in rest.groupBy(shared_class_of("word").alias("k")).agg(F.sum("c").alias("c"), F.count_if(F.col("c") == 1).alias("n1")).collect():  # at most SHARED rows
        known[HEAD + r["k"]], once[r["k"]] = r["c"], r["n1"]
    mass = known[HEAD:]
    unseen = np.where(mass > 0, np.maximum(once, 1) / (np.maximum(once, 1) + mass), 1.0)
    model = Model(known)

    for r in range(rounds):  # each round learns from its own share of the training texts
        held_model = sc.broadcast((model, head))

        def update(batches, held_model=held_model):
            base, ids_of = held_model.value
            own = Model(known)
            own.w1, own.w2 = base.w1.copy(), base.w2.copy()
            for b in batches:
                _, ids, first, _, _ = encoded(b.column(0).to_pylist(), ids_of, np.arange(HEAD))
                own.learn(context(ids, first), ids, rate)
            for kind, a, z in ((1, own.w1, base.w1), (2, own.w2, base.w2)):
                d = a - z
                at = np.flatnonzero(np.abs(d).sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind), pa.int32()), pa.array(at, pa.int64()),
                                                  pa.array(d[at].astype(np.float64).tolist(), pa.list_(pa.float64()))], ["kind", "at", "d"])
        share = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == r).select(text)
        # a weight's change is averaged over the tasks that changed it
        deltas = (share.mapInArrow(update, "kind int, at long, d array<double>")
                  .groupBy("kind", "at").agg(*[F.avg(F.get("d", F.lit(k))).alias(f"d{k}") for k in range(GROUPS)]))
        new = Model(known)
        new.w1, new.w2 = model.w1.copy(), model.w2.copy()
        table = deltas.toPandas()  # at most one row a weight row: the model's fixed size
        for kind, w in ((1, new.w1), (2, new.w2)):
            t = table[table["kind"] == kind]
            w[t["at"].to_numpy()] += t[[f"d{k}" for k in range(GROUPS)]].to_numpy(np.float32)
        model = new

    denominator = float(total + distinct + 1)
    # log10 of the share of a shared class's known token, less log10(c); of its unseen tokens
    inside, outside = np.log10(np.maximum(1 - unseen, 1e-12)) - np.log10(np.maximum(mass, 1)), np.log10(unseen)
    # by position in the index; the last entry stands for tokens outside it, which the join adds
    c_of = np.concatenate([known[:HEAD], [c for _, c in often], [0.0]])
    base_of, rare_of = np.log10((c_of + 1) / denominator), np.zeros(len(c_of))
    shared = shared_class([w for w, _ in often])
    classes = np.concatenate([np.arange(HEAD), HEAD + shared])
    rare_of[HEAD:-1] = inside[shared] + np.log10(c_of[HEAD:-1])
    base_of[-1] = 0.0
    held_model = sc.broadcast((model, index, classes, base_of, rare_of))

    def score(batches):
        m, index_of, class_of, base, rare = held_model.value
        names = ["row", "doc_id", "word", "n", "n_tokens", "n_known", "base", "model"]
        for b in batches:
            for start in range(0, b.num_rows, 100):
                part = b.slice(start, 100)
                at, ids, first, sizes, flat = encoded(part.column(0).to_pylist(), index_of, class_of)
                cuts, row = np.cumsum(sizes) - sizes, part.column(1).to_numpy(zero_copy_only=False)
                none = pa.nulls(len(row), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), none, pa.array(np.zeros(len(row), np.int64)), pa.array(sizes),
                     pa.array(np.add.reduceat((at >= 0).astype(np.int64), cuts)), pa.array(np.add.reduceat(base[at], cuts)),
                     pa.array(np.add.reduceat(m.log10(context(ids, first), ids) + rare[at], cuts))], names)
                missing = np.flatnonzero(at < 0)
                found = Counter(zip(np.repeat(row, sizes)[missing].tolist(), [flat[j] for j in missing.tolist()]))
                zero = np.zeros(len(found), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in found], pa.int64()), pa.nulls(len(found), pa.int64()), pa.array([w for _, w in found], pa.binary()),
                     pa.array(list(found.values()), pa.int64()), pa.array(zero), pa.array(zero), pa.array(zero * 0.0), pa.array(zero * 0.0)], names)
    # rows get a number of their own, so that repeated and null doc_ids stay apart
    numbered = docs.select(text, F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    scored = numbered.mapInArrow(score, "row long, doc_id long, word binary, n long, n_tokens long, n_known long, base double, model double")
    # document rows carry a key that no word has, so they spread instead of meeting at null
    keyed = scored.withColumn("key", F.coalesce("word", F.concat(F.lit("\n").cast("binary"), F.col("row").cast("string").cast("binary"))))
    joined = keyed.join(counts.withColumnRenamed("word", "key"), "key", "left")
    rare = F.col("word").isNotNull()
    by_class = lambda v: F.get(F.array(*[F.lit(float(x)) for x in v]), shared_class_of("word"))
    chance = F.when(F.col("c").isNull(), by_class(outside)).otherwise(by_class(inside) + F.log10("c"))
    sums = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(rare & F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.when(rare, F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(denominator))).otherwise(0.0)).alias("base_score"),
        F.sum(F.col("model") + F.when(rare, F.col("n") * chance).otherwise(0.0)).alias("score"))
    return sums.select("doc_id", (fold == held).alias("held_out"), "n_tokens", "n_known",
                       F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
