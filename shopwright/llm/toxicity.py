"""Toxicity by weak supervision.

Voters look at a text alone: a fixed lexicon, lexicons induced from the
labelled training rows (words and word beginnings, dealt by hash into several
voters) and surface patterns.  A generative label model, fitted by EM on the
counts of vote patterns, estimates each voter's accuracy; voters whose votes
stay correlated within the classes are joined into one factor over their
joint votes.  Its posteriors label a bounded sample of training rows, on
which a logistic regression over words and word beginnings is fitted; that
linear classifier scores every text.

The fit uses at most ``max_rows`` labelled rows (the first by a hash of
doc_id) whose crc32(doc_id) mod 5 is not 0; scoring covers all rows.

Nulls and edge cases: a null text is empty; an empty text gets the score of
the intercept; without labelled rows of both classes every score is near 0; repeated rows are scored one by one; held_out is null for
a null doc_id; labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: fixed values: a seed lexicon of plain insults
LEXICON = frozenset("idiot moron stupid loser clown trash scum worthless pathetic disgusting".split())
INDUCED, EDGE = 5, ".,;:!?\"'()[]*%&$#|"


def features(text: str) -> set[str]:
    out = set()
    for w in set(text.lower().split()):
        w = w.strip(EDGE)
        if w:
            out.add(w)
            out.update(f"{w[:n]}~" for n in (4, 5, 6) if len(w) > n)
    return out


def votes(text: str, seen: set[str], lexicons: list[frozenset]) -> tuple[int, ...]:
    """1 toxic, -1 clean, 0 abstains."""
    letters = sum(map(str.isalpha, text)) or 1
    pattern = sum(map(str.isupper, text)) / letters > 0.5 or text.count("!") > 0.02 * len(text) + 2
    return (1 if seen & LEXICON else 0, *(1 if seen & x else -1 for x in lexicons), 1 if pattern else 0,
            1 if re.search(r"\b(you|your) \w* ?(are|is) ", text.lower()) else 0)


def induce(rows: list[tuple[set[str], int]], least: int = 4, ratio: float = 4.0) -> list[frozenset]:
    """Features that mark toxic training rows, dealt over INDUCED voters by hash."""
    seen = [Counter(), Counter()]
    size = [1, 1]
    for f, y in rows:
        seen[y].update(f)
        size[y] += 1
    lists: list[set] = [set() for _ in range(INDUCED)]
    for f, n in seen[1].items():
        if n >= least and math.log((n + 0.5) / size[1] * size[0] / (seen[0][f] + 0.5)) > ratio / 1.5 and n > 3 * seen[0][f]:
            lists[zlib.crc32(f.encode()) % INDUCED].add(f)
    return [frozenset(x) for x in lists]


def label_model(patterns: Counter, prior: float, rounds: int = 60, linked: float = 0.15) -> dict[tuple, float]:
    """P(toxic | votes) for each vote pattern: EM with correlated voters joined into pairs."""
    keys = list(patterns)
    v, n = np.array(keys), np.array([patterns[k] for k in keys], float)
    post = np.clip((v == 1).sum(1) / 2.0, 0.02, 0.98)
    groups = [(j,) for j in range(v.shape[1])]
    for step in range(rounds):
        if step == rounds // 2:  # correlation within the classes, by the accuracies so far
            strength = []
            for a in range(v.shape[1]):
                for b in range(a):
                    c = 0.0
                    for w in (n * post, n * (1 - post)):
                        x, y = (z - np.average(z, weights=w + 1e-9) for z in (v[:, a], v[:, b]))
                        cov, sd = (w * x * y).sum(), math.sqrt((w * x * x).sum() * (w * y * y).sum())
                        c += cov / sd * w.sum() / n.sum() if sd > 1e-9 else 0.0
                    strength.append((abs(c), b, a))
            used, pairs = set(), []
            for c, a, b in sorted(strength, reverse=True):
                if c > linked and not used & {a, b}:
                    used |= {a, b}
                    pairs.append((a, b))
            groups = pairs + [(j,) for j in range(v.shape[1]) if j not in used]
        log = np.tile(np.log([[prior], [1 - prior]]), (1, len(keys)))
        for g in groups:
            states = [tuple(r) for r in v[:, g]]
            for y, w in enumerate((n * post, n * (1 - post))):
                table: dict = defaultdict(float)
                for s, x in zip(states, w):
                    table[s] += x
                total = sum(table.values()) + 3 ** len(g)
                log[y] += [math.log((table[s] + 1) / total) for s in states]
        post = 1 / (1 + np.exp(np.clip(log[1] - log[0], -50, 50)))
    return dict(zip(keys, post.tolist()))


def fit(rows: list[tuple[str, int]], rounds: int = 300, rate: float = 0.5, least: int = 3) -> tuple[dict[str, float], float]:
    """(weights, intercept) from labelled texts."""
    if not rows or len({y for _, y in rows}) < 2:
        return {}, -50.0
    pool: dict[str, str] = {}
    seen = [({pool.setdefault(x, x) for x in features(t)}, y) for t, y in rows]
    lexicons = induce(seen)
    cast = [votes(t, f, lexicons) for (t, _), (f, _) in zip(rows, seen)]
    posterior = label_model(Counter(cast), np.mean([y for _, y in rows]))
    y = np.array([posterior[c] for c in cast])
    df, mass = Counter(), Counter()
    for (f, _), p in zip(seen, y.tolist()):
        df.update(f)
        for x in f:
            mass[x] += p
    # features whose posterior rate stands above the whole by three standard errors: the
    # many neutral words of a long text must not add up
    rate0 = y.mean()
    ids = {f: i for i, f in enumerate(sorted(f for f, n in df.items() if n >= least and mass[f] / n - rate0 > 3 * math.sqrt(rate0 * (1 - rate0) / n)))}
    if not ids:
        return {}, math.log(rate0 / (1 - rate0))
    at = [np.fromiter((ids[x] for x in f if x in ids), np.int64) for f, _ in seen]
    row, col = np.repeat(np.arange(len(at)), [len(a) for a in at]), np.concatenate(at)
    w, b, grad2 = np.zeros(len(ids)), math.log(y.mean() / (1 - y.mean())), np.full(len(ids), 1e-2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], len(at)) + b, -30, 30)))
        g = np.bincount(col, (p - y)[row], len(ids)) + 0.002 * w
        grad2 += g * g
        w -= rate * g / np.sqrt(grad2)
        b -= 2 * rate * (p - y).mean()
    return {f: float(w[i]) for f, i in ids.items() if abs(w[i]) > 0.02}, float(b)


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 3_000) -> DataFrame:
    """One row per document.  An id labelled both toxic and not counts as toxic; of the
    documents' columns only doc_id and text are read."""
    common.prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    wanted = (labels.where("toxic is not null and doc_id is not null").where(fold != 0)
              .groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    sample = (docs.join(wanted, docs["doc_id"] == wanted["_id"]).select("_id", F.coalesce("text", F.lit("")).alias("text"), "toxic")
              .orderBy("_id").collect())  # at most max_rows labelled rows
    weights, start = fit([(r["text"], r["toxic"]) for r in sample])
    held = docs.sparkSession.sparkContext.broadcast((weights, start))

    def run(batches):
        w, b0 = held.value
        known: dict[str, tuple] = {}
        for b in batches:
            scores = []
            for text in b.column(1).to_pylist():
                hit: set[str] = set()
                for word in set((text or "").lower().split()):
                    f = known.get(word)
                    if f is None:
                        if len(known) > 400_000:
                            known.clear()
                        f = known[word] = tuple(x for x in features(word) if x in w)
                    hit.update(f)
                z = b0 + sum(w[x] for x in sorted(hit))
                scores.append(1 / (1 + math.exp(-max(-50.0, min(50.0, z)))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])
    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
            .select("doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
