"""Quality rules: a ledger of rule failures, and policies over it.

``ledger`` measures every text once and stores, per row, the measurements and
one bit per failed rule (``fail_bits``, bit k for the k-th rule of RULES) as a
narrow Parquet table below the checkpoint folder.  A policy is a versioned bit
mask: ``apply_policy`` keeps the rows with ``fail_bits & mask = 0`` and never
touches a text.  ``ablation`` counts the rows per distinct failure pattern (a
partial aggregate, at most 2**rules patterns) and tells, for each rule of a
policy, how many rows it fails, how many it alone rejects and how many the
policy would keep without it, all by bit operations on the patterns.

Words are runs of anything but the six ASCII white-space characters.  Texts
are measured in blocks of some megabytes with numpy; the 8-word windows are
compared exactly (pairs of pairs of pairs, numbered by sorting), not by hash.

Nulls and edge cases: a null text has no words and fails like an empty one;
rows with a null or repeated doc_id are judged one by one; a text of any
length is measured whole; an empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from ..session import stored

WINDOW = 8
#: bytes of text measured at a time
BLOCK = 4_000_000
#: fixed values: characters that count as symbols, those that open a list line, those that end a cut line
SYMBOLS = b"#*$%&|<>"
_BULLETS = tuple(x.encode() for x in ("-", "*", "•"))
_ELLIPSES = tuple(x.encode() for x in ("...", "…"))

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words",
            "n_bullet_lines", "n_ellipsis_lines", "top_word", "n_stutters"]

#: (name, condition under which a text fails); the position is the bit, so rules are only ever appended
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 10 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines"),
    ("few_letters", "100 * n_letter_words < 80 * n_words"),
    ("bullets", "100 * n_bullet_lines > 90 * n_lines"),
    ("ellipses", "100 * n_ellipsis_lines > 30 * n_lines"),
    ("top_word", "100 * top_word > 30 * n_words"),
    ("stutters", "100 * n_stutters > 20 * n_words"),
]
BASE = ("few_words", "repeated_windows")

#: policy version -> its rules; a published version never changes
POLICIES = {
    "base": BASE,
    "v1": tuple(name for name, _ in RULES if name not in ("bullets", "ellipses", "top_word", "stutters")),
    "v2": tuple(name for name, _ in RULES),
}

_WHITE, _SYMBOL, _LETTER = (np.zeros(256, bool) for _ in range(3))
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL[list(SYMBOLS)] = True
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _per_text(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` per text; text k ends before position ends[k]."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[ends], prepend=0)


def _numbers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each distinct pair."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def _repeated(word: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Words of each text that lie in a window met twice or more in that text.

    ``word``: numbers that differ for different words and for different texts,
    so a window that reaches into the next text is met once only.
    """
    code, size = word, 1
    while size < WINDOW and len(code) > size:
        code = _numbers(code[:-size], code[size:])  # the 2 * size words from each position
        size *= 2
    at = np.flatnonzero(np.bincount(code)[code] > 1) if len(word) >= WINDOW else word[:0]
    edge = np.bincount(at, minlength=len(word) + WINDOW) - np.bincount(at + WINDOW, minlength=len(word) + WINDOW)
    return np.bincount(text[np.cumsum(edge)[:len(word)] > 0], minlength=n_texts)


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """MEASURES of each text."""
    n, out, ids = len(texts), {}, {}
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    white = _WHITE[raw]
    out["word_chars"] = _per_text(~white & ((raw & 0xC0) != 0x80), ends)
    out["n_symbols"] = _per_text(_SYMBOL[raw], ends)
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    out["n_words"] = sizes
    text = np.repeat(np.arange(n), sizes)
    for w in split:
        for x in set(w):
            ids.setdefault(x, len(ids))
    number = np.fromiter((ids[x] for w in split for x in w), np.int64, int(sizes.sum()))
    word = text * max(1, len(ids)) + number
    out["n_repeat_words"] = _repeated(word, text, n)
    each, times = np.unique(word, return_counts=True)
    out["top_word"] = np.zeros(n, np.int64)
    np.maximum.at(out["top_word"], each // max(1, len(ids)), times)
    out["n_stutters"] = np.bincount(text[1:][word[1:] == word[:-1]], minlength=n)
    letter = np.fromiter((bool(_LETTER[np.frombuffer(x, np.uint8)].any()) for x in ids), bool, len(ids))
    out["n_letter_words"] = np.bincount(text[letter[number]], minlength=n)
    lines = np.zeros((n, 4), np.int64)
    for k, t in enumerate(texts):
        full = [x for x in t.split(b"\n") if x.strip()]
        if full:
            ends_in = [x.strip() for x in full]
            lines[k] = (len(full), len(full) - len(set(full)), sum(x.startswith(_BULLETS) for x in ends_in),
                        sum(x.endswith(_ELLIPSES) for x in ends_in))
    out["n_lines"], out["n_dup_lines"], out["n_bullet_lines"], out["n_ellipsis_lines"] = lines.T
    return out


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, MEASURES) of every row."""
    common.prepare(docs.sparkSession)
    names = ["doc_id", *MEASURES]

    def run(batches):
        def block(ids, texts):
            m = measure(texts)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(m[x].astype(np.int64)) for x in MEASURES]], names)
        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                if texts and size + len(t) > BLOCK:
                    yield block(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
            if texts:
                yield block(ids, texts)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def mask(names) -> int:
    """The bit mask of some rules."""
    return sum(1 << k for k, (name, _) in enumerate(RULES) if name in names)


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, MEASURES, fail_bits), written once below the checkpoint folder."""
    bits: Column = F.lit(0).cast("long")
    for k, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return stored(measured(docs).withColumn("fail_bits", bits), "rule_ledger")


def apply_policy(rows: DataFrame, version: str = "v2") -> DataFrame:
    """The ledger with base_failed, kept and sole_rule: the policy's rule that alone rejects the row, or ``none``."""
    in_policy = F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[version])).cast("long"))
    base = F.col("fail_bits").bitwiseAND(F.lit(mask(BASE)).cast("long"))
    sole = F.lit("none")
    for k, (name, _) in enumerate(RULES):
        sole = F.when(in_policy == F.lit(1 << k), F.lit(name)).otherwise(sole)
    return rows.select("*", (base != 0).alias("base_failed"), ((base == 0) & (in_policy == 0)).alias("kept"), sole.alias("sole_rule"))


def ablation(rows: DataFrame, version: str = "v2") -> DataFrame:
    """rule, n_failed, n_sole, n_kept, n_kept_without: the policy with all its rules and without each."""
    chosen = mask(POLICIES[version])
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
                                for k, (name, _) in enumerate(RULES) if chosen >> k & 1])).alias("x")
    in_policy = F.col("fail_bits").bitwiseAND(F.lit(chosen).cast("long"))

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long").alias(name)
    return (patterns.select("n", in_policy.alias("bits"), rules).select("n", "bits", "x.rule", "x.bit").groupBy("rule")
            .agg(total(F.col("bits").bitwiseAND(F.col("bit")) != 0, "n_failed"), total(F.col("bits") == F.col("bit"), "n_sole"),
                 total(F.col("bits") == 0, "n_kept"),
                 total(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0, "n_kept_without")))


def judge(docs: DataFrame, version: str = "v2") -> DataFrame:
    """Every row with its measurements, fail_bits, base_failed, kept, sole_rule and
    n_kept_without_sole: rows the policy would keep without the rule that alone rejects this one (0: none does)."""
    rows = apply_policy(ledger(docs), version)
    freed = ablation(rows, version).select(F.col("rule").alias("sole_rule"), F.col("n_kept_without").alias("n_kept_without_sole"))
    return (rows.join(F.broadcast(freed), "sole_rule", "left")  # one row a rule
            .select(*rows.columns, F.coalesce("n_kept_without_sole", F.lit(0).cast("long")).alias("n_kept_without_sole")))
