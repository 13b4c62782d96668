"""SimHash near-duplicate groups through deletion-variant signatures.

A 64-bit fingerprint is cut into ``distance // 2 + 1`` segments: of two
fingerprints that differ in at most ``distance`` bits, one segment differs in
at most one bit.  Every fingerprint is indexed under each segment with one
bit blanked out; an equality join on (segment, blanked bit, value) finds all
candidates, and the join condition verifies the distance.  Each pair is kept
only under the first key that it shares, so it comes out once.

Nulls and edge cases: a null or word-less text has fingerprint 0 and links
like any other; rows with a null doc_id are left out (nothing can name
them); repeated doc_ids give one row per input row; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CHUNK = 65_536


def bit_majority(digests: bytes) -> int:
    """Fingerprint of concatenated little-endian 64-bit hashes."""
    n = len(digests) // 8
    counts = np.zeros(2048, np.int64)
    for k in range(0, len(digests), 8 * CHUNK):
        part = np.frombuffer(digests[k:k + 8 * CHUNK], np.uint8).reshape(-1, 8)
        counts += np.bincount((part + np.arange(0, 2048, 256)).ravel(), minlength=2048)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    ones = counts.reshape(8, 256) @ bits.astype(np.int64)
    return int(np.packbits((2 * ones > n).ravel(), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, shingle: int) -> int:
    """``bytes.lower`` lower-cases A-Z only; ``bytes.split`` cuts at the six ASCII white-space characters."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:n - 1])).tolist()
    ends = (ends[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_digest
    big = b"".join([digest(joined[a:b], 42) for a, b in zip(starts, ends)])
    return bit_majority(np.frombuffer(big, ">u8").astype("<u8").tobytes())


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the unsigned fingerprint's bits in a long."""
    def run(batches):
        for b in batches:
            fps = [fingerprint(t or b"", shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())], ["doc_id", "fp"])
    return (docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("t"))
            .mapInArrow(run, "doc_id long, fp long"))


def links(fps: DataFrame, distance: int) -> DataFrame:
    """(a, b): distinct fingerprints, a < b, at most ``distance`` bits apart; each pair once."""
    m = distance // 2 + 1
    cuts = [64 * k // m for k in range(m + 1)]
    masks = []
    for lo, hi in zip(cuts, cuts[1:]):
        whole = ((1 << hi) - 1) ^ ((1 << lo) - 1)
        masks += [(p, whole, 1 << p) for p in range(lo, hi)]  # the slot is the blanked bit
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    keys = F.array(*[F.struct(F.lit(i).alias("slot"), F.col("fp").bitwiseAND(F.lit(signed(w & ~bit))).alias("key")) for i, w, bit in masks])
    index = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.slot", "k.key")
    x = F.col("a").bitwiseXOR(F.col("b"))
    # the first slot a pair shares: no earlier segment differs in at most one bit
    first = F.lit(-1)
    for lo, hi in reversed(list(zip(cuts, cuts[1:]))):
        part = x.bitwiseAND(F.lit(signed(((1 << hi) - 1) ^ ((1 << lo) - 1))))
        inner = F.when(part == 0, F.lit(lo))
        for p in range(lo, hi):
            inner = inner.when(part == F.lit(signed(1 << p)), F.lit(p))
        first = F.when(F.bit_count(part) <= 1, inner).otherwise(first)
    left = index.select(F.col("fp").alias("a"), "slot", "key")
    right = index.select(F.col("fp").alias("b"), F.col("slot").alias("slot2"), F.col("key").alias("key2"))
    return left.join(right, (F.col("slot") == F.col("slot2")) & (F.col("key") == F.col("key2")) & (F.col("a") < F.col("b"))
                     & (F.bit_count(x) <= distance) & (F.col("slot") == first)).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, links (of its fingerprint to other fingerprints).

    Documents with equal fingerprints are folded into one node first, so
    copies are never expanded into pairs.
    """
    common.prepare(docs.sparkSession)
    fps = common.cut(fingerprints(docs, shingle))
    nodes = common.cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    pairs = common.cut(links(nodes.select("fp"), distance))
    name = nodes.select(F.col("fp"), F.col("first_id"))
    edges = (pairs.join(name.toDF("a", "ia"), "a").join(name.toDF("b", "ib"), "b")
             .select(F.col("ia").alias("a"), F.col("ib").alias("b")))
    roots = common.components(edges, nodes.select(F.col("first_id").alias("node"))).toDF("first_id", "component_id")
    degree = (pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("links")))
    classes = (nodes.join(roots, "first_id").join(degree, "fp", "left")
               .select("fp", "component_id", F.coalesce("links", F.lit(0)).alias("links")))
    return (fps.join(classes, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "links"))
