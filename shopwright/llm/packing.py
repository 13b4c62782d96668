"""Best-fit packing of tokenised documents into sequences.

Large-item matching on the histogram of piece lengths: lengths above a third
of the capacity are matched greedily, at most two to a sequence (the longest
with the longest partner that fits); shorter lengths follow in falling order,
each into the smallest gap that holds it.  The histogram has at most
``capacity`` entries whatever the corpus holds, so the plan is bounded; the
pieces themselves never leave the tasks.  A piece finds its place by its rank
among pieces of its length, numbered per bucket so that a length that many
copies share is spread.

Nulls and edge cases: a null text is empty (its ids are the end id alone); a
row with a null doc_id is packed too, its doc_id stays null; repeated rows
are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: entries of a worker's word cache before it starts afresh, and bytes of text taken at a time (both bound memory)
CACHE, SLICE = 400_000, 12_000_000
_TOKENIZERS: dict[str, "WordEncoder"] = {}
_SIMPLE = re.compile(r"([A-Za-zß-öø-ÿ]+)([.,!?|*&%$#]*)")


class WordEncoder:
    """Ids of texts by their white-space separated words, each distinct word encoded once.

    The tokenizer's own normaliser and splitter never join characters across
    white space, so the ids of a text are those of its words in order.  A run
    of letters or of signs is one unit to the splitter; in ASCII and lower
    case its bytes are its characters, so it goes straight to the merges.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.merges = self.whole.model
        self.parts: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}

    def _ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            if part.isascii():
                got = b"".join([x.id.to_bytes(4, "little") for x in self.merges.tokenize(part)])
            else:
                got = self._ids(part)
            self.parts[part] = got
        return got

    def word(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            m = _SIMPLE.fullmatch(word)
            got = self.words[word] = self._part(m[1].lower()) + self._part(m[2]) if m else self._ids(word)
        return got

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of the words, as bytes."""
        if len(self.words) >= CACHE:
            self.words = {"": b""}
        if len(self.parts) >= CACHE:
            self.parts = {"": b""}
        get, word = self.words.get, self.word
        return [get(w) or word(w) for w in words]

    def texts(self, column: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other (``end`` closes each text), and where each text's ids end."""
        split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        coded = split.flatten().dictionary_encode()
        known = self.learn(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        at = np.asarray(coded.indices)
        n = sizes[at]
        before = np.cumsum(n)
        pool = np.frombuffer(b"".join(known), "<u4")
        starts = (np.cumsum(sizes) - sizes)[at]
        shift = starts - (before - n)
        kind = np.int32 if max(len(pool), len(n) and before[-1]) < 2 ** 31 else np.int64
        ids = pool[np.repeat(shift.astype(kind), n) + np.arange(n.sum(), dtype=kind)]
        offsets = np.asarray(split.offsets)
        stops = np.concatenate(([0], before))[offsets[1:] - offsets[0]]
        if end is None:
            return ids, stops
        return np.insert(ids, stops, np.uint32(end)), stops + np.arange(1, len(stops) + 1)

    def text(self, text: str) -> bytes:
        return self.texts(pa.array([text], pa.string()))[0].tobytes()


def encoder(path: str) -> WordEncoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordEncoder(path)
    return _TOKENIZERS[path]


def slices(batches):
    """The rows of (id, text) batches in runs of about SLICE bytes of text (a longer text is a run of its own)."""
    held, size = [], 0
    for b in (b for b in batches if b.num_rows):
        grown = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        for k in range(b.num_rows):
            if k > first and size + grown[k] - (grown[first - 1] if first else 0) > SLICE:
                held.append(b.slice(first, k - first))
                yield pa.concat_batches(held)
                held, size, first = [], 0, k
        held.append(b.slice(first))
        size += int(grown[-1] - (grown[first - 1] if first else 0))
        if size >= SLICE:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut at ``capacity``."""
    def run(batches):
        enc = encoder(tokenizer)
        for b in slices(batches):
            ids, stops = enc.texts(b.column(1), end_id)
            raw, out, first = memoryview(ids.tobytes()), [], 0
            for doc, stop in zip(b.column(0).to_pylist(), stops.tolist()):
                for piece, k in enumerate(range(first, stop, capacity)):
                    z = min(k + capacity, stop)
                    out.append((doc, piece, k - first, z - k, zlib.crc32(raw[4 * k:4 * z])))
                first = stop
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32())] + [pa.array(c, pa.int64()) for c in cols[2:]],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long"))


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Placements (length, first rank, pieces, first sequence, pieces per sequence, offset).

    ``gaps`` maps a gap to runs of equally filled sequences (first, count).
    """
    left, out, made = dict(histogram), [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    rank = dict.fromkeys(histogram, 0)

    def opened(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                bisect.insort(order, gap)
            gaps.setdefault(gap, []).append((first, count))

    def put(length: int, count: int, first: int, each: int, offset: int) -> None:
        out.append((length, rank[length], count, first, each, offset))
        rank[length] += count
        left[length] -= count

    large = sorted(x for x in histogram if 3 * x > capacity)
    for x in reversed(large):
        while left[x]:
            mates = [y for y in large if y <= min(x, capacity - x) and left[y]]
            if mates and (mates[-1] != x or left[x] > 1):
                y = mates[-1]
                if y == x:
                    n = left[x] // 2
                    put(x, 2 * n, made, 2, 0)
                else:
                    n = min(left[x], left[y])
                    put(x, n, made, 1, 0)
                    put(y, n, made, 1, x)
                opened(capacity - x - y, made, n)
            else:
                mates = [y for y in mates if y != x]
                if mates:
                    n = min(left[x], left[mates[-1]])
                    put(x, n, made, 1, 0)
                    put(mates[-1], n, made, 1, x)
                    opened(capacity - x - mates[-1], made, n)
                else:
                    n = left[x]
                    put(x, n, made, 1, 0)
                    opened(capacity - x, made, n)
            made += n
    for x in sorted((x for x in histogram if 3 * x <= capacity), reverse=True):
        while left[x]:
            at = bisect.bisect_left(order, x)
            if at == len(order):
                each = capacity // x
                opened(capacity, made, -(-left[x] // each))
                made += -(-left[x] // each)
                at = len(order) - 1
            gap = order[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            each = gap // x
            full, rest = divmod(min(left[x], count * each), each)
            if full:
                put(x, full * each, first, each, capacity - gap)
                opened(gap - each * x, first, full)
            if rest:
                put(x, rest, first + full, rest, capacity - gap)
                opened(gap - rest * x, first + full, 1)
            used = full + bool(rest)
            opened(gap, first + used, count - used)
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, buckets: int | None = None) -> DataFrame:
    """pieces() with sequence_id and offset."""
    spark = docs.sparkSession
    common.prepare(spark)
    n = buckets or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the bucket comes from the row's content, so a task that runs again numbers its rows alike
    got = common.cut(pieces(docs, tokenizer, capacity, end_id)
                     .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)).cast("int")))
    counts = got.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = spark.createDataFrame(plan(histogram, capacity) or [(0, 0, 0, 0, 1, 0)],
                                   "length long, first_rank long, n long, first_seq long, each long, at long")
    by_length = places.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first_rank", "n", "first_seq", "each", "at"))).alias("places"))
    before = counts.select("length", "bucket", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inner = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (got.withColumn("r", F.row_number().over(inner) - 1).join(before, ["length", "bucket"])
              .withColumn("rank", F.col("r") + F.col("before")).join(F.broadcast(by_length), "length")
              .withColumn("p", F.filter("places", lambda p: (p["first_rank"] <= F.col("rank")) & (F.col("rank") < p["first_rank"] + p["n"]))[0])
              .withColumn("i", F.col("rank") - F.col("p.first_rank")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("p.first_seq") + F.floor(F.col("i") / F.col("p.each"))).cast("long").alias("sequence_id"),
                         (F.col("p.at") + F.pmod("i", "p.each") * F.col("length")).cast("long").alias("offset"))
