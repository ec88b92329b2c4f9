"""Importance resampling towards a target corpus, over hashed runs of words.

Two corpora are counted into the same buckets; a bucket's gain is the logarithm of its share in the
target over its share in the raw corpus, held as one array of whole numbers.  A text's weight is
the sum of the gains of its runs, and Gumbel noise from its id turns the greatest scores into a
draw without replacement.

The draw is a distributed quickselect.  Keys (score, id, ...) are all different, so each has one
place.  A few random keys are pivots; one aggregate counts what lies before, at and behind each;
the pivots around the wanted place bound the next round.  Only the winners are sorted.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.storage import written
from estatelens.llm.textbytes import PUNCTUATION, text_slices, word_spans

#: Longest word whose checksum is made by table; longer ones go to the library one by one.
LONG_WORD = 64


@dataclass(frozen=True)
class ResampleParams:
    """``per_cent`` of the texts with ``least_words`` words or more are drawn; ``runs``: longest
    run of words; ``buckets`` of the hashed runs; ``seed`` of the noise; ``pivots``: keys that one
    round of the selection tries."""

    per_cent: int = 5
    least_words: int = 20
    runs: int = 3
    buckets: int = 10_000
    seed: int = 42
    pivots: int = 15


def _byte_steps() -> np.ndarray:
    """The usual table of the reflected checksum, from its polynomial."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_STEP = _byte_steps()


def _zero_steps(most: int) -> np.ndarray:
    """``[n, i, v]``: what byte ``i`` of a checksum, being ``v``, becomes after ``n`` zero bytes."""
    out = np.empty((most + 1, 4, 256), np.uint32)
    for i in range(4):
        out[0, i] = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
    for n in range(most):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ _STEP[out[n] & np.uint32(255)]
    return out


_ZEROS = _zero_steps(LONG_WORD)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_checksums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of each word: all words take their next byte together, longest first."""
    order = np.argsort(-sizes, kind="stable")
    begin, length = starts[order], sizes[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    left = len(order)
    for i in range(int(min(length[:1].max(initial=0), LONG_WORD))):
        left = int(np.searchsorted(-length, -i, side="left"))
        now = state[:left]
        state[:left] = (now >> np.uint32(8)) ^ _STEP[(now ^ data[begin[:left] + i]) & 255]
    out = np.empty(len(order), np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(sizes > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i]:starts[i] + sizes[i]].tobytes())
    return out


def _followed(head: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Checksums of ``head`` followed by zero bytes; xor with the next part's gives the whole."""
    out = _ZEROS[sizes, 0, head & 255]
    for i in range(1, 4):
        out ^= _ZEROS[sizes, i, (head >> np.uint32(8 * i)) & 255]
    return out


def run_buckets(data: np.ndarray, offsets: np.ndarray, params: ResampleParams) -> tuple:
    """Words of each row, and ``(bucket, row)`` arrays for every length of run.

    A run's checksum follows from those of its head and its last word, without its bytes.
    """
    data = _LOWER[data]
    starts, ends, firsts = word_spans(data, offsets, PUNCTUATION)
    sizes, counts = ends - starts, np.diff(firsts)
    row = np.repeat(np.arange(len(counts)), counts)
    last = firsts[1:][row]
    words = word_checksums(data, starts, sizes)
    short = sizes <= LONG_WORD
    space = np.uint32(zlib.crc32(b" "))
    out, run = [(words % np.uint32(params.buckets), row)], words
    for n in range(2, params.runs + 1):
        size = max(len(words) - n + 1, 0)
        tail = np.minimum(sizes[n - 1:], LONG_WORD)
        spaced = _followed(run[:size], np.ones(size, np.int64)) ^ space
        run = _followed(spaced, tail) ^ words[n - 1:]
        for i in np.flatnonzero(~short[n - 1:]):
            whole = b" ".join(data[starts[j]:ends[j]].tobytes() for j in range(i, i + n))
            run[i] = zlib.crc32(whole)
        inside = np.flatnonzero(np.arange(size) + n <= last[:size])
        out.append((run[inside] % np.uint32(params.buckets), row[inside]))
    return counts, out


def bucket_counts(texts: DataFrame, params: ResampleParams, column: str = "text") -> DataFrame:
    """``bucket, n`` over all texts; a task sends each bucket once."""
    def count(batches):
        total = np.zeros(params.buckets, np.int64)
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                for buckets, _ in run_buckets(data, offsets, params)[1]:
                    total += np.bincount(buckets, minlength=params.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return texts.select(F.col(column).cast("string").alias("text")) \
        .mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, params: ResampleParams) -> np.ndarray:
    """Gain of every bucket, in whole thousandths; ``raw`` and ``target`` are bucket counts."""
    def counted(df: DataFrame) -> np.ndarray:
        out = np.zeros(params.buckets, np.int64)
        for bucket, n in df.collect():  # a row a bucket at most
            out[bucket] = n
        return out

    s, t = counted(raw), counted(target)
    all_s, all_t, size = int(s.sum()), int(t.sum()), params.buckets
    return np.array([math.floor(1000 * math.log(((int(b) + 1) * (all_s + size))
                                                / ((int(a) + 1) * (all_t + size))))
                     for a, b in zip(s, t)], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, params: ResampleParams, key: str = "doc_id",
             column: str = "text") -> DataFrame:
    """``key, n_words, n_features, weight, score`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches):
        gains = shared.value
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                words, runs = run_buckets(data, offsets, params)
                features = np.zeros(len(words), np.int64)
                weight = np.zeros(len(words), np.int64)
                for buckets, rows in runs:
                    at = np.searchsorted(rows, np.arange(len(words) + 1))
                    total = np.concatenate([[0], np.cumsum(gains[buckets])])
                    features += np.diff(at)
                    weight += np.diff(total[at])
                ids = batch.column(0).slice(first, len(words))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(words.astype(np.int64)), pa.array(features), pa.array(weight)],
                    ["key", "n_words", "n_features", "weight"])

    own = docs.select(F.col(key).alias("key"), F.col(column).cast("string").alias("text"))
    kind = own.schema["key"].dataType.simpleString()
    found = own.mapInArrow(weigh, f"key {kind}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{params.seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0))))
    return found.withColumn("score", F.col("weight") + noise)


KEY = ("score", "key", "n_features", "row")


def _place(score: Column, key: Column, runs: Column, row: Column) -> Column:
    """Less for better keys: score down, then id (NULL last), run count and row number."""
    return F.struct((-score).alias("a"), key.isNull().alias("b"), key.alias("c"),
                    runs.alias("d"), row.alias("e"))


def _own_place() -> Column:
    return _place(*map(F.col, KEY))


def _place_of(row, kind) -> Column:
    """Place of a collected row whose id has the type ``kind``."""
    score, key, runs, number = row
    return _place(F.lit(score).cast("long"), F.lit(key).cast(kind), F.lit(runs).cast("long"),
                  F.lit(number).cast("long"))


def kth_key(rows: DataFrame, k: int, pivots: int):
    """The row whose key has place ``k`` (from 1) among ``rows``, whose keys all differ.

    Each round reads what lies between two known keys; bounds on ``score`` reach the Parquet scan.
    """
    kind, own = rows.schema["key"].dataType, _own_place()
    low = high = None
    before, turn = 0, 0
    while True:
        turn += 1
        active = rows
        if low is not None:
            active = active.where((F.col("score") <= low[0]) & (own > _place_of(low, kind)))
        if high is not None:
            active = active.where((F.col("score") >= high[0]) & (own < _place_of(high, kind)))
        tried = active.orderBy(F.xxhash64("row", F.lit(turn)), "row").limit(pivots) \
            .select(*KEY).collect()
        # three-way counts: keys before each pivot; one is at it; the rest lie behind
        counted = active.agg(*[F.count_if(own < _place_of(p, kind)) for p in tried]).first()
        places = sorted((before + n + 1, i) for i, n in enumerate(counted))
        for place, i in places:
            if place == k:
                return tried[i]
            if place > k:
                high = tried[i]
                break
            low, before = tried[i], place


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` in the order of their keys, without a task that holds them all.

    Ranges of keys are sorted apart; a range's first rank is the number of rows in those before.
    """
    order = [F.desc("score"), F.asc_nulls_last("key"), F.asc("n_features"), F.asc("row")]
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("at", 33)
    sizes = sorted(dealt.groupBy(part.alias("part")).count().collect())  # a row a partition
    first, offsets = 0, []
    for number, size in sizes:
        offsets.append((number, first))
        first += size
    table = dealt.sparkSession.createDataFrame(offsets, "part long, first long")
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.withColumn("part", part).join(table, "part").withColumn(
        "rank", F.col("first") + within + 1)


def resample(docs: DataFrame, target: DataFrame, params: ResampleParams = ResampleParams(),
             key: str = "doc_id", column: str = "text") -> DataFrame:
    """``key, n_features, weight, score, rank`` of every row of ``docs``.

    Runs of up to ``runs`` words of all ``docs`` and all ``target`` texts are counted into buckets
    by CRC-32.  ``per_cent`` of the rows with ``least_words`` words (rounded down) are drawn by
    greatest score, ties to the smaller key; ``rank`` is their order and NULL elsewhere.

    NULL and empty texts have no runs and weight 0.  A NULL key is seeded as empty text and comes
    last in ties.  Repeated rows each count and may each be drawn; rows equal in score and key
    follow their number of runs.  Empty tables give no rows, or no gains from ``target``.  Other
    columns are ignored.  Only bucket counts, pivots and one number a partition reach the driver.
    """
    gains = bucket_gains(bucket_counts(docs, params, column), bucket_counts(target, params, column),
                         params)
    scored = written(weighted(docs, gains, params, key, column)
                     .withColumn("row", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_words") >= params.least_words)
    k = params.per_cent * able.count() // 100
    out = [F.col("key").alias(key), "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return scored.select(*out, none)
    last = _place_of(kth_key(able, k, params.pivots), scored.schema["key"].dataType)
    wins = (F.col("n_words") >= params.least_words) & (_own_place() <= last)
    return ranked(scored.where(wins)).select(*out, "rank").union(
        scored.where(~wins).select(*out, none))
