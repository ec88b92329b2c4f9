"""Best-fit packing with exact complements, planned on length counts.

Texts become ids, ids become pieces of at most ``capacity``; only the number of pieces of each
length, at most ``capacity`` numbers, comes to the driver.  There lengths are taken from the
longest: its gap is looked up among single lengths, then sums of two, then of three, and as many
sequences as the counts allow are closed at once.  What has no exact complement is packed best-fit,
again by counts.  The plan says for each length which ranks go where; ranks come from counted
buckets, so equal lengths never meet in one task.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.storage import written
from estatelens.llm.textbytes import text_slices
from estatelens.llm.tokens import word_ids

BUCKET_ROWS = 20_000
SLICE_BYTES = 1 << 22  # texts whose chunks are numbered together


class Complements:
    """Available lengths, with an index of the sums of two of them."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.capacity = len(counts) - 1
        self._sums = None

    def take(self, lengths: tuple[int, ...]) -> int:
        """Consumes as many sequences of these lengths as the counts allow."""
        need = Counter(lengths)
        times = min(int(self.counts[x]) // k for x, k in need.items())
        if times:
            for x, k in need.items():
                self.counts[x] -= times * k
                if self.counts[x] < 2:
                    self._sums = None
        return times

    def _pairs(self) -> np.ndarray:
        """For each sum, whether two available lengths make it (a double needs two pieces)."""
        if self._sums is None:
            there = self.counts > 0
            sums = np.zeros(self.capacity + 1, bool)
            for a in np.flatnonzero(there):
                sums[2 * a + 1:] |= there[a + 1:self.capacity - a + 1][:len(sums[2 * a + 1:])]
                if 2 * a <= self.capacity and self.counts[a] > 1:
                    sums[2 * a] = True
            self._sums = sums
        return self._sums

    def _two(self, gap: int) -> tuple[int, int] | None:
        a = np.arange(gap // 2 + gap % 2, gap)
        ok = (self.counts[a] > 0) & (self.counts[gap - a] > (2 * a == gap))
        hit = np.flatnonzero(ok)
        return (int(a[hit[-1]]), gap - int(a[hit[-1]])) if len(hit) else None

    def fill(self, longest: int):
        """Combinations that hold ``longest`` and fill a sequence exactly, with their numbers."""
        gap, counts = self.capacity - longest, self.counts
        if counts[longest] and gap and (times := self.take((longest, gap))):
            yield (longest, gap), times
        while counts[longest] and (two := self._two(gap)):
            if not (times := self.take((longest, *two))):
                break
            yield (longest, *two), times
        while counts[longest]:
            third = np.flatnonzero((counts[:gap] > 0) & self._pairs()[gap:0:-1])
            for c in third[::-1]:
                two = self._two(gap - int(c))
                if two and (times := self.take((longest, int(c), *two))):
                    yield (longest, int(c), *two), times
                    break
            else:
                break


def plan_sequences(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, sequences)`` that use up ``counts[length]`` pieces of every length."""
    capacity = len(counts) - 1
    left = Complements(np.array(counts, np.int64))
    rest, plan = np.zeros(capacity + 1, np.int64), []
    if left.counts[capacity]:
        plan.append(((capacity,), int(left.counts[capacity])))
        left.counts[capacity] = 0
    for longest in range(capacity - 1, 0, -1):
        if left.counts[longest]:
            plan += left.fill(longest)
            rest[longest], left.counts[longest] = left.counts[longest], 0
            left._sums = None if rest[longest] else left._sums
    return plan + _best_fit(rest)


def _best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    capacity = len(counts) - 1
    open_: dict[int, list] = defaultdict(list)  # gap: (lengths, sequences)
    filled = np.zeros(capacity + 1, bool)

    def put(lengths: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(lengths)
        open_[gap].append((lengths, n))
        filled[gap] = True

    for length in range(capacity, 0, -1):
        n = int(counts[length])
        while n:
            fits = np.flatnonzero(filled[length:])
            if not len(fits):
                many = capacity // length
                if n >= many:
                    put((length,) * many, n // many)
                if n % many:
                    put((length,) * (n % many), 1)
                break
            gap = length + int(fits[0])
            lengths, bins = open_[gap].pop()
            if not open_[gap]:
                filled[gap] = False
            used = min(n, bins)
            if bins > used:
                put(lengths, bins - used)
            put((*lengths, length), used)
            n -= used
    return [entry for entries in open_.values() for entry in entries]


def document_pieces(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0,
                    keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every text of ``docs``."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def cut(batches):
        encoder = word_ids(path, end)
        for batch in batches:
            doc_ids = batch.column(0)
            for first, data, offsets in text_slices(batch.column(1), SLICE_BYTES):
                raw, bounds = data.tobytes(), offsets.tolist()
                ids, begin = encoder.encode([raw[a:b] for a, b in zip(bounds, bounds[1:])])
                begin = begin.tolist()
                rows, pieces, starts, lengths, sums, held = [], [], [], [], [], []
                for row, (low, high) in enumerate(zip(begin, begin[1:])):
                    for piece, at in enumerate(range(low, high, capacity)):
                        part = ids[at:min(at + capacity, high)]
                        rows.append(first + row)
                        pieces.append(piece)
                        starts.append(at - low)
                        lengths.append(len(part))
                        sums.append(zlib.crc32(part.astype("<u4").tobytes()))
                        if keep_ids:
                            held.append(part.astype(np.int32))
                columns = [doc_ids.take(pa.array(rows)), pa.array(pieces, pa.int32()),
                           pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                           pa.array(sums, pa.int64())]
                if keep_ids:
                    columns.append(pa.array(held, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        cut, schema + (", ids array<int>" if keep_ids else ""))


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (a stored table with ``length``) with ``sequence_id`` and ``offset``."""
    found = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in found:
        counts[row.length] = row["count"]
    slots, base = [], 0
    used = np.zeros(capacity + 1, np.int64)
    for lengths, sequences in plan_sequences(counts):
        offset = 0
        for length in lengths:
            slots.append((length, int(used[length]), base, offset))
            used[length] += sequences
            offset += length
        base += sequences
    slots = np.array(sorted(slots), np.int64).reshape(-1, 4)
    keys = (slots[:, 0] << 44) + slots[:, 1]
    shared = pieces.sparkSession.sparkContext.broadcast((keys, slots))

    # ranks: number rows inside (length, bucket), shift by the rows of the buckets before
    buckets = max(16, -(-int(counts.sum()) // BUCKET_ROWS))
    dealt = pieces.withColumn("_bucket", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = (dealt.groupBy("length", "_bucket").count()
              .withColumn("_before", F.sum("count").over(
                  Window.partitionBy("length").orderBy("_bucket")) - F.col("count"))
              .select("length", "_bucket", "_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (dealt.withColumn("_in", F.row_number().over(inside) - 1)
              .join(before, ["length", "_bucket"])
              .withColumn("_rank", F.col("_before") + F.col("_in"))
              .select(*pieces.columns, "_rank"))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    names = [f.name for f in schema]
    at = pieces.columns.index("length")

    def place(batches):
        keys, slots = shared.value
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy()
            length = batch.column(at).to_numpy()
            slot = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            sequence = slots[slot, 2] + rank - slots[slot, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(slots[slot, 3])], names)

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0,
                   keep_ids: bool = False) -> DataFrame:
    """Packs all ``docs(doc_id, text, ...)``: one row per piece with its sequence and offset.

    A text is its ids and then ``end``; NULL and empty texts are ``end`` alone.  Only texts longer
    than ``capacity`` are cut.  Every row of the input is packed, repeated rows and rows without
    doc_id included; other columns are ignored; an empty table gives no rows.  Equal lengths are
    interchangeable, so which of them stand together is a matter of rank, fixed by doc_id.
    """
    pieces = written(document_pieces(docs, path, capacity, end, keep_ids), "pieces")
    return place_pieces(pieces, capacity)
