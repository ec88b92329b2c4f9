"""N-gram Jaccard join: size-aware heavy-light search for sets of word shingles.

Texts with equal shingle sets form one class.  Two unlike sets of similarity at least ``t`` must
share one of the ``n - ceil(t n) + 1`` first elements of each, in any order common to all sets;
with one element more they must share two.  Small (light) sets list all pairs of their first
elements as keys, so that only sets that agree in two of them meet; large (heavy) sets, whose
pairs would be too many, list single elements, and so do small sets that a large one could match.
The boundary is the size up to which the pairs cost less than scanning the single lists.

The common order puts rare shingles first.  How often a shingle occurs is read from a count
sketch of all documents: a fixed number of counters, so it may be sent to every task; collisions
only make the order less good, never the join wrong.

Lists are turned into links in rounds: each member with one head of its lists, then those outside
a list's largest component with random members of it, and last all pairs that are still in
different components.  A parity bitmap of each set
bounds the difference from below and drops pairs without their texts; all others are verified on
the whole texts.  So components are exact without listing all pairs of a group of copies.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.components import components
from estatelens.llm.storage import (brought_back, drop_shuffles, passing_tables, set_aside,
                                    written)
from estatelens.llm.textbytes import (combine, give_back, shingle_hashes, text_slices, word_hashes,
                                      word_spans)

SKETCH_CHUNK = 1 << 16
BITMAP_WORDS = 16
HUB_MEMBERS = 1000
DRAWS = 4


@dataclass(frozen=True)
class JaccardParams:
    """``percent``: least similarity; ``shingle``: words in a run; ``sketch_bits``: counters of the
    sketch as a power of two (one byte each is sent to every task); ``filter_bits``: bits of the
    filter of repeated keys, likewise; ``max_light``: upper end of the cost-chosen boundary."""

    percent: int = 80
    shingle: int = 5
    sketch_bits: int = 22
    filter_bits: int = 26
    max_light: int = 128


def document_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text in turn; none for NULL or no words."""
    for _, data, offsets in text_slices(column):
        starts, ends, firsts = word_spans(data, offsets)
        hashes, begin = shingle_hashes(word_hashes(data, starts, ends), firsts, size)
        for row in range(len(offsets) - 1):
            yield np.unique(hashes[begin[row]:begin[row + 1]])


# ------------------------------------------------------------------------------- the sketch


#: Levels of a counter: eight for each doubling, so that a byte holds rare and less rare apart.
LEVELS = np.ceil(2.0 ** (np.arange(1, 256) / 8)).astype(np.int64)


def count_levels(texts: DataFrame, params: JaccardParams) -> np.ndarray:
    """How often shingles of all texts occur, by hash bucket: ``2**sketch_bits`` levels of a byte.

    Every task adds up its own rows; chunks of counters are then summed as a stream.  Only the
    finished levels, whose number is a parameter, come to the driver.
    """
    bits, size = params.sketch_bits, params.shingle
    shift, chunk = np.uint64(64 - bits), min(SKETCH_CHUNK, 1 << bits)

    def row(key: int, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.int32()), pa.array([counts.tobytes()])], ["chunk", "counts"])

    def count(batches):
        own = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                starts, ends, firsts = word_spans(data, offsets)
                hashes, _ = shingle_hashes(word_hashes(data, starts, ends), firsts, size)
                at, n = np.unique((hashes >> shift).astype(np.int64), return_counts=True)
                own[at] += n.astype(np.uint32)
            del batch
            give_back()
        for i in range(0, len(own), chunk):
            part = own[i:i + chunk]
            if part.any():  # counters take one byte where that holds them
                yield row(i // chunk, part.astype("<u1" if part.max() < 1 << 8 else "<u4"))

    def levels(sums: np.ndarray) -> np.ndarray:
        return np.searchsorted(LEVELS, sums, side="right").astype(np.uint8)

    def total(batches):
        at, sums = None, None
        for batch in batches:
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = part.as_buffer()
                part = np.frombuffer(part, "<u1" if len(part) == chunk else "<u4")
                if key == at:
                    sums = sums + part
                    continue
                if at is not None:
                    yield row(at, levels(sums))
                at, sums = key, part.astype("<i8")
        if at is not None:
            yield row(at, levels(sums))

    schema = "chunk int, counts binary"
    parts = (texts.mapInArrow(count, schema).repartition("chunk")
             .sortWithinPartitions("chunk").mapInArrow(total, schema))
    out = np.zeros(1 << bits, np.uint8)
    for part in parts.toLocalIterator():
        out[part.chunk * chunk:(part.chunk + 1) * chunk] = np.frombuffer(part.counts, np.uint8)
    return out


def first_elements(n: int, percent: int) -> int:
    """How many first elements of a set of ``n`` hold one of any match; 0: only equal sets match."""
    if n * 100 < percent * (n + 1) and (n - 1) * 100 < percent * n:
        return 0
    return n - -(-percent * n // 100) + 1


def light_boundary(levels: np.ndarray, params: JaccardParams) -> int:
    """Largest set size for which pairs of first elements cost less than the single lists.

    A set with ``p`` first elements writes ``p`` keys and meets about ``extra`` other sets in each
    list, or writes ``p (p + 1) / 2`` keys of which hardly any are shared.  ``extra`` is how many
    more occurrences than chance an element's bucket holds, averaged over all occurrences.
    """
    buckets = np.bincount(levels, minlength=256)
    counts = np.concatenate([[0.0], LEVELS.astype(float)])
    total = float((buckets * counts).sum())
    if not total:
        return 0
    chance = total / len(levels)
    over = np.where(counts > chance + 6 * math.sqrt(chance) + 1, counts, 0.0)
    extra = float((buckets * over * np.maximum(over - chance, 0)).sum() / total)
    best = 0
    for n in range(1, params.max_light + 1):
        p = first_elements(n, params.percent)
        if p * (p + 1) / 2 <= p * (1 + extra):
            best = n
    return best


# ---------------------------------------------------------------------------- sets and keys


def _keys(own: np.ndarray, levels: np.ndarray, shift, light: int, percent: int) -> np.ndarray:
    n, p = len(own), first_elements(len(own), percent)
    if not p:
        return np.zeros(0, np.uint64)
    order = np.lexsort((own, levels[(own >> shift).astype(np.int64)]))
    heavy = own[order[:p]]
    if n > light:
        return heavy
    first = np.sort(own[order[:p + 1]])
    i, j = np.triu_indices(len(first), 1)
    pairs = combine([first[i], first[j]], 2)
    return np.concatenate([pairs, heavy]) if n * 100 >= (light + 1) * percent else pairs


def _bitmap(own: np.ndarray) -> np.ndarray:
    bits = np.bincount((own & np.uint64(64 * BITMAP_WORDS - 1)).astype(np.int64),
                       minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view("<i8")


def set_class(own: np.ndarray) -> int:
    """64-bit digest of a whole set; equal sets are one class."""
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def _set_table(docs: DataFrame, levels: np.ndarray, params: JaccardParams) -> DataFrame:
    light, shift = light_boundary(levels, params), np.uint64(64 - params.sketch_bits)
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    size, percent = params.shingle, params.percent
    names = ["doc_id", "n_shingles", "class", "keys", *(f"b{i}" for i in range(BITMAP_WORDS))]
    schema = ("doc_id long, n_shingles long, class long, keys array<long>, "
              + ", ".join(f"b{i} long" for i in range(BITMAP_WORDS)))

    def sets(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                counts, classes, keys, bitmaps = [], [], [], []
                for own in document_sets(part.column(1), size):
                    counts.append(len(own))
                    classes.append(set_class(own) if len(own) else None)
                    keys.append(_keys(own, shared.value, shift, light, percent).view(np.int64))
                    bitmaps.append(_bitmap(own))
                at = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
                bits = np.array(bitmaps)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(counts, pa.int64()), pa.array(classes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()),
                                             pa.array(np.concatenate(keys))),
                    *(pa.array(bits[:, i].copy()) for i in range(BITMAP_WORDS))], names)
            batch = part = None
            give_back()

    return docs.mapInArrow(sets, schema)


# -------------------------------------------------------------------------- lists and links


def key_filter(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of the low bits of 64-bit hashes: ``bits`` bits, however many keys there are."""
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (keys.select(F.shiftright(slot, 6).alias("word"), F.expr(
        f"shiftleft(1L, cast({column} & 63L as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))).toArrow()
    filled = np.zeros(bits >> 6, np.int64)
    filled[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return filled


def passes(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are in the bitmap: all that were put in, and few others."""
    at = hashes & np.int64(len(filled) * 64 - 1)
    return ((filled[at >> 6] >> (hashes & np.int64(63))) & 1).astype(bool)


def _shared_lists(table: DataFrame, params: JaccardParams) -> DataFrame:
    """``key, class, n, head, head_n, head_lists`` of every key that two or more classes list.

    The head of a list is its member that stands in most lists: of a group of near copies the one
    least changed, with the best chance to be similar to all others.

    Keys are counted with map-side combine, so that copies and long lists shrink before the
    shuffle.  A bitmap of the repeated keys, of fixed size, then drops nearly all other entries
    where they are read; what it lets through too much, the count of classes removes.
    """
    bits = 1 << params.filter_bits
    listed = table.where("class is not null").select(
        "class", F.col("n_shingles").cast("int").alias("n"), "keys")
    repeated = (listed.select(F.explode("keys").alias("key")).groupBy("key").count()
                .where("count > 1"))
    shared = table.sparkSession.sparkContext.broadcast(key_filter(repeated, "key", bits))
    drop_shuffles(table.sparkSession)

    def likely(batches):
        for batch in batches:
            # equal texts have equal keys: once a batch is enough
            first = np.unique(batch.column(0).to_numpy(), return_index=True)[1]
            batch = batch.take(pa.array(first))
            keys = batch.column(2)
            key = keys.flatten().to_numpy()
            keep = np.flatnonzero(passes(shared.value, key))
            row = np.repeat(np.arange(batch.num_rows), keys.value_lengths().to_numpy())[keep]
            if len(row):
                lists = np.bincount(row, minlength=batch.num_rows)[row].astype(np.int32)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[keep]), batch.column(0).take(row), batch.column(1).take(row),
                     pa.array(lists)], ["key", "class", "n", "lists"])

    # one shuffle: equal entries, counts and heads all meet by key
    entries = (listed.mapInArrow(likely, "key long, class long, n int, lists int")
               .repartition("key").distinct())
    heads = (entries.groupBy("key").agg(F.count("*").alias("members"),
                                        F.max(F.struct("lists", "class", "n")).alias("head"))
             .where("members > 1")
             .select("key", F.col("head.n").alias("head_n"), F.col("head.class").alias("head"),
                     F.col("head.lists").alias("head_lists")))
    return written(entries.drop("lists").join(heads, "key"), "lists")


def _difference(a: str, b: str):
    """Lower bound of the size of the symmetric difference, from the parity bitmaps."""
    bits = [F.bit_count(F.col(f"{a}.b{i}").bitwiseXOR(F.col(f"{b}.b{i}")))
            for i in range(BITMAP_WORDS)]
    total = bits[0]
    for bit in bits[1:]:
        total = total + bit
    return total


def _possible(a: str, b: str, percent: int):
    """No proof against similarity in sizes and bitmaps: the difference of two similar sets is at
    most ``(100 - percent) / (100 + percent)`` of their sizes' sum."""
    sizes = F.col(f"{a}.n") + F.col(f"{b}.n")
    return ((F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent)
            & (_difference(a, b) * (100 + percent) <= sizes * (100 - percent)))


def _likely(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Pairs ``hub, member`` that sizes and bitmaps leave possible."""
    return (pairs.alias("p").join(bitmaps.alias("h"), F.col("p.hub") == F.col("h.class"))
            .join(bitmaps.alias("m"), F.col("p.member") == F.col("m.class"))
            .where(_possible("h", "m", percent)).select("p.hub", "p.member"))


def _involved(lists: DataFrame, classes: DataFrame, docs: DataFrame,
              params: JaccardParams) -> DataFrame:
    """The classes that stand in a list, with one text each.

    Texts of other documents are dropped where they are read, by a bitmap of fixed size; what it
    lets through too much, the join removes.
    """
    wanted = written(classes.join(lists.select("class").distinct(), "class"), "wanted")
    hashed = wanted.select(F.xxhash64("doc_id").alias("key"))
    shared = docs.sparkSession.sparkContext.broadcast(
        key_filter(hashed, "key", 1 << params.filter_bits))

    def likely(batches):
        for batch in batches:
            out = batch.filter(pa.array(passes(shared.value, batch.column(0).to_numpy())))
            if out.num_rows:
                yield out.select(["doc_id", "text"])

    texts = docs.where("doc_id is not null").select(
        F.xxhash64("doc_id").alias("key"), "doc_id", "text").mapInArrow(
        likely, "doc_id long, text string")
    return written(wanted.join(texts, "doc_id"), "involved")


def _verified(pairs: DataFrame, involved: DataFrame, params: JaccardParams) -> DataFrame:
    """The pairs whose whole texts are similar.

    Members of a hub are dealt to tasks in portions of about ``HUB_MEMBERS``, each with the hub's
    text; a task reads one portion after another as a sorted stream.
    """
    size, percent = params.shingle, params.percent
    sizes = pairs.groupBy("hub").agg(F.count("*").alias("members"))
    dealt = written(pairs.join(sizes, "hub").select(
        "hub", "member", F.pmod(F.xxhash64("member"), F.ceil(F.col("members") / HUB_MEMBERS))
        .cast("int").alias("portion")), "pairs")
    wanted = dealt.select("hub", "portion", F.col("hub").alias("class"), F.lit(0).alias("role")) \
        .distinct().union(dealt.select("hub", "portion", "member", F.lit(1)))
    keyed = (wanted.join(involved.select("class", "text"), "class")
             .select("hub", "portion", "role", "class", "text"))

    def verify(batches):
        at, hub = None, None
        for batch in batches:
            hubs, portions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            roles, own_class = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            left, right = [], []
            for i, own in enumerate(document_sets(batch.column(4), size)):
                if set_class(own) != own_class[i]:
                    continue  # another text under the same doc_id
                if roles[i] == 0:
                    at, hub = (hubs[i], portions[i]), own
                elif at == (hubs[i], portions[i]):
                    both = len(np.intersect1d(hub, own, assume_unique=True))
                    if 100 * both >= percent * (len(hub) + len(own) - both):
                        left.append(hubs[i])
                        right.append(own_class[i])
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["hub", "member"])

    return (keyed.repartition("hub", "portion").sortWithinPartitions("hub", "portion", "role")
            .mapInArrow(verify, "hub long, member long"))


def _placed(lists: DataFrame, joined: DataFrame) -> DataFrame:
    """``key, class, component`` of the lists that hold more than one component so far."""
    placed = lists.select("key", "class").join(
        joined.withColumnRenamed("node", "class"), "class", "left") \
        .select("key", "class", F.coalesce("component", "class").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"),
                                      F.max("component").alias("high")).where("low <> high")
    return written(placed.join(mixed.select("key"), "key"), "placed")


def _stragglers(placed: DataFrame) -> DataFrame:
    """Pairs of a member outside its list's largest component and random members of that.

    Each list draws for itself, so a member of many lists meets many others of the group.
    """
    groups = placed.groupBy("key", "component").agg(
        F.count("*").alias("members"),
        F.array(*[F.min_by("class", F.xxhash64(F.lit(i), "key", "class"))
                  for i in range(DRAWS)]).alias("drawn"))
    main = groups.groupBy("key").agg(F.max(F.struct("members", "component", "drawn")).alias("m")) \
        .select("key", F.col("m.component").alias("main"), "m.drawn")
    return (placed.join(main, "key").where("component <> main")
            .select(F.explode("drawn").alias("hub"), F.col("class").alias("member")).distinct())


def _rest(placed: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """All possible pairs of one list that are in different components so far."""
    sides = written(placed.join(bitmaps, "class"), "sides")
    return (sides.alias("a").join(
        sides.alias("b"), (F.col("a.key") == F.col("b.key"))
        & (F.col("a.class") < F.col("b.class"))
        & (F.col("a.component") != F.col("b.component")) & _possible("a", "b", percent))
        .select(F.col("a.class").alias("hub"), F.col("b.class").alias("member")).distinct())


def _joined_classes(docs: DataFrame, params: JaccardParams) -> tuple[DataFrame, DataFrame]:
    """The stored table of sets, and ``node, component`` of the classes that link."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    levels = count_levels(docs.select("text"), params)
    drop_shuffles(spark)
    table = written(_set_table(docs, levels, params), "sets")
    del levels
    words = [f"b{i}" for i in range(BITMAP_WORDS)]
    classes = written(table.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"),
        *(F.first(w).alias(w) for w in words)), "classes")
    lists = _shared_lists(table, params)
    drop_shuffles(spark)
    involved = _involved(lists, classes, docs, params)
    drop_shuffles(spark)
    bitmaps = involved.select("class", "n", *words).dropDuplicates(["class"])

    headed = lists.where((F.col("head") != F.col("class"))
                         & (F.col("head_n") * 100 >= F.col("n") * params.percent))
    pairs = headed.groupBy("class").agg(F.max(F.struct("head_lists", "head")).alias("h")) \
        .select(F.col("h.head").alias("hub"), F.col("class").alias("member"))
    joined, placed = None, lists
    for step in ("heads", "stragglers", "rest"):
        if step != "heads":
            placed = _placed(placed, joined)
        if step == "stragglers":
            pairs = _stragglers(placed)
        elif step == "rest":
            pairs = _rest(placed, bitmaps, params.percent)
        if step != "rest":
            pairs = _likely(pairs, bitmaps, params.percent)
        found = _verified(pairs, involved, params)
        if joined is not None:
            found = found.union(joined.select(F.col("node").alias("hub"),
                                              F.col("component").alias("member")))
        joined = written(components(found, "hub", "member"), "joined" if step == "rest" else "half")
        drop_shuffles(spark)
    return table, joined


def jaccard_components(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text, ...)``.

    Two rows link when their shingle sets have similarity ``percent`` or more; the component is
    the smallest doc_id reachable.  Words are runs outside ``\\x20 \\x09-\\x0D``, A-Z lower-cased;
    a text with fewer words than a shingle is one shingle.  NULL, empty and blank texts have no
    shingles and link with nothing: their component is their own doc_id.  Repeated rows are all
    returned.  A row without doc_id takes its component from rows that have one (NULL if none).
    Other columns are ignored.  Equal sets are recognised by 64-bit digests.
    """
    # the lists, texts and pairs on the way are deleted once the components are stored
    with passing_tables(docs.sparkSession, "sets", "joined"):
        table, joined = _joined_classes(docs, params)
    named = (table.where("class is not null").select("class", "doc_id")
             .join(joined.withColumnRenamed("node", "class"), "class", "left")
             .select(F.coalesce("component", "class").alias("root"), "class", "doc_id"))
    lowest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = named.groupBy("class").agg(F.first("root").alias("root")).join(lowest, "root")
    return (table.join(of_class.select("class", "component_id"), "class", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("class").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))


def drop_near_copies(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    All columns are kept, whatever their names.  Texts without words are never copies of anything.
    Repeated rows of a kept document are one row.  Rows without doc_id cannot be named, so they
    stay.
    """
    placed = jaccard_components(docs, params).groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.max(F.col("component_id") == F.col("doc_id"))
        .alias("keep")).where("keep").select(F.col("doc_id").alias("kept"), "rows")
    own = set_aside(docs, ["doc_id"])
    kept = own.join(placed, own.doc_id.cast("long") == F.col("kept"))
    single = kept.where("rows = 1").select(*own.columns)
    return brought_back(
        single.union(kept.where("rows > 1").select(*own.columns).dropDuplicates())
        .union(own.where("doc_id is null")), docs.columns, ["doc_id"])
