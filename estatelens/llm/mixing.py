"""Mixing sources to target weights by hierarchical budgets.

Documents hang in a tree of domain, language and source.  A budget of tokens goes down the tree by
the weights of the children; a child that cannot use its share (its supply times the epochs) is
given what it can use, and the rest goes to its siblings by their weights; only what no sibling
can use moves on to the next level.  Each leaf then takes whole epochs and a prefix of one more, in
an order seeded by epoch.

The prefix is found without sorting a leaf: documents fall into hash buckets, bucket sums give the
bucket where the budget ends, and only that bucket's documents are ordered.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.storage import brought_back, set_aside, written

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class MixParams:
    """``domains``: domain of each source (others: ``other``).  ``weights``: by level, the weight
    of each child name (others: 1).  The budget is ``budget`` tokens, or ``share`` of all tokens.
    ``epochs``: most times a document is taken.  ``bucket_rows``: documents of a bucket aimed at.
    ``max_leaves``: leaf counts come to the driver, so a tree with more is refused."""

    domains: Mapping[str, str] = field(default_factory=dict)
    weights: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    budget: int | None = None
    share: float = 0.9
    epochs: int = 1
    seed: int = 17
    bucket_rows: int = 500
    max_leaves: int = 100_000


def fill_by_weight(budget: float, capacity: dict, weight: dict) -> dict:
    """Shares of ``budget`` by weight, none above its capacity; what one leaves goes to the rest."""
    out = {name: 0.0 for name in capacity}
    open_ = {name for name in capacity if weight[name] > 0 and capacity[name] > 0}
    left = min(budget, sum(capacity[n] for n in open_))
    while open_ and left > 0:
        unit = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if capacity[n] <= unit * weight[n]}
        if not full:
            for n in open_:
                out[n] = unit * weight[n]
            break
        for n in full:
            out[n] = capacity[n]
            left -= capacity[n]
        open_ -= full
    return out


def leaf_budgets(supply: Mapping[tuple, int], budget: float, params: MixParams) -> dict:
    """Tokens for every leaf ``(domain, lang, source)``."""

    def usable(leaves: dict, depth: int) -> float:
        """What a subtree can take: names of weight 0 take nothing."""
        return sum(n * params.epochs for leaf, n in leaves.items()
                   if all(params.weights.get(level, {}).get(leaf[i], 1.0) > 0
                          for i, level in enumerate(LEVELS) if i >= depth))

    def spread(leaves: dict, depth: int, budget: float) -> dict:
        if depth == len(LEVELS):
            return {leaf: int(budget + 1e-6) for leaf in leaves}
        groups: dict = {}
        for leaf, n in leaves.items():
            groups.setdefault(leaf[depth], {})[leaf] = n
        weight = {g: float(params.weights.get(LEVELS[depth], {}).get(g, 1.0)) for g in groups}
        shares = fill_by_weight(
            budget, {g: usable(m, depth + 1) for g, m in groups.items()}, weight)
        out = {}
        for g, members in groups.items():
            out |= spread(members, depth + 1, shares[g])
        return out

    return spread(dict(supply), 0, budget)


def _named(docs: DataFrame, params: MixParams) -> DataFrame:
    source, lang = (F.coalesce(F.col(c), F.lit("")) for c in ("source", "lang"))
    domain = F.lit(None).cast("string")
    if params.domains:
        domain = F.create_map(*[F.lit(x) for pair in params.domains.items() for x in pair])[source]
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^ \t-\r]+"))
    return docs.select("*", F.struct(
        F.coalesce(domain, F.lit("other")).alias("domain"), lang.alias("lang"),
        source.alias("source")).alias("_leaf"), words.cast("long").alias("_tokens"))


def _bucket(hash_column, bits: int):
    return F.shiftrightunsigned(hash_column, 64 - bits)


NEEDED = ["doc_id", "text", "lang", "source"]


def mix_documents(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """Rows of ``docs(doc_id, text, lang, source, ...)`` chosen for the mixture.

    All columns are kept, and ``_leaf`` (domain, lang, source), ``_tokens`` (words) and ``_epoch``
    are added, in place of columns of these names; a row stands once for each epoch it is taken
    in.  NULL lang or source are the name
    ``''``, a NULL text has no tokens.  A document is taken in the last, partial epoch if all
    documents of its leaf before it and itself fit the leaf's budget; the order is a hash of seed,
    epoch, doc_id and text, so repeated rows stand together.  A leaf without tokens is taken once.
    """
    rows = _mixed(set_aside(docs, NEEDED), params)
    return brought_back(rows, docs.columns, NEEDED, _leaf="_leaf", _tokens="_tokens",
                        _epoch="_epoch")


def mixed_rows(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """As ``mix_documents``, with the columns of ``docs`` only, whatever their names."""
    return brought_back(_mixed(set_aside(docs, NEEDED), params), docs.columns, NEEDED)


def _mixed(docs: DataFrame, params: MixParams) -> DataFrame:
    named = written(_named(docs, params), "named")
    stats = named.groupBy("_leaf").agg(F.sum("_tokens").alias("tokens"),
                                       F.count("*").alias("rows")) \
        .limit(params.max_leaves + 1).collect()
    if len(stats) > params.max_leaves:
        raise ValueError(f"more than {params.max_leaves} leaves")
    supply = {tuple(r._leaf): r.tokens for r in stats}
    total = sum(supply.values())
    budget = total * params.share if params.budget is None else params.budget
    budgets = leaf_budgets(supply, budget, params)
    plan = []
    for r in stats:
        own, n = budgets[tuple(r._leaf)], r.tokens
        whole = min(own // n, params.epochs) if n else 1
        plan.append((r._leaf, int(whole), int(own - whole * n) if n else 0))
    if not plan:
        return named.withColumn("_epoch", F.lit(0))
    schema = "_leaf struct<domain:string,lang:string,source:string>, _whole int, _rest long"
    # one row a leaf, and the number of leaves is bounded
    plan = F.broadcast(docs.sparkSession.createDataFrame(plan, schema))
    largest = max(r.rows for r in stats)
    bits = max(4, min(24, (largest // params.bucket_rows).bit_length()))
    placed = named.join(plan, "_leaf").withColumn(
        "_hash", F.xxhash64(F.lit(params.seed), "_whole", "doc_id", "text"))
    placed = placed.withColumn("_bucket", _bucket(F.col("_hash"), bits))

    sums = placed.where("_rest > 0").groupBy("_leaf", "_bucket").agg(
        F.sum("_tokens").alias("tokens"), F.first("_rest").alias("_rest"))
    upto = F.sum("tokens").over(Window.partitionBy("_leaf").orderBy("_bucket"))
    # the bucket in which a leaf's budget ends, or none
    ends = (sums.withColumn("upto", upto).where("upto > _rest")
            .groupBy("_leaf").agg(F.min(F.struct("_bucket", (F.col("upto") - F.col("tokens"))
                                                 .alias("before"))).alias("end")))
    ends = F.broadcast(ends.select("_leaf", F.col("end._bucket").alias("_last"),
                                   F.col("end.before").alias("_before")))
    placed = placed.join(ends, "_leaf", "left")
    inside = Window.partitionBy("_leaf").orderBy("_hash", "doc_id", "text") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (placed.where("_rest > 0 and _bucket = _last")
            .withColumn("_upto", F.sum("_tokens").over(inside) + F.col("_before"))
            .where("_upto <= _rest").select(*named.columns, F.col("_whole").alias("_epoch")))
    early = (placed.where("_rest > 0 and (_last is null or _bucket < _last)")
             .select(*named.columns, F.col("_whole").alias("_epoch")))
    full = (placed.where("_whole > 0").select(
        *named.columns, F.explode(F.expr("sequence(0, _whole - 1)")).alias("_epoch")))
    return full.union(early).union(last)
