"""The queries of this subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.llm.bytepairs import token_counts
from estatelens.llm.chat import format_chats
from estatelens.llm.jaccard import jaccard_components
from estatelens.llm.kdtree import top_k
from estatelens.llm.mixing import MixParams, mix_documents
from estatelens.llm.multiindex import near_duplicates
from estatelens.llm.negatives import hard_negatives
from estatelens.llm.packing import pack_documents
from estatelens.llm.personal import personal_spans
from estatelens.llm.repetition import RepetitionParams, repetition_rules
from estatelens.llm.resampling import resample
from estatelens.llm.toxicity import toxicity_scores
from estatelens.llm.urls import RULES, SOFT, STRICT, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    """Registers a query under a name; ``sql`` is its DuckDB answer."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = f"""[x for x in regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+') if x <> '']"""


@query("op7_ngram_jaccard", f"""
with recursive w as (select doc_id, {WORDS_SQL} as w from documents),
s as (select doc_id, case
        when len(w) >= 5 then list_distinct(
            [array_to_string(w[i + 1:i + 5], ' ') for i in range(len(w) - 4)])
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from w),
e as (select doc_id, len(s) as n, unnest(s) as g from s),
l as (select a.doc_id as a, b.doc_id as b from e a join e b on a.g = b.g and a.doc_id <> b.doc_id
      group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r as (select doc_id, doc_id as c from s union select r.doc_id, l.b from r join l on r.c = l.a)
select s.doc_id, len(s.s) as n_shingles, m.c as component_id
from s join (select doc_id, min(c) as c from r group by doc_id) m using (doc_id)""")
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("piece_bpe_32k.model"))


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_embedding_near_dedup")
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op1_exact_top_k", """
with v as (select vec_id, [floor(256 * x::double) for x in embedding] as q
    from embeddings where vec_id is not null and len(embedding) > 0
      and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
    from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q))
select * from (select query_id, row_number() over (partition by query_id
    order by score desc, vec_id)::int as rank, vec_id, score from s) where rank <= 5""")
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def _alone(terms) -> str:
    """Pattern of any of the terms where no letter or digit touches it."""
    return "(^|[^a-z0-9])(" + "|".join(sorted(terms)) + ")([^a-z0-9]|$)"


def _rule_sql(column: int) -> str:
    arms = []
    for rule, verdict in sorted(RULES, key=lambda r: -len(r[0])):
        name, slash, start = rule.partition("/")
        arms.append(f"when (host = '{name}' or host like '%.{name}') "
                    f"and starts_with(path, '{slash + start}') then '{(rule, verdict)[column]}'")
    return "case " + " ".join(arms) + " end"


@query("op3_url_filters", f"""
with a as (select page_id, translate(url, '{UPPER}', '{LOWER}') as low,
    case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest
    from pages),
p as (select page_id, coalesce(low, '') as low, coalesce(translate(regexp_extract(rest,
      '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from a),
c as (select *,
    ({" + ".join(f"regexp_matches(low, '{_alone([t])}')::int" for t in STRICT)}) as n_strict,
    ({" + ".join(f"{w} * regexp_matches(low, '{_alone([t])}')::int" for t, w in SOFT.items())})
      as soft_weight from p)
select page_id, host, path, {_rule_sql(0)} as rule, n_strict::int as n_strict,
  soft_weight::int as soft_weight, coalesce({_rule_sql(1)},
    case when n_strict > 0 or soft_weight >= 3 then 'block' else 'allow' end) as verdict
from c""")
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


@query("op5_personal_data")
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_spans(table(spark, sf_dir, "documents"))


@query("op6_chat_formatting", """
with t as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text)
    as position from t),
l as (select conv_id, count(*) as n_turns,
    list(struct_pack(role := role, text := text) order by position) as turns from o group by 1),
u as (select min(conv_id) as conv_id, n_turns, turns from l group by n_turns, turns),
k as (select conv_id, n_turns from u a where not exists (select 1 from u b
    where b.n_turns > a.n_turns and b.turns[1:a.n_turns] = a.turns))
select conv_id, position, n_turns, concat('<|', role, '|>', chr(10), text, chr(10), '<|end|>',
  chr(10)) as rendered from o join k using (conv_id)""")
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


#: Domains of the sources and target weights of the mixture.
MIX = MixParams(
    domains={"src0": "crawl", **{f"src{i}": "forum" for i in range(1, 7)},
             **{f"src{i}": "books" for i in range(7, 13)},
             **{f"src{i}": "reference" for i in range(13, 20)}},
    weights={"domain": {"crawl": 0.35, "forum": 0.15, "books": 0.25, "reference": 0.25},
             "lang": {"en": 0.6, "de": 0.15, "fr": 0.15, "es": 0.1}},
    epochs=2)


@query("op2_mixing_sources")
def op2_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"), MIX).select(
        "doc_id", F.col("_leaf.domain").alias("domain"), "lang", "source",
        F.col("_epoch").alias("epoch"), F.col("_tokens").alias("n_tokens"))


_REPETITION = RepetitionParams()
_COVERED = ", ".join(f"coalesce(max(c) filter (n = {n}), 0)::bigint as dup_chars_{n}"
                     for n in _REPETITION.run_limits)
_BROKEN = " or ".join(
    [f"100 * dup_line_chars > {_REPETITION.line_limit} * word_chars",
     *[f"100 * dup_chars_{n} > {m} * word_chars" for n, m in _REPETITION.run_limits.items()]])


@query("op11_repetition_rules", f"""
with d as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, [x for x in regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+')
    if x <> ''] as w from d),
p as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from w),
g as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g from (
    select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
    from w, (values {", ".join(f"({n})" for n in (3, *_REPETITION.run_limits))}) t(n))),
t as (select doc_id, n, i from g qualify count(*) over (partition by doc_id, n, g) > 1),
m as (select distinct doc_id, n, unnest(range(i, i + n)) as i from t),
c as (select doc_id, n, count(*) as k, sum(length(word)) as c from m join p using (doc_id, i)
    group by doc_id, n),
r as (select doc_id, coalesce(max(k) filter (n = 3), 0) as n_repeat_words, {_COVERED}
    from d left join c using (doc_id) group by doc_id),
l as (select doc_id, unnest(string_split(text, chr(10))) as line,
    unnest(range(len(string_split(text, chr(10))))) as i from d),
e as (select doc_id, line from l where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
    qualify row_number() over (partition by doc_id, line order by i) > 1),
f as (select doc_id, count(line) as n_dup_lines, coalesce(sum(length(regexp_replace(line,
    '[\\x20\\x09-\\x0D]', '', 'g'))), 0)::bigint as dup_line_chars
    from d left join e using (doc_id) group by doc_id),
a as (select doc_id, len(w)::bigint as n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    n_dup_lines, n_repeat_words::bigint as n_repeat_words,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    r.* exclude (doc_id, n_repeat_words), dup_line_chars
    from w join r using (doc_id) join f using (doc_id))
select *, not base_failed and not ({_BROKEN}) as kept from a""")
def op11_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents"), _REPETITION).drop("failed")


@query("op12_importance_resampling", f"""
with recursive
b as (select v as v0, 0 as step, v::bigint as v from range(256) t(v) union all
    select v0, step + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end
    from b where step < 8),
tab as (select v0, v from b where step = 8),
src as (select 's' as side, doc_id, text from documents union all
    select 't', item_id, text from benchmark),
w as (select side, doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''),
    '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> ''] as w from src),
g as (select side, doc_id, unnest([array_to_string(w[i:i + n - 1], ' ')
    for i in range(1, len(w) - n + 2)]) as g from w, (values (1), (2), (3)) t(n)),
h as (select g, hex(encode(g)) as x from (select distinct g from g)),
c as (select g, x, 0 as i, 4294967295::bigint as c from h union all
    select g, x, i + 1, xor(c >> 8, tab.v) from c join tab
    on tab.v0 = xor(c & 255, 16 * (instr('0123456789ABCDEF', x[2 * i + 1]) - 1)
        + instr('0123456789ABCDEF', x[2 * i + 2]) - 1)
    where 2 * i < length(x)),
k as (select g, xor(c, 4294967295) % 10000 as bucket from c where 2 * i = length(x)),
f as (select side, doc_id, bucket, count(*) as n from g join k using (g) group by all),
u as (select bucket, coalesce(sum(n) filter (side = 's'), 0)::bigint as s,
    coalesce(sum(n) filter (side = 't'), 0)::bigint as t from f group by bucket),
v as (select bucket, floor(1000 * ln(((t + 1) * ((select sum(s) from u) + 10000))::double
    / ((s + 1) * ((select sum(t) from u) + 10000))::double))::bigint as gain from u),
m as (select doc_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
    from f join v using (bucket) where side = 's' group by doc_id),
z as (select doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features,
    coalesce(weight, 0) as weight, sha256('42:' || doc_id)[1:8] as h
    from w left join m using (doc_id) where side = 's'),
y as (select *, list_reduce([0::bigint] || [(instr('0123456789abcdef', h[i]) - 1)::bigint
    for i in range(1, 9)], lambda a, d: 16 * a + d) as hh from z),
q as (select *, weight + floor(-1000 * ln(-ln((hh + 0.5) / 4294967296)))::bigint as score from y),
r as (select doc_id, row_number() over (order by score desc, doc_id) as place from q
    where n_words >= 20)
select doc_id, n_features, weight, score,
  case when place <= 5 * (select count(*) from r) // 100 then place end as rank
from q left join r using (doc_id)""")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_hard_negatives", """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * x::double) for x in embedding] as q
    from embeddings where vec_id is not null and label is not null and len(embedding) > 0
      and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
    list_inner_product(a.q, b.q)::bigint as score
    from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
p as (select * from s where same qualify row_number() over (partition by anchor_id
    order by score desc, vec_id) <= 5)
select anchor_id, p.vec_id as positive_id, row_number() over (partition by anchor_id, p.vec_id
    order by s.score desc, s.vec_id)::int as rank, s.vec_id as negative_id,
  p.score as positive_score, s.score as negative_score
from p join s using (anchor_id) where not s.same and 50 * p.score <= 100 * s.score
  and 100 * s.score <= 95 * p.score qualify rank <= 3""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)
