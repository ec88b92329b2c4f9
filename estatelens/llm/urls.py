"""URL filters: host and path rules, then a weighted vocabulary.

Rules are a few constants and become one expression.  What no rule decides goes through an
Aho-Corasick automaton over all terms: a term counts where no letter or digit touches it.  One
strict term rejects, or distinct soft terms of enough weight.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (host and path of a rule, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))

STRICT = ("adult", "camgirl", "camgirls", "escort", "escorts", "hentai", "malware", "phishing",
          "porn", "porno", "spam", "warez", "xxx")
SOFT = {"bet": 1, "betting": 1, "bonus": 1, "casino": 2, "cheap": 1, "crack": 1, "dating": 1,
        "free": 1, "gambling": 2, "jackpot": 1, "loan": 1, "loans": 1, "nude": 2, "pills": 2,
        "poker": 1, "sex": 2, "sexy": 1, "slots": 1, "torrent": 1, "viagra": 2, "win": 1}


@dataclass(frozen=True)
class UrlParams:
    """``soft_limit``: weight of distinct soft terms from which a url is rejected."""

    rules: Sequence[tuple[str, str]] = RULES
    strict: Sequence[str] = STRICT
    soft: Mapping[str, int] = field(default_factory=lambda: SOFT)
    soft_limit: int = 3


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(column: Column) -> Column:
    return F.translate(column, _UPPER, _UPPER.lower())


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.substring_index(url, "://", 1)
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.length(rest) + 4)).otherwise("")
    return F.coalesce(lower_ascii(F.regexp_extract(after, r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.substring_index(url, "://", 1)
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.length(rest) + 4)).otherwise("")
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct of the longest fitting rule and its verdict; NULL if none fits."""
    out = F.lit(None)
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))) \
            .otherwise(out)
    return out


class TermCounter:
    """Finds the terms of a vocabulary that stand alone in a lower-case text."""

    def __init__(self, terms: Sequence[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term in terms:
            self.automaton.add_word(term, term)
        if terms:
            self.automaton.make_automaton()
        self.empty = not terms

    def terms(self, text: str) -> set[str]:
        found = set()
        if self.empty:
            return found
        for end, term in self.automaton.iter(text):
            start = end - len(term) + 1
            if not (start and _joins(text[start - 1])) and not (
                    end + 1 < len(text) and _joins(text[end + 1])):
                found.add(term)
        return found


def _joins(char: str) -> bool:
    return "a" <= char <= "z" or "0" <= char <= "9"


def judge_urls(pages: DataFrame, params: UrlParams = UrlParams()) -> DataFrame:
    """``page_id, host, path, rule, n_strict, soft_weight, verdict`` of every row of
    ``pages(page_id, url, ...)``.

    A rule fits its host and all subdomains if the path starts with its path; the longest wins.
    ``n_strict`` counts distinct strict terms, ``soft_weight`` sums distinct soft terms' weights.
    A NULL url, or one without ``://``, has empty host and path and no rule; a NULL url has no
    terms and is allowed.  Rows are returned one for one; other columns are not read.
    """
    strict, soft = frozenset(params.strict), dict(params.soft)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"),
                        path.alias("path"), lower_ascii(F.col("url")).alias("_url"))
    schema = "page_id long, host string, path string, n_strict int, soft_weight int"

    def count(batches):
        counter = TermCounter(sorted(strict | set(soft)))
        for batch in batches:
            found = [counter.terms(url or "") for url in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(f & strict) for f in found], pa.int32()),
                 pa.array([sum(soft[t] for t in f if t in soft) for f in found], pa.int32())],
                ["page_id", "host", "path", "n_strict", "soft_weight"])

    counted = read.mapInArrow(count, schema)
    rule = longest_rule(F.col("host"), F.col("path"), params.rules)
    rejected = (F.col("n_strict") > 0) | (F.col("soft_weight") >= params.soft_limit)
    return counted.withColumn("_rule", rule).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), "n_strict", "soft_weight",
        F.coalesce("_rule.verdict", F.when(rejected, "block").otherwise("allow"))
        .alias("verdict"))
