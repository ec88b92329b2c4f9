"""Personal data: base patterns, and spans added by weak supervision.

Text is only touched by built-in functions.  Four kinds are found by fixed patterns.  Further
candidates are longer runs that hold digits; regex, gazetteer and context labelers vote on each
(for, against or silent).  Expectation-maximisation over the counted vote patterns estimates how
reliable each labeler is and how likely each pattern is personal data; a logistic span classifier
is trained on these likelihoods and decides.  Vote and feature patterns are few by construction
(products of the labelers' answers), so only their counts come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.llm.storage import brought_back, set_aside, written

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Runs that cannot begin a match are entered only at their first
# character or where the last match ended, and repeats give nothing back; both leave the matches
# as they are and keep the search linear.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
OCTETS = rf"^{_PART}(?:\.{_PART}){{3}}$"

#: Longer runs without white space that hold a digit.
CANDIDATE = r"(?<!\S)(?=\S*+(?<=\S))(?=[^0-9\s]*+[0-9])\S{8,}+"

# Words that announce personal data, and beginnings of issued credentials.
CUES = ("account", "api", "call", "card", "contact", "iban", "key", "login", "passport",
        "password", "phone", "pin", "secret", "ssn", "tel", "token", "user")
ISSUED = ("AKIA", "ASIA", "AIza", "eyJ", "ghp_", "gho_", "glpat-", "sk_", "sk-", "xoxb-", "xoxp-")


@dataclass(frozen=True)
class PersonalParams:
    """``context``: characters before a candidate that labelers read; ``threshold``: least
    probability of an added span; ``rounds``: of expectation-maximisation."""

    context: int = 24
    threshold: float = 0.5
    rounds: int = 50


SPAN = "array<struct<start:int,end:int,value:string,ahead:string>>"


def find_spans(text: Column, pattern: str, context: int = 0) -> Column:
    """Leftmost matches with their code point places and the text just ahead."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)),
                       lambda m, b: F.struct(m.alias("m"), b.alias("b")))

    def step(state, x):
        start = state["pos"] + F.length(x["b"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"),
                        F.right(x["b"], F.lit(context)).alias("ahead"))
        return F.struct(end.alias("pos"), F.concat(state["out"], F.array(span)).alias("out"))

    begin = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(pairs, begin, step)["out"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of 16 to 19 digits is right."""
    turned = F.reverse(digits)

    def add(total, i):
        digit = F.ascii(F.substr(turned, i, F.lit(1))) - 48
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(False)


def _kind_spans(text: Column, kind: str) -> Column:
    """Spans of one base kind; texts that cannot hold one are not searched."""
    none = F.array().cast(SPAN)
    if kind == "email":
        return F.when(F.contains(text, F.lit("@")), find_spans(text, EMAIL)).otherwise(none)
    if kind == "ip":
        return F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(
            find_spans(text, IP), lambda s: s["value"].rlike(OCTETS))).otherwise(none)
    if kind == "card":
        return F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), F.filter(
            find_spans(text, CARD), lambda s: _luhn(_digits(s["value"])))).otherwise(none)
    return F.when(text.rlike(r"\+[0-9]"), F.filter(
        find_spans(text, PHONE),
        lambda s: F.length(_digits(s["value"])).between(8, 15))).otherwise(none)


def with_spans(docs: DataFrame, keep: list[str], params: PersonalParams) -> DataFrame:
    """``keep`` columns, the base spans of each kind and the candidates outside them."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(*keep, *[_kind_spans(text, k).alias(f"_{k}") for k in KINDS], F.when(
        text.rlike("[0-9]"), find_spans(text, CANDIDATE, params.context))
        .otherwise(F.array().cast(SPAN)).alias("_found"))
    return found


def _outside(candidates: Column, base: Column) -> Column:
    return F.filter(candidates, lambda c: ~F.exists(
        base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))


def _votes(value: Column, ahead: Column) -> list[Column]:
    """1 for, -1 against, 0 silent; one column for each labeler."""
    core = F.regexp_replace(value, r"^[\"'(<\[]+|[\"')>\],.;:!?]+$", "")
    lower, words = F.lower(core), F.lower(ahead)
    assigned = lower.rlike(r"^(?:password|passwd|pwd|token|secret|api[_-]?key)[=:]\S{4,}")
    shaped = core.rlike(r"^(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
                        r"|[0-9]{13,19}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})$")
    issued = F.lit(False)
    for start in ISSUED:
        issued = issued | core.startswith(start)
    cued = words.rlike(r"\b(?:" + "|".join(CUES) + r")\W*$")
    mixed = core.rlike("[0-9]") & core.rlike("[A-Za-z]") & (F.length(core) >= 16)
    address = lower.rlike(r"^(?:https?:|ftp:|www\.)|/")
    number = core.rlike(r"^[0-9.,:/-]{1,12}$")
    wordy = core.rlike(r"^[^0-9=]{5,}[0-9]{1,3}$")

    def says(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    return [says(assigned, number), says(shaped, wordy), says(issued, address),
            says(cued, ~cued & address), says(mixed & ~address, wordy | number)]


def _features(value: Column, votes: list[Column]) -> list[Column]:
    """Yes-or-no properties of a candidate that the classifier weighs."""
    return [*[v == 1 for v in votes], *[v == -1 for v in votes],
            F.contains(value, F.lit("=")), value.rlike("[A-Z]"), F.length(value) >= 16]


def estimate_labels(votes: np.ndarray, counts: np.ndarray, rounds: int) -> np.ndarray:
    """Probability of "yes" for each vote pattern, by expectation-maximisation.

    Each labeler has its own chance of every answer under yes and under no.  The start trusts
    every labeler alike; add-one counts keep chances off zero.
    """
    yes = 1 / (1 + np.exp(-2.0 * votes.sum(axis=1)))
    answers = np.stack([votes == a for a in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        share = np.stack([counts * (1 - yes), counts * yes])
        chance = np.einsum("cp,pja->cja", share, answers) + 1.0
        chance /= chance.sum(axis=2, keepdims=True)
        prior = (share.sum(axis=1) + 1) / (share.sum() + 2)
        log = np.log(prior)[:, None] + np.einsum("pja,cja->cp", answers, np.log(chance))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - yes).max() < 1e-9:
            break
        yes = new
    return yes


def fit_spans(features: np.ndarray, target: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Logistic weights (the intercept last) for soft targets, by Newton steps with a ridge."""
    x = np.hstack([features.astype(float), np.ones((len(features), 1))])
    w, share = np.zeros(x.shape[1]), counts / counts.sum()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (p - target)) + 1e-3 * w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    return w


def _decided(found: DataFrame, params: PersonalParams) -> DataFrame:
    """``found`` (stored) with ``_added``: the candidates that the trained classifier accepts."""
    base = F.concat(*[F.col(f"_{k}") for k in KINDS])
    found = found.withColumn("_found", _outside(F.col("_found"), base))
    each = found.select(F.explode("_found").alias("c"))
    votes = _votes(F.col("c.value"), F.col("c.ahead"))
    asked = each.select("c.value", F.array(*votes).alias("votes"))
    listed = [F.col("votes")[i] for i in range(len(votes))]
    # at most 3 ** labelers * 2 ** own features rows, whatever the input
    table = (asked.select("votes", F.array(*_features(F.col("value"), listed)).alias("features"))
             .groupBy("votes", "features").count().orderBy("votes", "features").collect())
    if not table:
        return found.withColumn("_added", F.array().cast(SPAN))
    counts = np.array([r["count"] for r in table], float)
    likely = estimate_labels(np.array([r.votes for r in table]), counts, params.rounds)
    weights = fit_spans(np.array([r.features for r in table]), likely, counts)
    cut = float(np.log(params.threshold / (1 - params.threshold)))

    def accepted(c: Column) -> Column:
        own = _features(c["value"], _votes(c["value"], c["ahead"]))
        total = F.lit(float(weights[-1]))
        for weight, feature in zip(weights, own):
            total = total + F.when(feature, F.lit(float(weight))).otherwise(0.0)
        return total >= cut

    return found.withColumn("_added", F.filter("_found", accepted))


def _joined(parts: list[tuple[str, Column]]) -> Column:
    def named(kind: str):
        return lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])

    return F.array_join(F.concat(*[F.transform(spans, named(kind)) for kind, spans in parts]), ",")


def personal_spans(docs: DataFrame, params: PersonalParams = PersonalParams()) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, n_other, base_sha256, spans`` of every row of
    ``docs(doc_id, text, ...)``.

    Spans are ``kind:start:end`` in code points, the end exclusive; added spans are of kind
    ``other``, follow the base kinds and never overlap them.  NULL is an empty text, which has no
    spans; rows are returned one for one; other columns are ignored.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = _decided(written(with_spans(own, ["doc_id"], params), "spans"), params)
    base = [(k, F.col(f"_{k}")) for k in KINDS]
    return found.select(
        "doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.size("_added").cast("long").alias("n_other"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined([*base, ("other", F.col("_added"))]).alias("spans"))


def redact_personal(docs: DataFrame, params: PersonalParams = PersonalParams()) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``<KIND>``; all columns are kept, whatever
    their names.

    Where spans of different kinds overlap, the one that begins first (then the longer) is
    replaced and the others with it.  A text without spans stays as it is, NULL included.
    """
    rows = set_aside(docs, ["text"])
    found = _decided(written(with_spans(rows, rows.columns, params), "spans"), params)

    def place(kind: str):
        return lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"),
                                  F.lit(kind.upper()).alias("kind"))

    every = F.array_sort(F.concat(*[F.transform(f"_{k}", place(k)) for k in KINDS],
                                  F.transform("_added", place("other"))))

    def step(state, s):
        start, end = s["start"], -s["end"]
        fresh = start >= state["pos"]
        piece = F.concat(F.substr(F.col("text"), state["pos"] + 1, start - state["pos"]),
                         F.lit("<"), s["kind"], F.lit(">"))
        return F.struct(F.greatest(state["pos"], end).alias("pos"),
                        F.when(fresh, F.concat(state["out"], F.array(piece)))
                        .otherwise(state["out"]).alias("out"))

    begin = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(every, begin, step, lambda state: F.concat(
        F.array_join(state["out"], ""), F.substr(F.col("text"), state["pos"] + 1)))
    clean = F.when(F.size(every) > 0, done).otherwise(F.col("text"))
    return brought_back(found.select(clean.alias("text"), "others"), docs.columns, ["text"])
