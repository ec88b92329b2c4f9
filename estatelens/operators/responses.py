"""Requests for a text scorer and rule checks on its answers.

The scorer itself is outside: it reads (kenmerk, field, text) and fills (kenmerk, field, reply).
Answers are trusted only where the section they were asked about supports them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions.privacy import (
    is_person_name, known_person_pattern, looks_like_company, person_hash, person_pattern,
    redact_persons, scrub_known_persons,
)
from estatelens.functions.sections import governance_tail, settlement_tail
from estatelens.functions.stages import compute_once
from estatelens.functions.text import (
    blank_to_null, filled, grounded, grounded_in, norm_name, squeeze, strip,
)
from estatelens.vocab import (
    ACQUIRER_PLACEHOLDERS, BANK_LIKE, GENERIC_BANK, GOVERNANCE_FLAGS, IP_KEYWORDS,
    PREMISES_FLAGS, RELATIONS, SETTLEMENTS,
)

FIELDS = ["sector", "oorzaak", "doorstart", "koopsom", "domeinnamen", "directie", "bank",
          "rechtmatigheid", "vastgoed", "afwikkeling"]
#: Sections that answers are checked against.
CHECKED_SECTIONS = ["andere_activa", "doorstart", "inventarisatie", "zekerheden"]
RELATION = "struct<relatie:string,company_name:string,detail:string>"


def prompt_requests(cases: DataFrame, clamp: int | None = None,
                    restarts: DataFrame | None = None, section_clamp: int | None = None,
                    attempt: int = 1) -> DataFrame:
    """(kenmerk, field, attempt, text) of every question whose text is not blank.

    ``cases`` carries the struct ``text``.  The price question is asked only for ``restarts``,
    the cases whose restart answer was true.  Texts are whole; for a scorer with a bounded
    context ``clamp`` cuts each to so many characters, and ``section_clamp`` the two premises
    sections before they are joined.  A question asked again, shorter, has a higher ``attempt``.
    """
    t = F.col("text")

    def cut(text: Column, size: int | None) -> Column:
        return text if size is None else F.substring(text, 1, size)

    asked = {
        "sector": t["activiteiten"], "oorzaak": t["oorzaak"], "doorstart": t["doorstart"],
        "domeinnamen": t["andere_activa"], "directie": t["inventarisatie"],
        "bank": t["zekerheden"], "rechtmatigheid": governance_tail(t["rechtmatigheid"]),
        "vastgoed": F.concat(cut(t["activa"], section_clamp), F.lit("\n---\n"),
                             cut(t["inventarisatie"], section_clamp)),
        "afwikkeling": settlement_tail(t["crediteuren"]),
    }
    rows = cases.select("kenmerk", F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), c.alias("text")) for f, c in asked.items()]))
        .alias("q")).select("kenmerk", "q.field", "q.text")
    if restarts is not None:
        priced = cases.join(restarts.select("kenmerk").distinct(), "kenmerk", "left_semi")
        rows = rows.unionByName(priced.select(
            "kenmerk", F.lit("koopsom").alias("field"), t["doorstart"].alias("text")))
    return rows.filter(strip(F.col("text")) != "").select(
        "kenmerk", "field", F.lit(attempt).alias("attempt"), cut(F.col("text"), clamp).alias("text"))


def response_json(reply: Column) -> Column:
    """Outermost braces of a reply as VARIANT; NULL when absent or malformed."""
    return F.try_parse_json(F.regexp_extract(reply, r"(?s)\{.*\}", 0))


def answers(responses: DataFrame) -> DataFrame:
    """One row per case with the parsed answer to each question as ``a_<field>``.

    Of several replies the first that parses counts: lowest ``attempt`` (1 where the column is
    missing), then the lowest text.
    """
    attempt = F.col("attempt") if "attempt" in responses.columns else F.lit(1)
    usable = response_json(F.col("reply")).isNotNull()
    # replies are dealt by case before they are parsed and sorted: a task that reads them may hold
    # many more than its share
    dealt = responses.select("kenmerk", "field", attempt.alias("attempt"), "reply").repartition(
        "kenmerk")
    rows = dealt.select("kenmerk", "field", F.when(usable, F.struct("attempt", "reply")).alias("r"))
    wide = rows.groupBy("kenmerk").agg(*[
        F.min(F.when(F.col("field") == f, F.col("r"))).alias(f"r_{f}") for f in FIELDS])
    return wide.select("kenmerk", *[response_json(F.col(f"r_{f}.reply")).alias(f"a_{f}")
                                    for f in FIELDS])


def _text(answer: Column, name: str) -> Column:
    return F.try_variant_get(answer, f"$.{name}", "string")


def valid_summary(answer: Column, text_name: str, label_name: str) -> tuple[Column, Column]:
    """(redacted description, label) of the activity and cause answers."""
    return redact_persons(_text(answer, text_name)), _text(answer, label_name)


def restarted(answer: Column) -> Column:
    return F.try_variant_get(answer, "$.doorstart", "boolean")


def valid_acquirer(answer: Column) -> Column:
    """Acquirer name without quotes; NULL for persons and placeholders."""
    name = F.btrim(strip(_text(answer, "overnemer")), F.lit("\"'"))
    refused = name.rlike(person_pattern()) | F.lower(name).isin(ACQUIRER_PLACEHOLDERS)
    return F.when(filled(name) & ~refused, name)


def acquirer_relation(name: Column, restart_text: Column) -> Column:
    row = F.struct(F.lit("overnemer").alias("relatie"), name.alias("company_name"),
                   F.lit("").alias("detail"))
    return F.when(grounded(name, restart_text), F.array(row)).otherwise(
        F.array().cast(f"array<{RELATION}>"))


def valid_domains(answer: Column) -> Column:
    return F.coalesce(F.try_variant_get(answer, "$.domeinnamen", "array<string>"),
                      F.array().cast("array<string>"))


def valid_ip(answer: Column, section: Column) -> Column:
    """IP claim, dropped when it names IP kinds of which none occurs in the section."""
    claim = _text(answer, "ie_rechten")
    named, supported = F.lit(False), F.lit(False)
    for word in IP_KEYWORDS:
        here = claim.rlike(rf"(?iU)\b{word}")
        named = named | here
        supported = supported | (here & section.rlike(rf"(?iU)\b{word}"))
    return F.when(filled(claim) & named & ~supported, None).otherwise(redact_persons(claim))


def known_persons(answer: Column) -> Column:
    """Real person names in the directors answer."""
    people = F.try_variant_get(answer, "$.personen", "array<string>")
    real = F.filter(people, lambda p: filled(strip(p)) & is_person_name(p))
    return F.coalesce(F.transform(real, lambda p: strip(p)), F.array().cast("array<string>"))


def director_hashes(persons: Column, salt: str) -> Column:
    return F.array_sort(F.array_distinct(F.transform(persons, lambda p: person_hash(p, salt))))


def _objects(answer: Column, name: str) -> Column:
    return F.coalesce(F.try_variant_get(answer, f"$.{name}", "array<variant>"),
                      F.array().cast("array<variant>"))


def director_relations(answer: Column, section: Column) -> Column:
    """Related legal entities named in the inventory section, with an allowed relation."""
    source = squeeze(section)
    rows = F.transform(_objects(answer, "bedrijven"), lambda b: F.struct(
        F.coalesce(blank_to_null(_text(b, "relatie")), F.lit("gelieerd")).alias("relatie"),
        strip(_text(b, "naam")).alias("company_name"), F.lit("").alias("detail")))
    return F.filter(rows, lambda r: r["relatie"].isin(RELATIONS)
                    & looks_like_company(r["company_name"])
                    & grounded_in(r["company_name"], source))


def bank_relations(answer: Column, section: Column) -> Column:
    """Lenders by their own name, found in the section, with the claim as a whole number."""
    source = squeeze(section)

    def row(b: Column) -> Column:
        claim = F.try_variant_get(b, "$.vordering", "double")
        shown = F.concat(F.lit("vordering "), F.bround(claim, 0).cast("bigint").cast("string"))
        return F.struct(F.lit("bank").alias("relatie"),
                        strip(_text(b, "naam")).alias("company_name"),
                        F.when(claim != 0, shown).otherwise("").alias("detail"))

    return F.filter(F.transform(_objects(answer, "banken"), row), lambda r: (
        grounded_in(r["company_name"], source)
        & ~r["company_name"].rlike(GENERIC_BANK)
        & (looks_like_company(r["company_name"]) | r["company_name"].rlike(BANK_LIKE))))


def valid_flag(answer: Column, name: str) -> Column:
    """A JSON boolean, else NULL (strings and numbers are no answer)."""
    member = F.variant_get(answer, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(member) == "BOOLEAN",
                  F.try_variant_get(answer, f"$.{name}", "boolean"))


def valid_settlement(answer: Column) -> Column:
    label = _text(answer, "afwikkeling")
    return F.when(label.isin(SETTLEMENTS), label).otherwise("")


def valid_creditor_count(answer: Column) -> Column:
    """Whole number in [0, 100000), else NULL."""
    path = "$.aantal_concurrente_crediteuren"
    whole = F.schema_of_variant(F.variant_get(answer, path, "variant")) == "BIGINT"
    n = F.when(whole, F.try_variant_get(answer, path, "bigint"))
    return F.when(n.between(0, 99999), n.cast("int"))


def dedupe_relations(relations: Column, own_name: Column) -> Column:
    """First entry per relation and comparable name, without the debtor itself.

    Names are compared without punctuation; the debtor matches when either name holds the other.
    """
    own = norm_name(own_name)
    keyed = F.transform(relations, lambda r: F.struct(
        r.alias("row"), norm_name(r["company_name"]).alias("norm")))
    others = F.filter(keyed, lambda k: ~(
        (own != "") & (k["norm"] != "")
        & (F.contains(own, k["norm"]) | F.contains(k["norm"], own))))
    seen = F.aggregate(
        others, F.array().cast(f"array<struct<row:{RELATION},norm:string>>"),
        lambda acc, k: F.when(
            F.exists(acc, lambda a: (a["row"]["relatie"] == k["row"]["relatie"])
                     & (a["norm"] == k["norm"])), acc)
        .otherwise(F.concat(acc, F.array(k))))
    return F.transform(seen, lambda k: k["row"])


FREE_TEXT = ["oorzaak", "activiteiten", "ie_rechten", "koopsom_toelichting"]


def validate_responses(cases: DataFrame, salt: str) -> DataFrame:
    """Rows with the struct ``text``, answers ``a_<field>``, ``debtor_name`` and the parsed
    creditor count ``parsed_count`` to checked profile columns and relations."""
    kept = [c for c in cases.columns if c != "text" and not c.startswith("a_")]
    cases = cases.select("*", *[F.col(f"text.{c}").alias(f"_text_{c}")
                                for c in CHECKED_SECTIONS]).drop("text")
    a = {f: F.col(f"a_{f}") for f in FIELDS}
    t = {c: F.col(f"_text_{c}") for c in CHECKED_SECTIONS}
    activity, sector = valid_summary(a["sector"], "activiteiten", "sector")
    cause, cause_label = valid_summary(a["oorzaak"], "oorzaak", "categorie")
    staged = compute_once(cases, {
        "activiteiten": activity, "sector": sector,
        "oorzaak": cause, "oorzaak_categorie": cause_label,
        "doorstart": restarted(a["doorstart"]), "overnemer": valid_acquirer(a["doorstart"]),
        "domeinnamen": valid_domains(a["domeinnamen"]),
        "ie_rechten": valid_ip(a["domeinnamen"], t["andere_activa"]),
        "_persons": known_persons(a["directie"]),
        **{f: valid_flag(a["rechtmatigheid"], f) for f in GOVERNANCE_FLAGS},
        **{f: valid_flag(a["vastgoed"], f) for f in PREMISES_FLAGS},
        "afwikkeling": valid_settlement(a["afwikkeling"]),
        "concurrent_aantal": F.coalesce(F.col("parsed_count"),
                                        valid_creditor_count(a["afwikkeling"])),
    })
    price_known = F.col("doorstart")
    staged = compute_once(staged, {
        "koopsom": F.when(price_known, F.try_variant_get(a["koopsom"], "$.koopsom", "double")),
        "koopsom_toelichting": F.when(price_known,
                                      redact_persons(_text(a["koopsom"], "toelichting"))),
        "bestuurders_gehasht": director_hashes(F.col("_persons"), salt),
        "_pattern": known_person_pattern(F.col("_persons")),
        "_relations": F.concat(
            acquirer_relation(F.col("overnemer"), t["doorstart"]),
            director_relations(a["directie"], t["inventarisatie"]),
            bank_relations(a["bank"], t["zekerheden"])),
    })
    scrubbed = compute_once(staged, {
        **{c: scrub_known_persons(F.col(c), F.col("_pattern")) for c in FREE_TEXT},
        "relations": dedupe_relations(F.col("_relations"), F.col("debtor_name")),
    })
    produced = ["activiteiten", "sector", "oorzaak", "oorzaak_categorie", "doorstart",
                "overnemer", "koopsom", "koopsom_toelichting", "domeinnamen", "ie_rechten",
                "bestuurders_gehasht", *GOVERNANCE_FLAGS, *PREMISES_FLAGS, "afwikkeling",
                "concurrent_aantal", "relations"]
    return scrubbed.select(*kept, *produced)
