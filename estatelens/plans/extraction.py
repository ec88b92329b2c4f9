"""Report extraction: reports of a case to one record.

Reports are mined where they lie, row by row; what meets the worklist are figures and the few
sections that answers are checked against.  ``plans.mined`` keeps mined reports between runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions import figures
from estatelens.functions.sections import split_sections
from estatelens.functions.stages import compute_once
from estatelens.functions.text import blank_to_null, clean_text, lines, unify_line_ends
from estatelens.operators.keyset import flag_known
from estatelens.operators.responses import CHECKED_SECTIONS, answers, validate_responses
from estatelens.vocab import DEBT_LABELS

#: Sections that questions or checks are about.
SECTIONS = ["activiteiten", "oorzaak", "doorstart", "andere_activa", "zekerheden",
            "rechtmatigheid", "activa", "crediteuren", "personeel", "inventarisatie", "head"]
#: Those that a record needs: what answers are checked against.
CHECKED = [*CHECKED_SECTIONS, "head"]


def section_reports(texts: DataFrame) -> DataFrame:
    """(document_kenmerk, text) to the cleaned text, its lines and its sections."""
    cleaned = compute_once(texts, {"cleaned": clean_text(F.col("text"))})
    sectioned = compute_once(cleaned, {"sections": split_sections(F.col("cleaned"))})
    return sectioned.withColumn("lines", lines(F.col("cleaned")))


def mine_reports(sectioned: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """The figures of a report: all of them, or those named by ``only``, at the cost of those.

    Input columns pass through, lines excepted.  The revenue table reads the uncleaned text: a
    page break inside it counts as a line.
    """
    section = F.coalesce(F.try_element_at("sections", F.lit("crediteuren")), F.lit(""))
    staff = F.coalesce(F.try_element_at("sections", F.lit("personeel")), F.lit(""))
    whole = F.col("cleaned")
    miners = {
        "revenue": lambda: figures.parse_revenue(F.col("text")),
        "assets": lambda: figures.asset_realizations(whole),
        "boedel": lambda: figures.estate_balances(whole),
        "creditors": lambda: figures.creditor_recovery(whole),
        "debt": lambda: figures.merge_debt(figures.debt_sections(section),
                                           figures.debt_totals(whole)),
        "headcount": lambda: figures.headcount(staff, whole),
    }
    wanted = list(miners) if only is None else list(only)
    if unknown := set(wanted) - set(miners):
        raise ValueError(f"no such figures: {sorted(unknown)}")
    return compute_once(sectioned.drop("lines"), {name: miners[name]() for name in wanted})


def mine_texts(texts: DataFrame, narrative: Column | None = None,
               financial: Column | None = None) -> DataFrame:
    """(document_kenmerk, text, …) to one row per report: its sections and all its figures, made
    where the text lies.

    ``narrative`` and ``financial`` say which reports to read as such (default: each as both).
    Other columns pass through, the text does not.
    """
    as_told = F.lit(True) if narrative is None else narrative
    as_sums = F.lit(True) if financial is None else financial
    rows = compute_once(texts, {"cleaned": clean_text(F.col("text")), "_told": as_told,
                                "_sums": as_sums})
    rows = compute_once(rows, {"_plain": unify_line_ends(F.col("cleaned"))})
    rows = compute_once(rows, {"_found": F.when(F.col("_told"), split_sections(
        F.col("cleaned"), F.col("_plain")))})

    def section(name: str) -> Column:
        return F.coalesce(F.try_element_at("_found", F.lit(name)), F.lit(""))

    def told(c: Column) -> Column:
        return F.when(F.col("_told"), c)

    def sums(c: Column) -> Column:
        return F.when(F.col("_sums"), c)

    whole = F.col("cleaned")
    return compute_once(rows, {
        "sections": told(F.struct(*[section(name).alias(name) for name in SECTIONS])),
        "revenue": told(figures.parse_revenue(F.col("text"))),
        "by_section": told(figures.debt_sections(section("crediteuren"), unified=True)),
        "staff": told(figures.headcount(section("personeel"), unified=True)),
        "whole_staff": told(figures.headcount(F.col("_plain"), unified=True)),
        "assets": sums(figures.asset_realizations(whole)),
        "boedel": sums(figures.estate_balances(whole)),
        "creditors": sums(figures.creditor_recovery(whole)),
        "totals": sums(figures.debt_totals(whole)),
    }).drop("cleaned", "text", "_told", "_sums", "_plain", "_found")


def _wanted_reports(worklist: DataFrame) -> DataFrame:
    """One row per case and distinct report, with the parts that report plays."""
    one = F.col("first_nar") == F.col("last_nar")

    def part(doc: str, first, latest, financial: bool):
        return F.struct(F.col(doc).alias("document_kenmerk"), first.alias("is_first"),
                        latest.alias("is_latest"), F.lit(financial).alias("is_financial"))

    parts = F.array(
        part("first_nar", F.lit(True), F.coalesce(one, F.lit(False)), False),
        F.when(~one, part("last_nar", F.lit(False), F.lit(True), False)),
        part("last_fin", F.lit(False), F.lit(False), True))
    rows = worklist.select("kenmerk", F.explode(
        F.filter(parts, lambda p: p["document_kenmerk"].isNotNull())).alias("p"))
    return rows.select("kenmerk", "p.*")


def _mined_here(worklist: DataFrame, texts: DataFrame) -> DataFrame:
    """The wanted reports of ``texts``, mined where they lie.

    Bitmaps of the wanted ids, of a fixed size, go to the texts; a few texts that nobody wants are
    mined as well and meet no case afterwards.
    """
    financial = F.col("is_financial")
    rows = flag_known(texts.select("document_kenmerk", "text"), _wanted_reports(worklist),
                      ["document_kenmerk"], {"_narrative": ~financial, "_financial": financial})
    rows = rows.filter(F.col("_narrative") | F.col("_financial"))
    return mine_texts(rows, F.col("_narrative"), F.col("_financial")).drop(
        "_narrative", "_financial")


def _mined_cases(worklist: DataFrame, mined: DataFrame, sections: Sequence[str],
                 current: DataFrame | None = None) -> DataFrame:
    """The parts of every case with a report, as structs: figures and the named sections."""
    wanted, on = _wanted_reports(worklist), ["document_kenmerk"]
    if current is not None:  # which version of a report's text counts
        on.append("text_digest")
        wanted = wanted.join(current.select(*on), "document_kenmerk")

    def carried(name: str) -> Column:
        text = F.col(f"sections.{name}")
        # text before the first header stands in for a missing inventory only
        return F.when(F.col("sections.inventarisatie") == "", text) if name == "head" else text

    reports = wanted.join(mined.select(
        *on, F.when(F.col("sections").isNotNull(), F.struct(
            F.struct(*[carried(name).alias(name) for name in sections]).alias("sections"),
            (F.col("sections.crediteuren") != "").alias("has_debt"),
            (F.col("sections.personeel") != "").alias("has_staff"),
            "revenue", "by_section", "staff", "whole_staff")).alias("narrative"),
        F.when(F.col("boedel").isNotNull(), F.struct("assets", "boedel", "creditors", "totals"))
        .alias("financial")), on)

    def part(flag: str, column: str):
        return F.first(F.when(F.col(flag), F.col(column)), ignorenulls=True)

    # at most three rows per case, and equal ones of a report that was mined twice
    return reports.groupBy("kenmerk").agg(
        part("is_first", "narrative").alias("n0"), part("is_latest", "narrative").alias("n1"),
        part("is_financial", "financial").alias("f"))


def _mined_worklist(worklist: DataFrame, mined: DataFrame, sections: Sequence[str],
                    current: DataFrame | None = None) -> DataFrame:
    """Worklist rows with the chosen sections (struct ``text``) and all figures."""
    cases = worklist.select("kenmerk", "insolventienummer", "kvk_nummer", "debtor_name").join(
        _mined_cases(worklist, mined, sections, current), "kenmerk", "left")
    no_rows = F.array().cast(f"array<{figures.REVENUE_ROW}>")

    def latest_with(flag: str, column: str) -> Column:
        late = F.coalesce(F.col(f"n1.{flag}"), F.lit(False))
        return F.when(late, F.col(f"n1.{column}")).otherwise(F.col(f"n0.{column}"))

    chosen = chosen_sections(sections)
    return cases.select(
        "kenmerk", "insolventienummer", "kvk_nummer", "debtor_name",
        F.struct(*[c.alias(name) for name, c in chosen.items()]).alias("text"),
        figures.merge_revenue(F.coalesce("n1.revenue", no_rows),
                              F.coalesce("n0.revenue", no_rows)).alias("omzet_historie"),
        latest_with("has_debt", "by_section").alias("by_section"),
        latest_with("has_staff", "staff").alias("staff"),
        F.coalesce("n1.whole_staff", "n0.whole_staff").alias("whole_staff"),
        F.coalesce("f.assets", F.create_map().cast("map<string,double>"))
        .alias("asset_realizations"),
        F.col("f.boedel").alias("boedel"), F.col("f.creditors").alias("creditors"),
        F.col("f.totals").alias("totals"))


def chosen_sections(names: Sequence[str]) -> dict[str, Column]:
    """The section each question is about, from the earliest (``n0``) and the latest narrative
    (``n1``).

    What a company did stands best in the first report, how its estate went in the latest.
    """
    def pick(name: str, *order: str) -> Column:
        return F.coalesce(*[blank_to_null(F.col(f"{n}.sections.{name}")) for n in order],
                          F.lit(""))

    texts = {}
    for name in names:
        if name == "activiteiten":
            texts[name] = pick(name, "n0", "n1")
        elif name == "inventarisatie":
            texts[name] = F.coalesce(blank_to_null(pick(name, "n0", "n1")),
                                     pick("head", "n0", "n1"))
        elif name != "head":
            texts[name] = pick(name, "n1", "n0")
    return texts


def case_sections(worklist: DataFrame, texts: DataFrame) -> DataFrame:
    """(kenmerk, text): the sections a scorer is asked about, input of ``prompt_requests``."""
    return _mined_worklist(worklist, _mined_here(worklist, texts), SECTIONS).select(
        "kenmerk", "text")


def mined_case_sections(worklist: DataFrame, mined: DataFrame, current: DataFrame) -> DataFrame:
    """As ``case_sections``, from the mined-report table."""
    return _mined_worklist(worklist, mined, SECTIONS, current).select("kenmerk", "text")


def extract_company(worklist: DataFrame, texts: DataFrame, responses: DataFrame | None = None,
                    *, salt: str) -> DataFrame:
    """One record per case of the worklist (kenmerk, first_nar, last_nar, last_fin, debtor_name,
    insolventienummer, kvk_nummer).

    ``texts`` is (document_kenmerk, text), ``responses`` is (kenmerk, field, reply).  A case whose
    texts are missing keeps a record without figures.  ``salt`` keys the hashes of persons; it
    must not be empty.  No report text is shuffled: figures and a few sections meet their case.
    """
    return _extracted(_mined_worklist(worklist, _mined_here(worklist, texts), CHECKED), responses,
                      salt)


def extract_mined(worklist: DataFrame, mined: DataFrame, current: DataFrame,
                  responses: DataFrame | None = None, *, salt: str) -> DataFrame:
    """As ``extract_company``, from the mined-report table (``plans.mined``); ``current`` is
    (document_kenmerk, text_digest) of the texts that count.  No text is read."""
    return _extracted(_mined_worklist(worklist, mined, CHECKED, current), responses, salt)


def _extracted(cases: DataFrame, responses: DataFrame | None, salt: str) -> DataFrame:
    if not salt:
        raise ValueError("hashes of persons need a salt")
    none = F.col("staff.personeel_ttv").isNull() & F.col("staff.personeel_jaar_voor").isNull()
    claims = figures.merge_debt(F.col("by_section"), F.col("totals"))
    claim_names = [key for key, _ in DEBT_LABELS]
    # flat columns: field access stays below the stages that follow
    flat = compute_once(cases, {
        "_claims": claims,
        "_staff": F.when(none, F.col("whole_staff")).otherwise(F.col("staff"))}).select(
        "kenmerk", "insolventienummer", "kvk_nummer", "debtor_name", "omzet_historie",
        "asset_realizations", "boedel", "creditors", "text", "_staff.personeel_ttv",
        "_staff.personeel_jaar_voor", *[f"_claims.{c}" for c in claim_names],
        F.col("_claims.concurrent_aantal").alias("parsed_count"))
    if responses is None:
        responses = cases.sparkSession.createDataFrame(
            [], "kenmerk string, field string, reply string")
    checked = validate_responses(flat.join(answers(responses), "kenmerk", "left"), salt)
    return checked.withColumn("debt", F.struct(*claim_names, "concurrent_aantal")).drop(
        *claim_names, "parsed_count", "concurrent_aantal")
