import json

from pyspark.sql import functions as F

from estatelens.operators import fanout, responses
from estatelens.plans.extraction import extract_company


def variant(fn):
    return lambda c: fn(F.try_parse_json(c))


def answers(evaluate, values, fn):
    return evaluate([json.dumps(v) for v in values], variant(fn))


def test_response_json(evaluate):
    got = evaluate(['x {"a": {"b": 1}} y', "{half", "geen", "} {", None],
                   lambda c: F.try_variant_get(responses.response_json(c), "$.a.b", "int"))
    assert got == [1, None, None, None, None]


def test_acquirers(evaluate):
    names = ["'Klaver B.V.'", ' "De Overnemer" ', "de heer Bos", "n.v.t.", "", None, "Koper Groep"]
    got = answers(evaluate, [{"overnemer": n} for n in names], responses.valid_acquirer)
    assert got == ["Klaver B.V.", None, None, None, None, None, "Koper Groep"]


def test_ip_claim_needs_support(evaluate):
    section = F.lit("Er is een MERK en een domein")
    claims = ["merkrechten en octrooi", "octrooi", "software van dhr. Bos", "", None]
    got = answers(evaluate, [{"ie_rechten": c} for c in claims],
                  lambda a: responses.valid_ip(a, section))
    assert got == ["merkrechten en octrooi", None, "software van [persoon]", "", None]


def test_flags_are_json_booleans_only(evaluate):
    got = answers(evaluate, [{"f": v} for v in (True, False, None, "true", 1, [])] + [{}],
                  lambda a: responses.valid_flag(a, "f"))
    assert got == [True, False, None, None, None, None, None]


def test_creditor_count(evaluate):
    values = [0, 99999, 100000, -1, 2.5, "3", None]
    got = answers(evaluate, [{"aantal_concurrente_crediteuren": v} for v in values],
                  responses.valid_creditor_count)
    assert got == [0, 99999, None, None, None, None, None]


def test_bank_amounts_round_half_even(evaluate):
    section = F.lit("Rabobank, ABN AMRO, de bank, Lening B.V. en Tulp")
    banks = [{"naam": "Rabobank", "vordering": 2.5}, {"naam": "ABN  amro", "vordering": 3.5},
             {"naam": "de bank", "vordering": 1}, {"naam": "Lening B.V.", "vordering": 0},
             {"naam": "Tulp"}, {"naam": "ING bank"}, {}]
    got = answers(evaluate, [{"banken": banks}], lambda a: F.transform(
        responses.bank_relations(a, section), lambda r: F.concat_ws("=", r["company_name"], r["detail"])))
    assert got == [["Rabobank=vordering 2", "ABN  amro=vordering 4", "Lening B.V.="]]


def test_directors(evaluate):
    people = ["Jan Bos ", "jan", "een natuurlijk persoon", None, "Jan Bos"]
    got = answers(evaluate, [{"personen": people}, {"personen": None}, {}],
                  lambda a: responses.director_hashes(responses.known_persons(a), "s"))
    assert [len(g) for g in got] == [1, 0, 0]


def test_related_companies(evaluate):
    section = F.lit("Holding A B.V. en Stichting B")
    firms = [{"naam": "Holding A B.V.", "relatie": "moeder"}, {"naam": "Stichting B"},
             {"naam": "Holding A B.V.", "relatie": "buur"}, {"naam": "Elders B.V."}, {"naam": "en"}]
    got = answers(evaluate, [{"bedrijven": firms}], lambda a: F.transform(
        responses.director_relations(a, section), lambda r: F.concat_ws(":", r["relatie"], r["company_name"])))
    assert got == [["moeder:Holding A B.V.", "gelieerd:Stichting B"]]


NARRATIVE = """Kop
1. Inventarisatie
Bestuurder is Moeder Holding B.V.
2. Personeel
Aantal ten tijde van faill.
  12
6. Voortzetten / doorstart onderneming
Verkocht aan Klaver B.V.
8. Crediteuren
8.1 Boedel
 € 10,00
8.7 Wijze"""


def test_extraction_end_to_end(spark):
    work = spark.createDataFrame(
        [("K1", "n", "n", "f", "F.1", "1", "Debiteur B.V."), ("K2", "x", "y", "z", "F.2", None, None)],
        "kenmerk string, first_nar string, last_nar string, last_fin string, "
        "insolventienummer string, kvk_nummer string, debtor_name string")
    texts = spark.createDataFrame(
        [("n", NARRATIVE), ("f", "Totaal debiteuren € 5,00\nTotaal boedelvorderingen € 11,00")],
        "document_kenmerk string, text string")
    replies = spark.createDataFrame(
        [("K1", "doorstart", '{"doorstart": true, "overnemer": "Klaver B.V."}'),
         ("K1", "koopsom", '{"koopsom": 5, "toelichting": "via J. Bos"}'),
         ("K1", "directie", '{"personen": ["J. Bossen"], "bedrijven": [{"naam": '
                            '"Moeder Holding B.V.", "relatie": "moeder"}]}'),
         ("K1", "oorzaak", '{"oorzaak": "fout van J. Bossen of bossen", "categorie": "overig"}')],
        "kenmerk string, field string, reply string")
    records = {r["kenmerk"]: r for r in extract_company(work, texts, replies, salt="s").collect()}
    one, two = records["K1"], records["K2"]
    assert one["oorzaak"] == "fout van [persoon] of [persoon]"
    assert [(r["relatie"], r["company_name"]) for r in one["relations"]] == [
        ("overnemer", "Klaver B.V."), ("moeder", "Moeder Holding B.V.")]
    assert (one["koopsom"], one["personeel_ttv"], one["debt"]["boedelvorderingen"],
            one["asset_realizations"]) == (5.0, 12, 11.0, {"debiteuren": 5.0})
    assert two["relations"] == [] and two["omzet_historie"] == []
    without = extract_company(work, texts, salt="s")
    assert {r["kenmerk"] for r in fanout.to_debt(without).collect()} == {"K1"}
    assert without.filter("personeel_ttv = 12").count() == 1


def test_price_is_asked_after_a_restart_only(spark):
    cases = spark.createDataFrame([("a",), ("b",)], "kenmerk string").select("kenmerk", F.struct(*[
        F.lit("tekst" if k == "doorstart" else " ").alias(k) for k in (
            "activiteiten", "oorzaak", "doorstart", "andere_activa", "zekerheden",
            "rechtmatigheid", "activa", "crediteuren", "personeel", "inventarisatie")]).alias("text"))
    restarts = spark.createDataFrame([("a",)], "kenmerk string")
    got = responses.prompt_requests(cases, clamp=3, restarts=restarts).collect()
    assert sorted((r["kenmerk"], r["field"]) for r in got) == [
        ("a", "doorstart"), ("a", "koopsom"), ("a", "vastgoed"), ("b", "doorstart"), ("b", "vastgoed")]
    assert {r["text"] for r in got if r["field"] != "vastgoed"} == {"tek"}


def test_whole_rows_of_every_job_can_be_read(spark):
    """All columns at once, with field access on top (optimiser rules differ by what is read)."""
    from datetime import datetime

    from estatelens.plans.extraction import mine_reports, section_reports
    from estatelens.sources import payloads

    texts = spark.createDataFrame([("n", NARRATIVE)], "document_kenmerk string, text string")
    mined = mine_reports(section_reports(texts))
    row = mined.select("*", "debt.pref_uwv", "boedel.definitief_saldo").collect()[0]
    assert row["debt"]["boedelvorderingen"] == 10.0 and row["headcount"]["personeel_ttv"] == 12
    assert mined.filter("debt.boedelvorderingen = 10 and size(assets) = 0").count() == 1
    one = mine_reports(section_reports(texts), only=["headcount"])
    assert one.columns == [c for c in mined.columns if c not in (
        "revenue", "assets", "boedel", "creditors", "debt")]
    assert one.first()["headcount"] == row["headcount"]

    raw = spark.createDataFrame(
        [("q", '{"model": {"persoon": {"voornaam": "Jan"}}}', datetime(2024, 1, 1))],
        "query_kenmerk string, payload string, scraped_at timestamp")
    decoded = payloads.anonymise(payloads.decode_case(raw), "s")
    assert decoded.select("*", "record.debtor.name").filter("record.type = 'person'").count() == 1
    assert payloads.normalise_cases(raw, "s").collect()[0]["entity_type"] == "person"


def test_replies_are_dealt_by_case_before_they_are_parsed_and_sorted(spark):
    rows = spark.range(0, 4000, 1, 1).selectExpr(
        "concat('K', cast(id % 400 as string)) as kenmerk", "'sector' as field",
        """concat('{"sector": "s', cast(id as string), '"}') as reply""")
    found = responses.answers(rows)
    assert found.count() == 400
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    below = plan[plan.rindex("Exchange"):]
    assert "try_parse_json" not in below and "Sort" not in below and "Aggregate" not in below
