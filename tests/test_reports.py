from pyspark.sql import functions as F

from estatelens.functions import figures, sections

HEADER = "  Jaar   Omzet        Winst en verlies    Balanstotaal"


def revenue(evaluate, *body):
    got = evaluate(["\n".join(["kop", HEADER, *body])], figures.parse_revenue)[0]
    return [tuple(r) for r in got]


def test_sections_first_hit_and_head(evaluate):
    got = evaluate([
        "Kop\n Activiteiten  onderneming \nbouw\n1. Inventarisatie\ninv\n1.5 Oorzaak faillissement"
        "\noz\n1. Inventarisatie\nherhaald\n8. Crediteuren\nx", "geen kop\n", "\n2. Personeel\n",
        "1. inventarisatie\nA", None, ""], sections.split_sections)
    assert got == [
        {"head": "Kop", "activiteiten": "Activiteiten  onderneming \nbouw",
         "inventarisatie": "1. Inventarisatie\ninv",
         "oorzaak": "1.5 Oorzaak faillissement\noz\n1. Inventarisatie\nherhaald",
         "crediteuren": "8. Crediteuren\nx"},
        {"head": "geen kop\n"}, {"head": "", "personeel": "2. Personeel"},
        {"inventarisatie": "1. inventarisatie\nA"}, None, {"head": ""}]


def test_headers_do_not_match_inside_lines(evaluate):
    got = evaluate(["zie 2. Personeel\nActiviteiten onderneming en meer"], sections.split_sections)
    assert list(got[0]) == ["head"]


def test_sections_beyond_basic_plane(evaluate):
    got = evaluate(["😀😀 kop\n2. Personeel 😀\n3. Activa\n😀"], sections.split_sections)
    assert got == [{"head": "😀😀 kop", "personeel": "2. Personeel 😀", "activa": "3. Activa\n😀"}]


def test_revenue_columns_and_stop(evaluate):
    rows = revenue(evaluate, "toelichting", " 2020   € 1.000,00   € -5,00             € 7,00", "",
                   " 2021                € 2,00", " einde", " 2022   € 9,00")
    assert rows == [(2020, 1000.0, -5.0, 7.0), (2021, None, 2.0, None)]


def test_revenue_duplicate_year_gives_nothing(evaluate):
    assert revenue(evaluate, " 2020   € 1,00", " 2020   € 2,00") == []


def test_revenue_page_break_uses_up_the_window(evaluate):
    blank = [""] * 11
    assert revenue(evaluate, " 2020   € 1,00", *blank, " 2021   € 2,00") == [
        (2020, 1.0, None, None), (2021, 2.0, None, None)]
    assert revenue(evaluate, " 2020   € 1,00\x0c", *blank, " 2021   € 2,00") == [
        (2020, 1.0, None, None)]


def test_revenue_without_result_column_or_table(evaluate):
    got = evaluate(["Jaar  Omzet  Balanstotaal\n2020 € 1,00", "niets", "", None],
                   figures.parse_revenue)
    assert got == [[], [], [], []]


def test_assets_last_total_wins(evaluate):
    got = evaluate(["Subtotaal debiteuren € 5,00\nTotaal debiteuren x € 7,50 € 9,00\n"
                    "Totaal overige gebonden activa € 4,00\nsubtotaal OVERIG € 3,00\n"
                    "Totaal vrij actief € 0,00\nTotaal procedures € n.v.t.\n"
                    "Totaal deelnemingen Totaal voorraden / onderhanden € 2,00"],
                   figures.asset_realizations)
    assert got == [{"debiteuren": 7.5, "overig": 3.0, "deelnemingen": 2.0, "voorraden": 2.0}]


def test_estate_and_recovery(evaluate):
    fin = ("Definitief Saldo  € -12,30\nDefinitief Saldo € 1,00\ndefinitief saldo € 9,00\n"
           "Preferente crediteuren € 1.000,00 € 500,00 50,5 %\n"
           "Totaal concurrente schuldeisers € 1,00 € 0,00 . %")
    estate = evaluate([fin], figures.estate_balances)[0]
    assert tuple(estate) == (-12.3, None, None)
    recovery = evaluate([fin], figures.creditor_recovery)[0]
    assert tuple(recovery["preferente"]) == (1000.0, 500.0, 50.5)
    assert tuple(recovery["concurrente"]) == (1.0, 0.0, None)


def test_debt_totals_prefer_first_source(evaluate):
    got = evaluate(["totaal boedelvorderingen (x) € 5,00"], lambda c: figures.debt_totals(
        c, F.lit("Totaal boedelvorderingen € 6,00\nAndere preferente crediteuren € 7,00")))[0]
    assert (got["boedelvorderingen"], got["pref_overig"], got["pref_uwv"]) == (5.0, 7.0, None)


def test_debt_sections(evaluate):
    text = ("8. Crediteuren\n8.1 Boedel\n   € 1.000,00  1\n huur € 5,00\n   € 2.000,00 2\n"
            "8.5 Aantal\n 12   1\n 2020\n8.1 Herhaald\n niets\n8.6 Bedrag\n € 5,00\n8.7 Wijze\n"
            " € 9,00")
    got = evaluate([text], figures.debt_sections)[0]
    assert (got["boedelvorderingen"], got["concurrent_aantal"], got["concurrent_bedrag"],
            got["pref_uwv"]) == (2000.0, 12, 5.0, None)


def test_debt_year_counts_need_report_number(evaluate):
    got = evaluate(["8.5 Aantal\n 2020  3", "8.5 Aantal\n 2020", "8.5 Aantal\n 1989"],
                   figures.debt_sections)
    assert [g["concurrent_aantal"] for g in got] == [2020, None, 1989]


def test_last_subsection_is_read_for_39_lines(evaluate):
    filler = "\n".join(["x"] * 38)
    got = evaluate([f"8.6 Bedrag\n{filler}\n€ 1,00", f"8.6 Bedrag\nx\n{filler}\n€ 1,00",
                    f"8.6 Bedrag\nx\n{filler}\n€ 1,00\n9. Procedures"], figures.debt_sections)
    assert [g["concurrent_bedrag"] for g in got] == [1.0, None, 1.0]


def test_headcount_left_column_within_four_lines(evaluate):
    far = " " * 41
    got = evaluate([
        f"Aantal ten tijde van faill.\n{far}1\n   69\nAantal in jaar voor faill\nx\n 70 ",
        "Aantal ten tijde van faill\na\nb\nc\nd\n5\nPersoneel gemiddeld aantal\n6", "niets"],
        figures.headcount)
    assert [tuple(g) for g in got] == [(69, 70), (6, None), (None, None)]


def test_headcount_falls_back_only_when_empty(evaluate):
    whole = F.lit("Aantal ten tijde van faill\n 5\nAantal in jaar voor faill\n 6")
    got = evaluate(["", "Aantal in jaar voor faill\n 7"], lambda c: figures.headcount(c, whole))
    assert [tuple(g) for g in got] == [(5, 6), (None, 7)]


def test_settlement_tail_takes_first_mention(evaluate):
    got = evaluate(["a 8.7 b 8.7 c", "x" * 5000, ""], sections.settlement_tail)
    assert got == ["8.7 b 8.7 c", "x" * 5000, ""]
    got = evaluate(["a 8.7 b 8.7 c", "x" * 5000, ""], lambda c: sections.settlement_tail(c, 4000))
    assert got == ["8.7 b 8.7 c", "x" * 4000, ""]


def test_documents_rejoin_to_their_lines(spark):
    """Sections of the sample documents, put together again, hold every non-blank line."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(50)
    with_header = docs.withColumn("text", F.concat(F.lit("kop\n2. Personeel\n"), "text",
                                                   F.lit("\n3. Activa\nslot")))
    for row in with_header.select("text", sections.split_sections(F.col("text")).alias("s")).collect():
        want = [ln.strip() for ln in row["text"].splitlines() if ln.strip()]
        got = [ln.strip() for k in ("head", "personeel", "activa")
               for ln in row["s"][k].splitlines() if ln.strip()]
        assert got == want


def test_figures_in_any_case_and_behind_odd_letters(evaluate):
    """The first letter is looked for plainly; the others fold as before."""
    texts = ["totaal BOEDELVORDERINGEN € 1,00 Totaal preferente ſchuldeiſers 5 € 2,00",
             "Totaal boedelvorderingen\n€ 3,00 TOTAAL boedelvorderİngen p € \n4,00", "", None]
    found = evaluate(texts, figures.debt_totals)
    assert [(r["boedelvorderingen"], r["pref_totaal"]) for r in found] == [
        (1.0, 2.0), (4.0, None), (None, None), (None, None)]
    staff = evaluate(["x aantal TEN tijde van faill\n\n 3\n", "PERSONEEL gemiddeld aantal\n7"],
                     figures.headcount)
    assert [r["personeel_ttv"] for r in staff] == [3, 7]


def test_claims_are_found_in_one_scan_and_years_without_failing_casts(spark):
    rows = spark.createDataFrame([("Totaal boedelvorderingen € 1,00",)], "t string")
    plan = rows.select(figures.debt_totals(rows.t).alias("d"), figures.parse_revenue(
        rows.t).alias("r"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
    assert plan.count("try_cast") <= len(figures.DEBT_LABELS) + 1  # amounts alone
