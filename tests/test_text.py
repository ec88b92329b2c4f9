from datetime import date, datetime

from pyspark.sql import functions as F

from estatelens.functions import casenumber, classify, dates, privacy, text


def test_parse_euro(evaluate):
    got = evaluate(["€ 1.234,56", "-", "--", "", None, "€ -5,00", "€ ,00", "€ -\xa05,00",
                    "1.2.3,4,5", "n.v.t.", "5d"], text.parse_euro)
    assert got == [1234.56, None, None, None, None, -5.0, 0.0, -5.0, None, None, None]


def test_matched_euro_agrees_with_parse_euro(evaluate):
    amounts = ["€ 1.234,56", "€-5,00", "€ - 7,10", "€\xa012,00", "€\n3,00", ""]
    assert evaluate(amounts, text.matched_euro) == evaluate(amounts, text.parse_euro)


def test_lines_follow_every_separator(evaluate):
    got = evaluate(["a\x0cb\r\nc\n", "", "a\n\nb", "\n", "a\x85b c", None], text.lines)
    assert got == [["a", "b", "c"], [], ["a", "", "b"], [""], ["a", "b", "c"], None]


def test_strip_all_white_space(evaluate):
    got = evaluate(["\xa0 a b\t\n", " \n", "", "x", None, "　é\x1f"], text.strip)
    assert got == ["a b", "", "", "x", None, "é"]


def test_clean_text(evaluate):
    got = evaluate(["w orden W ij new e", "a\x07b\x0cc\td\re\n", "éw x", "w A"], text.clean_text)
    assert got == ["worden Wij new e", "abc\td\re\n", "éw x", "w A"]


def test_grounded(evaluate):
    source = F.lit("De  KLAVER\n b.v. is")
    got = evaluate(["klaver B.V.", "Klaver bv", "", None, "  De\tKlaver "],
                   lambda c: text.grounded(c, source))
    assert got == [True, False, False, False, True]


def test_dutch_date_uses_first_hit_only(evaluate):
    got = evaluate(["op 31 februari 2024", "op 3 personen 2024, later op 4 mei 2024",
                    "op 4 Mei 2024 en op 5 mei 2024", "op 6 juli 3026", "Op 4 mei 2024", "", None,
                    "op 1 mei 0000", "op 0 mei 2024"], dates.dutch_date)
    assert got == [None, None, date(2024, 5, 4), date(3026, 7, 6), None, None, None, None, None]


def test_dotnet_date_ignores_offset_by_default(evaluate):
    values = ["/Date(1769382000000+0100)/", "/Date(1769382000000)/", "/Date(-1)/", "x", None,
              "/Date(99999999999999999999)/"]
    assert evaluate(values, dates.dotnet_date) == [date(2026, 1, 25)] * 2 + [None] * 4
    assert evaluate(values[:2], lambda c: dates.dotnet_date(c, local=True)) == [
        date(2026, 1, 26), date(2026, 1, 25)]


def test_iso_date_clamp(evaluate):
    got = evaluate(["2024-01-05T10:00", "2024-1-5", "2024-02-30", "3026-07-06", "1969-12-31",
                    "2149-06-06", "20240105", "", None], dates.iso_date_clamp)
    assert got == [date(2024, 1, 5), None, None, None, None, date(2149, 6, 6), None, None, None]


def test_dmy_date(evaluate):
    got = evaluate(["05-01-2024", "00-00-0000", "31-02-2024", "2024-01-05", ""], dates.dmy_date)
    assert got == [date(2024, 1, 5), None, None, None, None]


def test_case_year_pivot(evaluate):
    got = evaluate(["F.10/30/1", "F.10/31/1", "F.10/x/1", "junk", ""], dates.case_year)
    assert got == [2030, 1931, 0, 0, 0]


def test_period_start():
    now = datetime(2024, 3, 31, 12)
    assert dates.period_start("Laatste week", now) == datetime(2024, 3, 24, 12)
    assert dates.period_start("Vandaag", now) == now
    assert dates.period_start("Laatste maand", now) == datetime(2024, 2, 28, 12)
    assert dates.period_start("anders", datetime(2024, 1, 5)) == datetime(2023, 12, 5)


def test_event_type_longest_keyword_wins(evaluate):
    got = evaluate(["Neerlegging tussentijdse uitdelingslijst na uitspraak", "EINDE na uitspraak",
                    "Beëindiging", "niets"], classify.event_type)
    assert got == ["neerlegging_tussentijdse_uitdelingslijst", "uitspraak", "einde", "unknown"]


def test_subtype_and_insolvency_type(evaluate):
    assert evaluate(["na voorlopige surseance, verzet", "verzet", "x"], classify.event_subtype) == [
        "na_surseance", "verzet", None]
    assert evaluate(["surseance en schuldsanering", "Surséance", "x"],
                    classify.insolvency_type) == ["schuldsanering", "surseance", "unknown"]


def test_report_type(evaluate):
    got = evaluate(["Financieel verslag  21-04-2026", "Verslag: 3", "2024", "", None, "Eind"],
                   classify.report_type)
    assert got == ["Financieel verslag", "Verslag", "Verslag", "Verslag", "Verslag", "Eind"]


def test_derive_case_number(evaluate):
    got = evaluate(["10_rot_26_194_F_V_02_B", "08.one.12.0388.F.V.03.B", "alk.09.0164.F.V.01",
                    "xyz_09_1_F_V_1", "junk"], casenumber.derive_case_number)
    assert [tuple(r) for r in got] == [
        ("10_rot_26_194_F", "F.10/26/194"), ("08_one_12_0388_F", "F.08/12/388"),
        ("alk.09.0164.F", "F.14/09/164"), ("xyz.09.1.F", ""), ("", "")]


def test_hashes_differ_in_normalisation(evaluate):
    plain = evaluate(["Jan", " jan "], lambda c: privacy.salted_hash(c, "s"))
    folded = evaluate(["Jan", " jan "], lambda c: privacy.person_hash(c, "s"))
    assert plain[0] != plain[1] and folded[0] == folded[1]
    assert all(len(h) == 12 and set(h) <= set("0123456789abcdef") for h in plain + folded)


def test_redaction(evaluate):
    got = evaluate(["Dhr. J. de Vries is weg", "mevr. Élise X", "de heer loopt", "", None],
                   privacy.redact_persons)
    assert got == ["[persoon] is weg", "mevr. Élise X", "de heer loopt", "", None]
    once = evaluate(["met mevrouw Bos en dhr. A. van Dam"], privacy.redact_persons)
    assert evaluate(once, privacy.redact_persons) == once
    assert evaluate(["mevr. Élise X"], lambda c: privacy.redact_persons(c, True)) == ["[persoon]"]


def test_known_persons(spark):
    df = spark.createDataFrame(
        [(["J. de Vries", "A.b\\E(c"], "j. DE vries, De Vries en A.B\\E(C"), ([], "tekst")],
        "n array<string>, t string")
    got = [r[0] for r in df.select(privacy.scrub_known_persons(
        F.col("t"), privacy.known_person_pattern(F.col("n")))).collect()]
    assert got == ["[persoon], [persoon] en [persoon]", "tekst"]
