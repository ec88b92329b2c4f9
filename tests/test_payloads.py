import html
import json
from datetime import date, datetime

from pyspark.sql import functions as F

from estatelens.operators import fanout
from estatelens.sources import listing, payloads, rawlog
from estatelens.sources.listing import unescaped


def decode(spark, *bodies):
    df = spark.createDataFrame([(f"Q{i}", json.dumps(b)) for i, b in enumerate(bodies)],
                               "query_kenmerk string, payload string")
    rows = payloads.decode_case(df).orderBy("query_kenmerk").collect()
    return [r["record"].asDict(recursive=True) for r in rows]


def test_mixed_trade_names_and_entity_classes(spark):
    company, trader, person, named, bare = decode(
        spark,
        {"model": {"persoon": {"kvkNummer": "1", "achternaam": "Klaver B.V."}}},
        {"model": {"persoon": {"voornaam": "Jan", "voorvoegsel": "de", "achternaam": "Bos"},
                   "handelendOnderDeNamen": ["Los", {"handelsnaam": "Zaak", "KvKNummer": "7"}, None]}},
        {"model": {"persoon": {"geboortedatum": "x", "achternaam": "Bos"}}},
        {"model": {"persoon": None, "handelendOnderDeNamen": [{"KvKNummer": "8"}]}},
        {"persoon": {"KvKNummer": "9", "achternaam": "Zonder omslag"}})
    assert [r["type"] for r in (company, trader, person, named, bare)] == [
        "company", "eenmanszaak", "person", "company", "company"]
    assert trader["debtor"]["trade_names"] == ["Los", "Zaak"]
    assert (trader["debtor"]["name"], trader["debtor"]["kvk_nummer"]) == ("Jan de Bos", "7")
    assert named["debtor"]["trade_names"] == [""] and named["debtor"]["name"] == ""
    assert bare["debtor"]["name"] == "Zonder omslag" and bare["kenmerk"] == "Q4"


def test_addresses_in_fixed_order(spark):
    record = decode(spark, {"model": {
        "woonadressen": [{"straat": "A", "huisnummer": "1", "huisnummerToevoeging1": "",
                          "huisnummerToevoeging2": "b", "plaats": "W"}],
        "vestigingsadressen": None,
        "correspondentieadressen": [{"straat": "C"}],
        "handelendOnderDeNamen": [{"vestigingsadressen": [{"plaats": "H"}]}]}})[0]
    assert [(a["type"], a["number"], a["city"]) for a in record["debtor"]["addresses"]] == [
        ("woon", "1 b", "W"), ("correspondentie", None, None), ("vestiging", None, "H")]


def test_trustees(spark):
    record = decode(spark, {"model": {
        "curators": [{"titulatuur": "mr.", "achternaam": "Bos",
                      "adres": {"straat": "Plein", "huisnummer": "7", "plaats": "Assen"}}],
        "bewindvoerders": [{"voorletters": "A.", "achternaam": "Vos", "adres": {}}]}})[0]
    assert [(c["name"], c["address"], c["phone"]) for c in record["curators"]] == [
        ("mr. Bos", "Plein 7, Assen", None), ("A. Vos", None, None)]


def test_attempt_status(evaluate):
    got = evaluate([None, "<html>", '{"model": null}', '{"model": {}}', '{"status": 1}'],
                   payloads.attempt_status)
    assert got == ["fetch_failed", "fetch_failed", "purged", "ok", "ok"]
    bad = ["null", "[]", '"x"', "5", '{"model": 7}', '{"model": []}', '{"model": "x"}',
           '{"model": {"persoon": [1]}}', '{"model": {"persoon": 3}}',
           '{"model": {"curators": {"a": 1}}}', '{"model": {"curators": ["x"]}}',
           '{"model": {"woonadressen": true}}', '{"persoon": "Jan"}']
    assert evaluate(bad, payloads.attempt_status) == ["fetch_failed"] * len(bad)
    good = ['{"model": {"persoon": null, "curators": []}}', '{"model": {"persoon": ""}}',
            '{"model": {"persoon": {"a": 1}, "curators": [{"achternaam": "x"}]}}',
            '{"model": {"curators": {}, "woonadressen": 0}}']
    assert evaluate(good, payloads.attempt_status) == ["ok"] * len(good)


def test_status_of_one_parse_equals_the_status_of_all_types(spark):
    """Shapes that the schema reads, reports, or reads although they are no case."""
    member = ['"x"', '""', "0", "7", "true", "false", "null", "[]", "{}", "[null]", '["x"]', "[[]]",
              '[{"a": 1}]', '[null, {"a": 1}]', '[{"a": 1}, 3]', '{"a": 1}', '{"a": {"b": [1]}}']
    names = ["persoon", "curators", "publicatiegeschiedenis", "handelendOnderDeNamen", "RC",
             "onbekend"]
    inner = [f'{{"{n}": {v}, "status": 1}}' for n in names for v in member]
    bodies = [None, "", " ", "x", "{", "null", "[]", "[{}]", "{}", " {} ", '"a"', "5", '{"a": 1} x',
              '{"a": 1}{"b": 2}', '{"a": 1}, {"b": 2}', '{"m\\u006fdel": null}',
              '{"model": null, "RC": "r"}', '{"curators": "x", "model": {"RC": "r"}}',
              '{"model": {"curators": [{"adres": "x", "achternaam": "Bos"}]}}',
              *inner, *[f'{{"model": {v}}}' for v in [*member, *inner]]]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, payload string")
    want = {r.i: r.s for r in df.select("i", payloads.attempt_status(df.payload).alias("s"))
            .collect()}
    got = {r.i: r for r in payloads.read_payloads(df).collect()}
    assert {bodies[i]: r.status for i, r in got.items()} == {bodies[i]: s for i, s in want.items()}
    assert all((r.m is not None) == (r.status == "ok") for r in got.values())
    kept = got[bodies.index('{"model": {"curators": [{"adres": "x", "achternaam": "Bos"}]}}')]
    assert kept.status == "ok"
    read = got[bodies.index('{"curators": "x", "model": {"RC": "r"}}')]
    assert read.m["RC"] == "r"


def test_anonymise_keeps_companies_and_trustees(spark):
    body = {"achternaam": "Bos"}
    df = spark.createDataFrame(
        [("c", json.dumps({"model": {"persoon": {"KvKNummer": "1", **body}}})),
         ("p", json.dumps({"model": {
             "persoon": {"voornaam": "Jan", **body}, "curators": [{"achternaam": "Vos"}],
             "handelendOnderDeNamen": ["Bos B.V.", "Bos"],
             "woonadressen": [{"straat": "A", "postcode": "1", "plaats": "W"}]}}))],
        "query_kenmerk string, payload string")
    company, person = [r["record"] for r in payloads.anonymise(
        payloads.decode_case(df), "s").orderBy("query_kenmerk").collect()]
    assert company["debtor"]["name"] == "Bos" and not company["is_anonymized"]
    assert person["is_anonymized"] and len(person["debtor"]["name"]) == 12
    assert person["debtor"]["trade_names"][0] == "Bos B.V."
    assert len(person["debtor"]["trade_names"][1]) == 12
    address = person["debtor"]["addresses"][0]
    assert (address["street"], address["postcode"], address["city"]) == (None, None, "W")
    assert person["curators"][0]["name"] == "Vos"


def test_search_envelopes(spark):
    item = {"publicatieKenmerk": "", "kenmerk": "A", "omschrijving": "o"}
    bodies = [{"result": {"model": {"items": [item]}}}, [item], {"result": [item]},
              {"model": {"items": [item]}}, {"result": None}, {"result": {"model": {}}},
              {"result": {"status": 3}, "model": {"items": [item]}}, {"items": [{"kenmerk": ""}]}]
    df = spark.createDataFrame([(str(i), json.dumps(b)) for i, b in enumerate(bodies)]
                               + [("x", "{")], "court string, body string")
    got = payloads.decode_search(df).orderBy("court").collect()
    assert [(r["court"], r["kenmerk"], r["description"]) for r in got] == [
        (str(i), "A", "o") for i in range(4)]


def test_reports_of_companies_only(spark):
    cases = spark.createDataFrame([("a", "company", "F.1"), ("b", "person", "F.1"),
                                   ("c", "company", "")],
                                  "kenmerk string, type string, insolventienummer string")
    body = json.dumps({"model": {"items": [
        {"VerslagKenmerk": "v1", "DatumVerslagen": "/Date(0)/", "Titel": "Verslag: 1"},
        {"VerslagKenmerk": ""}, {"VerslagKenmerk": "v2"}]}})
    replies = spark.createDataFrame([("F.1", body), ("", body)],
                                    "insolventienummer string, body string")
    got = payloads.decode_reports(cases, replies).orderBy("document_kenmerk").collect()
    assert [tuple(r) for r in got] == [("a", "v1", date(1970, 1, 1), "Verslag"),
                                       ("a", "v2", None, "Verslag")]


def test_probe_verdicts(spark):
    bodies = {"a": {"result": {"status": 1, "model": {"aantalResultaten": 2, "items": [{}]}}},
              "b": {"status": 1, "model": {"aantalResultaten": 0, "items": []}},
              "c": {"result": []}, "d": {"result": {"status": 2}}}
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in bodies.items()],
                               "insolventienummer string, body string")
    got = payloads.classify_probe(df).orderBy("insolventienummer").collect()
    assert [(r["status"], r["aantal"], r["queued"]) for r in got] == [
        ("found", 2, 0), ("not_found", 0, 0), ("error", 0, 0), ("error", 0, 0)]


def test_malformed_records_go_aside(spark):
    df = spark.createDataFrame([("a", '{"kenmerk": "x", "publications": null}'), ("b", "{"),
                                ("c", "[1]")], "kenmerk string, record string")
    good, bad = rawlog.decode_record(df)
    assert [r["record"]["kenmerk"] for r in good.filter("kenmerk = 'a'").collect()] == ["x"]
    assert "b" in [r["kenmerk"] for r in bad.collect()]


def test_fanout_defaults(spark):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), json.dumps({"publications": [{"date": "3026-01-01"}]}))],
        "kenmerk string, scraped_at timestamp, record string")
    good, _ = rawlog.decode_record(df)
    case = fanout.to_cases(good).collect()[0]
    assert (case["kenmerk"], case["court"], case["kvk_nummer"], case["city"],
            case["curator_names"], case["publication_count"], case["document_count"]) == (
        "a", "", None, None, [], 1, 0)
    pub = fanout.to_publications(good).collect()[0]
    assert (pub["publicatie_datum"], pub["event_subtype"], pub["event_type"]) == (None, None, "")
    assert fanout.to_documents(good).count() == 0


def test_pick_city_preference(spark):
    df = spark.sql("""select array(named_struct('type', 'woon', 'city', 'W'),
        named_struct('type', 'vestiging', 'city', ''), named_struct('type', 'anders', 'city', 'X')) a
        union all select array(named_struct('type', 'anders', 'city', 'X'))""")
    assert sorted(r[0] for r in df.select(fanout.pick_city(F.col("a"))).collect()) == ["W", "X"]


def test_entities_as_the_standard_library_decodes_them(spark):
    cells = [None, "", "plain", "a & b", "&", "&&amp;;", "Caf&eacute; &amp; Zn", "&#39;x&#39;",
             "&#039; &#x27; &#150; &#0;", "A&B", "&notit; &not it &ampx", "&NotEqualTilde;!",
             "&CounterClockwiseContourIntegral;", "x &copy 2024", "&amp;lt;", "&;&#;&#x;", "&lt",
             "&" + "a" * 40 + ";", "&\n&eacute\n;"]
    df = spark.createDataFrame([(i, c, c) for i, c in enumerate(cells)],
                               "i int, name string, other string")
    out = unescaped(df, ["name", "other"])
    want = [c if c is None else html.unescape(c) for c in cells]
    rows = out.orderBy("i").collect()
    assert [r.name for r in rows] == want == [r.other for r in rows]
    assert out.columns == df.columns


def test_python_sees_only_cells_with_other_entities(spark, monkeypatch):
    seen = F.pandas_udf(lambda cells: cells.map(lambda c: "seen", na_action="ignore"), "string")
    monkeypatch.setattr(listing, "_unescape", seen)
    df = spark.createDataFrame([("a & b",), ("&eacute;&#39;",), ("A&B",), ("plain",)], "c string")
    assert [r.c for r in unescaped(df, ["c"]).collect()] == ["a & b", "é'", "seen", "plain"]


def test_listing_entities_and_audit(spark):
    row = ('<a href="/faillissement/verslagen/verslag/alk.09.1.F.V.01">Details</a></td> '
           '<td nowrap="nowrap"> 1 </td><td nowrap="nowrap" class="sorting_1">00-00-0000</td>'
           '<td nowrap="nowrap"><span title="Caf&eacute; &quot;&amp;&#39;">x</span></td>'
           '<td nowrap="nowrap">&#39;s-Hertogenbosch</td>')
    df = spark.createDataFrame(
        [(1, row + "Resulaten 1 tot 1 van 1.234"), (2, row + "Resulaten 1 tot 1 van 9"),
         (3, "Resulaten 201 tot 201 van 9"), (4, row), (5, row + "Resulaten 401 tot 402 van 9")],
        "page int, html string")
    got = listing.parse_listing(df).filter("page = 1").collect()[0]
    assert (got["company_name"], got["city"], got["kvk_nummer"], got["verslag_datum"]) == (
        "Café \"&'", "'s-Hertogenbosch", "1", None)
    audit = {r["page"]: r["verdict"] for r in listing.audit_listing(df).collect()}
    assert audit == {1: "ok", 2: "wrong offset", 3: "no rows", 4: "no result line", 5: "row count"}
