"""Decoders for register JSON: search results, case payloads, report lists, probe replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.functions import classify, dates
from estatelens.functions.privacy import anonymise_debtor
from estatelens.functions.stages import compute_once
from estatelens.functions.text import blank_to_null, filled, let, strip
from estatelens.schemas import ADDRESS, API_CASE, API_MODEL, API_TRADE_NAME, RECORD

_ITEMS = "array<variant>"


def _items(holder: Column) -> Column:
    """The list under ``items`` when the value is an object, else the value itself if a list."""
    return let(holder, lambda v: F.coalesce(F.try_variant_get(v, "$.items", _ITEMS),
                                            F.try_variant_get(v, "$", _ITEMS)))


def _member(value: Column, name: str) -> Column:
    """Object member, or the value itself where the object lacks it (or is no object)."""
    return let(value, lambda v: F.coalesce(F.variant_get(v, f"$.{name}", "variant"), v))


def _first_filled(item: Column, *names: str) -> Column:
    texts = [blank_to_null(F.try_variant_get(item, f"$.{n}", "string")) for n in names]
    return F.coalesce(*texts)


# -------------------------------------------------------------------------------- search


def decode_search(responses: DataFrame) -> DataFrame:
    """(court, body) to one row per hit: court, position, kenmerk, description.

    Accepts a bare list, ``result``, ``result.model`` and ``model`` envelopes and three
    spellings of each key; unreadable bodies and hits without an id give no row.
    """
    parsed = responses.select("court", F.try_parse_json("body").alias("body"))
    model = _member(_member(F.col("body"), "result"), "model")
    hits = parsed.select("court", F.posexplode(_items(model)).alias("position", "item"))
    return hits.select(
        "court", "position",
        _first_filled(F.col("item"), "publicatiekenmerk", "publicatieKenmerk", "kenmerk")
        .alias("kenmerk"),
        F.coalesce(_first_filled(F.col("item"), "publicatieomschrijving",
                                 "publicatieOmschrijving", "omschrijving"), F.lit(""))
        .alias("description"),
    ).filter(F.col("kenmerk").isNotNull())


# --------------------------------------------------------------------------------- cases


_LISTS = ("curators", "bewindvoerders", "publicatiegeschiedenis", "vestigingsadressen",
          "woonadressen", "correspondentieadressen")


def _is_empty(value: Column) -> Column:
    """Missing, JSON null, or an empty text, zero, false, list or object."""
    kind = F.schema_of_variant(value)
    return (value.isNull() | kind.isin("VOID", "ARRAY<VOID>", "OBJECT<>")
            | F.coalesce(F.try_variant_get(value, "$", "string").isin("", "0", "false"),
                         F.lit(False)))


def _well_formed(model: Column) -> Column:
    """Whether a case can be read: an object, whose person is an object and whose lists hold
    objects, where they are there at all."""
    def member(name: str) -> Column:
        return F.try_variant_get(model, f"$.{name}", "variant")

    good = F.schema_of_variant(model).startswith("OBJECT") & let(
        member("persoon"),
        lambda v: _is_empty(v) | F.schema_of_variant(v).startswith("OBJECT"))
    for name in _LISTS:
        good = good & let(member(name), lambda v: _is_empty(v) | F.schema_of_variant(v)
                          .startswith("ARRAY<OBJECT"))
    return good


def attempt_status(payload: Column) -> Column:
    """``purged`` for a null model, ``ok`` for a case that can be read, else ``fetch_failed``.

    The case is the ``model`` of an object, or the object itself where it has none.  This looks at
    the types of all members of any payload; ``read_payloads`` needs it for odd ones only.
    """
    def status(v: Column) -> Column:
        wrapped = F.try_variant_get(v, "$.model", "variant")
        return (F.when(v.isNull() | ~F.schema_of_variant(v).startswith("OBJECT"), "fetch_failed")
                .when(wrapped.isNotNull() & F.is_variant_null(wrapped), "purged")
                .when(_well_formed(F.coalesce(wrapped, v)), "ok")
                .otherwise("fetch_failed"))

    return let(F.try_parse_json(payload), status)


def _joined(sep: str, *parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), filled), sep)


def house_number(number: Column, suffix1: Column, suffix2: Column) -> Column:
    return blank_to_null(strip(_joined(" ", number, suffix1, suffix2)))


def _addresses(kind: str, source: Column) -> Column:
    mapped = F.transform(source, lambda a: F.struct(
        F.lit(kind).alias("type"), a["straat"].alias("street"),
        house_number(a["huisnummer"], a["huisnummerToevoeging1"], a["huisnummerToevoeging2"])
        .alias("number"),
        a["postcode"].alias("postcode"), a["plaats"].alias("city")))
    return F.coalesce(mapped, F.array().cast(T.ArrayType(ADDRESS)))


def person_name(first: Column, prefix: Column, surname: Column) -> Column:
    return F.coalesce(blank_to_null(strip(_joined(" ", first, prefix, surname))),
                      surname, F.lit(""))


def trustee_name(title: Column, initials: Column, prefix: Column, surname: Column) -> Column:
    return strip(_joined(" ", title, initials, prefix, surname))


def trustee_address(address: Column) -> Column:
    """'street nr, postcode city' without missing parts; NULL when nothing is known."""
    street = F.when(filled(address["straat"]),
                    strip(F.concat_ws(" ", address["straat"], address["huisnummer"])))
    place = F.when(filled(address["postcode"]) | filled(address["plaats"]),
                   strip(F.concat_ws(" ", address["postcode"], address["plaats"])))
    return blank_to_null(F.concat_ws(", ", street, place))


def _trustees(source: Column) -> Column:
    mapped = F.transform(source, lambda c: F.struct(
        trustee_name(c["titulatuur"], c["voorletters"], c["voorvoegsel"], c["achternaam"])
        .alias("name"),
        trustee_address(c["adres"]).alias("address"),
        c["adres"]["telefoonnummer"].alias("phone")))
    return F.coalesce(mapped, F.array().cast("array<struct<name:string,address:string,phone:string>>"))


def _iso(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def classify_publications(pubs: DataFrame, description: str = "description") -> DataFrame:
    """Adds event type, subtype, date and insolvency type read from the description."""
    text = F.col(description)
    return pubs.withColumns({
        "event_type": classify.event_type(text),
        "event_subtype": classify.event_subtype(text),
        "event_date": dates.dutch_date(text),
        "insolvency_type": classify.insolvency_type(text),
    })


def _publications(source: Column) -> Column:
    def one(p: Column) -> Column:
        text = F.coalesce(p["publicatieOmschrijving"], F.lit(""))
        return F.struct(
            _iso(dates.dotnet_date(p["publicatieDatum"])).alias("date"),
            F.coalesce(p["publicatieKenmerk"], F.lit("")).alias("kenmerk"),
            text.alias("description"),
            classify.event_type(text).alias("event_type"),
            classify.event_subtype(text).alias("event_subtype"),
            _iso(dates.dutch_date(text)).alias("event_date"),
            classify.insolvency_type(text).alias("insolvency_type"))

    return F.coalesce(F.transform(source, one),
                      F.array().cast(RECORD["publications"].dataType))


_CORRUPT = "_corrupt"
_BOTH = T.StructType(API_CASE.fields + API_MODEL.fields)  # with and without the ``model`` wrapper
_ENVELOPE = T.StructType([T.StructField("case", _BOTH), T.StructField(_CORRUPT, T.StringType())])


def read_payloads(payloads: DataFrame) -> DataFrame:
    """(payload, …) to the other columns, ``status`` and ``m``, the case (NULL unless ``ok``).

    One parse gives both.  It reports every payload that is no object or has a member of another
    type than the schema's, so what it reports nothing about is ``ok``; only the rest, and what
    may have a null model, is looked at member by member.  Of a member that occurs twice the last
    value counts.
    """
    keep = [c for c in payloads.columns if c != "payload"]
    payload = F.col("payload")
    # as a member of an object, so that text behind the payload's end is an error too
    parsed = F.from_json(F.concat(F.lit('{"case":'), payload, F.lit("}")), _ENVELOPE,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    rows = compute_once(payloads, {"_p": parsed})
    case = F.col("_p.case")
    named = F.contains(payload, F.lit("model")) | F.contains(payload, F.lit("\\u"))
    plain = (F.col(f"_p.{_CORRUPT}").isNull() & case.isNotNull()
             & (case["model"].isNotNull() | ~named))
    status = F.when(F.coalesce(plain, F.lit(False)), "ok").otherwise(attempt_status(payload))
    rows = compute_once(rows, {"status": status}, [*keep, "_p"])
    bare = F.struct(*[case[f].alias(f) for f in API_MODEL.fieldNames()])
    return rows.select(*keep, "status", F.when(
        F.col("status") == "ok", F.coalesce(case["model"], bare)).alias("m"))


def readable_cases(payloads: DataFrame) -> DataFrame:
    """(query_kenmerk, payload, …) to the rows whose case can be read, plus ``record``."""
    rows = read_payloads(payloads).filter("status = 'ok'").drop("status")
    return _decoded(rows, [c for c in payloads.columns if c != "payload"])


def decode_case(payloads: DataFrame) -> DataFrame:
    """(query_kenmerk, payload, …) of readable payloads to the same rows plus ``record``.

    Entity class: a registry number on the person without personal details is a company;
    personal details make a sole trader or a person, by whether any registry number is known;
    a registry number on a trade name alone is a company.
    """
    bare = F.struct(*[F.col("_p")[f].alias(f) for f in API_MODEL.fieldNames()])
    keep = [c for c in payloads.columns if c != "payload"]
    parsed = compute_once(payloads, {"_p": F.from_json("payload", _BOTH)}, keep).select(
        *keep, F.coalesce(F.col("_p.model"), bare).alias("m"))
    return _decoded(parsed, keep)


def _decoded(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """Rows with a case ``m`` to ``keep`` and ``record``."""
    def person(key: str) -> Column:
        return F.try_element_at("m.persoon", F.lit(key))

    trade = F.transform(
        F.filter(F.col("m.handelendOnderDeNamen"), lambda e: e.isNotNull()),
        lambda e: F.struct(e.alias("text"),
                           F.when(e.startswith("{"), F.from_json(e, API_TRADE_NAME))
                           .alias("object")))
    staged = compute_once(parsed, {
        "trade": F.coalesce(trade, F.array().cast(T.ArrayType(T.StructType([
            T.StructField("text", T.StringType()),
            T.StructField("object", API_TRADE_NAME)])))),
        "own_kvk": F.coalesce(blank_to_null(person("KvKNummer")),
                              blank_to_null(person("kvkNummer"))),
        "personal": filled(person("voornaam")) | filled(person("geboortedatum")),
        "pubs": _publications(F.col("m.publicatiegeschiedenis")),
    })
    trade_kvks = F.filter(F.transform("trade", lambda t: t["object"]["KvKNummer"]), filled)
    staged = staged.withColumn("kvk", F.coalesce(F.col("own_kvk"), F.get(trade_kvks, F.lit(0))))

    m = F.col("m")
    legal_person = F.col("own_kvk").isNotNull() & ~F.col("personal")
    entity = (F.when(legal_person, "company")
              .when(F.col("personal"), F.when(F.col("kvk").isNotNull(), "eenmanszaak")
                    .otherwise("person"))
              .when(F.col("kvk").isNotNull(), "company")
              .otherwise("person"))
    name = F.when(legal_person, F.coalesce(person("achternaam"), F.lit(""))).otherwise(
        person_name(person("voornaam"), person("voorvoegsel"), person("achternaam")))
    addresses = F.concat(
        _addresses("vestiging", m["vestigingsadressen"]),
        _addresses("woon", m["woonadressen"]),
        _addresses("correspondentie", m["correspondentieadressen"]),
        F.flatten(F.transform("trade", lambda t: F.concat(
            _addresses("vestiging", t["object"]["vestigingsadressen"]),
            _addresses("correspondentie", t["object"]["correspondentieadressen"])))))
    names = F.transform("trade", lambda t: F.when(
        t["object"].isNotNull(), F.coalesce(t["object"]["handelsnaam"], F.lit("")))
        .otherwise(t["text"]))

    def text_of(field: str) -> Column:
        return F.coalesce(m[field], F.lit(""))

    record = F.struct(
        F.coalesce(blank_to_null(F.get(F.col("pubs"), F.lit(0))["kenmerk"]),
                   F.col("query_kenmerk")).alias("kenmerk"),
        text_of("landelijkUniekZaaknummer").alias("insolventienummer"),
        text_of("toezichtZaaknummer").alias("toezichtzaaknummer"),
        entity.alias("type"),
        text_of("behandelendeInstantieNaam").alias("court"),
        text_of("RC").alias("judge"),
        F.lit(False).alias("is_anonymized"),
        F.struct(name.alias("name"), F.col("kvk").alias("kvk_nummer"),
                 names.alias("trade_names"), addresses.alias("addresses")).alias("debtor"),
        F.concat(_trustees(m["curators"]), _trustees(m["bewindvoerders"])).alias("curators"),
        F.col("pubs").alias("publications"),
        F.array().cast(RECORD["documents"].dataType).alias("documents"),
    )
    return compute_once(staged, {"record": record}, keep)


# ------------------------------------------------------------------------------- reports


def documents_of(body: Column) -> Column:
    """Documents in a report-list reply: bare list, or wrapped in ``model`` / ``items``."""
    items = _items(_member(F.try_parse_json(body), "model"))

    def one(item: Column) -> Column:
        return F.struct(
            F.try_variant_get(item, "$.VerslagKenmerk", "string").alias("kenmerk"),
            _iso(dates.dotnet_date(F.try_variant_get(item, "$.DatumVerslagen", "string")))
            .alias("date"),
            classify.report_type(F.try_variant_get(item, "$.Titel", "string")).alias("type"),
            F.lit(None).cast("string").alias("pdf_path"))

    return F.coalesce(F.filter(F.transform(items, one), lambda d: filled(d["kenmerk"])),
                      F.array().cast(RECORD["documents"].dataType))


def _reportable(entity: Column, number: Column) -> Column:
    # a report names the natural person behind it, so only companies get documents
    return (entity == "company") & filled(number)


def decode_reports(cases: DataFrame, reports: DataFrame) -> DataFrame:
    """Cases (kenmerk, type, insolventienummer) and replies (insolventienummer, body) to
    document rows of company cases."""
    wanted = cases.filter(_reportable(F.col("type"), F.col("insolventienummer"))).select(
        "kenmerk", "insolventienummer")
    joined = wanted.join(reports.select("insolventienummer", "body"), "insolventienummer")
    docs = joined.select("kenmerk", F.explode(documents_of(F.col("body"))).alias("d"))
    return docs.select("kenmerk", F.col("d.kenmerk").alias("document_kenmerk"),
                       F.to_date("d.date").alias("document_date"),
                       F.col("d.type").alias("document_type"))


# --------------------------------------------------------------------------- whole flow


def anonymise(cases: DataFrame, salt: str) -> DataFrame:
    """Cases with a ``record`` struct, personal data of natural persons removed."""
    record = F.col("record")
    natural = record["type"].isin("person", "eenmanszaak")
    changed = record.withField("debtor", anonymise_debtor(record["debtor"], record["type"], salt))
    changed = changed.withField("is_anonymized", record["is_anonymized"] | natural)
    return compute_once(cases, {"record": changed})


def normalise_cases(payloads: DataFrame, salt: str, reports: DataFrame | None = None,
                    git_sha: str = "") -> DataFrame:
    """(query_kenmerk, scraped_at, payload) to attempt-log rows.

    Every payload yields one row from one parse: its status, and for readable cases the entity
    class and the anonymised record as JSON.  ``reports`` adds documents to company cases; of several
    replies for one number the lowest text counts.
    """
    rows = read_payloads(payloads)
    ok = F.col("status") == "ok"
    readable = anonymise(_decoded(rows, [c for c in rows.columns if c != "m"]), salt)
    if reports is not None:
        number = F.when(ok & _reportable(F.col("record.type"), F.col("record.insolventienummer")),
                        F.col("record.insolventienummer"))
        # rows without a number get keys of their own that match nothing, so no task owns them all
        spread = F.concat(F.lit("\u0000"), F.xxhash64("query_kenmerk", "scraped_at"))
        single = reports.groupBy("insolventienummer").agg(F.min("body").alias("_body"))
        readable = (
            readable.withColumn("_number", F.coalesce(number, spread))
            .join(single.withColumnRenamed("insolventienummer", "_number"), "_number", "left")
            .withColumn("record", F.col("record").withField("documents",
                                                            documents_of(F.col("_body")))))
    stamped = F.col("record").withField(
        "scraped_at", F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    written = compute_once(readable, {
        "json": F.when(ok, F.to_json(stamped, {"ignoreNullFields": "false"})),
        "entity_type": F.when(ok, F.col("record.type"))})
    return written.select(
        F.col("query_kenmerk").alias("kenmerk"), "scraped_at", "status",
        F.coalesce("entity_type", F.lit("")).alias("entity_type"),
        F.when(ok, "").when(F.col("status") == "purged", "case no longer published")
        .otherwise("unreadable payload").alias("error"),
        F.coalesce("json", F.lit("")).alias("record"), F.lit(git_sha).alias("git_sha"))


# --------------------------------------------------------------------------------- probes


def classify_probe(responses: DataFrame) -> DataFrame:
    """(insolventienummer, body) of number searches to probe rows found / not_found / error."""
    parsed = responses.select("insolventienummer", F.try_parse_json("body").alias("v"))
    result = _member(F.col("v"), "result")
    staged = parsed.select(
        "insolventienummer",
        F.coalesce(F.try_variant_get(result, "$.status", "double") == 1, F.lit(False))
        .alias("answered"),
        F.coalesce(F.try_variant_get(result, "$.model.aantalResultaten", "int"), F.lit(0))
        .alias("count"),
        F.coalesce(F.size(F.try_variant_get(result, "$.model.items", _ITEMS)), F.lit(0))
        .alias("items"),
        F.coalesce(F.try_variant_get(result, "$.model.items[0].publicatiekenmerk", "string"),
                   F.lit("")).alias("first_id"))
    found = F.col("answered") & (F.col("count") > 0) & (F.col("items") > 0)
    return staged.select(
        "insolventienummer",
        F.when(~F.col("answered"), "error").when(found, "found").otherwise("not_found")
        .alias("status"),
        F.when(found, F.col("count")).otherwise(0).alias("aantal"),
        F.when(found, F.col("first_id")).otherwise("").alias("publicatiekenmerk"),
        (found & (F.col("first_id") != "")).cast("int").alias("queued"),
        F.when(~F.col("answered"), "search not answered").otherwise("").alias("error"))
