"""Closed vocabularies.  All values here are fixed by the register and its report model."""

from __future__ import annotations

# --- fixed values: month names -------------------------------------------------------------
MONTHS = {
    "januari": 1, "februari": 2, "maart": 3, "april": 4, "mei": 5, "juni": 6,
    "juli": 7, "augustus": 8, "september": 9, "oktober": 10, "november": 11, "december": 12,
}

# --- fixed values: keyword -> label, declaration order ---------------------------------------
EVENT_TYPES = [
    ("uitspraak", "uitspraak"),
    ("opheffing", "opheffing"),
    ("einde", "einde"),
    ("beëindiging", "einde"),
    ("beeindiging", "einde"),
    ("vernietiging", "vernietiging"),
    ("vervanging", "vervanging"),
    ("neerlegging slotuitdelingslijst", "neerlegging_slotuitdelingslijst"),
    ("neerlegging tussentijdse uitdelingslijst", "neerlegging_tussentijdse_uitdelingslijst"),
    ("vereenvoudigde afwikkeling", "vereenvoudigde_afwikkeling"),
    ("zitting", "zitting"),
    ("rectificatie", "rectificatie"),
    ("overdracht", "overdracht"),
    ("overgedragen", "overdracht"),
    ("rekening en verantwoording", "rekening_en_verantwoording"),
]
EVENT_SUBTYPES = [
    ("gebrek aan baten", "gebrek_aan_baten"),
    ("verbindende uitdelingslijst", "verbindende_uitdelingslijst"),
    ("schone lei", "schone_lei"),
    ("nihil uitdeling", "nihil_uitdeling_schone_lei"),
    ("omzetting", "omzetting_faillissement"),
    ("hoger beroep", "hoger_beroep"),
    ("verzet", "verzet"),
    ("na surseance", "na_surseance"),
    ("faillietverklaring", "faillietverklaring"),
    ("na voorlopige surseance", "na_surseance"),
]
INSOLVENCY_TYPES = [
    ("faillissement", "faillissement"),
    ("schuldsanering", "schuldsanering"),
    ("surseance", "surseance"),
    ("surséance", "surseance"),
]
TERMINAL_EVENTS = ["opheffing", "einde"]

# --- fixed values: courts in search order -----------------------------------------------------
COURTS = [
    "amsterdam", "den haag", "gelderland", "limburg", "midden-nederland", "noord-holland",
    "noord-nederland", "oost-brabant", "overijssel", "rotterdam", "zeeland-west-brabant",
]

# --- fixed values: court numbers used before the 2013 merger of districts ----------------------
OLD_COURT_NUMBERS = {
    "she": 1, "bre": 2, "maa": 3, "roe": 4, "arn": 5, "zut": 6, "zwo": 7, "alm": 8,
    "gra": 9, "sgr": 9, "dha": 9, "rot": 10, "dor": 11, "mid": 12, "ams": 13, "alk": 14,
    "haa": 15, "utr": 16, "lee": 17, "gro": 18, "ass": 19,
}

# --- fixed values: company suffixes in trade names ---------------------------------------------
COMPANY_SUFFIXES = ["b.v.", "n.v.", "v.o.f.", "c.v.", "b.v", "n.v", "v.o.f", "c.v"]

# --- fixed values: what text conversion leaves behind -------------------------------------------
CONTROL_CHARACTERS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
STRAY_BLANK = r"([wW])(?<=\b[wW]) ([a-z])"

# --- fixed values: section headers of a trustee's report (h = blank, not a line break) ----------
SECTION_HEADERS = [
    ("activiteiten", "a", r"Activiteiten{h}+onderneming{h}*$"),
    ("inventarisatie", "1.", r"1\.{h}*Inventarisatie"),
    ("oorzaak", "1.5", r"1\.5{h}*Oorzaak{h}+faillissement"),
    ("personeel", "2.", r"2\.{h}*Personeel"),
    ("activa", "3.", r"3\.{h}*Activa"),
    ("andere_activa", "3.8", r"3\.8{h}*Andere{h}+activa"),
    ("debiteuren", "4.", r"4\.{h}*Debiteuren"),
    ("zekerheden", "5.", r"5\.{h}*Bank{h}*/{h}*Zekerheden"),
    ("doorstart", "6.", r"6\.{h}*Voortzetten{h}*/{h}*doorstart"),
    ("rechtmatigheid", "7.", r"7\.{h}*Rechtmatigheid"),
    ("crediteuren", "8.", r"8\.{h}*Crediteuren"),
    ("procedures", "9.", r"9\.{h}*Procedures"),
    ("overig", "10.", r"10\.{h}*Overig"),
]

# --- fixed values: asset category -> wording on a (sub)total line --------------------------------
ASSET_CATEGORIES = [
    ("onroerende_zaken", r"onroerende zaken"),
    ("vervoersmiddelen", r"vervoersmiddelen"),
    ("bedrijfsmiddelen", r"bedrijfsmiddelen"),
    ("deelnemingen", r"deelnemingen"),
    ("intercompany", r"intercompanyvorderingen"),
    ("voorraden", r"voorraden / onderhanden"),
    ("liquide_middelen", r"liquide middelen"),
    ("debiteuren", r"debiteuren"),
    ("bank_zekerheden", r"bank / zekerheden"),
    ("voortzetten", r"voortzetten onderneming"),
    ("doorstart", r"doorstart onderneming"),
    ("voortzetten_doorstart_totaal", r"voortzetten / doorstart"),
    ("rechtmatigheid", r"rechtmatigheid"),
    ("procedures", r"procedures"),
    ("overig", r"overig(?![a-z])"),
    ("vrij_actief_totaal", r"vrij actief"),
]

# --- fixed values: labels in financial reports ---------------------------------------------------
ESTATE_LABELS = [
    ("definitief_saldo", "Definitief Saldo"),
    ("saldo_boedelrekening", "Saldo Boedelrekening"),
    ("beschikbaar_voor_uitdeling", "Saldo beschikbaar voor uitdeling"),
]
RECOVERY_LABELS = [
    ("preferente", r"(?:Totaal preferente schuldeisers|Preferente crediteuren)"),
    ("concurrente", r"(?:Totaal concurrente schuldeisers|Concurrente crediteuren)"),
]
DEBT_LABELS = [
    ("boedelvorderingen", r"Totaal boedelvorderingen"),
    ("pref_fiscus", r"Preferente vordering(?:en)? van de fiscus"),
    ("pref_uwv", r"Preferente vordering(?:en)? van het UWV"),
    ("pref_overig", r"Andere preferente crediteuren"),
    ("pref_totaal", r"Totaal preferente schuldeisers"),
    ("concurrent_bedrag",
     r"(?:Totaal concurrente schuldeisers|Bedrag concurrente crediteuren|Concurrente crediteuren)"),
]
DEBT_SUBSECTIONS = {
    "boedelvorderingen": "1", "pref_fiscus": "2", "pref_uwv": "3",
    "pref_overig": "4", "concurrent_aantal": "5", "concurrent_bedrag": "6",
}
HEADCOUNT_HEADERS = [
    ("personeel_ttv", r"(?:Aantal ten tijde van faill|Personeel gemiddeld aantal)"),
    ("personeel_jaar_voor", r"Aantal in jaar voor faill"),
]

# --- fixed values: answers accepted from a scorer -------------------------------------------------
SECTORS = [
    "bouw", "zorg", "horeca", "detailhandel", "groothandel", "ICT", "energie", "transport",
    "industrie", "vastgoed", "financieel", "landbouw", "zakelijke dienstverlening", "overig",
]
CAUSES = ["markt", "liquiditeit", "wanbeleid", "fraude", "corona", "overig"]
SETTLEMENTS = [
    "gebrek_aan_baten", "vereenvoudigd", "uitdeling", "akkoord", "voortgezet", "onbekend",
]
RELATIONS = ["bestuurder", "aandeelhouder", "moeder", "dochter", "gelieerd"]
ACQUIRER_PLACEHOLDERS = [
    "koper", "de koper", "overnemer", "de overnemer", "gegadigde", "de gegadigde",
    "doorstarter", "de doorstarter", "partij", "particulier", "onbekend", "n.v.t.",
]
IP_KEYWORDS = ["merk", "handelsna", "octrooi", "patent", "auteursrecht", "licentie"]
GOVERNANCE_FLAGS = [
    "boekhoudplicht_voldaan", "depot_jaarrekeningen_ok", "onbehoorlijk_bestuur",
    "paulianeus_handelen",
]
PREMISES_FLAGS = ["onroerend_goed", "huurpand"]

# --- fixed values: patterns for people and legal forms ---------------------------------------------
PERSON_SPAN = (
    r"(?U)(?i:de her(?:en)?|de heer|mevrouw|mevr\.|dhr\.|mw\.)\s+"
    r"(?:(?:van|der|den|de|het|ter|te|op|in|'t|v\.d\.)\s+|[{cap}][\w'.-]*\s*){{1,7}}"
)
NOT_A_NAME = (
    r"(?iU)natuurlijk|persoon|bestuurder|aandeelhouder|onbekend|gegevens|curator|privacy"
    r"|anoniem|directie"
)
LEGAL_FORM = (
    r"(?iU)\b(B\.?V\.?|N\.?V\.?|V\.?O\.?F\.?|C\.?V\.?|Holding|Beheer|Stichting|Coöperatie"
    r"|U\.?A\.?|GmbH|Ltd|Inc|S\.?A\.?|Group|Groep)\b"
)
BANK_LIKE = (
    r"(?iU)bank|rabo|abn|amro|bunq|knab|triodos|volksbank|factor|lease|financ|krediet|agricole"
)
GENERIC_BANK = r"(?iU)^(de |een |betrokken |desbetreffende |huis)?bank$"
