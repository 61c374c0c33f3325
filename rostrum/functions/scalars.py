"""Scalar functions of the turn model, each from columns to a column (built-in expressions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and codes that results must carry.
STATES = {
    "NSW": "New South Wales", "VIC": "Victoria", "QLD": "Queensland", "SA": "South Australia", "WA": "Western Australia",
    "TAS": "Tasmania", "NT": "Northern Territory", "ACT": "Australian Capital Territory",
}
STATE_SPELLINGS = {"Queesland": "Queensland"}
PARTY_CODES = {
    "LIB": "LP", "LPI0": "LP", "NPA": "NP", "NPActing": "NP", "Nats": "NATS", "GRN": "AG", "G(WA)": "GWA", "ON": "PHON", "Ind.": "IND", "Ind": "IND",
    "N/A": None, "UNKNOWN": None,
}
PARTY_ALIASES = {
    "COAL": ("LP", "LIB", "LNP", "NP", "NPA", "NAT", "NATS", "Nats", "NATS WA", "NatsWA", "CLP"),
    "GRN": ("AG", "TG"), "GWA": ("G(WA)",), "PHON": ("ON",), "IND": ("Ind.",), "KAP": ("AUS",),
}
PARTY_GROUPS = {
    "chamber": ({"Coalition": ("LP", "LNP", "CLP"), "Labor": ("ALP",), "Greens": ("AG",), "Nationals": ("NP", "NATS")}, "Other", "Other"),
    "committee": ({"Coalition": ("LP", "LNP", "CLP"), "Labor": ("ALP",), "Greens": ("AG",), "Nationals": ("NP", "NATS")}, "Other", "Witness"),
    "cited": ({"Coalition": ("LP", "LNP", "CLP"), "Labor": ("ALP",), "Greens": ("AG",), "Nationals": ("NP", "NATS"), "Democrats": ("AD",)}, "Other", "Other"),
    "comparative": (
        {
            "Coalition": ("LP", "LNP", "NP", "NATS", "CLP", "LCP"), "Labor": ("ALP",), "Greens": ("AG", "GRN"),
            "Crossbench": ("IND", "AD", "NXT", "CA", "XEN", "KAP", "PUP", "UAP", "PHON", "TG", "DLP", "APA", "FF", "OTH"),
        }, "Unknown", "Unknown",
    ),
}
COALITION, COALITION_WIDE, LABOR = ("LP", "LNP", "NP", "NATS", "CLP"), PARTY_ALIASES["COAL"], ("ALP",)
#: Half-open periods of government, by scheme.
GOVERNMENTS = {
    "corpus": (("1996-03-11", "2007-11-24", COALITION), ("2007-11-24", "2013-09-18", LABOR), ("2013-09-18", "2022-05-23", COALITION), ("2022-05-23", "2100-01-01", LABOR)),
    "daily": (("1996-03-11", "2007-12-03", COALITION_WIDE), ("2007-12-03", "2013-09-18", LABOR), ("2013-09-18", "2022-05-23", COALITION_WIDE), ("2022-05-23", "2099-12-31", LABOR)),
}
#: Last year of each parliament (ladder), from the 39th on.
PARLIAMENT_ENDS = (1999, 2001, 2004, 2007, 2010, 2013, 2016, 2019, 2022)
HONORIFICS = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Senator", "Hon", "Prof")


def first_of(pairs: list[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """A chain of conditions and values."""
    out = reduce(lambda a, p: a.when(*p), pairs[1:], F.when(*pairs[0]))
    return out if otherwise is None else out.otherwise(otherwise)


def mapped(col: Column, table: dict, otherwise: Column | None = None) -> Column:
    """A value for each key of a small table, else ``otherwise`` (default: the column)."""
    return first_of([(col == k, F.lit(v)) for k, v in table.items()], col if otherwise is None else otherwise)


def clean(col: Column) -> Column:
    """NULL for what stands for a missing value, else the trimmed text."""
    t = F.trim(col)
    return F.when(~F.lower(t).isin("nan", "none", "nat", "<na>", ""), t)


def flag(col: Column) -> Column:
    """0/1 as an integer, NULL if it's neither."""
    return F.when(F.lower(F.trim(col.cast("string"))).isin("1", "1.0", "true", "yes"), 1).when(F.lower(F.trim(col.cast("string"))).isin("0", "0.0", "false", "no"), 0)


def clock(col: Column) -> Column:
    """``HH:MM:SS`` from ``HH:MM:SS``, ``H:MM``, ``H.MM am``, ``H,MM pm`` and ``H am``; else NULL."""
    t = F.lower(F.trim(col))
    part = lambda p, i: F.regexp_extract(t, p, i).try_cast("int")
    full, short, noon, bare = r"^(\d{1,2}):(\d{2}):(\d{2})$", r"^(\d{1,2}):(\d{2})$", r"^(\d{1,2})[.,:](\d{2})\s*([ap])\.?m\.?$", r"^(\d{1,2})\s*([ap])\.?m\.?$"
    half = lambda p, i: F.when(F.regexp_extract(t, p, i) == "p", part(p, 1) % 12 + 12).otherwise(part(p, 1) % 12)
    say = lambda h, m, s: F.when((h < 24) & (m < 60) & (s < 60), F.format_string("%02d:%02d:%02d", h, m, s))
    zero = F.lit(0)
    return F.when(t.rlike(full), say(part(full, 1), part(full, 2), part(full, 3))).when(t.rlike(short), say(part(short, 1), part(short, 2), zero)).when(t.rlike(noon), say(half(noon, 3), part(noon, 2), zero)).when(t.rlike(bare), say(half(bare, 2), zero, zero))


def minutes(col: Column) -> Column:
    """Minutes since midnight of ``HH:MM[:SS]``, as a double."""
    p = F.split(col, ":")
    part = lambda i: F.try_element_at(p, F.lit(i)).try_cast("double")
    return part(1) * 60 + part(2) + F.coalesce(part(3), F.lit(0.0)) / 60


def from_minutes(col: Column) -> Column:
    """``HH:MM`` of minutes, a day's 1440 taken off."""
    m = F.pmod(F.floor(col).cast("int"), F.lit(1440))
    return F.format_string("%02d:%02d", F.floor(m / 60).cast("int"), m % 60)


def flatten(col: Column) -> Column:
    """Line breaks with the white space around them become one space."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), r"\s*\n\s*", " "))


def name_forms(title: Column, first: Column, surname: Column) -> Column:
    """Five written forms of a name."""
    up = F.upper
    return F.array(F.concat_ws(" ", title, up(surname)), F.concat_ws(" ", title, first, up(surname)), F.concat_ws(" ", title, surname), F.concat_ws(" ", title, first, surname), F.concat_ws(", ", up(surname), first))


def title(gender: Column, academic: Column) -> Column:
    return F.coalesce(clean(academic), F.when(F.lower(gender) == "female", "Ms").when(F.lower(gender) == "male", "Mr"))


def surname_case(col: Column) -> Column:
    """Capitals, but for the ``c`` or ``ac`` of Mc and Mac before a capital."""
    prefix = F.regexp_extract(col, r"^(Mc|Mac)(?=[A-Z])", 1)
    return F.concat(prefix, F.upper(F.regexp_replace(col, r"^(Mc|Mac)(?=[A-Z])", "")))


def spoken_name(name: Column, canonical: Column) -> Column:
    """A speaker's name: the canonical one if known; else without a colon at the end and without first names after an honorific."""
    cleaned = F.trim(F.regexp_replace(F.trim(name), r":+$", ""))
    t = F.split(cleaned, r"\s+")
    last = F.regexp_replace(F.element_at(t, -1), r"\)+$", "")
    plain = ~F.upper(F.element_at(t, 2)).isin("THE", "DEPUTY", "ACTING", "TEMPORARY", "PRESIDENT", "SPEAKER", "CHAIR", "CLERK")
    known = F.element_at(t, 1).isin(*HONORIFICS) & (F.size(t) >= 3)
    return F.when(name.isNull() | (F.trim(name) == ""), name).otherwise(F.coalesce(canonical, F.when(F.coalesce(known, F.lit(False)) & F.coalesce(plain, F.lit(False)), F.concat_ws(" ", F.element_at(t, 1), last)), cleaned))


def display_name(honorific: Column, first: Column, surname: Column) -> Column:
    """``Honorific SURNAME, First``."""
    return F.concat(F.when(clean(honorific).isNotNull(), F.concat(honorific, F.lit(" "))).otherwise(F.lit("")), F.upper(surname), F.when(clean(first).isNotNull(), F.concat(F.lit(", "), F.initcap(first))).otherwise(F.lit("")))


def state(col: Column) -> Column:
    """The full name of a state, NULL for what isn't one; a remark after a dash is cut."""
    cut = F.trim(F.substring_index(col, "—", 1))
    names = {v.upper(): v for v in STATES.values()} | STATES | {k.upper(): v for k, v in STATE_SPELLINGS.items()}
    return mapped(F.upper(cut), names, F.lit(None).cast("string"))


def party(col: Column) -> Column:
    """The canonical code of a party; NULL for unknown ones and for what doesn't start with a letter."""
    t = F.when(col.rlike("^[A-Za-z]"), col)
    return first_of([(t == k, F.lit(v)) for k, v in PARTY_CODES.items()], t)


def party_alias(col: Column) -> Column:
    return first_of([(col.isin(*v), F.lit(k)) for k, v in PARTY_ALIASES.items()], col)


def party_group(col: Column, scheme: str = "chamber") -> Column:
    """The group of a party under one of the schemes of :data:`PARTY_GROUPS`."""
    groups, other, missing = PARTY_GROUPS[scheme]
    t = F.upper(F.trim(col)) if scheme == "comparative" else F.trim(col)
    return F.when(col.isNull(), missing).otherwise(first_of([(t.isin(*v), F.lit(k)) for k, v in groups.items()], F.lit(other)))


def turn_type(written: Column, question: Column, answer: Column, interject: Column) -> Column:
    """The first that holds of written_question, question, answer, interjection; else speech."""
    return F.when(written == 1, "written_question").when(question == 1, "question").when(answer == 1, "answer").when(interject == 1, "interjection").otherwise("speech")


def exclusive_type(kind: str, question: Column, answer: Column, interject: Column) -> Column:
    q, a, i = (F.coalesce(x, F.lit(0)) == 1 for x in (question, answer, interject))
    return {"question": q, "answer": a & ~q, "interject": i & ~q & ~a, "statement": ~q & ~a & ~i}.get(kind, F.lit(True))


def parliament(year: Column) -> Column:
    """The number of the parliament of a year, by the ladder of last years."""
    return first_of([(year <= y, F.lit(39 + i)) for i, y in enumerate(PARLIAMENT_ENDS)], F.when(year.isNotNull(), 39 + len(PARLIAMENT_ENDS)))


#: First year of each labelled parliament, and the half-open ranges of years by number.
PARLIAMENT_LABELS = ((1998, "39th"), (2001, "40th"), (2004, "41st"), (2007, "42nd"), (2010, "43rd"), (2013, "44th"), (2016, "45th"), (2019, "46th"), (2022, "47th"))
PARLIAMENT_TERMS = ((36, 1996, 1998), (37, 1998, 2001), (38, 2001, 2004), (39, 2004, 2007), (40, 2007, 2010), (41, 2010, 2013), (42, 2013, 2016), (43, 2016, 2019), (44, 2019, 2022), (45, 2022, 2025), (46, 2025, 2028))
#: Numbers that newer files count from one again.
PARLIAMENT_NUMBERS = {1: 46, 2: 47, 3: 48}


def parliament_label(year: Column) -> Column:
    """The label of the last parliament that had begun."""
    return first_of([(year >= y, F.lit(label)) for y, label in reversed(PARLIAMENT_LABELS)], F.when(year.isNotNull(), "pre-39th"))


def parliament_term(year: Column) -> Column:
    """The parliament whose years hold this one; 46 outside of all."""
    return first_of([((year >= a) & (year < b), F.lit(n)) for n, a, b in PARLIAMENT_TERMS], F.when(year.isNotNull(), 46))


def parliament_number(number: Column) -> Column:
    return first_of([(number == k, F.lit(v)) for k, v in PARLIAMENT_NUMBERS.items()], number)


def place(state_col: Column, electorate: Column) -> Column:
    """The state where there is one, else the electorate."""
    return F.coalesce(F.nullif(clean(state_col), F.lit("")), F.nullif(clean(electorate), F.lit("")))


def reference_label(chamber: Column, day: Column, speaker: Column, heading: Column, summary: Column, most: int = 80) -> Column:
    """A short label of a turn for a list of references."""
    said = F.coalesce(F.nullif(F.nullif(F.trim(heading), F.lit("")), F.lit("nan")), F.trim(F.coalesce(summary, F.lit(""))))
    text = F.when(F.length(said) > most, F.concat(F.rtrim(F.left(said, F.lit(most))), F.lit("…"))).otherwise(said)
    who = F.coalesce(F.nullif(F.trim(speaker), F.lit("")), F.lit("Unknown Speaker"))
    return F.concat(F.when(chamber == "senate", "Senate").otherwise("House"), F.lit(" Hansard, "), day.cast("string"), F.lit(", "), who, F.lit(", "), text)


def chamber_name(col: Column) -> Column:
    t = F.lower(col)
    return F.when(t.contains("joint"), "Joint").when(t.contains("senate"), "Senate").when(t.contains("house") | t.contains("representatives"), "House").otherwise(col)


#: First day of each government and its parties, as committees count.
COMMITTEE_GOVERNMENTS = (
    ("1996-03-02", ("LP", "NP", "NATS", "CLP", "LNP", "NatsWA", "NAT")),
    ("2007-11-24", ("ALP",)),
    ("2013-09-07", ("LP", "NP", "NATS", "CLP", "LNP", "NatsWA", "NAT")),
    ("2022-05-21", ("ALP",)),
)


def in_government(day: Column, party_col: Column, scheme: str = "corpus") -> Column:
    """1 if the party governs on the day, else 0; in the scheme ``committee`` null without a party or before the first government."""
    if scheme == "committee":
        ruled = first_of([(day >= F.lit(a).cast("date"), party_col.isin(*p).cast("int")) for a, p in reversed(COMMITTEE_GOVERNMENTS)])
        return F.when(party_col != "", ruled)
    return first_of([((day >= F.lit(a).cast("date")) & (day < F.lit(b).cast("date")) & party_col.isin(*p), F.lit(1)) for a, b, p in GOVERNMENTS[scheme]], F.lit(0))


def word_count(col: Column) -> Column:
    """Runs of other characters than white space: one pass over the text, nothing built."""
    return F.coalesce(F.regexp_count(col, F.lit(r"(?U)\S+")), F.lit(0)).cast("long")


def occurrences(col: Column, terms: list[str]) -> Column:
    """Non-overlapping occurrences of literal terms, added up."""
    one = lambda t: ((F.length(col) - F.length(F.replace(col, F.lit(t), F.lit("")))) / len(t)).cast("long")
    return reduce(lambda a, b: a + b, map(one, terms))


def density(col: Column, term: str) -> Column:
    """Occurrences of a term, whatever its case, in 1000 words."""
    n = word_count(col)
    return F.when(n > 0, 1000.0 * occurrences(F.lower(col), [term.lower()]) / n).otherwise(0.0)


def turn_hash(chamber: Column, day: Column, name_id: Column, body: Column) -> Column:
    """Twelve hexadecimal digits that identify a turn by its content."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.substring(F.sha2(F.concat(F.lower(part(chamber)), F.lit("|"), part(day), F.lit("|"), part(clean(name_id)), F.lit("|"), F.substring(part(body), 1, 200)), 256), 1, 12)


def day_hash(chamber: Column, day: Column) -> Column:
    return F.substring(F.sha2(F.concat(F.coalesce(chamber, F.lit("")), F.lit("|"), F.coalesce(day.cast("string"), F.lit(""))), 256), 1, 12)


def preview(col: Column, size: int = 280) -> Column:
    return F.when(F.length(col) > size, F.concat(F.substring(col, 1, size), F.lit("…"))).otherwise(col)


def context_line(time_stamp: Column, name: Column, party_col: Column, place: Column, body: Column) -> Column:
    """``[time] name (party, place): body``, parts that are missing left out."""
    said = lambda c: clean(c).isNotNull()
    inner = F.concat_ws(", ", clean(party_col), clean(place))
    return F.concat(F.when(said(time_stamp), F.concat(F.lit("["), time_stamp, F.lit("] "))).otherwise(F.lit("")), F.coalesce(clean(name), F.lit("")), F.when(inner != "", F.concat(F.lit(" ("), inner, F.lit(")"))).otherwise(F.lit("")), F.lit(": "), flatten(body))


#: Fixed patterns of inline interjections.
EMBEDDED = (
    r"(?i)(?:(?:Mr|Mrs|Ms|Dr|Hon\.?)\s+[A-Z][A-Za-z'\-]+|(?:An?\s+)?(?:honourable\s+)?(?:opposition|government|honourable)\s+members?)\s+interjecting[—\-]",
    r"\b[A-Z]{2,}(?:\s+[A-Z]{2,})?\s+interjecting[—\-]",
)


def has_interjection(body: Column) -> Column:
    return F.coalesce(body.rlike(EMBEDDED[0]) | body.rlike(EMBEDDED[1]), F.lit(False))


def strip_interjections(body: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(body, EMBEDDED[0], " "), EMBEDDED[1], " "), "  +", " "))


def slug(col: Column) -> Column:
    t = F.lower(F.trim(col))
    for a, b in (("&", " and "), (r"\|", " or "), ("~", " not "), (r"[^a-z0-9]+", "-")):
        t = F.regexp_replace(t, a, b)
    return F.regexp_replace(t, "^-+|-+$", "")


def iso_week(day: Column) -> Column:
    return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), day).cast("int"), F.weekofyear(day))


def strip_tags(html: Column) -> Column:
    """Text of HTML: tags become spaces, white space is squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]*>", " "), r"\s+", " "))


def json_part(col: Column) -> Column:
    """From the first brace to the last; NULL without both."""
    found = F.regexp_extract(col, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def capped(col: Column, size: int = 32_000) -> Column:
    return preview(col, size)


def bar(n: Column, most: Column, width: int = 40) -> Column:
    """A bar of blocks: at least one, at most ``width``."""
    return F.repeat(F.lit("█"), F.greatest(F.lit(1), F.floor(n * F.least(F.lit(1.0), F.lit(float(width)) / most)).cast("int")))


def token_cost(text: Column, price_per_million: float) -> Column:
    """Estimated price of a text at four characters a token."""
    return F.length(text) / 4 * price_per_million / 1e6
