"""Tests of sitting days: each gives ``date``, ``test`` and ``message`` of what it finds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.functions.scalars import party_alias
from rostrum.operators.joins import in_spell
from rostrum.operators.windows import consecutive_duplicates

#: Ids of offices rather than persons; of the house, and its further ids that stand for no known person.
SPECIAL = ("10000", "10001", "UNKNOWN", "20000", "1")
SPECIAL_HOUSE = ("10000", "10001", "UNKNOWN", "20000")
#: Texts that may repeat from turn to turn (T2). They are looked for anywhere, in any case; a caret ties to the start.
REPEATABLE = (
    r"interjecting",
    r"^to move[:\-—]",
    r"^by leave[—\-]",
    r"—by leave—",
    r"^to present a bill",
    r"^I move:",
    r"^That this bill be now read",
    r"^That the \w[\w\s]+ bill be now read",
    r"^That the bill be now read",
    r"^That the amendments be agreed",
    r"^Is leave granted",
    r"^Leave not granted",
    r"^Leave granted",
    r"^Order[!.]?$",
    r"^\(Time expired\)",
    r"^Question ",
    r"^Votes and Proceedings",
    r"^Pause the clock",
    r"^That the senator be no longer heard",
    r"^Document made a parliamentary paper",
    r"^There is no point of order",
    r"^An incident having occurred",
    r"^The (?:PRESIDENT|SPEAKER|CHAIR|DEPUTY)",
    r"^(?:Honourable|Opposition|Government) (?:members|senators):",
    r"^Yes\.$",
    r"^No\.$",
    r"^\d{2}:\d{2}:\d{2}",
    r"^—I move:",
    r"^Notice Paper",
    r"^Ordered that the report be made",
    r"^The question is that the bill be now read",
    r"^\(\s*\)\s*\(",
)
#: How text that may follow an expired time starts (T3), in any case.
AFTER_TIME = (
    r"Question (resolved|negatived|agreed to|put)",
    r"Honourable (senators|members) interjecting",
    r"Opposition (senators|members) interjecting",
    r"Government (senators|members) interjecting",
    r"The (PRESIDENT|DEPUTY PRESIDENT|SPEAKER|DEPUTY SPEAKER|CHAIR|ACTING DEPUTY)",
    r"Senator \w+ interjecting",
    r"Mr \w+ interjecting",
    r"Ms \w+ interjecting",
    r"Leave granted",
    r"Sitting suspended",
    r"Debate adjourned",
    r"House adjourned",
    r"Senate adjourned",
    r"Bill read a",
    r"Proposed expenditure",
    r"Motion \(by",
    r"That the",
    r"Consideration interrupted",
    r"A division having been",
    r"Debate \(on motion",
)
MAY_REPEAT = "(?i)" + "|".join(REPEATABLE)
MAY_FOLLOW = f"(?i)^(?:{'|'.join(AFTER_TIME)})"


def _errors(df: DataFrame, test: str, message) -> DataFrame:
    return df.select(F.col("date").cast("date").alias("date"), F.lit(test).alias("test"), message.cast("string").alias("message"))


def t1_dates(days: DataFrame, sessions: DataFrame) -> DataFrame:
    """Days whose header has another date, or none."""
    s = sessions.select(F.col("date").alias("date"), F.col("header_date"))
    return _errors(days.select("date").distinct().join(s, "date", "left").where("header_date IS NULL OR header_date <> date"), "T1", F.coalesce(F.concat(F.lit("header says "), F.col("header_date").cast("string")), F.lit("no header")))


def t2_duplicates(turns: DataFrame, keys: tuple[str, ...] = ("date",), order: str = "order") -> DataFrame:
    """Turns with the text of the turn before, interjections aside; a count for each day.

    Empty texts and those that may repeat count as a turn before, but not as a repetition.
    """
    found = consecutive_duplicates(turns.where("interject = 0"), "body", list(keys), order)
    n = found.where((F.col("body") != "") & ~F.col("body").rlike(MAY_REPEAT)).groupBy("date").agg(F.count("*").alias("n"))
    return _errors(n, "T2", F.concat(F.col("n").cast("string"), F.lit(" consecutive duplicates")))


def t3_expired(turns: DataFrame) -> DataFrame:
    """Text of more than 20 characters after the first ``(Time expired)``, unless procedural."""
    mark = "(Time expired)"
    rest = F.trim(F.substr(F.col("body"), F.instr("body", mark) + F.lit(len(mark))))
    return _errors(turns.where((F.instr("body", mark) > 0) & (F.length(rest) > 20) & ~rest.rlike(MAY_FOLLOW)), "T3", F.concat(F.lit("text after expiry at "), F.col("order").cast("string")))


def t4_unique(turns: DataFrame) -> DataFrame:
    """Persons with several parties (aliases count as one) or places on one day."""
    spoken = turns.where((F.coalesce("interject", F.lit(0)) == 0) & F.col("name_id").isNotNull() & ~F.col("name_id").isin(*SPECIAL))
    n = spoken.groupBy("date", "name_id").agg(F.countDistinct(party_alias(F.col("party"))).alias("p"), F.countDistinct("place").alias("s"))
    return _errors(n.where("p > 1 OR s > 1"), "T4", F.concat(F.col("name_id"), F.lit(" has several parties or places")))


def t5_unknown(turns: DataFrame, known: DataFrame) -> DataFrame:
    ids = turns.where(F.col("name_id").isNotNull() & ~F.col("name_id").isin(*SPECIAL)).select("date", "name_id").distinct()
    return _errors(ids.join(known.select("name_id").distinct(), "name_id", "left_anti"), "T5", F.concat(F.lit("unknown id "), F.col("name_id")))


def t6_alive(turns: DataFrame, bio: DataFrame, *, house: bool = False) -> DataFrame:
    """Persons who speak before their birth or after their death; the house rule passes over unknown births."""
    met = turns.select("date", "unique_id").distinct().join(bio.select("unique_id", "birth_date", "death_date"), "unique_id")
    bad = (F.col("date") < F.col("birth_date")) | (F.col("date") > F.col("death_date"))
    return _errors(met.where(F.coalesce(bad, F.lit(False)) & (F.col("birth_date").isNotNull() if house else F.lit(True))), "T6", F.concat(F.col("unique_id"), F.lit(" is not alive")))


def t7_term(turns: DataFrame, terms: DataFrame, *, house: bool = False) -> DataFrame:
    """Persons none of whose terms covers the day; those without terms are passed over.

    A missing start is open, but the house rule drops such terms.
    """
    t = terms.where("start IS NOT NULL") if house else terms
    met = turns.select("date", "unique_id").where("unique_id IS NOT NULL").distinct().join(t, "unique_id").groupBy("date", "unique_id").agg(F.bool_or(in_spell(F.col("date"), F.col("start"), F.col("end"))).alias("ok"))
    return _errors(met.where("NOT ok"), "T7", F.concat(F.col("unique_id"), F.lit(" has no term")))


def validate(turns: DataFrame, sessions: DataFrame, known: DataFrame, bio: DataFrame, terms: DataFrame, *, house: bool = False) -> DataFrame:
    """All findings."""
    out = t1_dates(turns, sessions)
    for x in (t2_duplicates(turns), t3_expired(turns), t4_unique(turns), t5_unknown(turns, known), t6_alive(turns, bio, house=house), t7_term(turns, terms, house=house)):
        out = out.unionByName(x)
    return out


def totals(days: DataFrame, errors: DataFrame) -> DataFrame:
    """Days, clean days and findings of each test."""
    d = days.select("date").distinct()
    clean = d.join(errors, "date", "left_anti").agg(F.count("*").alias("n")).select(F.lit("clean").alias("what"), "n")
    return d.agg(F.count("*").alias("n")).select(F.lit("days").alias("what"), "n").union(clean).union(errors.groupBy(F.col("test").alias("what")).agg(F.count("*").alias("n")))
