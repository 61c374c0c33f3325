"""Order-sensitive operators over the turns of a sitting day: each is one window expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed pattern: procedural openings that are no debate heading.
HEADING_SKIP = (
    r"(?i)took the chair|adjourned|resumed|interrupted|suspended|the chair was taken|presiding|in the chair|"
    r"the (?:house|senate) divided|question so resolved|question negatived|bill read|ordered that"
)
ALL, BEFORE, AFTER = (Window.unboundedPreceding, Window.unboundedFollowing), (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)


def day(keys: list[str], order: str):
    """The window of a day: rows of ``keys`` in ``order``."""
    return Window.partitionBy(*keys).orderBy(order)


def speech_numbers(df: DataFrame, row_type: Column, keys: list[str], order: str, *, historical: bool = False) -> DataFrame:
    """``speech_no``: speeches, questions and answers start a new number; other turns inherit it; stage directions have none and end it.

    ``historical``: every turn but an interjection starts a new number, and nothing ends it.
    """
    w = day(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    starts = row_type != "interjection" if historical else row_type.isin("speech", "question", "answer", "business_start", "petition")
    number = F.sum(F.when(starts, 1).otherwise(0)).over(w)
    if historical:
        return df.withColumn("speech_no", number)
    ends = row_type.isin("stage_direction", "division")
    open_ = F.last(F.when(ends, False).when(starts, True), ignorenulls=True).over(w)
    return df.withColumn("speech_no", F.when(F.coalesce(open_, F.lit(False)), number))


def interjections(df: DataFrame, group: list[str], order: str, name_id: str = "name_id", explicit: Column | None = None, *, presiding: bool = True) -> DataFrame:
    """``interject``: 1 for turns in a speech group by another than its first speaker, or marked as such."""
    w = Window.partitionBy(*group).orderBy(order)
    first = F.first(name_id).over(w.rowsBetween(*ALL))
    value = F.when(F.row_number().over(w) == 1, 0)
    if presiding:
        value = value.when(F.col(name_id) == "10000", 0)
    if explicit is not None:
        value = value.when(explicit, 1)
    return df.withColumn("interject", value.when(F.col(name_id).isNotNull() & (F.col(name_id) != first), 1).otherwise(0))


def headings(df: DataFrame, is_heading: Column, body: Column, keys: list[str], order: str, skip: str = HEADING_SKIP) -> DataFrame:
    """``debate_heading``: the nearest earlier heading of the day that isn't procedural, else an empty text."""
    real = is_heading & (F.coalesce(body, F.lit("")) != "") & ~body.rlike(skip)
    return df.withColumn("debate_heading", F.coalesce(F.last(F.when(real, body), ignorenulls=True).over(day(keys, order).rowsBetween(*BEFORE)), F.lit("")))


def context(df: DataFrame, line: Column, keys: list[str], order: str, n: int = 3, glue: str = " ¶ ") -> DataFrame:
    """``context_before`` and ``context_after``: the lines of n turns on either side."""
    w = day(keys, order)
    return df.withColumn("context_before", F.array_join(F.collect_list(line).over(w.rowsBetween(-n, -1)), glue)).withColumn("context_after", F.array_join(F.collect_list(line).over(w.rowsBetween(1, n)), glue))


def exchanges(df: DataFrame, matched: Column, question: Column, answer: Column, keys: list[str], order: str) -> DataFrame:
    """Matched turns and the partners they pull in, with ``match_source`` and ``exchange_order``.

    A matched question is its own exchange; a matched answer belongs to the last
    question before it; an unmatched answer joins if some matched question has it as
    its next answer, an unmatched question if some matched answer has it as its last
    question; other matched turns have no exchange.
    """
    w = day(keys, order)
    o = F.col(order)
    d = df.withColumns({"_m": F.coalesce(matched, F.lit(False)), "_q": F.coalesce(question, F.lit(False)), "_a": F.coalesce(answer, F.lit(False))})
    d = d.withColumn("_prev_q", F.last(F.when(F.col("_q"), o), ignorenulls=True).over(w.rowsBetween(*BEFORE)))
    d = d.withColumn("_next_a", F.first(F.when(F.col("_a"), o), ignorenulls=True).over(w.rowsBetween(*AFTER)))
    # the matched questions that point at an answer all lie after the answer before it
    d = d.withColumn("_last_a", F.last(F.when(F.col("_a"), o), ignorenulls=True).over(w.rowsBetween(*BEFORE)))
    d = d.withColumn("_asked", F.last(F.when(F.col("_m") & F.col("_q"), o), ignorenulls=True).over(w.rowsBetween(*BEFORE)))
    d = d.withColumn("_asked", F.when(F.col("_asked") >= F.coalesce(F.col("_last_a"), F.col("_asked")), F.col("_asked")))
    # the matched answers that point at a question all lie before the next question
    d = d.withColumn("_next_q", F.first(F.when(F.col("_q"), o), ignorenulls=True).over(w.rowsBetween(*AFTER)))
    d = d.withColumn("_answered", F.first(F.when(F.col("_m") & F.col("_a") & ~F.col("_q"), o), ignorenulls=True).over(w.rowsBetween(*AFTER)))
    d = d.withColumn("_answered", F.when(F.col("_answered") <= F.coalesce(F.col("_next_q"), F.col("_answered")), F.col("_answered")))
    d = d.withColumn(
        "match_source",
        F.when(F.col("_m"), "search").when(F.col("_a") & F.col("_asked").isNotNull(), "question_answer").when(F.col("_q") & F.col("_answered").isNotNull(), "answer_question"),
    )
    d = d.withColumn(
        "exchange_order",
        F.when(F.col("_m") & F.col("_q"), o).when(F.col("_m") & F.col("_a"), F.col("_prev_q")).when(~F.col("_m") & F.col("_a") & F.col("_asked").isNotNull(), F.col("_asked")).when(~F.col("_m") & F.col("_q") & F.col("_answered").isNotNull(), o),
    )
    return d.where("match_source IS NOT NULL").select(*df.columns, "match_source", "exchange_order")


def fill_forward(df: DataFrame, col: str, keys: list[str], order: str) -> DataFrame:
    return df.withColumn(col, F.last(col, ignorenulls=True).over(day(keys, order).rowsBetween(Window.unboundedPreceding, 0)))


def fill_both(df: DataFrame, col: str, keys: list[str], order: str) -> DataFrame:
    """Forward, then backward."""
    w = day(keys, order)
    return df.withColumn(col, F.coalesce(F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.first(col, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))))


def consecutive_duplicates(df: DataFrame, body: str, keys: list[str], order: str) -> DataFrame:
    """Rows whose text is that of the row before."""
    return df.withColumn("_before", F.lag(body).over(day(keys, order))).where(F.col(body) == F.col("_before")).drop("_before")


def unwrap_midnight(df: DataFrame, t: str, keys: list[str], order: str) -> DataFrame:
    """Minutes that go on past midnight: every drop of more than 30 between known times adds a day from there on."""
    w = day(keys, order)
    before = F.last(t, ignorenulls=True).over(w.rowsBetween(*BEFORE))
    d = df.withColumn("_drop", F.when(F.col(t) < before - 30, 1).otherwise(0))
    return d.withColumn(t, F.col(t) + 1440 * F.sum("_drop").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_drop")


def interpolate(df: DataFrame, t: str, keys: list[str], order: str) -> DataFrame:
    """Missing values on the line between the known ones by row position, flat beyond them; ``time_est`` marks them."""
    w = day(keys, order)
    d = df.withColumn("_i", F.row_number().over(w))
    known = F.when(F.col(t).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(t).alias("t")))
    d = d.withColumn("_p", F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("_n", F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    between = F.col("_p.t") + (F.col("_i") - F.col("_p.i")) * (F.col("_n.t") - F.col("_p.t")) / (F.col("_n.i") - F.col("_p.i"))
    value = F.when(F.col(t).isNotNull(), F.col(t)).when(F.col("_p").isNotNull() & F.col("_n").isNotNull(), between).otherwise(F.coalesce(F.col("_p.t"), F.col("_n.t")))
    return d.withColumn("time_est", F.col(t).isNull() & value.isNotNull()).withColumn(t, value).drop("_i", "_p", "_n")


def rolling_mean(df: DataFrame, value: str, order: str, k: int, keys: list[str] | None = None) -> DataFrame:
    """``rolling``: the centred mean over ``2 k + 1`` rows that there are."""
    return df.withColumn("rolling", F.avg(value).over(Window.partitionBy(*(keys or [])).orderBy(order).rowsBetween(-k, k)))


def first_rows(df: DataFrame, keys: list[str], order: list, n: int = 1) -> DataFrame:
    """The first n rows of each key under an explicit order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def first_events(entries: DataFrame, turns: DataFrame, key: str, gap: int = 180, *, override: bool = False) -> DataFrame:
    """The first turn on or after each entry: of a key's first spell, and of those that start more than ``gap`` days after the known end of the spell before.

    A first entry with no turn on or after it takes the first turn of all; it is
    passed over if a turn of the key is flagged already, unless ``override``.
    ``entries``: ``key``, ``start``, ``end``; ``turns``: ``key``, ``date``,
    ``turn_id`` (its order within a day) and, if there are such columns,
    ``substantive`` (false: no candidate) and ``first_speech`` (1: flagged).
    """
    w = Window.partitionBy(key).orderBy("start", "end")
    ranked = entries.where("start IS NOT NULL").withColumn("_end", F.lag("end").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    fresh = ranked.where(F.col("_first") | (F.datediff("start", "_end") > gap)).groupBy(key, "start").agg(F.bool_or("_first").alias("_first"))
    if "first_speech" in turns.columns and not override:
        flagged = turns.where("first_speech = 1").select(key).distinct().withColumn("_flagged", F.lit(True))
        fresh = fresh.join(flagged, key, "left").where("NOT _first OR _flagged IS NULL").drop("_flagged")
    own = turns.where("date IS NOT NULL")
    if "substantive" in turns.columns:
        own = own.where("substantive")
    met = own.join(fresh, key).where("date >= start OR _first")
    return first_rows(met, [key, "start"], [F.col("date") < F.col("start"), "date", "turn_id"]).drop("_first")
