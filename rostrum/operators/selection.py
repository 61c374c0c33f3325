"""Samples, budgets and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SORTS = {"date": ("date", "order"), "chamber": ("chamber", "date"), "name": ("name", "date"), "party": ("party", "date"), "in_gov": ("in_gov", "date"), "state_or_electorate": ("state", "electorate", "date")}


def stratified(df: DataFrame, stratum: Column, key: str, n: int = 6, seed: int = 42) -> DataFrame:
    """n rows of each stratum, by a hash of the key: the same ones every time."""
    w = Window.partitionBy(stratum).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def broad(df: DataFrame, period: str, size: Column, key: str, cap: int) -> DataFrame:
    """``cap`` rows spread over the periods, the longest first; what doesn't divide goes to the earliest periods."""
    periods = df.groupBy(period).agg(F.count("*").alias("_have"))
    w = Window.orderBy(period)
    take = periods.withColumn("_k", F.row_number().over(w)).join(F.broadcast(periods.agg(F.count("*").alias("_n"))))
    take = take.select(period, (F.greatest(F.lit(1), F.floor(F.lit(cap) / F.col("_n"))) + F.when((F.lit(cap) >= F.col("_n")) & (F.col("_k") <= F.lit(cap) % F.col("_n")), 1).otherwise(0)).alias("_take"))
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(period).orderBy(size.desc(), key)))
    return ranked.join(take, period).where(F.col("_r") <= F.col("_take")).drop("_r", "_take")


def budget(df: DataFrame, period: str, speaker: str, score: str, key: str, slots: int) -> DataFrame:
    """Rows under a budget: slots in proportion to each period, dealt round by round to the speakers by their best score."""
    n = df.groupBy(period).agg(F.count("*").alias("_c"))
    share = n.join(F.broadcast(df.agg(F.count("*").alias("_all")))).select(period, F.greatest(F.lit(1), F.bround(F.lit(float(slots)) * F.col("_c") / F.col("_all"))).alias("_slots"))
    own = Window.partitionBy(period, speaker)
    d = df.withColumn("_round", F.row_number().over(own.orderBy(F.desc(score), key))).withColumn("_best", F.max(score).over(own))
    d = d.withColumn("_place", F.row_number().over(Window.partitionBy(period).orderBy("_round", F.desc("_best"), speaker, key)))
    return d.join(share, period).where(F.col("_place") <= F.col("_slots")).drop("_round", "_best", "_place", "_slots")


def cap_speakers(df: DataFrame, speaker: str, order: list[str], share: float = 0.15, least: int = 3) -> DataFrame:
    """At most this share of the rows, and ``least`` in any case, of each speaker."""
    d = df.withColumn("_r", F.row_number().over(Window.partitionBy(speaker).orderBy(*order)))
    return d.join(F.broadcast(df.agg(F.greatest(F.lit(least), F.bround(share * F.count("*"))).alias("_cap")))).where(F.col("_r") <= F.col("_cap")).drop("_r", "_cap")


def budget_whole(df: DataFrame, period: str, speaker: str, score: str, key: str, date: str, slots: int) -> DataFrame:
    """:func:`budget`, then the first row by ``date`` and ``key`` in any case, then :func:`cap_speakers` in that order, which keeps that row."""
    first = df.orderBy(date, key).limit(1)
    picked = budget(df, period, speaker, score, key, slots).join(F.broadcast(first.select(key)), key, "left_anti").unionByName(first)
    return cap_speakers(picked, speaker, [date, key])


def affordable(df: DataFrame, text: str, period: str, speaker: str, score: str, key: str, date: str, tokens: int, most: int | None = 500) -> DataFrame:
    """All rows if their texts (four characters a token) fit a budget and they are no more than ``most``; else :func:`budget_whole` with as many slots as the budget has for a text of mean length.

    ``most`` None: the budget alone counts. Both the sum and the number are taken over all rows.
    """
    r = df.agg(F.sum(F.floor(F.length(text) / 4)).alias("t"), F.count("*").alias("n")).first()
    total = r.t or 0
    if total <= tokens and (most is None or r.n <= most):
        return df
    slots = max(1, int(tokens / max(total / max(r.n, 1), 1)))
    return budget_whole(df, period, speaker, score, key, date, slots if most is None else min(slots, most))


def sort_names(sort: str, columns: list[str]) -> list[str]:
    """The columns of a named order that a table has; unknown names sort by date. A place is the state where there is one, else the electorate."""
    names = [c for c in SORTS.get(sort, SORTS["date"]) if c in columns]
    return [c for c in names if c != "electorate" or "state" not in columns]


def ordering(sort: str = "date", descending: bool = False, tie: str = "turn_id", columns: list[str] | None = None) -> list[Column]:
    """Sort keys of a result; NULLs come last either way; unknown names sort by date."""
    names = sort_names(sort, columns if columns is not None else [c for keys in SORTS.values() for c in keys if c != "electorate"])
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in names] + [F.col(tie).asc()]


def page_bounds(total: int, page: int, size: int) -> tuple[int, int, int]:
    """Page, size and number of pages within bounds."""
    size = min(200, max(1, size))
    pages = max(1, -(-total // size))
    return min(max(1, page), pages), size, pages


def page(df: DataFrame, keys: list[Column], number: int, size: int) -> DataFrame:
    return df.orderBy(*keys).offset((number - 1) * size).limit(size)


def position(df: DataFrame, names: list[str], wanted: Column, size: int, *, descending: bool = False, tie: str = "turn_id") -> DataFrame:
    """Where a row stands in the order of :func:`ordering` and on which page: counted, not ranked in one task."""
    at = df.where(wanted).orderBy(tie).limit(1).select(*(F.col(c).alias(f"_at_{c}") for c in (*names, tie)))
    before, equal = F.lit(False), F.lit(True)
    for c in (*names, tie):
        mine, its = F.col(c), F.col(f"_at_{c}")
        sooner = mine > its if descending and c != tie else mine < its
        before = before | equal & F.coalesce(sooner | mine.isNotNull() & its.isNull(), mine.isNotNull() & its.isNull())
        equal = equal & mine.eqNullSafe(its)
    n = df.select(*names, tie).join(F.broadcast(at), before).agg(F.count("*").alias("_n"))
    return at.join(F.broadcast(n)).select(*(F.col(f"_at_{c}").alias(c) for c in (*names, tie)), (F.col("_n") + 1).alias("position"), F.ceil((F.col("_n") + 1) / size).alias("page"))
