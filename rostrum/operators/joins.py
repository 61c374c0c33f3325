"""Dimension lookups: equal keys, alternate keys, intervals and patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.operators.windows import first_rows

#: Rows up to which a dimension is sent to every task; larger ones are joined by shuffles.
BROADCAST_ROWS = 200_000


def small(dim: DataFrame) -> DataFrame:
    """A broadcast hint for a dimension, if a count of at most :data:`BROADCAST_ROWS` proves it small."""
    return F.broadcast(dim) if len(dim.limit(BROADCAST_ROWS + 1).select(F.lit(1)).groupBy().count().where(F.col("count") <= BROADCAST_ROWS).take(1)) else dim


def fill_from(df: DataFrame, dim: DataFrame, key: str, cols: list[str], ordinal: str) -> DataFrame:
    """NULLs of ``cols`` from the first row of ``dim`` with the key; rows stay as many."""
    first = first_rows(dim, [key], [ordinal]).select(key, *(F.col(c).alias(f"_{c}") for c in cols))
    joined = df.join(small(first), key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in cols}).drop(*(f"_{c}" for c in cols))


def match_forms(df: DataFrame, dim: DataFrame, name: str, forms: str, value: str, ordinal: str, day: str | None = None, spells: DataFrame | None = None, *, start: str = "start", end: str = "end") -> DataFrame:
    """``value`` of the first row of ``dim`` one of whose written ``forms`` is the name, as written or else in any case.

    With a ``day`` and ``spells`` (``value``, ``start``, ``end``) a match is rejected,
    and no other sought, if there are spells of that value but none covers the day.
    Missing bounds are open, a missing day is in spells without any date only.
    """
    long = dim.select(value, ordinal, F.posexplode(forms).alias("_form", "_key")).where("_key IS NOT NULL")
    exact = first_rows(long, ["_key"], [ordinal, "_form"]).select("_key", F.col(value).alias("_exact"))
    lower = first_rows(long.withColumn("_key", F.lower("_key")), ["_key"], [ordinal, "_form"]).select(F.col("_key").alias("_low"), F.col(value).alias("_loose"))
    joined = df.join(small(exact), F.col(name) == F.col("_key"), "left").join(small(lower), F.lower(name) == F.col("_low"), "left")
    matched = joined.withColumn(value, F.coalesce("_exact", "_loose")).drop("_key", "_exact", "_low", "_loose")
    if day is None or spells is None:
        return matched
    terms = spells.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_id")).agg(F.collect_set(F.struct(F.col(start).alias("s"), F.col(end).alias("e"))).alias("_terms"))
    covered = F.exists("_terms", lambda x: F.coalesce(in_spell(F.col(day), x["s"], x["e"]), F.lit(False)))
    guarded = matched.join(small(terms), F.col(value) == F.col("_id"), "left")
    return guarded.withColumn(value, F.when(F.col("_terms").isNull() | covered, F.col(value))).drop("_id", "_terms")


def in_spell(day: Column, start: Column, end: Column) -> Column:
    """Whether the day lies in a spell whose missing bounds are open; both ends count."""
    return (start.isNull() | (day >= start)) & (end.isNull() | (day <= end))


def as_of(df: DataFrame, spells: DataFrame, key: str, day: str, value: str, row_id: str, *, start: str = "start", end: str = "end", ordinal: str = "ordinal", shortest: bool = False) -> DataFrame:
    """``value`` of the spell that covers the day.

    A dated spell overrides what is there, one without any date only fills NULL; of
    several the first by ``ordinal`` counts, or with ``shortest`` the shortest, and
    if none covers the day then the one that ended last.
    """
    s = spells.select(key, F.col(start).alias("_s"), F.col(end).alias("_e"), F.col(ordinal).alias("_o"), F.col(value).alias("_v"))
    met = df.select(row_id, key, day).join(small(s), key)
    covered = in_spell(F.col(day), F.col("_s"), F.col("_e"))
    if shortest:
        order = [F.when(covered, 0).otherwise(1), F.when(covered, F.coalesce(F.datediff("_e", "_s"), F.lit(1 << 30))), F.col("_e").desc_nulls_first(), "_o"]
        best = first_rows(met, [row_id], order).select(row_id, F.col("_v").alias("_new"), F.lit(True).alias("_dated"))
    else:
        dated = F.col("_s").isNotNull() | F.col("_e").isNotNull()
        best = first_rows(met.where(covered).withColumn("_dated", dated), [row_id], [F.col("_dated").desc(), "_o"]).select(row_id, F.col("_v").alias("_new"), "_dated")
    joined = df.join(best, row_id, "left")
    return joined.withColumn(value, F.when(F.col("_dated") & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.coalesce(F.col(value), F.col("_new")))).drop("_new", "_dated")


def pattern_lookup(df: DataFrame, patterns: DataFrame, name: str, day: str, row_id: str, *, pattern: str = "pattern", value: str = "value", ordinal: str = "ordinal") -> DataFrame:
    """``value`` of the first pattern that the name contains, in its dates: a broadcast of a table that :func:`small` proves small."""
    met = df.select(row_id, name, day).join(small(patterns), F.contains(F.lower(name), F.lower(pattern)) & in_spell(F.col(day), F.col("start"), F.col("end")))
    best = met.groupBy(row_id).agg(F.min_by(value, ordinal).alias(value))
    return df.join(best, row_id, "left")


def add_missing(primary: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """``primary`` and those rows of ``other`` whose key it lacks."""
    return primary.unionByName(other.join(primary, key, "left_anti"), allowMissingColumns=True)


def annotated(df: DataFrame, notes: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Rows with their annotations; missing ones are empty texts."""
    return df.join(notes.select(key, *cols), key, "left").withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in cols})


def to_do(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that a checkpoint doesn't have yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def spells_from_events(df: DataFrame, key: str, at: str, keep: list[str]) -> DataFrame:
    """Spells from one event to the next: ``start``, ``end`` (NULL for the last) and ``ordinal``."""
    w = Window.partitionBy(key).orderBy(at, *keep)
    return df.select(key, *keep, F.to_date(at).alias("start"), F.date_sub(F.to_date(F.lead(at).over(w)), 1).alias("end"), F.row_number().over(w).alias("ordinal"))
