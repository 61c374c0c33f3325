"""Excerpts and citations. Overlapping windows have no built-in form: those two are vectorised Python functions."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def snippet_of(body: str, phrase: str, window: int = 300) -> str:
    """The part around the first of the occurrences with most others near; without any the first 600 characters."""
    low, term = body.lower(), phrase.lower()
    at = np.array([m.start() for m in re.finditer(f"(?={re.escape(term)})", low)] if term else [], np.int64)
    if not len(at):
        return body[:600] + "..." * (len(body) > 600)
    near = np.searchsorted(at, at + len(phrase) + window, "right") - np.searchsorted(at, at - window, "left")
    p = int(at[near.argmax()])
    a, z = max(0, p - window), min(len(body), p + len(phrase) + window)
    return "..." * (a > 0) + body[a:z] + "..." * (z < len(body))


def excerpt_of(body: str, terms: list[str], window: int = 400, ends: int = 400) -> str:
    """Both ends and what is around whole-word matches, with marks where text is left out; the whole text without a match."""
    found = np.array([m.span() for t in terms if t for m in re.finditer(rf"\b{re.escape(t)}\b", body, re.IGNORECASE)], np.int64).reshape(-1, 2)
    if not len(found):
        return body
    #: how many windows open and close at each place; text is kept where some are open
    change = np.zeros(len(body) + 1, np.int64)
    np.add.at(change, np.concatenate([[0, max(0, len(body) - ends)], np.maximum(0, found[:, 0] - window)]), 1)
    np.add.at(change, np.concatenate([[min(ends, len(body)), len(body)], np.minimum(len(body), found[:, 1] + window)]), -1)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(change) > 0, [0]]).astype(np.int8)))
    return " […] ".join(body[a:z] for a, z in edges.reshape(-1, 2).tolist())


def snippet(col: Column, phrase: str, window: int = 300) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else snippet_of(x, phrase, window))

    return run(col)


def excerpt(col: Column, terms: list[str], window: int = 400, ends: int = 400) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else excerpt_of(x, terms, window, ends))

    return run(col)


def citations(reports: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``ref`` and ``number``: the ids in ``[n, m]`` groups, numbered by where each first occurs in its report."""
    groups = F.regexp_extract_all(text, F.lit(r"\[(\d+(?:\s*,\s*\d+)*)\]"), F.lit(1))
    ids = reports.select(key, F.posexplode(groups).alias("_g", "_ids")).select(key, "_g", F.posexplode(F.split("_ids", r"\s*,\s*")).alias("_i", "ref"))
    first = ids.groupBy(key, F.col("ref").cast("long").alias("ref")).agg(F.min(F.struct("_g", "_i")).alias("_at"))
    return first.withColumn("number", F.row_number().over(Window.partitionBy(key).orderBy("_at"))).drop("_at")


def rewritten(reports: DataFrame, key: str, text: str, before: str = "<sup>", after: str = "</sup>") -> DataFrame:
    """``reports`` with ``rewritten``: in each ``[n, m]`` group the ids give way to their numbers of :func:`citations`."""
    group = r"\[(\d+(?:\s*,\s*\d+)*)\]"
    numbers = citations(reports, key, text).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("ref", "number"))).alias("_numbers"))
    parts, ids = F.split(text, group, -1), F.regexp_extract_all(text, F.lit(group), F.lit(1))
    numbered = lambda g: F.array_join(F.transform(F.split(g, r"\s*,\s*"), lambda x: F.element_at("_numbers", x.cast("long")).cast("string")), ", ")
    marked = F.transform(F.arrays_zip(F.slice(parts, F.lit(1), F.size(ids)).alias("p"), ids.alias("g")), lambda x: F.concat(x["p"], F.lit(before), numbered(x["g"]), F.lit(after)))
    return reports.join(numbers, key, "left").withColumn("rewritten", F.concat(F.array_join(marked, ""), F.element_at(parts, -1))).drop("_numbers")


def references(reports: DataFrame, key: str, text: str, known: DataFrame, ref: str, label: str) -> DataFrame:
    """The list of each report: ``number`` and ``label`` of the ids it cites."""
    return citations(reports, key, text).join(known.select(F.col(ref).alias("ref"), label), "ref").select(key, "number", label)


def citation_faults(reports: DataFrame, key: str, text: str, known: DataFrame, ref: str) -> DataFrame:
    """Ids that don't exist, groups of more than three, and brackets that are no group of ids."""
    group = r"\[(\d+(?:\s*,\s*\d+)*)\]"
    used = citations(reports, key, text)
    unknown = used.join(known.select(F.col(ref).alias("ref")), "ref", "left_anti").select(key, F.concat(F.lit("unknown "), F.col("ref").cast("string")).alias("fault"))
    groups = reports.select(key, F.explode(F.regexp_extract_all(text, F.lit(group), F.lit(1))).alias("g"))
    many = groups.where(F.size(F.split("g", ",")) > 3).select(key, F.concat(F.lit("too many: "), F.col("g")).alias("fault"))
    raw = reports.select(key, F.explode(F.regexp_extract_all(F.regexp_replace(text, group, ""), F.lit(r"\[[^\]]*\]?"), F.lit(0))).alias("b"))
    return unknown.union(many).union(raw.select(key, F.concat(F.lit("raw bracket: "), F.col("b")).alias("fault")))


def list_faults(reports: DataFrame, key: str, text: str, listed: DataFrame, ref: str = "ref") -> DataFrame:
    """Ids that a report cites and its list lacks, or the other way round. ``listed``: ``key`` and the id."""
    cited, have = citations(reports, key, text).select(key, "ref"), listed.select(key, F.col(ref).cast("long").alias("ref"))
    lacking = cited.subtract(have).select(key, F.concat(F.lit("not listed "), F.col("ref").cast("string")).alias("fault"))
    return lacking.union(have.subtract(cited).select(key, F.concat(F.lit("not cited "), F.col("ref").cast("string")).alias("fault")))
