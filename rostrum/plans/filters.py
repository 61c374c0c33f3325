"""Metadata filters of a search, compiled into one predicate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.scalars import exclusive_type

FLAGS = ("in_gov", "interject", "question", "answer", "first_speech", "q_in_writing", "fedchamb_flag", "div_flag")
#: Years of governments by name.
ERAS = {
    "howard": (1996, 2007), "rudd": (2007, 2010), "rudd1": (2007, 2010), "gillard": (2010, 2013), "rudd2": (2013, 2013),
    "abbott": (2013, 2015), "turnbull": (2015, 2018), "morrison": (2018, 2022), "albanese": (2022, 2100),
}


def _like(col: str, text: str) -> Column:
    return F.coalesce(F.contains(F.lower(F.col(col)), F.lit(text.lower())), F.lit(False))


def predicate(columns: list[str], spec: dict) -> Column:
    """All conditions of ``spec`` together; one whose column is absent doesn't count."""
    has = set(columns)
    parts: list[Column] = []
    ranges = [r for r in spec.get("date_ranges") or [] if r.get("from") or r.get("to")]
    if "date" in has:
        day = F.col("date").cast("date")
        side = lambda r: (day >= F.lit(r["from"]).cast("date") if r.get("from") else F.lit(True)) & (day <= F.lit(r["to"]).cast("date") if r.get("to") else F.lit(True))
        if ranges:
            parts.append(reduce(lambda a, b: a | b, map(side, ranges)))
        elif spec.get("date_from") or spec.get("date_to"):
            parts.append(side({"from": spec.get("date_from"), "to": spec.get("date_to")}))
    if spec.get("party") and "party" in has:
        parts.append(F.upper("party").isin(*(p.upper() for p in spec["party"])))
    if spec.get("gender") and "gender" in has:
        parts.append(F.lower("gender") == spec["gender"].lower())
    parts += [F.col(f).try_cast("int") == int(spec[f]) for f in FLAGS if spec.get(f) is not None and f in has]
    if spec.get("has_embedded_interject") is not None and "has_embedded_interject" in has:
        parts.append(F.coalesce(F.col("has_embedded_interject").cast("boolean"), F.lit(False)) == bool(spec["has_embedded_interject"]))
    if spec.get("row_type") and {"question", "answer"} <= has:
        exchange = (F.coalesce(F.col("question").try_cast("int"), F.lit(0)) == 1) | (F.coalesce(F.col("answer").try_cast("int"), F.lit(0)) == 1)
        parts.append(exchange if spec["row_type"] == "exchange" else ~exchange)
    parts += [_like(c, spec[k]) for k, c in (("speaker", "name"), ("electorate", "electorate"), ("state", "state")) if spec.get(k) and c in has]
    if spec.get("name_id") and "name_id" in has:
        ids = spec["name_id"]
        parts.append(F.col("name_id").isin(*(ids if isinstance(ids, list | tuple) else [ids])))
    if spec.get("unique_id") and "unique_id" in has:
        parts.append(F.col("unique_id") == spec["unique_id"])
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def apply_filters(df: DataFrame, spec: dict | None) -> DataFrame:
    return df.where(predicate(df.columns, spec or {}))


def element(e: dict, columns: list[str]) -> Column:
    """One element of a filter by research question; an unknown or malformed one holds for no row."""
    kind, v = e.get("type"), e.get("value")
    no, year = F.lit(False), F.year("date") if "date" in columns else F.col("year")
    between = lambda y: year.between(int(y[0]), int(y[1]))
    try:
        if kind == "speaker":
            return _like("name", str(v))
        if kind == "year_range":
            return between(v)
        if kind == "party":
            return F.col("party") == str(v)
        if kind == "gov_era":
            return between(ERAS[str(v).lower()])
        if kind == "division_turns":
            return F.coalesce(F.col("div_flag") == 1, no) if str(v).lower() in ("true", "1", "yes") else no
        if kind == "debate_date":
            return F.col("date").isin(*(F.lit(d).cast("date") for d in (v if isinstance(v, list | tuple) else [v])))
        if kind == "speaker_date":
            return _like("name", v["speaker"]) & F.col("date").isin(*(F.lit(d).cast("date") for d in v["dates"]))
        if kind == "speaker_year":
            return _like("name", v["speaker"]) & between(v["years"])
        if kind in ("speaker_type", "speaker_year_type"):
            turn = exclusive_type(v.get("turn_type", ""), F.col("question"), F.col("answer"), F.col("interject"))
            return _like("name", v["speaker"]) & turn & (between(v["years"]) if kind == "speaker_year_type" else F.lit(True))
        if kind == "state_year":
            return _like("state", v["state"]) & between(v["years"])
    except (KeyError, TypeError, ValueError, IndexError):
        return no
    return no


def research_filter(df: DataFrame, elements: list[dict], floor: int = 50) -> DataFrame:
    """Rows for which any element holds; all rows if fewer than ``floor`` would stay."""
    if not elements:
        return df
    some = df.where(F.coalesce(reduce(lambda a, b: a | b, (element(e, df.columns) for e in elements)), F.lit(False)))
    return some if len(some.limit(floor).select(F.lit(1)).collect()) >= floor else df
