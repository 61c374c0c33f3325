"""The search service: hits, totals, series, facets, paging, exchanges, deep links."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.functions import scalars as S
from rostrum.operators import aggregates as A
from rostrum.operators import selection as L
from rostrum.operators import windows as W
from rostrum.plans import filters, lang
from rostrum.sources.tables import new_version
from rostrum.sources.tokens import Tokens

#: Seeds of further searches come from so many matches.
SEEDED = 100
FACETS = ("party", "gender", "name_id", "in_gov", "question", "answer", "interject", "first_speech", "q_in_writing", "div_flag", "state", "electorate", "chamber")


@dataclass
class Request:
    expression: str = ""
    chamber: str = "both"
    filters: dict = field(default_factory=dict)
    page: int = 1
    size: int = 50
    sort: str = "date"
    descending: bool = False
    case_sensitive: bool = False
    mode: str = "token"

    def key(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True, default=str)


@dataclass
class Result:
    """The written matches (without texts) and frames over them; ``hits`` is a page, the others are over all matches.

    ``matches`` has the metadata, ``matched_terms`` and ``embedded``: texts are read
    once for all matches, and once more for the previews of the page and for the seeds.
    """

    matches: DataFrame
    total: int
    pages: int
    hits: DataFrame
    series: DataFrame
    facets: DataFrame
    seeds: DataFrame


class Engine:
    """Searches over a table of turns (``turn_id``, ``chamber``, ``date``, ``order``, ``body`` and metadata).

    ``tokens``: a token table of the turns; searches of whole words then read
    postings, and texts only of the turns that have the words. ``folder``: where
    matches are written; without one they are computed anew for each part of a result.
    """

    def __init__(self, turns: DataFrame, ttl: float = 300, entries: int = 500, tokens: Tokens | None = None, folder: str | None = None):
        self.turns, self.ttl, self.entries, self.tokens, self.folder = turns, ttl, entries, tokens, folder
        self._cache: dict[str, tuple[float, Result]] = {}

    def matches(self, r: Request) -> DataFrame:
        """Metadata, text and chamber in one predicate, so that all of it reaches the scan."""
        d = self.turns if r.chamber == "both" else self.turns.where(F.col("chamber") == r.chamber)
        d = filters.apply_filters(d, r.filters)
        text = lang.auto_quote(r.expression)
        if not text:
            return d
        tree = lang.parse(text)
        if self.tokens is None or r.mode != "token":
            return d.where(lang.compile_tree(tree, F.col("body"), r.mode, r.case_sensitive))
        d = d.join(self.tokens.ids(tree).withColumnRenamed("id", "turn_id"), "turn_id", "left_semi")
        return d.where(lang.compile_tree(tree, F.col("body"), r.mode, True)) if r.case_sensitive else d

    def _found(self, r: Request) -> DataFrame:
        """Matches without their texts, with what the texts say."""
        text = lang.auto_quote(r.expression)
        said = lang.matched_terms(lang.terms(lang.parse(text)), F.col("body"), r.case_sensitive) if text else F.lit("")
        m = self.matches(r).withColumn("matched_terms", said).withColumn("embedded", S.has_interjection(F.col("body")).cast("int")).drop("body")
        if self.folder is None:
            return m
        path = new_version(m, self.folder)
        return m.sparkSession.read.schema(m.schema).parquet(path)

    def search(self, r: Request) -> Result:
        now = time.time()
        old = self._cache.get(r.key())
        if old and now - old[0] < self.ttl:
            return old[1]
        m = self._found(r)
        total = m.count()
        number, size, pages = L.page_bounds(total, r.page, r.size)
        keys = L.ordering(r.sort, r.descending, columns=self.turns.columns)
        # the page is found without the texts, which join by id afterwards
        ids = L.page(m, keys, number, size)
        hits = ids.join(self.turns.select("turn_id", S.preview(F.col("body")).alias("preview")), "turn_id").orderBy(*keys)
        first = m.select("turn_id").orderBy("turn_id").limit(SEEDED).join(self.turns.select("turn_id", "body"), "turn_id")
        named = {f: F.col(f) for f in (*FACETS, "embedded") if f in m.columns}
        if {"question", "answer"} <= set(m.columns):
            named["row_type"] = F.when((F.col("question") == 1) | (F.col("answer") == 1), "exchange").otherwise("speech")
        if "interject" in m.columns:
            named["no_interject"] = F.when(F.coalesce("interject", F.lit(0)) == 0, 1)
        named["parliament"] = S.parliament(F.year("date"))
        out = Result(m, total, pages, hits, A.time_series(m, F.year("date"), "chamber", ["senate", "house"]), A.facets(m, named), A.seeds(first, "body", "turn_id"))
        if len(self._cache) >= self.entries:
            self._cache.pop(next(iter(self._cache)))
        self._cache[r.key()] = (now, out)
        return out

    def metadata(self) -> DataFrame:
        """What can be filtered by: ``what`` and ``value`` of each party, state and electorate, the first and last day and the rows of each chamber."""
        real = lambda c: F.when(~F.trim(c).isin("", "nan", "None"), F.col(c))
        sets = [self.turns.select(F.lit(c).alias("what"), real(c).alias("value")).where("value IS NOT NULL").distinct() for c in ("party", "state", "electorate") if c in self.turns.columns]
        days = self.turns.agg(F.min("date").cast("string").alias("first_day"), F.max("date").cast("string").alias("last_day")).unpivot([], ["first_day", "last_day"], "what", "value")
        rows = self.turns.groupBy(F.concat(F.col("chamber"), F.lit("_rows")).alias("what")).agg(F.count("*").cast("string").alias("value"))
        return reduce(DataFrame.union, [*sets, days, rows])

    def aliases(self, term: str, seeds: list[str]) -> list[str]:
        """Seeds worth suggesting beside a term: no longer phrase that holds the term itself, none twice."""
        kept = [s for s in seeds[:20] if not (term.lower() in s.lower() and len(s.split()) > len(term.split()))]
        return list({s.lower(): s for s in reversed(kept)}.values())[::-1]

    def find_page(self, turn: int | str, r: Request) -> DataFrame:
        """Position and page of a turn, by id or by hash, among the hits of a request in its own order."""
        names = [c for c in L.sort_names(r.sort, self.turns.columns) if c != "turn_id"]
        wanted = F.col("turn_id") == turn if isinstance(turn, int) else self._hash() == turn
        return L.position(self.matches(r), names, wanted, min(200, max(1, r.size)), descending=r.descending)

    @staticmethod
    def _hash():
        return S.turn_hash(F.col("chamber"), F.col("date"), F.col("name_id"), F.col("body"))

    def day(self, chamber: str, date: str) -> DataFrame:
        return self.turns.where((F.col("chamber") == chamber) & (F.col("date") == F.lit(date).cast("date"))).orderBy("order")

    def day_by_hash(self, wanted: str) -> DataFrame:
        """The turns of a day, by the hash of its chamber and date; hashes are made of distinct days only."""
        days = self.turns.select("chamber", "date").distinct()
        return self.turns.join(days.where(S.day_hash(F.col("chamber"), F.col("date")) == wanted), ["chamber", "date"], "left_semi").orderBy("order")

    def by_hash(self, wanted: str) -> DataFrame:
        return self.turns.where(self._hash() == wanted)

    def exchanges(self, r: Request, n: int = 3, *, whole_days: bool = False) -> DataFrame:
        """Matches with heading, context and pairing; over the filtered turns of a day, or over whole days."""
        text = lang.auto_quote(r.expression)
        base = self.turns if r.chamber == "both" else self.turns.where(F.col("chamber") == r.chamber)
        base = base if whole_days else filters.apply_filters(base, r.filters)
        hit = lang.compile_tree(lang.parse(text), F.col("body"), r.mode, r.case_sensitive)
        if whole_days:
            hit = hit & filters.predicate(base.columns, r.filters)
        keys = ["chamber", "date"]
        days = base.where(hit).select(*keys).distinct()
        d = base.join(days, keys, "left_semi")
        d = W.headings(d, F.lower("name").isin("stage direction", "business start"), F.col("body"), keys, "order")
        d = W.context(d, F.concat(F.coalesce("name", F.lit("")), F.lit(": "), S.flatten(F.col("body"))), keys, "order", n)
        d = W.exchanges(d, hit, F.col("question") == 1, F.col("answer") == 1, keys, "order")
        return d.withColumn("match_id", F.concat_ws("-", "chamber", "date", "order")).withColumn("exchange_id", F.when(F.col("exchange_order").isNotNull(), F.concat(F.concat_ws("-", "chamber", "date"), F.lit("-xch"), F.col("exchange_order").cast("string"))))
