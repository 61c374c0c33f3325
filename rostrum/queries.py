"""One query for each operator over the tables of a data directory, with the SQL that says the same.

Conversations stand for sitting days (a user asks, an assistant answers, a system
turn directs), documents for speeches, orders for dated records and spells,
events for logs of use.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostrum.functions import excerpts as X
from rostrum.functions import scalars as S
from rostrum.operators import aggregates as A
from rostrum.operators import joins as J
from rostrum.operators import reports as R
from rostrum.operators import selection as L
from rostrum.operators import validation as V
from rostrum.operators import windows as W
from rostrum.plans import filters, lang
from rostrum.session import table
from rostrum.sources import proceedings, tables, tokens
from rostrum.sources.tables import links

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query; whole numbers become 64-bit ones."""

    def keep(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(lambda name: table(spark, sf_dir, name))
            return df.select(*(F.col(c).cast("long").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes))

        run.__name__ = f.__name__
        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return run

    return keep


def r4(c, name: str):
    return F.round(c, 4).alias(name)


def turns(t) -> DataFrame:
    return t("conversations").select("conv_id", F.col("turn").alias("order"), "role", F.coalesce("text", F.lit("")).alias("body"))


def by_year(t) -> DataFrame:
    return t("orders").withColumn("year", F.year("o_orderdate")).withColumn("date", F.to_date("o_orderdate"))


# search

@query("SELECT doc_id FROM documents WHERE (contains(lower(text), 'the') OR contains(lower(text), 'and')) AND contains(lower(text), 'that')")
def f1_f5_boolean_search(t):
    return t("documents").where(lang.compile_tree(lang.parse("('the' | 'and') & 'that'"), F.col("text"))).select("doc_id")


@query("SELECT doc_id, lang, source FROM documents WHERE (contains(text, 'The') OR contains(text, 'And')) AND source IN ('src1', 'src2', 'src3')")
def f6_case_sensitive(t):
    tree = lang.parse("The OR 'And'")
    return t("documents").where(F.col("source").isin("src1", "src2", "src3") & lang.compile_tree(tree, F.col("text"), case_sensitive=True)).select("doc_id", "lang", "source")


@query("""SELECT doc_id FROM documents WHERE contains(' ' || trim(regexp_replace(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ', ' of the ')
OR contains(' ' || trim(regexp_replace(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ', ' cion ')""")
def f3_fts_phrase(t):
    return t("documents").where(lang.compile_tree(lang.parse("'of-the' OR ción"), F.col("text"), "token")).select("doc_id")


@query("""SELECT doc_id FROM documents WHERE contains(' ' || trim(regexp_replace(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ', ' of the ')
OR contains(' ' || trim(regexp_replace(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ', ' cion ')""")
def s15_f3_token_table(t):
    """The token table is written, then postings answer without reading a text."""
    docs = t("documents")
    path = tokens.build(docs, "doc_id", "text", tables.scratch(docs.sparkSession, "tokens"))
    return tokens.Tokens(docs.sparkSession, path).ids(lang.parse("'of-the' OR ción")).withColumnRenamed("id", "doc_id")


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(lower(text), 'the') THEN 'the' END, CASE WHEN contains(lower(text), 'der') THEN 'der' END, CASE WHEN contains(lower(text), 'que') THEN 'que' END], lambda x: x IS NOT NULL), ' | ') AS matched
FROM documents WHERE contains(lower(text), 'the') OR contains(lower(text), 'der') OR contains(lower(text), 'que')""")
def f8_matched_terms(t):
    tree = lang.parse("the OR der OR que")
    d = t("documents").where(lang.compile_tree(tree, F.col("text")))
    return d.select("doc_id", lang.matched_terms(lang.terms(tree), F.col("text")).alias("matched"))


ALIASES = {"thesh": ["thesh", "Thesh"], "license": ["License", "Licensed"], "einung": ["Einung", "einung"]}


@query("""SELECT org, count(*) AS turns, sum(m)::BIGINT AS mentions, round(avg(m), 4) AS mean_mentions, count(*) FILTER (WHERE lang = 'en') AS n_en, count(DISTINCT source) AS speakers FROM (
SELECT 'thesh' AS org, lang, source, (length(text) - length(replace(text, 'thesh', ''))) / 5 + (length(text) - length(replace(text, 'Thesh', ''))) / 5 AS m FROM documents WHERE contains(text, 'thesh') OR contains(text, 'Thesh')
UNION ALL SELECT 'license', lang, source, (length(text) - length(replace(text, 'License', ''))) / 7 + (length(text) - length(replace(text, 'Licensed', ''))) / 8 FROM documents WHERE contains(text, 'License') OR contains(text, 'Licensed')
UNION ALL SELECT 'einung', lang, source, (length(text) - length(replace(text, 'Einung', ''))) / 6 + (length(text) - length(replace(text, 'einung', ''))) / 6 FROM documents WHERE contains(text, 'Einung') OR contains(text, 'einung')) GROUP BY org""")
def a11_mention_summary(t):
    """Mentions of each organisation under all its names; names are counted only in texts that hold them."""
    count = lambda a: F.when(reduce(lambda x, y: x | y, (F.contains("text", F.lit(n)) for n in a)), S.occurrences(F.col("text"), a)).otherwise(0)
    orgs = F.filter(F.array(*(F.struct(F.lit(o).alias("org"), count(a).alias("m")) for o, a in ALIASES.items())), lambda x: x["m"] > 0)
    d = t("documents").select("lang", "source", F.explode(orgs).alias("x")).select("lang", "source", "x.*")
    return d.groupBy("org").agg(F.count("*").alias("turns"), F.sum("m").alias("mentions"), r4(F.avg("m"), "mean_mentions"), F.count_if(F.col("lang") == "en").alias("n_en"), F.countDistinct("source").alias("speakers"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN '1995-01-01' AND '1995-03-31' OR o_orderdate::DATE >= '1998-06-01'")
def f10_date_ranges(t):
    return filters.apply_filters(by_year(t), {"date_ranges": [{"from": "1995-01-01", "to": "1995-03-31"}, {"from": "1998-06-01"}, {}]}).select("o_orderkey")


@query("""SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE upper(source) IN ('SRC1', 'SRC2', 'SRC3', 'SRC4') AND toxic = 0 AND contains(lower(lang), 'e') AND lower(lang) <> 'de'
AND NOT (coalesce(quality, 0) = 0)""")
def f12_f18_metadata_filters(t):
    d = t("documents").join(t("labels"), "doc_id", "left").select("doc_id", F.col("source").alias("party"), F.col("lang").alias("name"), F.col("toxic").alias("interject"), F.col("quality").alias("question"), F.lit(0).alias("answer"))
    return filters.apply_filters(d, {"party": ["src1", "SRC2", "src3", "src4"], "interject": 0, "speaker": "E", "row_type": "exchange", "electorate": "absent"}).where("lower(name) <> 'de'").select("doc_id")


@query("""SELECT o_orderkey FROM orders WHERE (contains(lower(o_orderpriority), 'urgent') AND year(o_orderdate) BETWEEN 1993 AND 1994) OR year(o_orderdate) BETWEEN 1998 AND 2007 AND year(o_orderdate) >= 1998 AND o_orderstatus = 'F' OR o_orderstatus = 'P'""")
def f20_filter_spec(t):
    d = by_year(t).select("o_orderkey", "date", F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("party"), F.lit(None).cast("int").alias("div_flag"))
    some = filters.research_filter(d, [{"type": "speaker_year", "value": {"speaker": "URGENT", "years": [1993, 1994]}}, {"type": "party", "value": "P"}, {"type": "no such", "value": 1}, {"type": "gov_era", "value": "nobody"}])
    late = filters.research_filter(d.where("party = 'F'"), [{"type": "year_range", "value": [1998, 2007]}], floor=0)
    return some.select("o_orderkey").union(late.select("o_orderkey")).distinct()


# counts and series

@query("SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 15")
def a1_topn(t):
    return A.top(t("documents"), ["source"], 15)


@query("""SELECT term, count(*) AS n FROM (SELECT unnest(['the', 'and', 'der', 'que', 'that']) AS term) JOIN documents ON contains(lower(text), term) GROUP BY 1""")
def a2_term_breakdown(t):
    found = ["the", "and", "der", "que", "that"]
    m = t("documents").select(lang.matched_terms(found, F.col("text")).alias("m")).where("m <> ''")
    return m.select(F.explode(F.split("m", " \\| ")).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


@query("""SELECT year(o_orderdate) AS period, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def a4_timeseries(t):
    return A.time_series(t("orders"), F.year("o_orderdate"), "o_orderstatus", ["F", "O", "P"])


@query("""WITH c AS (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders WHERE o_totalprice > 300000 GROUP BY 1)
SELECT s.y, coalesce(n, 0) AS n FROM (SELECT unnest(range(1990, (SELECT max(y) FROM c) + 1)) AS y) s LEFT JOIN c USING (y)""")
def a5_calendar_fill_all(t):
    """A5 over all years."""
    c = t("orders").where("o_totalprice > 300000").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))
    return A.calendar_fill(c, "y", F.lit(1990), F.max("y"), "n")


@query("""SELECT facet, value, count(*) AS n FROM (SELECT 'lang' AS facet, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents UNION ALL SELECT 'toxic', toxic::VARCHAR FROM documents LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'length', CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END FROM documents) WHERE value IS NOT NULL GROUP BY 1, 2""")
def a6_facets(t):
    d = t("documents").join(t("labels"), "doc_id", "left")
    return A.facets(d, {"lang": F.col("lang"), "source": F.col("source"), "toxic": F.col("toxic"), "length": F.when(F.col("n_chars") < 1000, "short").otherwise("long")})


@query("""SELECT p AS parliament, count(*) AS n FROM orders JOIN (VALUES (1, DATE '1992-01-01', DATE '1993-12-31'), (2, DATE '1994-01-01', DATE '1996-06-30'), (3, DATE '2000-01-01', DATE '2001-01-01')) v(p, a, b) ON o_orderdate::DATE BETWEEN a AND b GROUP BY 1""")
def a7_counts_by_range(t):
    ranges = [(1, "1992-01-01", "1993-12-31"), (2, "1994-01-01", "1996-06-30"), (3, "2000-01-01", "2001-01-01")]
    p = S.first_of([(F.col("date").between(F.lit(a).cast("date"), F.lit(b).cast("date")), F.lit(i)) for i, a, b in ranges])
    return by_year(t).withColumn("parliament", p).where("parliament IS NOT NULL").groupBy("parliament").agg(F.count("*").alias("n"))


@query("SELECT lang, array_to_string(list_sort(list(DISTINCT source)), ',') AS members, min(n_chars) AS least, max(n_chars) AS most, count(DISTINCT source) AS n_members, count(*) AS n FROM documents GROUP BY 1")
def a8_a10_sets_and_ranges(t):
    return R.sets_and_ranges(t("documents"), ["lang"], "source", "n_chars")


@query("""SELECT lang, count(*) FILTER (WHERE toxic = 0) AS "0", count(*) FILTER (WHERE toxic = 1) AS "1" FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def a13_crosstab(t):
    return A.crosstab(t("documents").join(t("labels"), "doc_id"), "lang", "toxic", [0, 1])


@query("SELECT year(o_orderdate) AS year, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct, count(*) AS n FROM orders GROUP BY 1")
def a14_rate_by_period(t):
    return A.share(by_year(t), ["year"], F.col("o_orderstatus") == "F").withColumn("pct", F.round("pct", 4))


@query("SELECT c_mktsegment, o_orderpriority, n, round(100.0 * n / sum(n) OVER (PARTITION BY c_mktsegment), 4) AS pct FROM (SELECT c_mktsegment, o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)")
def a15_row_pct(t):
    d = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return A.row_percentages(d, "c_mktsegment", "o_orderpriority").withColumn("pct", F.round("pct", 4))


WORDS_SQL = "CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) END"


@query(f"SELECT lang, sum(w)::BIGINT AS words, round(avg(w), 4) AS mean_words, median(w)::DOUBLE AS median_words FROM (SELECT lang, {WORDS_SQL} AS w FROM documents) GROUP BY 1")
def a17_words(t):
    d = t("documents").withColumn("w", S.word_count(F.col("text")))
    return d.groupBy("lang").agg(F.sum("w").alias("words"), r4(F.avg("w"), "mean_words"), F.median("w").alias("median_words"))


@query("""SELECT o_custkey, arg_max(o_orderpriority, (n, -r)) AS mode FROM (SELECT *, rank() OVER (ORDER BY o_orderpriority) AS r FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)) GROUP BY 1""")
def a18_mode(t):
    return t("orders").groupBy("o_custkey").agg(A.mode("o_orderpriority").alias("mode"))


@query("""SELECT label, count(*) AS n FROM (SELECT CASE WHEN f > 0 AND o > 0 THEN 'Both (' || f || '/' || o || ')' WHEN f > 0 THEN 'Closed' ELSE 'Open' END AS label FROM
(SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus <> 'F') AS o FROM orders GROUP BY 1)) GROUP BY 1""")
def a19_conditional_label(t):
    return R.conditional_label(t("orders"), ["o_custkey"], F.col("o_orderstatus") == "F").groupBy("label").agg(F.count("*").alias("n"))


@query(f"""WITH d AS (SELECT *, {WORDS_SQL} AS w, CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END AS size FROM documents LEFT JOIN labels USING (doc_id)), m AS (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS r FROM d GROUP BY 1, 2), s AS (SELECT source, size, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, size) AS r FROM d GROUP BY 1, 2)
SELECT d.source, count(*) AS turns, any_value(m.lang) AS party, any_value(s.size) AS gender, max(coalesce(toxic, 0))::BIGINT AS first_speech, count(*) FILTER (WHERE quality = 1) AS questions, count(*) FILTER (WHERE toxic = 1) AS interjections, count(DISTINCT d.lang) AS days, sum(w)::BIGINT AS words, round(avg(w), 4) AS mean_words
FROM d JOIN m ON m.source = d.source AND m.r = 1 JOIN s ON s.source = d.source AND s.r = 1 GROUP BY 1 ORDER BY turns DESC, d.source LIMIT 40""")
def a20_speaker_table(t):
    d = t("documents").join(t("labels"), "doc_id", "left").select("source", "text", F.col("lang").alias("party"), F.when(F.col("n_chars") > 2000, "long").otherwise("short").alias("gender"), F.col("toxic").alias("first_speech"), F.col("quality").alias("question"), F.col("toxic").alias("interject"), F.col("lang").alias("day"))
    return A.speaker_table(d, "source", S.word_count(F.col("text")), "day").withColumn("mean_words", F.round("mean_words", 4))


@query("""SELECT o_custkey, year AS peak, n AS peak_n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, year) AS r FROM (SELECT o_custkey, year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE r = 1""")
def a21_peak(t):
    return A.most_frequent(by_year(t), ["o_custkey"], "year", "peak")


@query("""SELECT doc_id, round(least(n_chars::DOUBLE, (SELECT quantile_cont(n_chars, 0.99) FROM documents)), 4) AS clipped FROM documents""")
def a23_quantile_clip(t):
    return A.clipped(t("documents"), "n_chars").select("doc_id", r4(F.col("clipped"), "clipped"))


@query("SELECT lang, quantile_cont(n_chars, 0.0)::DOUBLE AS low, quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.5) AS median, quantile_cont(n_chars, 0.75) AS q3, quantile_cont(n_chars, 1.0)::DOUBLE AS high FROM documents GROUP BY 1")
def a23_box(t):
    return A.box(t("documents"), ["lang"], "n_chars")


@query("""SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.75), 4) AS p75, round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.99), 4) AS p99,
round(avg(CASE WHEN user_id % 10 = 0 THEN 1.0 ELSE 0.0 END), 4) AS error_rate, round(avg(CASE WHEN value > 60 THEN 1.0 ELSE 0.0 END), 4) AS degraded_rate FROM events GROUP BY 1""")
def a25_latency_stats(t):
    d = A.latency(t("events"), ["event_type"], "value", F.col("user_id") % 10 == 0, 60.0)
    return d.select("event_type", "n", *(r4(F.col(c), c) for c in ("p50", "p75", "p95", "p99", "error_rate", "degraded_rate")))


@query("""SELECT event_type, CASE WHEN grade = '' THEN 'PASS' ELSE 'FAIL: ' || grade END AS grade FROM (SELECT event_type, concat_ws(',', CASE WHEN quantile_cont(value, 0.5) >= 40 THEN 'p50' END, CASE WHEN quantile_cont(value, 0.95) >= 90 THEN 'p95' END, CASE WHEN avg(CASE WHEN user_id % 10 = 0 THEN 1.0 ELSE 0.0 END) >= 0.1 THEN 'error_rate' END) AS grade FROM events GROUP BY 1)""")
def a25_graded(t):
    d = A.latency(t("events"), ["event_type"], "value", F.col("user_id") % 10 == 0, 60.0)
    return A.graded(d, {"p50": 40, "p95": 90, "error_rate": 0.1}).select("event_type", "grade")


@query("""WITH r AS (SELECT value, row_number() OVER (ORDER BY ts, event_id) AS i, count(*) OVER () AS n FROM events)
SELECT round(avg(value) FILTER (WHERE i <= greatest(1, n // 10)), 4) AS "first", round(avg(value) FILTER (WHERE i > n - greatest(1, n // 10)), 4) AS "last" FROM r""")
def a25_drift(t):
    return A.drift(t("events"), ["ts", "event_id"], "value").select(r4(F.col("first"), "first"), r4(F.col("last"), "last"))


@query("""SELECT c_mktsegment, round(sum((2 * i - m - 1) * n)::DOUBLE / sum(n * m), 6) AS gini FROM (SELECT c_mktsegment, n, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n) AS i, count(*) OVER (PARTITION BY c_mktsegment) AS m FROM
(SELECT c_mktsegment, o_custkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)) GROUP BY 1""")
def a26_gini(t):
    n = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "o_custkey").agg(F.count("*").alias("n"))
    return A.gini(n, ["c_mktsegment"], "n").withColumn("gini", F.round("gini", 6))


@query("""SELECT c_mktsegment, round(sum(n) FILTER (WHERE r <= 5)::DOUBLE / sum(n), 6) AS top_share FROM (SELECT c_mktsegment, n, row_number() OVER (PARTITION BY c_mktsegment ORDER BY n DESC, o_custkey) AS r FROM
(SELECT c_mktsegment, o_custkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)) GROUP BY 1""")
def a27_top5_share(t):
    n = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "o_custkey").agg(F.count("*").alias("n"))
    return A.top_share(n, ["c_mktsegment"], "n", ties=("o_custkey",)).withColumn("top_share", F.round("top_share", 6))


@query("""SELECT year, n, round(10000.0 * n / total, 4) AS rate FROM (SELECT year(o_orderdate) AS year, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n, count(*) AS total FROM orders GROUP BY 1) WHERE n > 0""")
def a28_rate_per_10k(t):
    o = by_year(t)
    n = o.where("o_orderpriority = '1-URGENT'").groupBy("year").agg(F.count("*").alias("n"))
    return A.rate(n, o.groupBy("year").agg(F.count("*").alias("total")), "year", "n", "total").select("year", "n", r4(F.col("rate"), "rate"))


@query("""SELECT year, c_mktsegment, round(n::DOUBLE / sum(n) OVER (PARTITION BY c_mktsegment), 6) AS share FROM (SELECT year(o_orderdate) AS year, c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)""")
def a29_heatmap(t):
    d = by_year(t).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return A.row_percentages(d, "c_mktsegment", "year").select("year", "c_mktsegment", F.round(F.col("pct") / 100, 6).alias("share"))


@query("""WITH o AS (SELECT o_custkey AS period, o_orderpriority AS name, o_orderstatus AS side FROM orders), c AS (SELECT period, count(*) AS n FROM o GROUP BY 1), s AS (SELECT period, n, (SELECT avg(n) FROM c) AS m FROM c WHERE n > 2 * (SELECT avg(n) FROM c)),
k AS (SELECT period, name, side, count(*) AS k, row_number() OVER (PARTITION BY period ORDER BY count(*) DESC, name, side) AS r FROM o WHERE name <> '5-LOW' GROUP BY 1, 2, 3)
SELECT s.period, any_value(n) AS n, round(any_value(m), 1) AS mean, round(any_value(n) / any_value(m), 1) AS ratio, coalesce(string_agg(name || ' (' || side || '): ' || k, '; ' ORDER BY r), '') AS speakers FROM s LEFT JOIN k ON k.period = s.period AND r <= 3 GROUP BY 1""")
def a30_spikes(t):
    """A30 with the first speakers: customers are periods, priorities speakers."""
    d = t("orders").select(F.col("o_custkey").alias("period"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("side"))
    return R.spikes(d, "period", "name", "side", F.col("name") == "5-LOW")


@query("""SELECT o_custkey, string_agg(y || '(' || n || ')', ' ' ORDER BY y) AS series, sum(n)::BIGINT AS n FROM (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""")
def a31_compact_strings(t):
    return A.compact(by_year(t), ["o_custkey"], "year")


@query("""WITH top AS (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 6) SELECT o_custkey, string_agg(y || '(' || n || ')', ' ' ORDER BY y) AS series, sum(n)::BIGINT AS n FROM (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders JOIN top USING (o_custkey) GROUP BY 1, 2) GROUP BY 1""")
def a32_top_matrix(t):
    return A.compact(A.of_top(by_year(t), "o_custkey", 6), ["o_custkey"], "year")


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_o_orderstatus, count(DISTINCT o_orderpriority) AS n_o_orderpriority FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1 OR count(DISTINCT o_orderpriority) > 1")
def a34_multiplicity(t):
    return A.several(t("orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"])


@query("""SELECT source, string_agg(lang, ',' ORDER BY lang) AS kept FROM (SELECT source, lang, count(*) AS n, sum(count(*)) OVER (PARTITION BY source) AS m FROM documents GROUP BY 1, 2) WHERE n >= 0.10 * m GROUP BY 1""")
def a35_share_threshold(t):
    return A.frequent_values(t("documents"), "source", "lang")


@query("""SELECT c_nationkey, name AS common, n AS common_n FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, name) AS r FROM (SELECT c_nationkey, regexp_replace(c_mktsegment || ' (' || c_custkey || ')', '\\s*\\([^)]*\\)$', '') AS name, count(*) AS n FROM customer GROUP BY 1, 2)) WHERE r = 1""")
def a36_common_name(t):
    name = F.regexp_replace(F.concat("c_mktsegment", F.lit(" ("), F.col("c_custkey").cast("string"), F.lit(")")), r"\s*\([^)]*\)$", "")
    return A.most_frequent(t("customer").withColumn("name", name), ["c_nationkey"], "name", "common")


@query("""SELECT n_regionkey, string_agg(n_name || ':' || members, ';' ORDER BY n_name) AS tree FROM (SELECT n_regionkey, n_name, string_agg(s_name, ',' ORDER BY s_name) AS members FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2) GROUP BY 1""")
def a37_nested(t):
    return R.nested(t("nation").join(t("supplier"), F.col("s_nationkey") == F.col("n_nationkey")), "n_regionkey", "n_name", "s_name")


PARLIAMENT_SQL = "CASE WHEN y <= 1999 THEN 39 WHEN y <= 2001 THEN 40 WHEN y <= 2004 THEN 41 ELSE 42 END"


@query(f"""SELECT p AS parliament, min(d) AS first_day, max(d) AS last_day, count(DISTINCT o_custkey) AS members FROM (SELECT *, {PARLIAMENT_SQL} AS p FROM (SELECT o_custkey, o_orderdate::DATE AS d, year(o_orderdate) + 4 AS y FROM orders)) GROUP BY 1""")
def a39_range_minmax(t):
    """P16, A38, A39."""
    return by_year(t).groupBy(S.parliament(F.col("year") + 4).alias("parliament")).agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.countDistinct("o_custkey").alias("members"))


@query("""SELECT c_mktsegment AS topic, string_agg(DISTINCT strftime(o_orderdate, '%Y-%m'), ',' ORDER BY strftime(o_orderdate, '%Y-%m')) AS months FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 400000 GROUP BY 1""")
def a40_topic_dates(t):
    d = t("orders").where("o_totalprice > 400000").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return R.topic_months(d.withColumnRenamed("c_mktsegment", "topic"), "topic", "o_orderdate")


@query("""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM documents) WHERE word NOT IN ('that', 'this') GROUP BY 1 ORDER BY n DESC, word LIMIT 50""")
def a41_bow(t):
    return A.words(t("documents"), "text", "[a-z]{4,}", ("that", "this"), 50)


SEED_STOP_SQL = ", ".join(f"'{x}'" for x in A.SEED_STOP)


@query(f"""WITH d AS (SELECT row_number() OVER (ORDER BY doc_id, text) AS o, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), lambda x: regexp_full_match(x, '[a-z]{{4,}}')) AS w
FROM (SELECT doc_id, text FROM documents WHERE (contains(lower(text), 'the') OR contains(lower(text), 'and')) AND contains(lower(text), 'that') ORDER BY doc_id, text LIMIT 100)),
l AS (SELECT o, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS a FROM d), p AS (SELECT *, lead(a) OVER (ORDER BY o, i) AS b FROM l),
g AS (SELECT 0 AS kind, a || ' ' || b AS seed, o, i FROM p WHERE a NOT IN ({SEED_STOP_SQL}) AND b NOT IN ({SEED_STOP_SQL}) UNION ALL SELECT 1, a, o, i FROM p WHERE length(a) >= 5 AND a NOT IN ({SEED_STOP_SQL})),
c AS (SELECT kind, seed, count(*) AS n, row_number() OVER (PARTITION BY kind ORDER BY count(*) DESC, min((o, i))) AS r FROM g GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY kind, r) AS position, seed, n FROM c WHERE kind = 1 OR r <= 15 QUALIFY row_number() OVER (ORDER BY kind, r) <= 20""")
def a42_seeds_search(t):
    """A42 over all matches of a search; the first hundred are the operator's own limit."""
    matched = t("documents").where(lang.compile_tree(lang.parse("('the' | 'and') & 'that'"), F.col("text")))
    return A.seeds(matched, "text", "doc_id")


@query("""SELECT trim(string_split(trim(text), chr(10))[1]) AS heading, count(*) AS n FROM conversations WHERE role = 'system' AND NOT regexp_matches(lower(text), 'adjourned|resumed|suspended') GROUP BY 1""")
def a43_headings(t):
    d = turns(t).where("role = 'system'").where(~F.col("body").rlike(W.HEADING_SKIP))
    return d.groupBy(F.trim(F.split_part(F.trim("body"), F.lit("\n"), F.lit(1))).alias("heading")).agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT ts::DATE AS day, count(*) AS n, count(DISTINCT user_id) AS users, count(*) FILTER (WHERE event_type = 'click') AS hits, round(100.0 * avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END), 4) AS hit_pct FROM events GROUP BY 1),
s AS (SELECT unnest(range((SELECT max(day) FROM c) - INTERVAL 89 DAY, (SELECT max(day) FROM c) + INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE AS day)
SELECT day, coalesce(n, 0) AS n, coalesce(users, 0) AS users, coalesce(hits, 0) AS hits, coalesce(hit_pct, 0) AS hit_pct FROM s LEFT JOIN c USING (day)""")
def a44_usage(t):
    return R.usage(t("events"), F.to_date("ts"), "user_id", F.col("event_type") == "click").withColumn("hit_pct", F.round("hit_pct", 4))


@query("""WITH e AS (SELECT user_id, ts, event_type, json_extract_string(props, '$.k')::BIGINT AS k FROM events), c AS (SELECT user_id, code, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, code) AS r FROM
(SELECT user_id, unnest([event_type, 'k' || (k % 3)]) AS code FROM e WHERE k IS NOT NULL) GROUP BY 1, 2), i AS (SELECT user_id, string_agg(code || ':' || n, ',' ORDER BY r) AS issues FROM c WHERE r <= 3 GROUP BY 1)
SELECT e.user_id, count(*) FILTER (WHERE k % 2 = 0) AS good, count(*) FILTER (WHERE NOT (k % 2 = 0)) AS bad, min(ts) AS first_seen, max(ts) AS last_seen, coalesce(any_value(issues), '') AS issues FROM e LEFT JOIN i USING (user_id) GROUP BY 1""")
def a45_feedback(t):
    """Notes of users with issue codes; the three commonest codes of each."""
    d = t("events").withColumn("k", F.get_json_object("props", "$.k").try_cast("long"))
    codes = F.when(F.col("k").isNotNull(), F.array("event_type", F.concat(F.lit("k"), (F.col("k") % 3).cast("string"))))
    return R.feedback(d, ["user_id"], F.col("k") % 2 == 0, "ts", codes)


A48 = """a AS (SELECT o_orderdate::DATE AS date, o_custkey AS who, o_orderkey % 10 AS w, o_orderpriority AS p FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_orderdate::DATE AS date, o_custkey AS who, o_orderkey % 10 AS w, o_orderpriority AS p FROM orders WHERE o_orderstatus <> 'F'),
s AS (SELECT greatest(min(a.date), (SELECT min(date) FROM b)) AS lo, least(max(a.date), (SELECT max(date) FROM b)) AS hi FROM a), x AS (SELECT a.* FROM a, s WHERE date BETWEEN lo AND hi), y AS (SELECT b.* FROM b, s WHERE date BETWEEN lo AND hi),
r AS (SELECT m.n::DOUBLE / k.n AS r FROM (SELECT date, count(DISTINCT who) AS n FROM x GROUP BY 1) m JOIN (SELECT date, count(DISTINCT who) AS n FROM y GROUP BY 1) k USING (date))"""


@query(f"""WITH {A48} SELECT 'complete' AS what, 'p' AS key, (SELECT round(100.0 * count(CASE WHEN p <> '5-LOW' THEN p END) / count(*), 4)::DOUBLE FROM a) AS a, (SELECT round(100.0 * count(CASE WHEN p <> '5-LOW' THEN p END) / count(*), 4)::DOUBLE FROM b) AS b
UNION ALL SELECT 'words', v.y::VARCHAR, v.n, u.n FROM (SELECT year(date) AS y, sum(w)::DOUBLE AS n FROM x GROUP BY 1) v JOIN (SELECT year(date) AS y, sum(w)::DOUBLE AS n FROM y GROUP BY 1) u USING (y)
UNION ALL SELECT 'interjections', 'pct', (SELECT round(100 * avg(CASE WHEN p = '1-URGENT' THEN 1.0 ELSE 0.0 END), 4) FROM x), (SELECT round(100 * avg(CASE WHEN p = '1-URGENT' THEN 1.0 ELSE 0.0 END), 4) FROM y)
UNION ALL SELECT 'speakers', unnest(['mean', 'p5', 'median', 'p95']), unnest([round(avg(r), 4), round(quantile_cont(r, 0.05), 4), round(quantile_cont(r, 0.5), 4), round(quantile_cont(r, 0.95), 4)]), NULL FROM r""")
def a48_compare(t):
    """Closed and other orders as two corpora, customers as speakers."""
    d = by_year(t).select("date", "o_orderstatus", F.col("o_custkey").alias("who"), (F.col("o_orderkey") % 10).alias("w"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("p"))
    closed = F.col("o_orderstatus") == "F"
    return R.compare(d.where(closed), d.where(~closed), F.col("w"), "who", F.coalesce(F.col("p") == "1-URGENT", F.lit(False)), ["p"])


@query("""SELECT c.year, a, b, round(a::DOUBLE / b, 6) AS ratio FROM (SELECT year(o_orderdate) AS year, count(*) AS a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) c JOIN (SELECT year(o_orderdate) AS year, count(*) AS b FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) d USING (year)""")
def j15_ratio_by_year(t):
    o = by_year(t)
    return R.by_key_ratio(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), "year").withColumn("ratio", F.round("ratio", 6))


@query("SELECT round(100.0 * count(text) / count(*), 4) AS text, round(100.0 * count(toxic) / count(*), 4) AS toxic, round(100.0 * count(quality) / count(*), 4) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def p39_completeness(t):
    return R.completeness(t("documents").join(t("labels"), "doc_id", "left"), ["text", "toxic", "quality"])


@query("""SELECT side, lang, round(100.0 * n / greatest(sum(n) OVER (PARTITION BY side), 1), 4) AS pct FROM (SELECT CASE WHEN toxic = 1 THEN 'gov' ELSE 'opp' END AS side, lang, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2)""")
def a50_side_shares(t):
    d = t("documents").join(t("labels"), "doc_id").withColumn("side", F.when(F.col("toxic") == 1, "gov").otherwise("opp"))
    return A.row_percentages(d, "side", "lang").select("side", "lang", r4(F.col("pct"), "pct"))


@query("""WITH top AS (SELECT source FROM documents GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 6), c AS (SELECT source, doc_id // 100 AS y, count(*) AS n FROM documents JOIN top USING (source) GROUP BY 1, 2)
SELECT source, y, n, round(avg(n) OVER (PARTITION BY source ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 4) AS rolling FROM c""")
def a53_top6_rolling(t):
    d = A.of_top(t("documents"), "source", 6).withColumn("y", F.floor(F.col("doc_id") / 100)).groupBy("source", "y").agg(F.count("*").alias("n"))
    return W.rolling_mean(d, "n", "y", 1, ["source"]).withColumn("rolling", F.round("rolling", 4))


@query("""WITH c AS (SELECT *, coalesce(text, '') AS body, contains(lower(coalesce(text, '')), 'the') AS m FROM conversations)
SELECT conv_id, count(*) AS turns, coalesce(arg_min(body, turn) FILTER (WHERE role = 'user'), arg_min(body, turn)) AS question, coalesce(arg_min(body, turn) FILTER (WHERE role = 'assistant'), arg_max(body, turn)) AS answer, string_agg(role || ': ' || body, chr(10) ORDER BY turn) AS transcript,
CASE WHEN bool_or(role = 'user' AND m) AND bool_or(role = 'assistant' AND m) THEN 'both' WHEN bool_or(role = 'user' AND m) THEN 'question' WHEN bool_or(role = 'assistant' AND m) THEN 'answer' ELSE '' END AS org_mentioned_in FROM c GROUP BY 1""")
def a55_exchange_assembly(t):
    d = turns(t).withColumn("match_source", F.when(F.contains(F.lower("body"), F.lit("the")), "search").otherwise("context"))
    return R.assembled(d, "conv_id", "order", F.col("role") == "user", F.col("role") == "assistant", F.concat("role", F.lit(": "), "body"), "body", "match_source")


# windows

@query("""WITH c AS (SELECT conv_id, turn, role, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER w AS s, max(CASE WHEN role <> 'assistant' THEN turn END) OVER w AS last_mark FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT c.conv_id, c.turn AS "order", CASE WHEN m.role = 'user' THEN s::BIGINT END AS speech_no FROM c LEFT JOIN conversations m ON m.conv_id = c.conv_id AND m.turn = c.last_mark""")
def w2_speech_no(t):
    kind = F.when(F.col("role") == "user", "speech").when(F.col("role") == "system", "stage_direction").otherwise("interjection")
    return W.speech_numbers(turns(t), kind, ["conv_id"], "order").select("conv_id", "order", "speech_no")


@query("""SELECT conv_id, turn AS "order", CASE WHEN row_number() OVER w = 1 THEN 0 WHEN role = 'system' THEN 0 WHEN role <> first_value(role) OVER w THEN 1 ELSE 0 END::BIGINT AS interject FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def w3_interject(t):
    d = turns(t).withColumn("name_id", F.when(F.col("role") == "system", "10000").otherwise(F.col("role")))
    return W.interjections(d, ["conv_id"], "order").select("conv_id", "order", "interject")


@query("""SELECT conv_id, turn AS "order", coalesce(last_value(CASE WHEN role = 'user' AND NOT regexp_matches(text, '(?i)adjourned|resumed|suspended') AND text <> '' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS debate_heading FROM conversations""")
def w4_heading(t):
    return W.headings(turns(t), F.col("role") == "user", F.col("body"), ["conv_id"], "order").select("conv_id", "order", "debate_heading")


@query("""SELECT conv_id, turn AS "order", coalesce(string_agg(role || ': ' || length(text), ' ¶ ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS context_before,
coalesce(string_agg(role || ': ' || length(text), ' ¶ ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), '') AS context_after FROM conversations""")
def w5_context(t):
    line = F.concat("role", F.lit(": "), F.length("body").cast("string"))
    return W.context(turns(t), line, ["conv_id"], "order").select("conv_id", "order", "context_before", "context_after")


@query("""WITH c AS (SELECT conv_id, turn, role = 'user' AS q, role = 'assistant' AS a, contains(lower(coalesce(text, '')), 'th') AND length(coalesce(text, '')) % 2 = 0 AS m FROM conversations),
p AS (SELECT *, max(CASE WHEN q THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pq, min(CASE WHEN a THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS na FROM c),
qa AS (SELECT conv_id, na AS turn, max(turn) AS x FROM p WHERE m AND q AND na IS NOT NULL GROUP BY 1, 2), aq AS (SELECT DISTINCT conv_id, pq AS turn FROM p WHERE m AND a AND pq IS NOT NULL)
SELECT conv_id, turn AS "order", 'search' AS match_source, CASE WHEN q THEN turn WHEN a THEN pq END AS exchange_order FROM p WHERE m
UNION ALL SELECT p.conv_id, p.turn, 'question_answer', x FROM p JOIN qa ON p.conv_id = qa.conv_id AND p.turn = qa.turn WHERE NOT m
UNION ALL SELECT p.conv_id, p.turn, 'answer_question', p.turn FROM p JOIN aq ON p.conv_id = aq.conv_id AND p.turn = aq.turn WHERE NOT m""")
def w6_exchange(t):
    d = turns(t)
    matched = F.contains(F.lower("body"), F.lit("th")) & (F.length("body") % 2 == 0)
    return W.exchanges(d, matched, F.col("role") == "user", F.col("role") == "assistant", ["conv_id"], "order").select("conv_id", "order", "match_source", "exchange_order")


@query("""SELECT conv_id, turn AS "order", last_value(CASE WHEN length(text) % 3 = 0 THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS page FROM conversations""")
def w7_ffill(t):
    d = turns(t).withColumn("page", F.when(F.length("body") % 3 == 0, F.length("body")))
    return W.fill_forward(d, "page", ["conv_id"], "order").select("conv_id", "order", "page")


@query("""WITH c AS (SELECT conv_id, turn, role, CASE WHEN length(text) % 3 = 0 THEN length(text) END AS page FROM conversations)
SELECT conv_id, turn AS "order", coalesce(last_value(page IGNORE NULLS) OVER (PARTITION BY conv_id, role ORDER BY turn), first_value(page IGNORE NULLS) OVER (PARTITION BY conv_id, role ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS page FROM c""")
def w8_fill_both(t):
    d = turns(t).withColumn("page", F.when(F.length("body") % 3 == 0, F.length("body")))
    return W.fill_both(d, "page", ["conv_id", "role"], "order").select("conv_id", "order", "page")


@query("""SELECT user_id, event_id FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) WHERE event_type = b""")
def w9_consecutive_dups(t):
    d = t("events").withColumn("at", F.struct("ts", "event_id"))
    return W.consecutive_duplicates(d, "event_type", ["user_id"], "at").select("user_id", "event_id")


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN (hour(ts) * 60 + minute(ts))::DOUBLE END AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
l AS (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM e),
u AS (SELECT user_id, event_id, i, t + 1440 * sum(CASE WHEN t < b - 30 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i) AS t FROM l),
k AS (SELECT *, max(CASE WHEN t IS NOT NULL THEN i END) OVER (PARTITION BY user_id ORDER BY i) AS pi, min(CASE WHEN t IS NOT NULL THEN i END) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni FROM u)
SELECT k.user_id, k.event_id, k.t IS NULL AND coalesce(p.t, n.t) IS NOT NULL AS time_est, round(CASE WHEN k.t IS NOT NULL THEN k.t WHEN p.t IS NOT NULL AND n.t IS NOT NULL THEN p.t + (k.i - k.pi) * (n.t - p.t) / (k.ni - k.pi) ELSE coalesce(p.t, n.t) END, 3) AS minutes
FROM k LEFT JOIN u p ON p.user_id = k.user_id AND p.i = k.pi LEFT JOIN u n ON n.user_id = k.user_id AND n.i = k.ni""")
def w10_w11_interpolate(t):
    d = t("events").withColumn("minutes", F.when(F.col("event_id") % 3 == 0, S.minutes(F.date_format("ts", "HH:mm"))))
    d = W.interpolate(W.unwrap_midnight(d, "minutes", ["user_id"], "event_id"), "minutes", ["user_id"], "event_id")
    return d.select("user_id", "event_id", "time_est", F.round("minutes", 3).alias("minutes"))


@query("SELECT year, n, round(avg(n) OVER (ORDER BY year ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 4) AS rolling FROM (SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1)")
def w12_rolling(t):
    return W.rolling_mean(by_year(t).groupBy("year").agg(F.count("*").alias("n")), "n", "year", 2).withColumn("rolling", F.round("rolling", 4))


@query("SELECT DISTINCT day, event_type FROM (SELECT ts::DATE AS day, event_type, row_number() OVER (PARTITION BY ts::DATE ORDER BY ts, event_id) AS r FROM events) WHERE r <= 5")
def w13_rank5(t):
    d = t("events").withColumn("day", F.to_date("ts"))
    return W.first_rows(d, ["day"], ["ts", "event_id"], 5).select("day", "event_type").distinct()


@query("""WITH t AS (SELECT o_custkey AS k, o_orderkey AS id, o_orderdate::DATE AS d, o_orderpriority <> '5-LOW' AS sub, o_totalprice > 450000 AS said, o_orderstatus <> 'P' AS known FROM orders),
f AS (SELECT k, d + 30 AS a, lag(CASE WHEN known THEN d + 60 END) OVER w AS e, row_number() OVER w AS i FROM t WINDOW w AS (PARTITION BY k ORDER BY d + 30, CASE WHEN known THEN d + 60 END NULLS FIRST)),
g AS (SELECT k, a, bool_or(i = 1) AS one FROM f WHERE i = 1 OR a - e > 180 GROUP BY 1, 2), h AS (SELECT * FROM g WHERE NOT one OR k NOT IN (SELECT k FROM t WHERE said)),
m AS (SELECT h.k, a, id, row_number() OVER (PARTITION BY h.k, a ORDER BY CASE WHEN d >= a THEN 0 ELSE 1 END, d, id) AS r FROM h JOIN t ON t.k = h.k AND sub AND (d >= a OR one))
SELECT k AS o_custkey, a AS start, id AS turn_id FROM m WHERE r = 1""")
def w14_first_event_all(t):
    """Every order is a turn and, a month later, an entry; spells of pending orders have no known end, low ones aren't substantive, very dear ones are flagged already."""
    o = by_year(t)
    entries = o.select("o_custkey", F.date_add("date", 30).alias("start"), F.when(F.col("o_orderstatus") != "P", F.date_add("date", 60)).alias("end"))
    said = o.select("o_custkey", "date", F.col("o_orderkey").alias("turn_id"), (F.col("o_orderpriority") != "5-LOW").alias("substantive"), F.when(F.col("o_totalprice") > 450000, 1).otherwise(0).alias("first_speech"))
    return W.first_events(entries, said, "o_custkey").select("o_custkey", "start", "turn_id")


@query("SELECT source, doc_id AS first_doc, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents WHERE contains(text, 'the')) WHERE r = 1")
def w15_first_mention(t):
    return R.first_mentions(t("documents").where(F.contains("text", F.lit("the"))), "source", "doc_id", ["n_chars"]).select("source", F.col("doc_id").alias("first_doc"), "n_chars")


@query("""WITH y AS (SELECT year, row_number() OVER (ORDER BY year) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT year(o_orderdate) AS year FROM orders)), t AS (SELECT year, greatest(1, 100 // n) + CASE WHEN 100 >= n AND k <= 100 % n THEN 1 ELSE 0 END AS take FROM y),
r AS (SELECT o_orderkey, year(o_orderdate) AS year, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) SELECT o_orderkey, year FROM r JOIN t USING (year) WHERE r <= take""")
def w18_broad_sample(t):
    return L.broad(by_year(t), "year", F.col("o_totalprice"), "o_orderkey", 100).select("o_orderkey", "year")


@query("""WITH o AS (SELECT o_orderkey, o_orderpriority AS v, o_orderdate::DATE AS d, o_totalprice AS s, year(o_orderdate) AS y FROM orders), c AS (SELECT y, greatest(1, round_even(100.0::DOUBLE * count(*) / (SELECT count(*) FROM o), 0)) AS slots FROM o GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY y, v ORDER BY s DESC, o_orderkey) AS rd, max(s) OVER (PARTITION BY y, v) AS b FROM o), e AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY rd, b DESC, v, o_orderkey) AS p, row_number() OVER (ORDER BY d, o_orderkey) AS f FROM r),
k AS (SELECT o_orderkey, e.y, v, row_number() OVER (PARTITION BY v ORDER BY d, o_orderkey) AS i, count(*) OVER () AS n FROM e JOIN c ON e.y = c.y WHERE p <= slots OR f = 1)
SELECT o_orderkey, y AS year FROM k WHERE i <= greatest(3, round_even(0.15::DOUBLE * n, 0))""")
def w19_budget_whole(t):
    """W19 with the first mention and the cap of each speaker."""
    return L.budget_whole(by_year(t), "year", "o_orderpriority", "o_totalprice", "o_orderkey", "date", 100).select("o_orderkey", "year")


@query("""WITH o AS (SELECT doc_id AS k, coalesce(source, '') AS v, lang AS y, n_chars AS s, length(text) // 4 AS t FROM documents), a AS (SELECT least(200, greatest(1, CAST(floor(100000 / greatest(sum(t)::DOUBLE / count(*), 1)) AS BIGINT))) AS slots, sum(t) <= 100000 AND count(*) <= 200 AS fits FROM o),
c AS (SELECT y, greatest(1, round_even(any_value(slots)::DOUBLE * count(*) / (SELECT count(*) FROM o), 0)) AS n FROM o, a GROUP BY 1), r AS (SELECT *, row_number() OVER (PARTITION BY y, v ORDER BY s DESC, k) AS rd, max(s) OVER (PARTITION BY y, v) AS b FROM o),
e AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY rd, b DESC, v, k) AS p, row_number() OVER (ORDER BY k) AS f FROM r), w AS (SELECT k, v, row_number() OVER (PARTITION BY v ORDER BY k) AS i, count(*) OVER () AS m FROM e JOIN c ON e.y = c.y WHERE p <= c.n OR f = 1)
SELECT k AS doc_id FROM w WHERE i <= greatest(3, round_even(0.15::DOUBLE * m, 0)) AND NOT (SELECT fits FROM a) UNION ALL SELECT k FROM o WHERE (SELECT fits FROM a)""")
def w19_token_budget(t):
    """W19 under a budget of tokens: languages are periods, sources speakers, lengths scores."""
    d = t("documents").withColumn("speaker", F.coalesce("source", F.lit(""))).withColumn("at", F.col("doc_id"))
    return L.affordable(d, "text", "lang", "speaker", "n_chars", "doc_id", "at", 100_000, 200).select("doc_id")


@query("""SELECT party, date, turn_id, position, CAST(ceil(position / 25.0) AS BIGINT) AS page FROM (SELECT *, row_number() OVER (ORDER BY party DESC NULLS LAST, date DESC NULLS LAST, turn_id) AS position FROM
(SELECT o_orderkey AS turn_id, o_orderdate::DATE AS date, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS party FROM orders)) WHERE turn_id IN (SELECT max(o_orderkey) FROM orders GROUP BY o_orderstatus = 'P')""")
def w20_find_page(t):
    """Of a turn with and of one without a party, in falling order."""
    o = by_year(t).select(F.col("o_orderkey").alias("turn_id"), "date", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("party"))
    ids = [r[0] for r in t("orders").groupBy(F.col("o_orderstatus") == "P").agg(F.max("o_orderkey")).select("max(o_orderkey)").collect()]  # two rows
    names = L.sort_names("party", o.columns)
    found = [L.position(o, names, F.col("turn_id") == i, 25, descending=True) for i in ids]
    return reduce(DataFrame.unionByName, found)


@query("SELECT source, dense_rank() OVER (ORDER BY f) AS citation FROM (SELECT source, min(doc_id) AS f FROM documents GROUP BY 1)")
def w21_citations(t):
    return R.citation_numbers(t("documents"), "source", "doc_id")


# joins

@query("""SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END, first) AS c_mktsegment FROM customer LEFT JOIN (SELECT c_nationkey, arg_min(c_mktsegment, c_custkey) AS first FROM customer GROUP BY 1) USING (c_nationkey)""")
def j1_fill(t):
    c = t("customer")
    holes = c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")))
    return J.fill_from(holes, c.withColumn("ordinal", F.col("c_custkey")), "c_nationkey", ["c_mktsegment"], "ordinal").select("c_custkey", "c_mktsegment")


@query("""WITH f AS (SELECT c_custkey AS v, k, f FROM (SELECT c_custkey, unnest([upper(c_mktsegment) || c_nationkey, 'The ' || c_mktsegment || c_nationkey]) AS k, unnest([0, 1]) AS f FROM customer)),
e AS (SELECT k, arg_min(v, (v, f)) AS v FROM f GROUP BY 1), l AS (SELECT lower(k) AS k, arg_min(v, (v, f)) AS v FROM f GROUP BY 1),
x AS (SELECT o_orderkey, o_orderdate::DATE AS day, CASE WHEN o_orderstatus = 'F' THEN upper(c_mktsegment) || c_nationkey WHEN o_orderstatus = 'O' THEN 'the ' || lower(c_mktsegment) || c_nationkey ELSE 'nobody' END AS name FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (SELECT o_orderkey, day, name, coalesce(e.v, l.v) AS v FROM x LEFT JOIN e ON e.k = name LEFT JOIN l ON l.k = lower(name)),
s AS (SELECT o_custkey AS k, o_orderdate::DATE AS a, o_orderdate::DATE + 60 AS b FROM orders),
g AS (SELECT o_orderkey, bool_or(day BETWEEN a AND b) AS ok FROM m JOIN s ON k = v GROUP BY 1)
SELECT o_orderkey, name, CASE WHEN coalesce(ok, true) THEN v END AS id FROM m LEFT JOIN g USING (o_orderkey)""")
def j2_alt_keys_dated(t):
    """J2 with its guard by date: customers share written forms, orders give days and spells of 60 days."""
    c, tag = t("customer"), F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))
    low = F.concat(F.lower("c_mktsegment"), F.col("c_nationkey").cast("string"))
    high = F.concat(F.upper("c_mktsegment"), F.col("c_nationkey").cast("string"))
    dim = c.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("ordinal"), F.array(high, F.concat(F.lit("The "), tag)).alias("forms"))
    name = F.when(F.col("o_orderstatus") == "F", high).when(F.col("o_orderstatus") == "O", F.concat(F.lit("the "), low)).otherwise("nobody")
    rows = by_year(t).join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "date", name.alias("name"))
    terms = by_year(t).select(F.col("o_custkey").alias("id"), F.col("date").alias("start"), F.date_add("date", 60).alias("end"))
    return J.match_forms(rows, dim, "name", "forms", "id", "ordinal", "date", terms).select("o_orderkey", "name", "id")


SPELLS = "SELECT o_custkey AS k, o_orderpriority AS v, o_orderdate::DATE AS a, (lead(o_orderdate) OVER w)::DATE - 1 AS b, row_number() OVER w AS o FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderpriority, o_orderkey)"


def spells(t) -> DataFrame:
    return J.spells_from_events(t("orders"), "o_custkey", "o_orderdate", ["o_orderpriority", "o_orderkey"]).withColumnRenamed("o_orderpriority", "party")


@query("""SELECT o_orderkey, CASE WHEN contains(lower(o_orderpriority), 'urgent') AND o_orderdate::DATE < '1996-01-01' THEN 'A' WHEN contains(lower(o_orderpriority), 'high') AND o_orderdate::DATE >= '1994-01-01' THEN 'B' WHEN contains(lower(o_orderpriority), '-') THEN 'C' END AS value FROM orders""")
def j6_theta(t):
    o = by_year(t)
    p = o.sparkSession.createDataFrame([("URGENT", None, "1995-12-31", "A", 1), ("high", "1994-01-01", None, "B", 2), ("-", None, None, "C", 3)], "pattern string, s string, e string, value string, ordinal int")
    p = p.select("pattern", F.to_date("s").alias("start"), F.to_date("e").alias("end"), "value", "ordinal")
    return J.pattern_lookup(o.select("o_orderkey", "o_orderpriority", "date"), p, "o_orderpriority", "date", "o_orderkey").select("o_orderkey", "value")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW')")
def j7_semi_anti(t):
    o = t("orders").withColumnRenamed("o_custkey", "c_custkey")
    return R.members_of(t("customer"), "c_custkey", o.where("o_orderstatus = 'P'"), o.where("o_orderpriority = '5-LOW'")).select("c_custkey")


@query("SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def j8_j10_equi_chain(t):
    d = t("supplier").join(J.small(t("nation")), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(J.small(t("region")), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return d.select("s_suppkey", "n_name", "r_name")


@query("""SELECT l_orderkey, l_linenumber, first AS unique_id FROM lineitem LEFT JOIN (SELECT o_custkey, arg_min(o_clerk, o_orderkey) AS first FROM (SELECT o_custkey, o_orderkey, o_orderpriority AS o_clerk FROM orders) GROUP BY 1) ON l_suppkey = o_custkey""")
def j9_votes_first_row(t):
    first = W.first_rows(t("orders"), ["o_custkey"], ["o_orderkey"]).select(F.col("o_custkey").alias("l_suppkey"), F.col("o_orderpriority").alias("unique_id"))
    return t("lineitem").join(first, "l_suppkey", "left").select("l_orderkey", "l_linenumber", "unique_id")


@query("SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def j11_anti_union_all(t):
    """J11 with all rows of both tables."""
    return J.add_missing(t("supplier").select("s_suppkey", "s_name"), t("customer").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name")), "s_suppkey")


@query("SELECT topic, o_orderdate::DATE AS date, count(*) AS turns FROM orders JOIN (SELECT c_custkey, c_mktsegment AS topic FROM customer WHERE c_acctbal > 9000) ON c_custkey = o_custkey GROUP BY 1, 2 ORDER BY turns DESC, date, topic LIMIT 25")
def j14_topic_days(t):
    c = t("customer").where("c_acctbal > 9000").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("topic"))
    return R.topic_days(by_year(t), c, "o_custkey", 25)


EVERY_FACT = "SELECT DISTINCT l_orderkey, o_custkey, l_shipdate::DATE AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def every_fact(t) -> DataFrame:
    """Each order and day of its lines, first lines or not: a look-up depends on nothing else of a line."""
    d = t("lineitem").join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    d = d.select("l_orderkey", "o_custkey", F.to_date("l_shipdate").alias("day")).distinct()
    return d.withColumn("fact", F.struct("l_orderkey", "day")).withColumn("party", F.lit(None).cast("string"))


@query(f"""WITH s AS ({SPELLS}), f AS ({EVERY_FACT}), m AS (SELECT l_orderkey, day, arg_min(v, o) AS v FROM f JOIN s ON k = o_custkey AND a <= day AND (b IS NULL OR day <= b) GROUP BY 1, 2)
SELECT f.l_orderkey, f.day, v AS party FROM f LEFT JOIN m ON m.l_orderkey = f.l_orderkey AND m.day = f.day""")
def j3_asof_all(t):
    """J3 over all lines."""
    return J.as_of(every_fact(t), spells(t), "o_custkey", "day", "party", "fact").select("l_orderkey", "day", "party")


@query(f"""WITH s AS (SELECT k, v, o, a, coalesce(b, a + 400) + 200 AS b FROM ({SPELLS})), f AS ({EVERY_FACT}), m AS (SELECT l_orderkey, day, v, row_number() OVER (PARTITION BY l_orderkey, day ORDER BY CASE WHEN day BETWEEN a AND b THEN 0 ELSE 1 END, CASE WHEN day BETWEEN a AND b THEN b - a END NULLS FIRST, b DESC, o) AS r FROM f JOIN s ON k = o_custkey)
SELECT f.l_orderkey, f.day, v AS party FROM f LEFT JOIN m ON m.l_orderkey = f.l_orderkey AND m.day = f.day AND r = 1""")
def j5_shortest_spell_all(t):
    """J5 over all lines."""
    s = spells(t).withColumn("end", F.date_add(F.coalesce("end", F.date_add("start", 400)), 200))
    return J.as_of(every_fact(t), s, "o_custkey", "day", "party", "fact", shortest=True).select("l_orderkey", "day", "party")


@query(f"""WITH s AS (SELECT k, a, least(coalesce(b, a + 100), a + 100) AS b FROM ({SPELLS})), f AS ({EVERY_FACT}) SELECT l_orderkey, day, bool_or(day BETWEEN a AND b) AS ok FROM f JOIN s ON k = o_custkey GROUP BY 1, 2""")
def j16_any_term_all(t):
    """J16 over all lines and spells, with holes after a hundred days."""
    s = spells(t).select("o_custkey", "start", F.least("end", F.date_add("start", 100)).alias("end"))
    return every_fact(t).join(s, "o_custkey").groupBy("l_orderkey", "day").agg(F.bool_or(J.in_spell(F.col("day"), F.col("start"), F.col("end"))).alias("ok"))


@query("SELECT doc_id, coalesce(quality::VARCHAR, '') AS quality, coalesce(toxic::VARCHAR, '') AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def j17_annotations(t):
    notes = t("labels").select("doc_id", F.col("quality").cast("string"), F.col("toxic").cast("string"))
    return J.annotated(t("documents").select("doc_id"), notes, "doc_id", ["quality", "toxic"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def c8_incremental(t):
    """What a manifest doesn't have yet."""
    return J.to_do(t("documents"), t("labels"), "doc_id").select("doc_id")


# order, pages, sets, samples

@query("SELECT * FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS party, c_nationkey FROM customer) ORDER BY party DESC NULLS LAST, c_nationkey DESC, c_custkey LIMIT 40 OFFSET 80")
def o1_o2_sorted_page(t):
    c = t("customer").select(F.col("c_custkey").alias("turn_id"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_mktsegment")).alias("party"), F.col("c_nationkey").alias("date"))
    number, size, _ = L.page_bounds(c.count(), 3, 40)
    return L.page(c, L.ordering("party", True), number, size).select(F.col("turn_id").alias("c_custkey"), "party", F.col("date").alias("c_nationkey"))


@query("SELECT kind, id, price FROM (SELECT 'o' AS kind, o_orderkey AS id, o_totalprice AS price FROM orders UNION ALL SELECT 'p', p_partkey, p_retailprice FROM part) ORDER BY price DESC, kind, id LIMIT 30")
def o3_topk_union(t):
    parts = [t("orders").select(F.lit("o").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")), t("part").select(F.lit("p").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"))]
    return R.top_of_all(parts, [F.desc("price"), F.col("kind"), F.col("id")], 30)


@query("SELECT doc_id FROM documents ORDER BY doc_id::VARCHAR")
def o4_text_order_all(t):
    """O4 of all rows."""
    return R.in_text_order(t("documents").select("doc_id"), "doc_id")


@query("SELECT c_custkey, 'a' AS side FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT o_custkey, 'b' FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)")
def u3_difference(t):
    """Both ways."""
    return R.differences(t("customer").select("c_custkey"), t("orders").select(F.col("o_custkey").alias("c_custkey")))


@query("SELECT doc_id, lang, NULL::BIGINT AS page_id FROM documents UNION ALL SELECT NULL, NULL, page_id FROM pages")
def u1_union(t):
    return R.bound([t("documents").select("doc_id", "lang"), t("pages").select("page_id")])


@query("SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':42'), doc_id) AS r FROM documents) WHERE r <= 6")
def sa1_stratified(t):
    return L.stratified(t("documents"), F.col("lang"), "doc_id").select("doc_id", "lang")


# validation

@query("""SELECT o_orderdate::DATE AS date, count(*) AS n FROM orders WHERE o_orderdate::DATE NOT IN (SELECT l_shipdate::DATE FROM lineitem) GROUP BY 1""")
def v1_dates(t):
    s = t("lineitem").select(F.to_date("l_shipdate").alias("date")).distinct().withColumn("header_date", F.col("date"))
    bad = V.t1_dates(by_year(t), s)
    return by_year(t).join(bad.select("date"), "date", "left_semi").groupBy("date").agg(F.count("*").alias("n"))


def day_turns(t) -> DataFrame:
    d = t("events").select(F.to_date("ts").alias("date"), F.struct("ts", "event_id").alias("order"), F.col("user_id").cast("string").alias("name_id"), F.col("event_type").alias("body"), F.when(F.col("event_id") % 7 == 0, 1).otherwise(0).alias("interject"), F.col("event_type").alias("party"), F.lit("x").alias("place"))
    return d


#: Kinds of events as turns: one may be repeated by procedure, one is empty, others not.
SAID = {"click": "Leave granted", "view": "", "error": "Senator X interjecting"}
SAID_SQL = f"CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SAID.items())} ELSE event_type END"


@query(f"""SELECT date, 'T2' AS test, n || ' consecutive duplicates' AS message FROM (SELECT date, count(*) AS n FROM (SELECT *, lag(body) OVER (PARTITION BY date ORDER BY ts, event_id) AS b FROM (SELECT ts::DATE AS date, ts, event_id, {SAID_SQL} AS body FROM events WHERE event_id % 7 <> 0))
WHERE body = b AND body <> '' AND NOT regexp_matches(body, '{V.MAY_REPEAT}') GROUP BY 1)""")
def v2_duplicates(t):
    """Every seventh event is an interjection."""
    said = F.coalesce(F.create_map(*(F.lit(x) for kv in SAID.items() for x in kv))[F.col("body")], F.col("body"))
    return V.t2_duplicates(day_turns(t).withColumn("body", said))


@query("""SELECT o_orderdate::DATE AS date, 'T4' AS test, o_custkey || ' has several parties or places' AS message FROM orders WHERE o_custkey <> 1 GROUP BY o_orderdate::DATE, o_custkey HAVING count(DISTINCT o_orderpriority) > 1 OR count(DISTINCT o_orderstatus) > 1""")
def v4_unique(t):
    d = by_year(t).select("date", F.col("o_custkey").cast("string").alias("name_id"), F.col("o_orderpriority").alias("party"), F.col("o_orderstatus").alias("place"), F.lit(0).alias("interject"))
    return V.t4_unique(d)


@query("""SELECT DISTINCT ts::DATE AS date, 'T5' AS test, 'unknown id ' || user_id AS message FROM events WHERE user_id <> 1 AND user_id NOT IN (SELECT s_suppkey FROM supplier)""")
def v5_unknown(t):
    return V.t5_unknown(day_turns(t), t("supplier").select(F.col("s_suppkey").cast("string").alias("name_id")))


@query("""WITH b AS (SELECT o_custkey AS k, min(o_orderdate)::DATE + 200 AS birth, max(o_orderdate)::DATE - 200 AS death FROM orders GROUP BY 1) SELECT DISTINCT o_orderdate::DATE AS date, 'T6' AS test, o_custkey || ' is not alive' AS message FROM orders JOIN b ON k = o_custkey WHERE o_orderdate::DATE < birth OR o_orderdate::DATE > death""")
def v6_alive(t):
    o = by_year(t).withColumn("unique_id", F.col("o_custkey").cast("string"))
    return V.t6_alive(o, o.groupBy("unique_id").agg(F.date_add(F.min("date"), 200).alias("birth_date"), F.date_sub(F.max("date"), 200).alias("death_date")))


@query(f"""WITH s AS (SELECT k, a, least(coalesce(b, a + 100), a + 100) AS b FROM ({SPELLS})), d AS (SELECT DISTINCT day AS date, o_custkey FROM ({EVERY_FACT})) SELECT date, 'T7' AS test, o_custkey || ' has no term' AS message FROM d JOIN s ON k = o_custkey GROUP BY date, o_custkey HAVING NOT bool_or(date BETWEEN a AND b)""")
def v7_term_all(t):
    """V7 with the days of all lines and all spells, with holes after a hundred days."""
    s = spells(t).select(F.col("o_custkey").cast("string").alias("unique_id"), "start", F.least("end", F.date_add("start", 100)).alias("end"))
    return V.t7_term(every_fact(t).select(F.col("day").alias("date"), F.col("o_custkey").cast("string").alias("unique_id")), s)


@query("""SELECT doc_id, instr(text, '. ') AS at FROM documents WHERE instr(text, '. ') > 0 AND length(substr(text, instr(text, '. ') + 2)) > 20""")
def v3_rest_after_mark(t):
    rest = F.substr(F.col("text"), F.instr("text", ". ") + F.lit(2))
    return t("documents").where((F.instr("text", ". ") > 0) & (F.length(rest) > 20)).select("doc_id", F.instr("text", ". ").alias("at"))


# scalars

@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%H:%M:%S') WHEN 1 THEN strftime(ts, '%H:%M') || ':00' WHEN 2 THEN strftime(ts, '%H:%M') || ':00' WHEN 3 THEN strftime(ts, '%H') || ':00:00' END AS clock, hour(ts) * 60 + minute(ts) + 0.0::DOUBLE AS minutes FROM events""")
def p1_p2_clock(t):
    k = F.col("event_id") % 5
    raw = F.when(k == 0, F.date_format("ts", "HH:mm:ss")).when(k == 1, F.date_format("ts", "H:mm")).when(k == 2, F.date_format("ts", "h.mm a")).when(k == 3, F.date_format("ts", "h a")).otherwise(F.date_format("ts", "HH.mm"))
    return t("events").select("event_id", S.clock(raw).alias("clock"), S.minutes(F.date_format("ts", "HH:mm")).alias("minutes"))


@query("""SELECT doc_id, trim(regexp_replace(text, '\\s*\\n\\s*', ' ', 'g'), ' ') AS flat, CASE WHEN length(text) > 280 THEN substr(text, 1, 280) || '…' ELSE text END AS preview FROM documents""")
def p4_p25_flatten_preview(t):
    return t("documents").select("doc_id", S.flatten(F.col("text")).alias("flat"), S.preview(F.col("text")).alias("preview"))


@query("""SELECT p AS raw, n AS party, a AS alias, g AS grp, c AS comparative, st AS state FROM (VALUES ('LIB', 'LP', 'COAL', 'Other', 'Unknown', NULL), ('NatsWA', 'NatsWA', 'COAL', 'Other', 'Unknown', NULL), ('ALP', 'ALP', 'ALP', 'Labor', 'Labor', NULL), ('UNKNOWN', NULL, 'UNKNOWN', 'Other', 'Unknown', NULL),
('(x', NULL, '(x', 'Other', 'Unknown', NULL), ('NSW', 'NSW', 'NSW', 'Other', 'Unknown', 'New South Wales'), ('Qld—retired', 'Qld—retired', 'Qld—retired', 'Other', 'Unknown', 'Queensland'), ('AG', 'AG', 'GRN', 'Greens', 'Greens', NULL), ('NP', 'NP', 'COAL', 'Nationals', 'Coalition', NULL)) v(p, n, a, g, c, st)""")
def p10_p13_normalise(t):
    raw = ["LIB", "NatsWA", "ALP", "UNKNOWN", "(x", "NSW", "Qld—retired", "AG", "NP"]
    d = t("region").limit(1).select(F.explode(F.array(*map(F.lit, raw))).alias("raw"))
    c = F.col("raw")
    return d.select("raw", S.party(c).alias("party"), S.party_alias(c).alias("alias"), S.party_group(c).alias("grp"), S.party_group(c, "comparative").alias("comparative"), S.state(c).alias("state"))


@query("""SELECT doc_id, CASE WHEN quality = 1 THEN 'question' WHEN toxic = 1 THEN 'interjection' ELSE 'speech' END AS kind FROM documents LEFT JOIN labels USING (doc_id)""")
def p14_turn_type(t):
    zero = F.lit(0)
    return t("documents").join(t("labels"), "doc_id", "left").select("doc_id", S.turn_type(zero, F.col("quality"), zero, F.col("toxic")).alias("kind"))


@query("""SELECT o_orderkey, CASE WHEN d >= '1996-03-11' AND d < '2007-11-24' AND p IN ('LP', 'NP') THEN 1 WHEN d >= '2007-11-24' AND d < '2013-09-18' AND p = 'ALP' THEN 1 ELSE 0 END AS in_gov FROM (SELECT o_orderkey, (o_orderdate + INTERVAL 10 YEAR)::DATE AS d, CASE o_orderkey % 3 WHEN 0 THEN 'LP' WHEN 1 THEN 'ALP' ELSE 'NP' END AS p FROM orders)""")
def p18_in_gov(t):
    p = F.when(F.col("o_orderkey") % 3 == 0, "LP").when(F.col("o_orderkey") % 3 == 1, "ALP").otherwise("NP")
    return by_year(t).select("o_orderkey", S.in_government(F.add_months("date", 120), p).alias("in_gov"))


@query(f"""SELECT doc_id, {WORDS_SQL} AS words, ((length(text) - length(replace(text, 'the', ''))) // 3) AS n, round(CASE WHEN {WORDS_SQL} > 0 THEN 1000.0 * ((length(text) - length(replace(lower(text), 'the', ''))) // 3) / {WORDS_SQL} ELSE 0 END, 4) AS density FROM documents""")
def p20_p22_text_metrics(t):
    c = F.col("text")
    return t("documents").select("doc_id", S.word_count(c).alias("words"), S.occurrences(c, ["the"]).alias("n"), r4(S.density(c, "The"), "density"))


@query("""SELECT doc_id, substr(sha256(lower(lang) || '|' || '2024-01-02' || '|' || coalesce(source, '') || '|' || substr(text, 1, 200)), 1, 12) AS turn_hash, substr(sha256(lang || '|' || '2024-01-02'), 1, 12) AS day_hash FROM documents""")
def p23_p24_hash(t):
    day = F.lit("2024-01-02").cast("date")
    return t("documents").select("doc_id", S.turn_hash(F.col("lang"), day, F.col("source"), F.col("text")).alias("turn_hash"), S.day_hash(F.col("lang"), day).alias("day_hash"))


EMBEDDED_SQL = " OR ".join("regexp_matches(body, '" + p.replace("'", "''") + "')" for p in S.EMBEDDED)


@query(f"""SELECT doc_id, coalesce({EMBEDDED_SQL}, false) AS embedded, regexp_replace(regexp_replace(replace(lower(source || ' & ' || lang), '&', ' and '), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug
FROM (SELECT *, CASE lang WHEN 'en' THEN 'As Mr Able interjecting— ' WHEN 'de' THEN 'An honourable member interjecting- ' WHEN 'fr' THEN 'ABLE interjecting-' ELSE 'no one interjecting: ' END || text AS body FROM documents)""")
def p29_p32_flag_slug(t):
    said = F.when(F.col("lang") == "en", "As Mr Able interjecting— ").when(F.col("lang") == "de", "An honourable member interjecting- ").when(F.col("lang") == "fr", "ABLE interjecting-").otherwise("no one interjecting: ")
    return t("documents").select("doc_id", S.has_interjection(F.concat(said, "text")).alias("embedded"), S.slug(F.concat(F.col("source"), F.lit(" & "), F.col("lang"))).alias("slug"))


@query("""SELECT event_id, isoyear(ts) || '-W' || lpad(weekofyear(ts)::VARCHAR, 2, '0') AS week FROM events""")
def p33_iso_week(t):
    return t("events").select("event_id", S.iso_week(F.col("ts")).alias("week"))


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'), ' ') AS plain FROM pages""")
def p34_tagstrip(t):
    return t("pages").select("page_id", S.strip_tags(F.col("html")).alias("plain"))


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events""")
def p35_json(t):
    return t("events").select("event_id", F.from_json(S.json_part(F.concat(F.lit("reply: "), F.col("props"), F.lit(" end"))), "k long")["k"].alias("k"))


@query("""WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS link, unnest(range(1, 1 + len(regexp_extract_all(html, 'href="(/[^"]*)"', 1)))) AS pos FROM pages) SELECT page_id, pos, link FROM r""")
def s13_links(t):
    """Links of pages in their order."""
    return links(t("pages"), "page_id", "html")


@query("""SELECT l_orderkey, r AS ayes, a AS noes, CASE WHEN r > a THEN 'aye' WHEN r < a THEN 'noe' ELSE 'tie' END AS result FROM (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS r, count(*) FILTER (WHERE l_returnflag = 'A') AS a FROM lineitem GROUP BY 1)""")
def x20_x22_division_result(t):
    return R.division_result(t("lineitem"), ["l_orderkey"], "l_returnflag", "R", "A")


@query("""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS at, part FROM (SELECT doc_id, unnest(string_split(replace(text, '. ', '.' || chr(1) || ' '), chr(1))) AS part, unnest(range(1, 1 + len(string_split(replace(text, '. ', '.' || chr(1) || ' '), chr(1))))) AS i FROM documents) WHERE trim(part, ' ') <> ''""")
def r2_separate_rows(t):
    """A text's sentences, cut where one ends without losing a sign, numbered anew."""
    return R.split_rows(t("documents"), "doc_id", "text", r"(?<=\.)(?= )")


@query("""SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS "A", sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS "N", sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS "R" FROM lineitem GROUP BY 1""")
def r10_wide(t):
    return R.wide_rows(t("lineitem"), "l_orderkey", "l_returnflag", ["A", "N", "R"], "l_quantity")


@query("""SELECT conv_id, turn AS "order" FROM (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nx FROM conversations) WHERE role = 'user' AND coalesce(nx, '') <> 'assistant'""")
def r13_unanswered(t):
    return R.without_answer(turns(t), ["conv_id"], "order", "role", "user", "assistant").select("conv_id", "order")


# excerpts, citations and trees: no SQL, held against plain Python in the tests

@query()
def p30_snippet(t):
    return t("documents").select("doc_id", X.snippet(F.col("text"), "the").alias("snippet"))


@query()
def p31_excerpt(t):
    return t("documents").select("doc_id", X.excerpt(F.col("text"), ["that"]).alias("excerpt"))


@query("""WITH d AS (SELECT doc_id, 'a [' || (doc_id % 7) || ', ' || (doc_id % 5) || '] b [' || (doc_id % 3) || ']' AS r FROM documents), u AS (SELECT doc_id, doc_id % 7 AS ref, 1 AS p FROM d UNION ALL SELECT doc_id, doc_id % 5, 2 FROM d UNION ALL SELECT doc_id, doc_id % 3, 3 FROM d)
SELECT doc_id, ref, row_number() OVER (PARTITION BY doc_id ORDER BY min(p)) AS number FROM u GROUP BY doc_id, ref""")
def p36_citations(t):
    part = lambda k: (F.col("doc_id") % k).cast("string")
    d = t("documents").select("doc_id", F.concat(F.lit("a ["), part(7), F.lit(", "), part(5), F.lit("] b ["), part(3), F.lit("]")).alias("r"))
    return X.citations(d, "doc_id", "r")


@query("""SELECT conv_id::VARCHAR AS path, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS "order", CASE role WHEN 'user' THEN 'question' WHEN 'assistant' THEN 'answer' ELSE 'speech' END AS row_type, 'R' || turn AS name_id FROM conversations""")
def x2_walk(t):
    """A file for each conversation, parsed back into turns."""
    tag = F.when(F.col("role") == "user", "question").when(F.col("role") == "assistant", "answer").otherwise("speech")
    speech = F.concat(F.lit("<"), tag, F.lit("><talk.start><talker><name>A</name><name.id>r"), F.col("order").cast("string"), F.lit("</name.id></talker><para>x</para></talk.start></"), tag, F.lit(">"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order", speech.alias("x")))), lambda r: r["x"]), "")
    files = turns(t).groupBy(F.col("conv_id").cast("string").alias("path")).agg(F.encode(F.concat(F.lit('<record version="2.1"><chamber.xscript><debate><debateinfo/>'), rows, F.lit("</debate></chamber.xscript></record>")), "UTF-8").alias("content"))
    return proceedings.parse(files, "turns").select("path", "order", "row_type", "name_id")


# further rows of the inventory

@query("SELECT coalesce(CASE c_nationkey % 4 WHEN 0 THEN 'New South Wales' WHEN 1 THEN 'Queensland' WHEN 2 THEN 'Victoria' END, 'Other') AS state, count(*) AS n FROM customer GROUP BY 1")
def a9_state_counts(t):
    """Counts by normalised place, with a default."""
    k = F.col("c_nationkey") % 4
    raw = F.when(k == 0, "NSW").when(k == 1, "Queesland").when(k == 2, "Vic").otherwise("nowhere")
    return t("customer").groupBy(F.coalesce(S.state(raw), F.lit("Other")).alias("state")).agg(F.count("*").alias("n"))


@query("""SELECT year(o_orderdate) AS year, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS "1-URGENT", count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS "2-HIGH" FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1""")
def a12_two_keys(t):
    return A.crosstab(by_year(t).where("o_orderpriority IN ('1-URGENT', '2-HIGH')"), "year", "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("SELECT source, round(100.0 * avg(CASE WHEN toxic = 1 THEN 1.0 ELSE 0.0 END), 4) AS pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def a16_flag_share(t):
    """Flags come as numbers, decimals or texts."""
    said = F.when(F.col("doc_id") % 2 == 0, F.col("toxic").cast("string")).otherwise(F.col("toxic").cast("double").cast("string"))
    d = t("documents").join(t("labels"), "doc_id", "left")
    return A.share(d, ["source"], F.coalesce(S.flag(said) == 1, F.lit(False))).select("source", r4(F.col("pct"), "pct"))


@query("SELECT max_by(year, (n, -year)) AS peak, max(n) AS n FROM (SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1)")
def a22_peak_overall(t):
    return R.peak(by_year(t), "year")


@query("""WITH d AS (SELECT DISTINCT o_orderdate::DATE AS date FROM orders WHERE o_totalprice > 400000) SELECT c_mktsegment, string_agg(y || '(' || n || ')', ' ' ORDER BY y) AS series, sum(n)::BIGINT AS n FROM (SELECT c_mktsegment, year(o_orderdate) AS y, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate::DATE IN (SELECT date FROM d) GROUP BY 1, 2) GROUP BY 1""")
def a33_topic_matrix(t):
    """Only days that matched."""
    o = by_year(t)
    d = o.join(o.where("o_totalprice > 400000").select("date").distinct(), "date", "left_semi").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return A.compact(d, ["c_mktsegment"], "year")


@query("SELECT o_custkey, string_agg(DISTINCT p::VARCHAR, ',' ORDER BY p::VARCHAR) AS parliaments FROM (SELECT o_custkey, CASE WHEN y <= 1999 THEN 39 WHEN y <= 2001 THEN 40 WHEN y <= 2004 THEN 41 ELSE 42 END AS p FROM (SELECT o_custkey, year(o_orderdate) + 4 AS y FROM orders)) GROUP BY 1")
def a38_parliaments(t):
    return by_year(t).groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set(S.parliament(F.col("year") + 4).cast("string"))), ",").alias("parliaments"))


@query("SELECT year(o_orderdate) AS year, count(*) FILTER (WHERE o_orderstatus = 'F') AS answered, count(*) FILTER (WHERE o_orderstatus <> 'F') AS unanswered FROM orders GROUP BY 1")
def a46_answered(t):
    return R.answered(by_year(t), ["year"], F.when(F.col("o_orderstatus") == "F", "True").otherwise("no"))


@query("SELECT v.i, v.p AS priority, count(o_orderkey) AS n FROM (VALUES (1, '5-LOW'), (2, '1-URGENT'), (3, 'absent')) v(i, p) LEFT JOIN orders ON o_orderpriority = v.p GROUP BY 1, 2")
def a47_ordered_counts(t):
    return R.ordered_counts(t("orders").withColumnRenamed("o_orderpriority", "priority"), "priority", ["5-LOW", "1-URGENT", "absent"])


@query("""SELECT round(100.0 * count(*) FILTER (WHERE toxic = 1) / count(toxic), 4) AS pct_negative, (SELECT arg_max(lang, (n, lang)) FROM (SELECT lang, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1)) AS top_lang,
(SELECT arg_max(source, (n, source)) FROM (SELECT source, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE source IS NOT NULL GROUP BY 1)) AS top_source FROM documents JOIN labels USING (doc_id)""")
def a51_a52_headline(t):
    return R.headline(t("documents").join(t("labels"), "doc_id"), F.col("toxic") == 1, "toxic", ["lang", "source"])


@query("SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1 ORDER BY conv_id LIMIT 20")
def a54_first20(t):
    return turns(t).groupBy("conv_id").agg(F.count("*").alias("n")).orderBy("conv_id").limit(20)


@query("SELECT doc_id, concat_ws(' | ', doc_id, source, CASE WHEN n_chars > 2000 THEN substr(text, 1, 60) END) AS record FROM documents")
def a56_record(t):
    return t("documents").select("doc_id", R.record([F.col("doc_id").cast("string"), F.col("source")], "text", F.col("n_chars") > 2000, 60).alias("record"))


@query("""SELECT 'lang' AS what, lang AS key, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 2 UNION ALL SELECT 'lang x toxic', coalesce(lang, 'none') || ' x ' || coalesce(toxic::VARCHAR, 'none'), count(*) FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'speakers', source, count(*) AS n FROM documents WHERE NOT starts_with(lower(source), 'src1') GROUP BY 2 ORDER BY n DESC, source LIMIT 15)""")
def a57_stats_block(t):
    return R.stats_block(t("documents").join(t("labels"), "doc_id", "left"), ["lang"], [("lang", "toxic")], "source", "src1")


@query("""SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT (toxic IS NULL AND regexp_matches(coalesce(text, ''), '(?i)licensed')) AND NOT coalesce(regexp_matches(text, '(?i)adjourned|^bill read a'), false) AND lower(source) <> 'procedural text'""")
def f21_f25_exclusions(t):
    """procedural texts and false positives go."""
    d = t("documents").join(t("labels"), "doc_id", "left").withColumn("error", F.lit(None).cast("string"))
    return R.excluded(d, "source", "text", "toxic", "text", "licensed", r"(?i)adjourned|^bill read a", "error").select("doc_id")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN n_name ELSE coalesce(CASE WHEN s_suppkey % 3 = 0 THEN 'own' END, n_name) END AS electorate FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def j4_overwrite(t):
    """Overwrite some rows, fill the others."""
    s = t("supplier").withColumn("electorate", F.when(F.col("s_suppkey") % 3 == 0, "own"))
    d = s.join(J.small(t("nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    return d.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("n_name")).otherwise(F.coalesce("electorate", "n_name")).alias("electorate"))


@query("SELECT lang, round(n::DOUBLE / total, 6) AS ratio FROM (SELECT lang, count(*) FILTER (WHERE toxic = 1) AS n, count(*) AS total FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1) WHERE n > 0")
def j18_ratio(t):
    d = t("documents").join(t("labels"), "doc_id", "left")
    n = d.where("toxic = 1").groupBy("lang").agg(F.count("*").alias("n"))
    return A.rate(n, d.groupBy("lang").agg(F.count("*").alias("total")), "lang", "n", "total", 1).select("lang", F.round("rate", 6).alias("ratio"))


@query("SELECT phrase, n FROM (SELECT trim(string_split(trim(text), chr(10))[1]) AS phrase, count(*) AS n FROM conversations GROUP BY 1) WHERE phrase NOT IN (SELECT trim(string_split(trim(text), chr(10))[1]) FROM conversations WHERE role = 'assistant')")
def u5_used_phrases_all(t):
    """U5 with the phrases of all assistants' turns as known."""
    d = turns(t).withColumn("phrase", F.trim(F.split_part(F.trim("body"), F.lit("\n"), F.lit(1))))
    return R.unused(d, F.col("phrase"), d.where("role = 'assistant'"))


@query("SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS latest, arg_min(o_orderpriority, o_orderkey) AS first FROM orders GROUP BY 1")
def w16_w17_latest_first(t):
    return R.latest_and_first(t("orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderstatus", "o_orderpriority", "o_orderkey")


@query("SELECT conv_id, turn AS \"order\", row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ref_id FROM conversations")
def w1_w22_order(t):
    return turns(t).select("conv_id", "order", F.row_number().over(W.day(["conv_id"], "order")).alias("ref_id"))


@query("SELECT event_id, CASE WHEN event_id % 4 < 2 THEN event_id % 4 END AS flag, CASE WHEN event_id % 3 = 0 THEN event_id END AS number, CASE WHEN event_id % 5 > 0 THEN event_type END AS said FROM events")
def p3_coercions(t):
    e = F.col("event_id")
    raw = F.when(e % 4 == 0, "0.0").when(e % 4 == 1, "true").otherwise("maybe")
    return t("events").select("event_id", S.flag(raw).alias("flag"), F.when(e % 3 == 0, e.cast("string")).otherwise("x").try_cast("long").alias("number"), S.clean(F.when(e % 5 > 0, F.col("event_type")).otherwise("nan")).alias("said"))


@query("SELECT s_suppkey, 'Mr SUPPLIER, Ann' AS shown, 'Mr SUPPLIER;Mr ann SUPPLIER;Mr Supplier;Mr ann Supplier;SUPPLIER, ann' AS forms, 'McDONALD' AS surname FROM supplier")
def p5_p9_names(t):
    """P5, P6, P7, P9."""
    title, first, last = S.title(F.lit("male"), F.lit(None).cast("string")), F.lit("ann"), F.lit("Supplier")
    return t("supplier").select("s_suppkey", S.display_name(title, first, last).alias("shown"), F.array_join(S.name_forms(title, first, last), ";").alias("forms"), S.surname_case(F.lit("McDonald")).alias("surname"))


@query("SELECT conv_id, turn AS \"order\", 'senate-' || conv_id || '-' || turn AS match_id, CASE role WHEN 'user' THEN 'question' WHEN 'assistant' THEN 'answer' ELSE 'statement' END AS kind, role || ' (x): ' || trim(regexp_replace(coalesce(text, ''), '\\s*\\n\\s*', ' ', 'g'), ' ') AS line FROM conversations")
def p15_p26_p28_turn_text(t):
    d = turns(t)
    q, a, i = (F.when(F.col("role") == r, 1).otherwise(0) for r in ("user", "assistant", "none"))
    kind = S.first_of([(S.exclusive_type(k, q, a, i), F.lit(k)) for k in ("question", "answer", "interject", "statement")])
    return d.select("conv_id", "order", F.concat_ws("-", F.lit("senate"), F.col("conv_id").cast("string"), F.col("order").cast("string")).alias("match_id"), kind.alias("kind"), S.context_line(F.lit(None).cast("string"), F.col("role"), F.lit("nan"), F.lit("x"), F.col("body")).alias("line"))


@query("SELECT source, n, repeat('█', greatest(1, floor(n * least(1.0, 40.0 / m))::INTEGER)) AS bar FROM (SELECT source, count(*) AS n, max(count(*)) OVER () AS m FROM documents GROUP BY 1)")
def s24_bars(t):
    return tables.bars(t("documents").groupBy("source").agg(F.count("*").alias("n")), "source", "n")


@query("SELECT p_partkey, coalesce(suppliers, '') AS suppliers FROM part LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT l_suppkey::VARCHAR, ',' ORDER BY l_suppkey::VARCHAR) AS suppliers FROM lineitem WHERE l_quantity > 45 GROUP BY 1) ON l_partkey = p_partkey")
def r9_list_column(t):
    s = t("lineitem").where("l_quantity > 45").withColumnRenamed("l_partkey", "p_partkey")
    return R.with_list(t("part").select("p_partkey"), s, "p_partkey", "l_suppkey", "suppliers")


@query("SELECT l_orderkey, l_linenumber, unnest(['quantity', 'discount']) AS name, unnest([l_quantity, l_discount]) AS value FROM lineitem")
def r1_long(t):
    """Wide to long."""
    return R.long_rows(t("lineitem"), ["l_orderkey", "l_linenumber"], {"l_quantity": "quantity", "l_discount": "discount"})


@query()
def sa3_sample(t):
    """A quarter of the rows, by a seed: the same ones however the table is cut."""
    return R.sampled(t("documents"), "doc_id", 0.25).select("doc_id")


TITLES = ("Water Bill", "QUESTIONS WITHOUT NOTICE", " budget ", "Health Act, Water Act", "Treaty on Rivers", "Weather", "")


@query("""SELECT topic, string_agg(DISTINCT strftime(d, '%Y-%m-%d'), ',' ORDER BY strftime(d, '%Y-%m-%d')) AS days FROM (SELECT upper(trim(['Water Bill', 'QUESTIONS WITHOUT NOTICE', ' budget ', 'Health Act, Water Act', 'Treaty on Rivers', 'Weather', ''][1 + o_custkey % 7])) AS topic, o_orderdate::DATE AS d, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS level FROM orders)
WHERE topic IN ('WATER BILL', 'TREATY ON RIVERS') OR level = 0 AND topic IN ('HEALTH ACT, WATER ACT', 'WEATHER') GROUP BY 1""")
def f24_topic_calendar(t):
    """upper topics that aren't procedural, and lower ones of legislation; the SQL names those that should be left."""
    topic = F.element_at(F.array(*map(F.lit, TITLES)), (F.col("o_custkey") % 7 + 1).cast("int"))
    return R.topic_calendar(by_year(t).select("date", F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("level"), topic.alias("topic")))


@query("""SELECT round(avg(r), 4) AS mean, round(quantile_cont(r, 0.05), 4) AS p5, round(quantile_cont(r, 0.5), 4) AS median, round(quantile_cont(r, 0.95), 4) AS p95 FROM (SELECT l_extendedprice / l_quantity AS r FROM lineitem)""")
def a24_ratio_figures(t):
    return R.ratio_figures(t("lineitem").select((F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("ratio")))


@query("""SELECT o_orderkey, CASE WHEN y >= 2022 THEN '47th' WHEN y >= 2019 THEN '46th' WHEN y >= 2016 THEN '45th' WHEN y >= 2013 THEN '44th' WHEN y >= 2010 THEN '43rd' WHEN y >= 2007 THEN '42nd' WHEN y >= 2004 THEN '41st' WHEN y >= 2001 THEN '40th' WHEN y >= 1998 THEN '39th' ELSE 'pre-39th' END AS label,
CASE WHEN y BETWEEN 1996 AND 1997 THEN 36 WHEN y BETWEEN 1998 AND 2000 THEN 37 WHEN y BETWEEN 2001 AND 2003 THEN 38 WHEN y BETWEEN 2004 AND 2006 THEN 39 WHEN y BETWEEN 2007 AND 2009 THEN 40 WHEN y BETWEEN 2010 AND 2012 THEN 41 WHEN y BETWEEN 2013 AND 2015 THEN 42 WHEN y BETWEEN 2016 AND 2018 THEN 43 WHEN y BETWEEN 2019 AND 2021 THEN 44 WHEN y BETWEEN 2022 AND 2024 THEN 45 ELSE 46 END AS term,
CASE o_custkey % 5 WHEN 0 THEN 46 WHEN 1 THEN 46 WHEN 2 THEN 47 WHEN 3 THEN 48 ELSE 4 END AS number FROM (SELECT *, year(o_orderdate) + o_custkey % 40 AS y FROM orders)""")
def p16_p37_parliaments(t):
    """By label, by half-open ranges, and repaired numbers."""
    y, k = F.col("year") + F.col("o_custkey") % 40, F.col("o_custkey") % 5
    return by_year(t).select("o_orderkey", S.parliament_label(y).alias("label"), S.parliament_term(y).alias("term"), S.parliament_number(F.when(k == 0, 46).otherwise(k)).alias("number"))


@query("""SELECT o_orderkey, CASE WHEN p IS NULL OR d < '1996-03-02' THEN NULL WHEN d >= '1996-03-02' AND d < '2007-11-24' AND p IN ('LP', 'NatsWA') THEN 1 WHEN d >= '2007-11-24' AND d < '2013-09-07' AND p = 'ALP' THEN 1 WHEN d >= '2013-09-07' AND d < '2022-05-21' AND p IN ('LP', 'NatsWA') THEN 1 WHEN d >= '2022-05-21' AND p = 'ALP' THEN 1 ELSE 0 END AS in_gov
FROM (SELECT o_orderkey, (o_orderdate + to_months(CAST(o_custkey % 15 AS INTEGER) * 12))::DATE AS d, CASE o_orderkey % 4 WHEN 0 THEN 'LP' WHEN 1 THEN 'ALP' WHEN 2 THEN 'NatsWA' END AS p FROM orders)""")
def p18_committee_in_gov(t):
    """P18 as committees count: days before the first government and rows without a party have none."""
    k = F.col("o_orderkey") % 4
    p = F.when(k == 0, "LP").when(k == 1, "ALP").when(k == 2, "NatsWA")
    return by_year(t).select("o_orderkey", S.in_government(F.add_months("date", (F.col("o_custkey") % 15 * 12).cast("int")), p, "committee").alias("in_gov"))


@query("""SELECT c_custkey, coalesce(nullif(CASE WHEN c_nationkey % 3 = 0 THEN '' WHEN c_nationkey % 3 = 1 THEN c_mktsegment END, ''), nullif(c_name, 'nan')) AS place FROM customer""")
def p27_place(t):
    k = F.col("c_nationkey") % 3
    return t("customer").select("c_custkey", S.place(F.when(k == 0, "").when(k == 1, F.col("c_mktsegment")), F.col("c_name")).alias("place"))


@query("""SELECT doc_id, CASE WHEN lang = 'en' THEN 'Senate' ELSE 'House' END || ' Hansard, 2020-01-02, ' || coalesce(nullif(trim(source), ''), 'Unknown Speaker') || ', ' || CASE WHEN length(trim(text)) > 80 THEN rtrim(substr(trim(text), 1, 80)) || '…' ELSE trim(text) END AS label FROM documents WHERE text IS NOT NULL""")
def p38_reference_label(t):
    chamber = F.when(F.col("lang") == "en", "senate").otherwise("house")
    return t("documents").where("text IS NOT NULL").select("doc_id", S.reference_label(chamber, F.lit("2020-01-02"), F.col("source"), F.lit(None).cast("string"), F.col("text")).alias("label"))


@query("""WITH d AS (SELECT doc_id, doc_id % 7 AS a, doc_id % 5 AS b, doc_id % 3 AS c FROM documents), n AS (SELECT *, 1 AS na, CASE WHEN b = a THEN 1 ELSE 2 END AS nb FROM d), m AS (SELECT *, CASE WHEN c = a THEN 1 WHEN c = b THEN nb ELSE 1 + greatest(na, nb) END AS nc FROM n)
SELECT doc_id, 'a <sup>' || na || ', ' || nb || '</sup> b <sup>' || nc || '</sup>.' AS rewritten FROM m""")
def p36_rewrite(t):
    """Groups of ids become their numbers by first occurrence."""
    part = lambda k: (F.col("doc_id") % k).cast("string")
    d = t("documents").select("doc_id", F.concat(F.lit("a ["), part(7), F.lit(", "), part(5), F.lit("] b ["), part(3), F.lit("].")).alias("r"))
    return X.rewritten(d, "doc_id", "r").select("doc_id", "rewritten")


@query("""SELECT coalesce(c_custkey, o_custkey) AS c_custkey, n, p, n IS NOT NULL AND p IS NOT NULL AS both FROM (SELECT c_custkey, c_mktsegment AS n FROM customer WHERE c_acctbal > 0) FULL JOIN (SELECT o_custkey, max(o_orderpriority) AS p FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def r7_linked(t):
    a = t("customer").where("c_acctbal > 0").select("c_custkey", F.col("c_mktsegment").alias("n"))
    return R.linked(a, t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("p")), "c_custkey")


@query("""SELECT c_custkey, coalesce(CASE WHEN s_acctbal > 0 THEN s_name END, c_name) AS c_name, coalesce(n_name, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN nation ON n_nationkey = s_nationkey""")
def r11_corrected(t):
    """Suppliers of a customer's number correct its name (if they owe nothing) and segment."""
    fix = t("supplier").join(F.broadcast(t("nation")), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(F.col("s_suppkey").alias("c_custkey"), F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("c_name"), F.col("n_name").alias("c_mktsegment"), F.lit(1).alias("ordinal"))
    return R.corrected(t("customer").select("c_custkey", "c_name", "c_mktsegment"), fix, ["c_custkey"], ["c_name", "c_mktsegment"])


@query("""WITH c AS (SELECT *, contains(lower(coalesce(text, '')), 'the') OR contains(lower(coalesce(text, '')), 'que') OR role = 'user' AS q FROM conversations), l AS (SELECT *, coalesce(lag(q) OVER (PARTITION BY conv_id ORDER BY turn), false) AS b FROM c)
SELECT conv_id, turn AS "order", q::BIGINT AS question, (CASE WHEN q THEN 0 WHEN b THEN 1 WHEN role = 'assistant' THEN 1 ELSE 0 END)::BIGINT AS answer FROM l""")
def r13_repaired_flags(t):
    d = turns(t).select("conv_id", "order", "body", F.when(F.col("role") == "user", 1).otherwise(0).alias("question"), F.when(F.col("role") == "assistant", 1).otherwise(0).alias("answer"))
    return R.repaired_flags(d, ["conv_id"], "order", "body", ["the", "que"]).select("conv_id", "order", "question", "answer")


@query("""SELECT event_id FROM events WHERE event_id % 3 = 0 OR event_id % 5 = 1""")
def r6_bad_stamps(t):
    """Hours beyond a day and words are no times."""
    e = F.col("event_id")
    stamp = F.when(e % 3 == 0, F.concat(F.lit("25:"), F.date_format("ts", "mm"))).when(e % 5 == 1, "noon").when(e % 7 == 0, F.lit(None).cast("string")).otherwise(F.date_format("ts", "HH:mm:ss"))
    return R.bad_stamps(t("events").withColumn("stamp", stamp), "stamp").select("event_id")
