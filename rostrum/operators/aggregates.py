"""Aggregates of searches and reports."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words that make no seeds: common ones and those of any sitting day.
SEED_STOP = tuple(
    """
    about above after again against also although among another answer around australia australian because been before being between
    both come committee could debate does doing during each every first from further given government have having here
    honourable house however important into issue itself just keep know like look madam made make many matter member
    minister more most much must need never number only opposition order other over parliament party people point president
    question right said same says second senate senator shall should since some speaker still such support take than
    that their them then there these they think third this those through time today under until upon very
    want well were what when where whether which while will with within without would year years your
    """.split()
)


def top(df: DataFrame, by: list[str], n: int, name: str = "n") -> DataFrame:
    """The n most frequent keys; ties in the order of the keys."""
    return df.groupBy(*by).agg(F.count("*").alias(name)).orderBy(F.desc(name), *by).limit(n)


def time_series(df: DataFrame, period: Column, split: str, values: list[str]) -> DataFrame:
    """Counts of each value by period, 0 where there are none."""
    return df.groupBy(period.alias("period")).pivot(split, values).count().na.fill(0)


def calendar_fill(counts: DataFrame, key: str, first: Column, last: Column, col: str) -> DataFrame:
    """A row for each integer of the range, 0 where ``counts`` has none."""
    span = counts.agg(first.alias("_a"), last.alias("_b")).select(F.explode(F.sequence("_a", "_b")).alias(key))
    return span.join(counts, key, "left").na.fill(0, [col])


def facets(df: DataFrame, named: dict[str, Column]) -> DataFrame:
    """``facet``, ``value`` and ``n`` of all facets in one pass; blank values don't count."""
    pairs = F.array(*(F.struct(F.lit(k).alias("facet"), c.cast("string").alias("value")) for k, c in named.items()))
    long = df.select(F.explode(pairs).alias("p")).select("p.*")
    return long.where("value IS NOT NULL AND lower(trim(value)) NOT IN ('', 'nan', 'none')").groupBy("facet", "value").agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Counts of each pair, with columns in the given order."""
    return df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row).pivot(col, values).count().na.fill(0)


def share(df: DataFrame, by: list[str], cond: Column, name: str = "pct") -> DataFrame:
    """Percentage of rows for which ``cond`` holds."""
    return df.groupBy(*by).agg((F.avg(F.when(cond, 1.0).otherwise(0.0)) * 100).alias(name), F.count("*").alias("n"))


def row_percentages(df: DataFrame, row: str, col: str) -> DataFrame:
    """``n`` and ``pct`` of each pair within its row."""
    n = df.groupBy(row, col).agg(F.count("*").alias("n"))
    return n.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(row)))


def mode(col: str, order: Column | None = None) -> Column:
    """The most frequent value, of equals the smallest."""
    return F.mode(col, True)


def most_frequent(df: DataFrame, by: list[str], of: str, name: str) -> DataFrame:
    """Of each key the most frequent value and its count; of equals the smallest."""
    n = df.where(F.col(of).isNotNull()).groupBy(*by, of).agg(F.count("*").alias("n"))
    return n.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), of))).where("_r = 1").select(*by, F.col(of).alias(name), F.col("n").alias(f"{name}_n"))


def clipped(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """``clipped``: values no higher than the quantile, which joins as one row."""
    cap = df.agg(F.percentile(col, q).alias("_cap"))
    return df.join(F.broadcast(cap)).withColumn("clipped", F.least(F.col(col).cast("double"), F.col("_cap"))).drop("_cap")


def box(df: DataFrame, by: list[str], col: str) -> DataFrame:
    p = F.percentile(col, [0.0, 0.25, 0.5, 0.75, 1.0])
    return df.groupBy(*by).agg(p.alias("p")).select(*by, *(F.col("p")[i].alias(n) for i, n in enumerate(("low", "q1", "median", "q3", "high"))))


#: Buckets of a doubling of the values at the first pass, and parts of a bucket at each further one; results don't depend on them.
OCTAVE, PARTS = 256, 65_536


def quantiles(df: DataFrame, col: str, at: list[float], *, octave: int = OCTAVE, parts: int = PARTS) -> DataFrame:
    """One row: ``n``, ``mean`` and ``q``, the exact quantiles ``at``, in proportion between neighbours as ``percentile`` has them.

    Nulls don't count, NaN is the largest value; without values ``mean`` and all of ``q`` are null. No task holds the values, however
    many differ: a pass counts them in a bounded number of buckets, each a span of values, and the next looks into those of the wanted
    ranks only, until each has one value. Two or three passes over ``df`` are usual, and they run when this is called.
    """
    x = df.select(F.col(col).cast("double").alias("x")).where("x IS NOT NULL")
    figures = [F.count("*").alias("n"), F.sum("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi")]

    def holding(counts: DataFrame, before: Column, ranks: list[Column]) -> list:
        c = counts.withColumn("before", before + F.sum("n").over(Window.partitionBy("b").orderBy("lo")) - F.col("n"))
        return c.where(reduce(lambda p, q: p | q, ((r >= F.col("before")) & (r < F.col("before") + F.col("n")) for r in ranks))).collect()

    size = F.log2(F.abs("x")) * octave + 1100 * octave  # above 0, as no double is below 2^-1074
    key = F.when(F.isnan("x"), F.lit(2**62)).otherwise(F.coalesce(F.floor(F.signum("x") * size), F.lit(0)))
    every = Window.partitionBy("b")
    first = x.groupBy(key.alias("k")).agg(*figures).withColumn("b", F.lit(0))
    first = first.withColumns({"total": F.sum("n").over(every), "mean": F.sum("s").over(every) / F.sum("n").over(every)})
    found = holding(first, F.lit(0), [f((F.col("total") - 1) * F.lit(q)) for q in at for f in (F.floor, F.ceil)])
    total, mean = (found[0].total, found[0].mean) if found else (0, None)
    places = [(total - 1) * float(q) for q in at]
    while some := [r for r in found if r.lo < r.hi]:
        of = lambda each: F.coalesce(*(F.when(F.col("b") == i, each(r)) for i, r in enumerate(some)))
        d = x.select("x", F.coalesce(*(F.when(F.col("x").between(r.lo, r.hi), F.lit(i)) for i, r in enumerate(some))).alias("b")).where("b IS NOT NULL")
        key = of(lambda r: F.col("x") if r.n <= parts else F.floor((F.col("x") - r.lo) / (r.hi - r.lo) * parts).cast("double"))
        ranks = sorted({f(p) for p in places for f in (math.floor, math.ceil)})
        found = [r for r in found if not r.lo < r.hi] + holding(d.groupBy("b", key.alias("k")).agg(*figures), of(lambda r: F.lit(r.before)), [F.lit(r) for r in ranks])

    def value(place: float) -> float:
        low, high = math.floor(place), math.ceil(place)
        a, b = (next(r.lo for r in found if r.before <= i < r.before + r.n) for i in (low, high))
        return a if low == high or a == b else (high - place) * a + (place - low) * b

    double = lambda v: F.lit(v).cast("double")
    return df.sparkSession.range(1, numPartitions=1).select(F.lit(total).cast("long").alias("n"), double(mean).alias("mean"), F.array(*(double(value(p) if found else None) for p in places)).alias("q"))


def latency(df: DataFrame, by: list[str], col: str, failed: Column, slow: float) -> DataFrame:
    """Percentiles, and the shares of failed and of slow requests."""
    p = F.percentile(col, [0.5, 0.75, 0.95, 0.99])
    return df.groupBy(*by).agg(p.alias("p"), F.count("*").alias("n"), F.avg(F.when(failed, 1.0).otherwise(0.0)).alias("error_rate"), F.avg(F.when(F.col(col) > slow, 1.0).otherwise(0.0)).alias("degraded_rate")).select(
        *by, "n", *(F.col("p")[i].alias(x) for i, x in enumerate(("p50", "p75", "p95", "p99"))), "error_rate", "degraded_rate"
    )


#: Seconds and percents within which a load test passes.
LIMITS = {"p50": 0.5, "p95": 3.0, "p99": 8.0, "error_rate": 0.005, "degraded_rate": 0.05}


def graded(figures: DataFrame, limits: dict[str, float] = LIMITS) -> DataFrame:
    """``grade``: PASS, or FAIL with the figures that are over their limit."""
    over = F.array_compact(F.array(*(F.when(F.col(c) >= v, F.lit(c)) for c, v in limits.items())))
    return figures.withColumn("grade", F.when(F.size(over) == 0, "PASS").otherwise(F.concat(F.lit("FAIL: "), F.array_join(over, ","))))


def speaker_table(df: DataFrame, speaker: str, words: Column, day: str, n: int = 40, *, party: str = "party", gender: str = "gender") -> DataFrame:
    """The n speakers of most turns: turns, commonest party and gender, first speech, questions, interjections, days and words."""
    d = df.withColumn("_w", words)
    g = d.groupBy(speaker).agg(
        F.count("*").alias("turns"), mode(party).alias("party"), mode(gender).alias("gender"), F.max(F.coalesce("first_speech", F.lit(0))).alias("first_speech"),
        F.count_if(F.col("question") == 1).alias("questions"), F.count_if(F.col("interject") == 1).alias("interjections"), F.countDistinct(day).alias("days"),
        F.sum("_w").alias("words"), F.avg("_w").alias("mean_words"),
    )
    return g.orderBy(F.desc("turns"), speaker).limit(n)


def drift(df: DataFrame, order: list[str], col: str, part: float = 0.1) -> DataFrame:
    """Mean of the last part of the rows over that of the first; ranks come from a global sort, not from one task's window."""
    n = df.count()
    k = max(1, int(n * part))
    head, tail = df.orderBy(*order).limit(k), df.orderBy(*(F.desc(c) for c in order)).limit(k)
    return head.agg(F.avg(col).alias("first")).join(F.broadcast(tail.agg(F.avg(col).alias("last")))).withColumn("ratio", F.col("last") / F.col("first"))


def gini(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The concentration of values within each key: 0 for equal ones or none."""
    w = Window.partitionBy(*by).orderBy(value)
    d = df.withColumn("_i", F.row_number().over(w)).withColumn("_n", F.count("*").over(Window.partitionBy(*by)))
    return d.groupBy(*by).agg((F.sum((2 * F.col("_i") - F.col("_n") - 1) * F.col(value)) / F.sum(F.col(value) * F.col("_n"))).alias("gini")).na.fill(0.0, ["gini"])


def top_share(df: DataFrame, by: list[str], value: str, k: int = 5, ties: tuple[str, ...] = ()) -> DataFrame:
    """The share of the k largest values."""
    w = Window.partitionBy(*by).orderBy(F.desc(value), *ties)
    return df.withColumn("_r", F.row_number().over(w)).groupBy(*by).agg((F.sum(F.when(F.col("_r") <= k, F.col(value)).otherwise(0)) / F.sum(value)).alias("top_share"))


def rate(counts: DataFrame, totals: DataFrame, key: str, n: str, total: str, per: int = 10_000) -> DataFrame:
    return counts.join(totals, key).withColumn("rate", per * F.col(n).cast("double") / F.col(total))


def spikes(df: DataFrame, period: str, factor: float = 2.0) -> DataFrame:
    """Periods with more than ``factor`` times the mean count over the periods that there are."""
    n = df.groupBy(period).agg(F.count("*").alias("n"))
    return n.join(F.broadcast(n.agg(F.avg("n").alias("mean")))).where(F.col("n") > factor * F.col("mean"))


def compact(df: DataFrame, by: list[str], part: str, name: str = "series") -> DataFrame:
    """``a(3) b(1)``: counts by part in one text for each key."""
    n = df.groupBy(*by, part).agg(F.count("*").alias("n"))
    listed = F.array_sort(F.collect_list(F.struct(F.col(part).alias("p"), "n")))
    return n.groupBy(*by).agg(F.array_join(F.transform(listed, lambda x: F.concat(x["p"].cast("string"), F.lit("("), x["n"].cast("string"), F.lit(")"))), " ").alias(name), F.sum("n").alias("n"))


def of_top(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the n most frequent keys."""
    return df.join(F.broadcast(top(df.where(F.col(key).isNotNull()), [key], n).select(key)), key, "left_semi")


def several(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Keys with more than one value of any of the columns; NULLs don't count."""
    return df.groupBy(key).agg(*(F.countDistinct(c).alias(f"n_{c}") for c in cols)).where(reduce(lambda a, b: a | b, (F.col(f"n_{c}") > 1 for c in cols)))


def frequent_values(df: DataFrame, key: str, of: str, least: float = 0.10) -> DataFrame:
    """Of each key the values that at least this share of its rows have, as a sorted list."""
    n = df.groupBy(key, of).agg(F.count("*").alias("n"))
    n = n.withColumn("s", F.col("n") / F.sum("n").over(Window.partitionBy(key))).where(F.col(of).isNotNull() & (F.col("s") >= least))
    return n.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(of)), ",").alias("kept"))


def words(df: DataFrame, text: str, pattern: str, stop: tuple[str, ...], n: int) -> DataFrame:
    """The n most frequent words that fit the pattern."""
    w = df.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(pattern), F.lit(0))).alias("word"))
    return top(w.where(~F.col("word").isin(*stop)) if stop else w, ["word"], n)


def bigrams(df: DataFrame, text: str, order: str, n: int, least: int = 4) -> DataFrame:
    """The n most frequent pairs of adjacent words; ties by where they first occur."""
    w = df.select(F.col(order).alias("_o"), F.filter(F.split(F.regexp_replace(F.lower(F.col(text)), "[^a-z]+", " "), " "), lambda x: F.length(x) >= least).alias("w"))
    pairs = w.select("_o", F.posexplode(F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))).alias("_i", "gram"))
    return pairs.groupBy("gram").agg(F.count("*").alias("n"), F.min(F.struct("_o", "_i")).alias("_first")).orderBy(F.desc("n"), "_first").limit(n).select("gram", "n")


def seeds(df: DataFrame, text: str, order: str, n: int = 20, pairs: int = 15, most: int = 100, stop: tuple[str, ...] = SEED_STOP) -> DataFrame:
    """``position``, ``seed`` and ``n``: the most frequent pairs of adjacent words, then single words up to n seeds.

    The first ``most`` rows are the operator's own limit. Words are four ASCII
    letters or more between other characters, single ones five; pairs go over shorter
    words and the ends of texts, not over stop words; ties by where they first occur.
    """
    at = Window.orderBy("_o")
    found = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    d = df.orderBy(order, text).limit(most).withColumn("_o", F.row_number().over(Window.orderBy(order, text)))
    d = d.select("_o", F.filter(found, lambda x: x.rlike("^[a-z]{4,}$")).alias("_w")).where(F.size("_w") > 0)
    d = d.withColumn("_next", F.lead(F.get("_w", F.lit(0))).over(at))
    d = d.select("_o", F.posexplode(F.transform("_w", lambda x, i: F.struct(x.alias("a"), F.coalesce(F.get("_w", i + 1), F.col("_next")).alias("b")))).alias("_i", "_p"))
    a, b = F.col("_p.a"), F.col("_p.b")
    both = F.when(~a.isin(*stop) & ~b.isin(*stop), F.concat_ws(" ", a, b))
    one = F.when(~a.isin(*stop) & (F.length(a) >= 5), a)
    long = d.select("_o", "_i", F.posexplode(F.array(both, one)).alias("_kind", "seed")).where("seed IS NOT NULL")
    c = long.groupBy("_kind", "seed").agg(F.count("*").alias("n"), F.min(F.struct("_o", "_i")).alias("_first"))
    c = c.withColumn("_r", F.row_number().over(Window.partitionBy("_kind").orderBy(F.desc("n"), "_first"))).where(F.col("_r") <= max(n, pairs)).where((F.col("_kind") == 1) | (F.col("_r") <= pairs))
    return c.withColumn("position", F.row_number().over(Window.orderBy("_kind", "_r"))).where(F.col("position") <= n).select("position", "seed", "n")
