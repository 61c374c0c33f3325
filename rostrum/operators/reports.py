"""Parts of reports over matches, topics, divisions and annotations: each is one plan over a frame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.operators.aggregates import quantiles

#: Names that stand for no person, in lower case, and topics of nearly every day (looked for at the start, in any case).
NON_SPEAKERS = ("stage direction", "business start", "procedural text")
PROCEDURAL_NAMES = (
    "The PRESIDENT", "The SPEAKER", "The DEPUTY PRESIDENT",
    "The CHAIR", "The CHAIRMAN", "Stage direction", "Business start",
    "The Deputy Speaker", "The DEPUTY SPEAKER", "The Acting Deputy President",
    "The Acting President", "Procedural text",
)
PROCEDURAL_TOPICS = (
    r"QUESTIONS\s+WITHOUT\s+NOTICE",
    r"QUESTIONS\s+TO\s+(MR|THE)\s+SPEAKER",
    r"NOTICE(S)?\s+OF\s+MOTION",
    r"COMMITTEE(S)?",
    r"CONDOLENCE(S)?",
    r"ORDER\s+OF\s+BUSINESS",
    r"PERSONAL\s+EXPLANATION(S)?",
    r"DOCUMENT(S)?",
    r"PETITION(S)?",
    r"ADJOURNMENT",
    r"STATEMENTS?\s+BY\s+MEMBER(S)?",
    r"ROUTINE\s+OF\s+BUSINESS",
    r"BUSINESS\s+OF\s+THE\s+(SENATE|HOUSE)",
    r"FORMAL\s+MOTION(S)?",
    r"MATTERS?\s+OF\s+PUBLIC\s+IMPORTANCE",
    r"PRIVILEGE",
    r"MINISTERIAL\s+ARRANGEMENT(S)?",
    r"LEAVE\s+OF\s+ABSENCE",
    r"VALEDICTORY",
    r"APPROPRIATION\s+BILL",
    r"BUDGET",
    r"SENATE\s+ESTIMATES",
    r"ESTIMATES\s+COMMITTEE",
    r"BUSINESS$",
    r"NOTICES$",
    r"BILLS$",
    r"MOTIONS$",
    r"DISTINGUISHED\s+VISITOR(S)?$",
    r"PARLIAMENTARY\s+REPRESENTATION$",
    r"ANSWERS\s+TO\s+QUESTIONS",
    r"MINISTERIAL\s+STATEMENTS?$",
    r"QUESTIONS\s+ON\s+NOTICE$",
)
#: Words of which a lower topic has one if it is about legislation, in any case.
LEGISLATIVE = ("BILL", "ACT", "SCHEME", "INQUIRY", "REVIEW", "STATEMENT", "TREATY", "PROTOCOL", "AGREEMENT", "POLICY", "STRATEGY", "FRAMEWORK", "REGULATION", "INSTRUMENT")


def listed(col: Column | str, glue: str = ",") -> Column:
    """Aggregate: the distinct values, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(col)), glue)


# counts

def sets_and_ranges(df: DataFrame, by: list[str], members: str, value: str) -> DataFrame:
    """The set of members, its size, and the range of a value."""
    return df.groupBy(*by).agg(listed(members).alias("members"), F.min(value).alias("least"), F.max(value).alias("most"), F.countDistinct(members).alias("n_members"), F.count("*").alias("n"))


def conditional_label(df: DataFrame, by: list[str], one: Column, names: tuple[str, str, str] = ("Both", "Closed", "Open")) -> DataFrame:
    """``label`` of each key by which of two kinds of rows it has; both with their numbers."""
    n = df.groupBy(*by).agg(F.count_if(one).alias("a"), F.count_if(~one).alias("b"))
    return n.withColumn("label", F.when((F.col("a") > 0) & (F.col("b") > 0), F.format_string(f"{names[0]} (%d/%d)", "a", "b")).when(F.col("a") > 0, names[1]).otherwise(names[2]))


def peak(df: DataFrame, period: str) -> DataFrame:
    """The period of most rows, the earliest of equals, and their number."""
    n = df.groupBy(period).agg(F.count("*").alias("n"))
    return n.agg(F.max_by(period, F.struct("n", -F.col(period))).alias("peak"), F.max("n").alias("n"))


def nested(df: DataFrame, outer: str, inner: str, member: str) -> DataFrame:
    """``tree``, the inner groups of each outer one with their members."""
    groups = df.groupBy(outer, inner).agg(F.array_join(F.array_sort(F.collect_list(member)), ",").alias("_m"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(inner).alias("g"), "_m"))), lambda x: F.concat(x["g"], F.lit(":"), x["_m"]))
    return groups.groupBy(outer).agg(F.array_join(lines, ";").alias("tree"))


def topic_months(df: DataFrame, topic: str, day: str) -> DataFrame:
    """The months in which each topic came up."""
    return df.groupBy(topic).agg(listed(F.date_format(day, "yyyy-MM")).alias("months"))


def topic_calendar(topics: DataFrame) -> DataFrame:
    """``topic`` and its days; upper topics, and lower ones without a comma that speak of legislation; no procedural ones.

    ``topics``: ``date``, ``level`` (0 is upper), ``topic``.
    """
    words = "(?i)" + "|".join(rf"\b{w}\b" for w in LEGISLATIVE)
    lower = (F.col("level") == 1) & ~F.contains("topic", F.lit(",")) & F.col("topic").rlike(words)
    named = topics.where((F.col("level") == 0) | lower).withColumn("topic", F.upper(F.trim("topic")))
    real = named.where((F.col("topic") != "") & ~F.col("topic").rlike(f"(?i)^(?:{'|'.join(PROCEDURAL_TOPICS)})"))
    return real.groupBy("topic").agg(listed(F.date_format("date", "yyyy-MM-dd")).alias("days"))


def topic_days(df: DataFrame, topics: DataFrame, key: str, n: int) -> DataFrame:
    """The n topics and days of most rows; a report's top."""
    return df.join(topics, key).groupBy("topic", "date").agg(F.count("*").alias("turns")).orderBy(F.desc("turns"), "date", "topic").limit(n)


def usage(events: DataFrame, day: Column, user: str, hit: Column, days: int = 90) -> DataFrame:
    """Events, users, hits and their share of each of the last days, zeros where there are none."""
    c = events.groupBy(day.alias("day")).agg(F.count("*").alias("n"), F.countDistinct(user).alias("users"), F.count_if(hit).alias("hits"), (F.avg(F.when(hit, 1.0).otherwise(0.0)) * 100).alias("hit_pct"))
    span = c.agg(F.max("day").alias("b")).select(F.explode(F.sequence(F.date_sub("b", days - 1), "b")).alias("day"))
    return span.join(c, "day", "left").na.fill(0)


def feedback(notes: DataFrame, by: list[str], good: Column, at: str, issues: Column, top: int = 3) -> DataFrame:
    """Good and bad notes, when first and last, and the commonest issue codes (``issues``: an array of each note)."""
    own = notes.groupBy(*by).agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"), F.min(at).alias("first_seen"), F.max(at).alias("last_seen"))
    codes = notes.select(*by, F.explode(issues).alias("code")).groupBy(*by, "code").agg(F.count("*").alias("k"))
    w = Window.partitionBy(*by).orderBy(F.desc("k"), "code")
    most = codes.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top)
    named = most.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "code", "k"))), lambda x: F.concat(x["code"], F.lit(":"), x["k"].cast("string"))), ",").alias("issues"))
    return own.join(named, by, "left").withColumn("issues", F.coalesce("issues", F.lit("")))


def answered(df: DataFrame, by: list[str], said: Column) -> DataFrame:
    """How many flags, in whatever words, mean yes."""
    yes = F.lower(said).isin("true", "yes", "1")
    return df.groupBy(*by).agg(F.count_if(yes).alias("answered"), F.count_if(~yes).alias("unanswered"))


def ordered_counts(df: DataFrame, col: str, wanted: list) -> DataFrame:
    """Counts in the order of a list, zero for what isn't there."""
    keys = df.sparkSession.createDataFrame(list(enumerate(wanted, 1)), f"i int, `{col}` {df.schema[col].dataType.simpleString()}")
    return F.broadcast(keys).join(df.groupBy(col).agg(F.count("*").alias("n")), col, "left").na.fill(0, ["n"]).select("i", col, "n")


def completeness(df: DataFrame, cols: list[str]) -> DataFrame:
    """Percent of rows that have a value, for each column."""
    return df.agg(*(F.round(100.0 * F.count(c) / F.count("*"), 4).alias(c) for c in cols))


def by_key_ratio(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Counts of two tables by a key that both have, and their ratio."""
    n, m = (d.groupBy(key).agg(F.count("*").alias(c)) for d, c in ((a, "a"), (b, "b")))
    return n.join(m, key).withColumn("ratio", F.col("a") / F.col("b"))


def ratio_figures(ratios: DataFrame, col: str = "ratio", *, few: bool = False) -> DataFrame:
    """Mean, median and the outer twentieths; of ``few`` ratios, as one for each day, by one aggregate that holds them."""
    at = [0.05, 0.5, 0.95]
    d = ratios.agg(F.avg(col).alias("mean"), F.percentile(col, at).alias("q")) if few else quantiles(ratios, col, at)
    return d.select(F.round("mean", 4).alias("mean"), *(F.round(F.col("q")[i], 4).alias(c) for i, c in enumerate(("p5", "median", "p95"))))


def compare(a: DataFrame, b: DataFrame, words: Column, speaker: str, interjects: Column, cols: list[str]) -> DataFrame:
    """Two corpora (``date``) as rows of ``what``, ``key``, ``a`` and ``b``.

    Percent of values that are there; and within the days that both span, words by
    year, the speakers of days that both have as ratios, and percent of interjections.
    """
    def full(d: DataFrame, side: str) -> DataFrame:
        return d.agg(*(F.round(100.0 * F.count(c) / F.count("*"), 4).alias(c) for c in cols)).unpivot([], cols, "key", side).withColumn("what", F.lit("complete"))

    span = a.agg(F.min("date").alias("a0"), F.max("date").alias("a1")).join(F.broadcast(b.agg(F.min("date").alias("b0"), F.max("date").alias("b1"))))
    span = span.select(F.greatest("a0", "b0").alias("_from"), F.least("a1", "b1").alias("_to"))
    x, y = (d.join(F.broadcast(span), F.col("date").between(F.col("_from"), F.col("_to"))) for d in (a, b))

    def years(d: DataFrame, side: str) -> DataFrame:
        return d.groupBy(F.year("date").cast("string").alias("key")).agg(F.sum(words).cast("double").alias(side)).withColumn("what", F.lit("words"))

    def spoken(d: DataFrame, side: str) -> DataFrame:
        return d.groupBy("date").agg(F.countDistinct(speaker).alias(side))

    def cut(d: DataFrame, side: str) -> DataFrame:
        return d.agg(F.round(100 * F.avg(F.when(interjects, 1.0).otherwise(0.0)), 4).alias(side)).select(F.lit("interjections").alias("what"), F.lit("pct").alias("key"), side)

    ratio = ratio_figures(spoken(x, "a").join(spoken(y, "b"), "date").select((F.col("a") / F.col("b")).alias("ratio")), few=True)
    figures = ratio.unpivot([], ["mean", "p5", "median", "p95"], "key", "a").select(F.lit("speakers").alias("what"), "key", "a", F.lit(None).cast("double").alias("b"))
    parts = [f(a if f is full else x, "a").join(f(b if f is full else y, "b"), ["what", "key"]).select("what", "key", "a", "b") for f in (full, years, cut)]
    return reduce(DataFrame.union, [*parts, figures])


def spikes(df: DataFrame, period: str, name: str, side: str, skip: Column, factor: float = 2.0, top: int = 3) -> DataFrame:
    """Periods of more than ``factor`` times the mean of those there are, with their first speakers (other than ``skip``).

    Columns: the period, ``n``, ``mean``, ``ratio``, ``speakers`` (``name (side): rows``, most first, by name among equals).
    """
    c = df.groupBy(period).agg(F.count("*").alias("n"))
    over = c.join(F.broadcast(c.agg(F.avg("n").alias("mean")))).where(F.col("n") > factor * F.col("mean"))
    k = df.where(~F.coalesce(skip, F.lit(False))).join(F.broadcast(over.select(period)), period).groupBy(period, name, side).agg(F.count("*").alias("k"))
    w = Window.partitionBy(period).orderBy(F.desc("k"), name, side)
    first = k.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top)
    text = F.transform(F.array_sort(F.collect_list(F.struct("_r", F.concat(F.col(name), F.lit(" ("), F.coalesce(F.col(side), F.lit("")), F.lit("): "), F.col("k").cast("string")).alias("s")))), lambda x: x["s"])
    said = first.groupBy(period).agg(F.array_join(text, "; ").alias("speakers"))
    return over.join(said, period, "left").select(period, "n", F.round("mean", 1).alias("mean"), F.round(F.col("n") / F.col("mean"), 1).alias("ratio"), F.coalesce("speakers", F.lit("")).alias("speakers"))


def headline(df: DataFrame, negative: Column, value: str, tops: list[str]) -> DataFrame:
    """Percent of values that are negative, and the commonest value of each column (the last by name among equals)."""
    out = df.agg(F.round(100.0 * F.count_if(negative) / F.count(value), 4).alias("pct_negative"))
    for c in tops:
        n = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
        out = out.join(F.broadcast(n.agg(F.max_by(c, F.struct("n", c)).alias(f"top_{c}"))))
    return out


def stats_block(df: DataFrame, cols: list[str], crossed: list[tuple[str, str]], speaker: str, skip: str, top: int = 15) -> DataFrame:
    """Value counts of columns, crosstabs and the first speakers, as rows of ``what``, ``key`` and ``n``."""
    plain = [df.where(F.col(c).isNotNull()).groupBy(F.lit(c).alias("what"), F.col(c).cast("string").alias("key")).agg(F.count("*").alias("n")) for c in cols]
    pairs = [df.groupBy(F.lit(f"{a} x {b}").alias("what"), F.concat_ws(" x ", F.coalesce(F.col(a).cast("string"), F.lit("none")), F.coalesce(F.col(b).cast("string"), F.lit("none"))).alias("key")).agg(F.count("*").alias("n")) for a, b in crossed]
    said = df.where(~F.startswith(F.lower(speaker), F.lit(skip))).groupBy(F.lit("speakers").alias("what"), F.col(speaker).alias("key")).agg(F.count("*").alias("n"))
    return reduce(DataFrame.union, [*plain, *pairs, said.orderBy(F.desc("n"), "key").limit(top)])


# rows

def first_mentions(df: DataFrame, key: str, order: str, keep: list[str]) -> DataFrame:
    """Of each key the row that comes first, by one aggregate."""
    return df.groupBy(key).agg(F.min(order).alias(order), *(F.min_by(c, order).alias(c) for c in keep))


def latest_and_first(df: DataFrame, key: str, order: list[str], latest: str, first: str, tie: str) -> DataFrame:
    """The last value of one column and the first of another."""
    return df.groupBy(key).agg(F.max_by(latest, F.struct(*order)).alias("latest"), F.min_by(first, tie).alias("first"))


def citation_numbers(df: DataFrame, key: str, order: str) -> DataFrame:
    """Numbers of keys by where each first occurs; a rank over one row for each key."""
    first = df.groupBy(key).agg(F.min(order).alias("_f"))
    return first.select(key, F.dense_rank().over(Window.orderBy("_f")).alias("citation"))


def members_of(df: DataFrame, key: str, other: DataFrame, own: DataFrame) -> DataFrame:
    """Rows whose key the other table has and the own one hasn't."""
    return df.join(other.select(key).distinct(), key, "left_semi").join(own.select(key).distinct(), key, "left_anti")


def top_of_all(frames: list[DataFrame], order: list[Column], n: int) -> DataFrame:
    """O3: the first rows of a union, of which each part is cut before."""
    return reduce(DataFrame.unionByName, [f.orderBy(*order).limit(n) for f in frames]).orderBy(*order).limit(n)


def in_text_order(df: DataFrame, key: str) -> DataFrame:
    """All rows in the order of an id as text."""
    return df.orderBy(F.col(key).cast("string"))


def bound(frames: list[DataFrame]) -> DataFrame:
    """All rows of tables that lack some of each other's columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that only one of the tables has, and which (``side``)."""
    return a.subtract(b).withColumn("side", F.lit("a")).union(b.subtract(a).withColumn("side", F.lit("b")))


def unused(df: DataFrame, phrase: Column, used: DataFrame) -> DataFrame:
    """Counts of phrases that a table of used ones (``phrase``) hasn't."""
    return df.groupBy(phrase.alias("phrase")).agg(F.count("*").alias("n")).join(used.select("phrase").distinct(), "phrase", "left_anti")


def excluded(df: DataFrame, name: str | None, body: str, framing: str, summary: str, wrong: str, procedural: str, error: str | None = None) -> DataFrame:
    """without procedural names and texts, false positives of a subject and rows with an annotation error."""
    d = df.where(~F.coalesce(F.col(body).rlike(procedural), F.lit(False)))
    d = d.where(~(F.coalesce(F.col(framing).cast("string"), F.lit("")) == "") | ~F.coalesce(F.col(summary), F.lit("")).rlike(f"(?i){wrong}"))
    if name:
        d = d.where(~F.coalesce(F.lower(name).isin(*NON_SPEAKERS) | F.col(name).isin(*PROCEDURAL_NAMES), F.lit(False)))
    return d.where(F.coalesce(F.col(error), F.lit("")) == "") if error else d


def assembled(df: DataFrame, key: str, order: str, question: Column, answer: Column, line: Column, body: str, source: str) -> DataFrame:
    """A row for each exchange: turns, first question and answer (the first and the last turn where there is none), transcript, and where it matched."""
    rows = F.array_sort(F.collect_list(F.struct(order, line.alias("line"))))
    of = lambda cond: F.min_by(F.when(cond, F.col(body)), F.when(cond, F.col(order)))
    asked, replied = F.bool_or(question & (F.col(source) == "search")), F.bool_or(answer & (F.col(source) == "search"))
    return df.groupBy(key).agg(
        F.count("*").alias("turns"),
        F.coalesce(of(question), F.min_by(body, order)).alias("question"),
        F.coalesce(of(answer), F.max_by(body, order)).alias("answer"),
        F.array_join(F.transform(rows, lambda x: x["line"]), "\n").alias("transcript"),
        F.when(asked & replied, "both").when(asked, "question").when(replied, "answer").otherwise("").alias("org_mentioned_in"),
    )


def record(header: list[Column], body: str, focal: Column, most: int = 600) -> Column:
    """Header fields joined, with an excerpt of the text of focal rows."""
    return F.concat_ws(" | ", *header, F.when(focal, F.left(body, F.lit(most))))


def division_result(df: DataFrame, by: list[str], vote: str, aye: str, noe: str) -> DataFrame:
    """Votes of either side and which carries."""
    d = df.groupBy(*by).agg(F.count_if(F.col(vote) == aye).alias("ayes"), F.count_if(F.col(vote) == noe).alias("noes"))
    return d.withColumn("result", F.when(F.col("ayes") > F.col("noes"), "aye").when(F.col("ayes") < F.col("noes"), "noe").otherwise("tie"))


def split_rows(df: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """A text's parts as rows of their own, numbered anew; the pattern may look ahead, so that nothing is lost. Blank parts go."""
    parts = df.select(key, F.posexplode(F.split(text, pattern, -1)).alias("_i", "part")).where("trim(part) <> ''")
    return parts.select(key, F.row_number().over(Window.partitionBy(key).orderBy("_i")).alias("at"), "part")


def without_answer(df: DataFrame, keys: list[str], order: str, kind: str, question: str, answer: str) -> DataFrame:
    """Questions that no answer follows at once."""
    d = df.withColumn("_next", F.lead(kind).over(Window.partitionBy(*keys).orderBy(order)))
    return d.where((F.col(kind) == question) & (F.coalesce("_next", F.lit("")) != answer)).drop("_next")


def repaired_flags(df: DataFrame, keys: list[str], order: str, body: str, askers: list[str], *, question: str = "question", answer: str = "answer") -> DataFrame:
    """Turns that call for a question by one of the phrases are questions, and the next turn that isn't is its answer."""
    said = F.lower(body).rlike("|".join(f"\\Q{a.lower()}\\E" for a in askers))
    w = Window.partitionBy(*keys).orderBy(order)
    d = df.withColumn("_q", F.coalesce(said | (F.col(question) == 1), F.lit(False))).withColumn("_after", F.coalesce(F.lag("_q").over(w), F.lit(False)))
    return d.withColumn(question, F.col("_q").cast("int")).withColumn(answer, F.when(F.col("_q"), 0).when(F.col("_after"), 1).otherwise(F.coalesce(answer, F.lit(0)))).drop("_q", "_after")


def corrected(df: DataFrame, corrections: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Values of a table of corrections, where it has one for the row; a null there corrects nothing. One correction for each key, the first by ``ordinal``."""
    first = corrections.groupBy(*keys).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ordinal"))).alias(f"_{c}") for c in cols))
    joined = df.join(first, keys, "left")
    return joined.select(*(F.coalesce(f"_{c}", c).alias(c) if c in cols else F.col(c) for c in df.columns))


def bad_stamps(df: DataFrame, stamp: str) -> DataFrame:
    """Rows whose time isn't one of a day."""
    return df.where(F.col(stamp).isNotNull() & ~F.col(stamp).rlike(r"^(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d)?$"))


def linked(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """All keys of two tables with what either has, and whether both do."""
    x, y = a.withColumn("_a", F.lit(True)), b.withColumn("_b", F.lit(True))
    return x.join(y, key, "full").withColumn("both", F.col("_a").isNotNull() & F.col("_b").isNotNull()).drop("_a", "_b")


def long_rows(df: DataFrame, ids: list[str], values: dict[str, str]) -> DataFrame:
    """Wide to long; ``values`` maps columns to names."""
    return df.unpivot(ids, [F.col(c).alias(n) for c, n in values.items()], "name", "value")


def wide_rows(df: DataFrame, key: str, name: str, names: list, value: str) -> DataFrame:
    """Long to wide, sums of what comes more than once."""
    return df.groupBy(key).pivot(name, names).agg(F.sum(value))


def with_list(df: DataFrame, other: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """A column with all values of another table, empty where there are none."""
    s = other.groupBy(key).agg(listed(F.col(value).cast("string")).alias(name))
    return df.join(s, key, "left").withColumn(name, F.coalesce(name, F.lit("")))


def sampled(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """SA3: a share of the rows by a hash of their key: the same ones however the table is cut."""
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))


def workload(spark, buckets: dict[str, tuple[float, list[str]]], n: int, seed: int = 42) -> DataFrame:
    """SA4: ``n`` searches, dealt to buckets by weight and within a bucket evenly, by a seed."""
    import random

    rng = random.Random(seed)
    names = list(buckets)
    picked = rng.choices(names, [buckets[b][0] for b in names], k=n)
    return spark.createDataFrame([(i, b, rng.choice(buckets[b][1])) for i, b in enumerate(picked)], "i int, bucket string, expression string")
