"""Queries that take whole tables: nothing is left out, whatever the keys are."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rostrum.operators import aggregates as A
from rostrum.operators import joins as J
from rostrum.operators import selection as L
from rostrum.operators import windows as W
from rostrum.queries import QUERIES
from rostrum.streaming import logs
from tests.oracle import DATA


@pytest.mark.parametrize("name", ["j3_asof_all", "j5_shortest_spell_all", "j16_any_term_all"])
def test_every_line_is_looked_up(spark, name):
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").selectExpr("l_orderkey", "to_date(l_shipdate) AS day")
    orders = spark.read.parquet(f"{DATA}/orders.parquet").selectExpr("o_orderkey AS l_orderkey")
    wanted = {tuple(r) for r in lines.join(orders, "l_orderkey", "left_semi").collect()}
    got = [(r.l_orderkey, r.day) for r in QUERIES[name](spark, DATA).collect()]
    assert len(got) == len(wanted) and set(got) == wanted


def seeds_by_hand(texts, stop, n=20):
    words = [w for x in texts[:100] for w in re.findall(r"\b[a-zA-Z]{4,}\b", (x or "").lower())]
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:]) if a not in stop and b not in stop]
    top = Counter(pairs).most_common(15)
    return (top + Counter(w for w in words if w not in stop and len(w) >= 5).most_common(n - len(top)))[:n]


@pytest.mark.parametrize("size", [2, 40])
def test_seeds(spark, size):
    texts = [f"Water budgets that water budgets, don't {'river' * (i % 3 + 1)} caf\u00e9teria word{i} plan_ning after" if i % 4 else None if i % 8 else "Minister of climate" for i in range(150)]
    texts = [f"{x} reform{chr(97 + i % size % 26)}abc" if x else x for i, x in enumerate(texts)]
    df = spark.createDataFrame([(1000 + 7 * i, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = [(r.seed, r.n) for r in A.seeds(df, "text", "doc_id").orderBy("position").collect()]
    assert got == seeds_by_hand(texts, A.SEED_STOP) and any(" " not in s for s, _ in got)


def test_text_order_of_all(spark):
    ids = [r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect()]
    got = [r.doc_id for r in QUERIES["o4_text_order_all"](spark, DATA).collect()]
    assert len(ids) > 50 and got == sorted(ids, key=str)


def test_names_are_guarded_by_date(spark):
    dim = spark.createDataFrame([(1, 1, ["SMITH", "Mr Smith"]), (2, 2, ["SMITH"]), (3, 3, ["Jones"]), (4, 4, ["Brown"]), (5, 5, ["Green"])], "id int, ordinal int, forms array<string>")
    spells = spark.createDataFrame([(1, "1901-01-01", "1910-12-31"), (1, "1920-01-01", None), (3, None, "1950-01-01"), (4, None, None), (4, "1901-01-01", "1902-01-01")], "id int, start string, end string")
    spells = spells.selectExpr("id", "date(start) AS start", "date(end) AS end")
    cases = [("SMITH", "1905-05-05", 1), ("smith", "1910-12-31", 1), ("SMITH", "1915-01-01", None), ("mr smith", "1990-01-01", 1), ("Jones", "1950-01-01", 3), ("Jones", "1950-01-02", None)]
    cases += [("brown", "2000-01-01", 4), ("Green", "2000-01-01", 5), ("Grey", "2000-01-01", None), (None, "2000-01-01", None), ("SMITH", None, None), ("Green", None, 5), ("Brown", None, 4)]
    df = spark.createDataFrame([(i, n, d) for i, (n, d, _) in enumerate(cases)], "i int, name string, day string").selectExpr("i", "name", "date(day) AS day")
    got = {r.i: r.id for r in J.match_forms(df, dim, "name", "forms", "id", "ordinal", "day", spells).collect()}
    assert got == {i: v for i, (_, _, v) in enumerate(cases)}


def test_budget_adds_first_mention_and_caps_speakers(spark):
    rows = [(k, 1990 + k // 50, "a" if k % 50 < 40 else f"b{k % 3}", k // 2, float(k % 50)) for k in range(100)]
    df = spark.createDataFrame(rows, "k int, y int, who string, d int, score double")
    plain = {r.k for r in L.budget(df, "y", "who", "score", "k", 20).collect()}
    got = [r.k for r in L.budget_whole(df, "y", "who", "score", "k", "d", 20).collect()]
    wanted, seen = [], {}
    for k in sorted(plain | {0}):
        who = rows[k][2]
        seen[who] = seen.get(who, 0) + 1
        if seen[who] <= max(3, round(0.15 * len(plain | {0}))):
            wanted.append(k)
    assert 0 not in plain and 0 in got and sorted(got) == wanted and len(wanted) < len(plain)


def test_first_entries_fall_back_to_the_first_turn(spark):
    entries = spark.sql("SELECT k, date(s) AS start, date(e) AS end FROM VALUES ('a', '1910-01-01', '1911-01-01'), ('b', '1900-01-01', '1901-01-01'), ('b', '1910-01-01', '1911-01-01'), ('c', '1900-01-01', '1901-01-01') AS t(k, s, e)")
    turns = spark.sql("SELECT k, date(d) AS date, n AS turn_id FROM VALUES ('a', '1905-01-01', 2), ('a', '1904-01-01', 1), ('b', '1899-01-01', 3), ('b', '1900-05-05', 4) AS t(k, d, n)")
    assert {(r.k, r.start.year, r.turn_id) for r in W.first_events(entries, turns, "k").collect()} == {("a", 1910, 1), ("b", 1900, 4)}


def test_streamed_users_are_exact(spark, tmp_path):
    ev = spark.range(40000).select((F.col("id") % 9000).alias("user_id"), F.when(F.col("id") % 3 > 0, "view").otherwise("click").alias("event_type"), F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 4)").alias("ts"))
    ev = ev.unionByName(ev.limit(5).withColumn("user_id", F.lit(None).cast("long")))
    ev.write.parquet(str(tmp_path / "in"))
    wanted = {tuple(r) for r in ev.groupBy(F.to_date("ts"), "event_type").agg(F.count("*"), F.countDistinct("user_id")).collect()}
    q = logs.daily_usage(spark.readStream.schema(ev.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("exact_usage").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("exact_usage").collect()} == wanted
