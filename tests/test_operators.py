"""Order-sensitive operators against the sequential definitions, and small edge rows."""

import random

from pyspark.sql import functions as F

from rostrum.functions import excerpts as X
from rostrum.functions import scalars as S
from rostrum.operators import aggregates as A
from rostrum.operators import joins as J
from rostrum.operators import reports as R
from rostrum.operators import selection as L
from rostrum.operators import validation as V
from rostrum.operators import windows as W
from rostrum.operators.search import Engine, Request
from rostrum.sources import proceedings, tables
from rostrum.streaming import logs


def pairs_by_hand(day):
    out = {}
    for i, (m, q, a) in enumerate(day):
        if m:
            prev = next((j for j in range(i - 1, -1, -1) if day[j][1]), None)
            out[i] = ("search", i if q else prev if a else None)
    extra = {}
    for i, (m, q, a) in enumerate(day):
        if m and q:
            n = next((j for j in range(i + 1, len(day)) if day[j][2]), None)
            if n is not None and not day[n][0]:
                extra[n] = ("question_answer", max(i, extra.get(n, ("", -1))[1]))
        elif m and a:
            p = next((j for j in range(i - 1, -1, -1) if day[j][1]), None)
            if p is not None and not day[p][0]:
                extra.setdefault(p, ("answer_question", p))
    return extra | out


def test_exchanges(spark):
    rng = random.Random(2)
    days = [[(rng.random() < 0.4, *rng.choice([(True, False), (False, True), (False, False)])) for _ in range(rng.randint(1, 9))] for _ in range(150)]
    rows = [(d, i, *x) for d, day in enumerate(days) for i, x in enumerate(day)]
    df = spark.createDataFrame(rows, "d int, o int, m boolean, q boolean, a boolean")
    got = {(r.d, r.o): (r.match_source, r.exchange_order) for r in W.exchanges(df, F.col("m"), F.col("q"), F.col("a"), ["d"], "o").collect()}
    assert got == {(d, i): v for d, day in enumerate(days) for i, v in pairs_by_hand(day).items()}


def test_times(spark):
    rows = [("a", 1, 1430.0), ("a", 2, None), ("a", 3, 10.0), ("a", 4, None), ("b", 1, None), ("b", 2, 60.0), ("b", 3, 40.0), ("c", 1, None)]
    d = spark.createDataFrame(rows, "d string, i int, t double")
    got = {(r.d, r.i): (r.t, r.time_est) for r in W.interpolate(W.unwrap_midnight(d, "t", ["d"], "i"), "t", ["d"], "i").collect()}
    assert got == {("a", 1): (1430, False), ("a", 2): (1440, True), ("a", 3): (1450, False), ("a", 4): (1450, True), ("b", 1): (60, True), ("b", 2): (60, False), ("b", 3): (40, False), ("c", 1): (None, False)}


def test_speech_numbers(spark):
    kinds = ["interjection", "speech", "interjection", "stage_direction", "interjection", "question", "division", "answer"]
    d = spark.createDataFrame([(0, i, k) for i, k in enumerate(kinds)], "d int, i int, k string")
    assert [r.speech_no for r in W.speech_numbers(d, F.col("k"), ["d"], "i").orderBy("i").collect()] == [None, 1, 1, None, None, 2, None, 3]
    assert [r.speech_no for r in W.speech_numbers(d, F.col("k"), ["d"], "i", historical=True).orderBy("i").collect()] == [0, 1, 1, 2, 2, 3, 4, 5]


def test_spells(spark):
    day = spark.createDataFrame([(1, "a", "2000-05-05", "old"), (2, "a", "2010-01-01", None), (3, "b", "2000-01-01", None), (4, "z", "2000-01-01", "kept")], "r int, k string, day string, p string").withColumn("day", F.to_date("day"))
    spells = spark.createDataFrame([("a", "2000-01-01", "2000-12-31", "X", 2), ("a", "2000-05-01", "2000-06-01", "Y", 3), ("a", None, None, "U", 1), ("b", None, None, "B", 1)], "k string, s string, e string, p string, ordinal int").select("k", F.to_date("s").alias("start"), F.to_date("e").alias("end"), "p", "ordinal")
    assert {r.r: r.p for r in J.as_of(day, spells, "k", "day", "p", "r").collect()} == {1: "X", 2: "U", 3: "B", 4: "kept"}
    assert {r.r: r.p for r in J.as_of(day, spells.where("start IS NOT NULL"), "k", "day", "p", "r", shortest=True).collect()} == {1: "Y", 2: "X", 3: None, 4: "kept"}


def test_scalars(spark):
    one = spark.range(1)
    ask = lambda **c: one.select(*(x.alias(k) for k, x in c.items())).first()
    r = ask(**{f"c{i}": S.clock(F.lit(x)) for i, x in enumerate(["14:01:02", "9:05", "2.30 pm", "12 am", "12,15 p.m.", "14.01", "25:00"])})
    assert list(r) == ["14:01:02", "09:05:00", "14:30:00", "00:00:00", "12:15:00", None, None]
    r = ask(a=S.spoken_name(F.lit("Mr TONY SMITH:"), F.lit(None).cast("string")), b=S.spoken_name(F.lit("Mr DEPUTY SPEAKER"), F.lit(None).cast("string")), c=S.spoken_name(F.lit("x"), F.lit("Canon")), d=S.surname_case(F.lit("McDonald")), e=S.surname_case(F.lit("O'Brien")), f=S.clean(F.lit("nan")), g=S.slug(F.lit("A & B | ~C!")), h=S.from_minutes(F.lit(1500.0)), i=S.word_count(F.lit("  a b ")))
    assert list(r) == ["Mr SMITH", "Mr DEPUTY SPEAKER", "Canon", "McDONALD", "O'BRIEN", None, "a-and-b-or-not-c", "01:00", 2]
    assert ask(a=S.has_interjection(F.lit("Mr Able interjecting—")), b=S.strip_interjections(F.lit("I say Opposition members interjecting— so")), c=S.parliament(F.lit(2011)), d=S.party_group(F.lit(None).cast("string"), "committee")) == (True, "I say so", 44, "Witness")


def test_validation(spark):
    rows = [("2000-01-01", 1, "p", "A", "x", "same words", 0), ("2000-01-01", 2, "p", "B", "x", "same words", 0), ("2000-01-01", 3, "q", "LP", "x", "talk (Time expired) and then much more than that", 0), ("2000-01-02", 1, "10000", "LP", "x", "(Time expired)", 0)]
    t = spark.createDataFrame(rows, "date string, order int, name_id string, party string, place string, body string, interject int").withColumn("date", F.to_date("date")).withColumn("unique_id", F.col("name_id"))
    sess = t.where("date = '2000-01-01'").select("date", F.col("date").alias("header_date")).distinct()
    bio = spark.createDataFrame([("p", "2001-01-01", None), ("q", None, "1999-01-01")], "unique_id string, b string, d string").select("unique_id", F.to_date("b").alias("birth_date"), F.to_date("d").alias("death_date"))
    terms = spark.createDataFrame([("p", None, "1999-01-01"), ("q", "1999-01-01", None)], "unique_id string, s string, e string").select("unique_id", F.to_date("s").alias("start"), F.to_date("e").alias("end"))
    found = V.validate(t, sess, spark.createDataFrame([("p",)], "name_id string"), bio, terms)
    assert sorted((r.test, str(r.date)) for r in found.collect()) == [("T1", "2000-01-02"), ("T2", "2000-01-01"), ("T3", "2000-01-01"), ("T4", "2000-01-01"), ("T5", "2000-01-01"), ("T6", "2000-01-01"), ("T6", "2000-01-01"), ("T7", "2000-01-01")]
    assert V.t6_alive(t, bio, house=True).count() == 1 and V.t7_term(t, terms, house=True).count() == 0
    assert {r.what: r.n for r in V.totals(t, found).collect()}["clean"] == 0


def test_selection(spark):
    d = spark.createDataFrame([(i, i % 3, f"s{i % 2}", float(i)) for i in range(20)], "k int, y int, s string, v double")
    assert L.broad(d, "y", F.col("v"), "k", 7).count() == 7 and L.broad(d, "y", F.col("v"), "k", 2).count() == 3
    assert L.cap_speakers(d, "s", ["k"]).count() == 6
    assert L.page_bounds(0, 5, 999) == (1, 200, 1) and L.page_bounds(101, 9, 50) == (3, 50, 3)
    assert A.gini(d.where("false"), ["s"], "v").count() == 0


XML21 = b"""<record version="2.1"><session.header><date>2001-02-03</date><chamber>Senate</chamber></session.header><chamber.xscript><business.start>The chair was taken at 2 pm</business.start>
<debate><debateinfo><title>WATER BILL</title><type>Bills</type></debateinfo><speech><talk.start><talker><name role="display">Able, Sen Ann</name><name.id>a1</name.id><party>LP</party><in.gov>1</in.gov></talker><para>\xe2\x80\x94First.</para></talk.start><para>Second.</para>
<interjection><talk.start><talker><name.id>b2</name.id></talker><para>No!</para></talk.start></interjection></speech>
<subdebate.1><subdebateinfo><title>Clause</title></subdebateinfo><question><talk.start><talker><name.id>c3</name.id></talker><para>Why?</para></talk.start></question></subdebate.1>
<division><division.header>That it pass</division.header><ayes><names><name>ABLE</name><name>BAKER</name></names></ayes><noes><names><name>CLARK</name></names></noes></division></debate></chamber.xscript></record>"""
XML22 = b"""<record version="2.2"><debate><debateinfo><title>D</title></debateinfo><speech><talk.start><talker><name.id>A1</name.id><name>Mr A</name></talker></talk.start><talk.text><body><p class="HPS-Normal"><a href="A1" type="MemberSpeech"><span class="HPS-MemberSpeech">Mr A</span></a> (<span class="HPS-Electorate">X</span>): begins</p><p>more</p>
<p><a href="b2" type="MemberInterjecting"><span class="HPS-MemberInterjecting">Ms B</span></a> interjecting</p><p class="HPS-DivisionPreamble">The House divided</p></body></talk.text></speech></debate><division><p>The question was: that it pass</p><p>AYES: 3</p><p>NOES: 5</p></division></record>"""
UPPER = b"""<RECORD><CHAMBER><DEBATE TITLE="OLD"><SPEECH SPEAKER="Mr C" NAMEID="cc" PARTY="ALP"><PARA>Early <INTERJECT NAMEID="dd"><PARA>Hear</PARA></INTERJECT> words</PARA></SPEECH></DEBATE></CHAMBER></RECORD>"""
COMMITTEE = b"""<committee version="2.2"><committee.name>Budget</committee.name><p>lost</p><debate><debateinfo><title>Health</title></debateinfo><p><span class="HPS-OfficeCommittee">CHAIR</span>: Welcome</p><p><span class="HPS-WitnessName">Dr W</span>: Thanks</p><p>indeed</p><p><a href="m1" type="MemberContinuation">Senator M</a>: Go</p></debate></committee>"""


def test_proceedings(spark):
    files = spark.createDataFrame([("d/2001-02-03.xml", XML21), ("d/2013-04-05.xml", XML22), ("up.xml", UPPER), ("bad.xml", b"<a>"), ("none.xml", None)], "path string, content binary")
    rows = proceedings.parse(files, "turns").collect()
    one = [r for r in rows if r.path.endswith("02-03.xml")]
    assert [(r.order, r.row_type, r.body) for r in one] == [(1, "business_start", "The chair was taken at 2 pm"), (2, "stage_direction", "WATER BILL"), (3, "speech", "First.\n\nSecond."), (4, "interjection", "No!"), (5, "stage_direction", "Clause"), (6, "question", "Why?"), (7, "division", one[-1].body)]
    assert one[2].name == "Senator ABLE" and one[2].name_id == "A1" and one[2].in_gov == 1 and one[5].question == 1 and one[0].date == "2001-02-03"
    two = [(r.row_type, r.name_id, r.body) for r in rows if r.path.endswith("04-05.xml")]
    assert two[:4] == [("stage_direction", None, "D"), ("speech", "A1", "begins\n\nmore"), ("interjection", "B2", "interjecting"), ("stage_direction", None, "The House divided")]
    old = [(r.row_type, r.name_id) for r in rows if r.path == "up.xml"]
    assert ("speech", "CC") in old
    assert [r.error is not None for r in rows if r.path in ("bad.xml", "none.xml")] == [True, True]
    assert [(r.level, r.topic, r.gvt_business) for r in proceedings.parse(files, "topics").collect() if r.path.endswith("02-03.xml")] == [(0, "WATER BILL", 1), (1, "Clause", 1)]
    assert [(r.ayes_count, r.noes_count, r.result) for r in proceedings.parse(files, "divisions").collect() if r.error is None] == [(2, 1, "aye"), (3, 5, "noe")]
    assert [(r.name, r.vote) for r in proceedings.parse(files, "votes").collect() if r.error is None] == [("ABLE", "aye"), ("BAKER", "aye"), ("CLARK", "noe")]
    assert [r.chamber for r in proceedings.parse(files, "headers").collect() if r.error is None] == ["Senate"]
    hearing = proceedings.parse(spark.createDataFrame([("c.xml", COMMITTEE)], "path string, content binary"), "committee").collect()
    assert [(r.name, r.witness_flag, r.body, r.portfolio) for r in hearing] == [("CHAIR", 0, "Welcome", "Health"), ("Dr W", 1, "Thanks\n\nindeed", "Health"), ("Senator M", 0, "Go", "Health")]


def engine(spark):
    rows = [(1, "senate", "2001-01-01", 1, "stage direction", None, 0, 0, "WATER BILL"), (2, "senate", "2001-01-01", 2, "Able", "A1", 1, 0, "Question about water"), (3, "senate", "2001-01-01", 3, "Clark", "C3", 0, 1, "Answer without the term"), (4, "house", "2002-01-01", 1, "Baker", "B2", 0, 0, None)]
    return Engine(spark.createDataFrame(rows, "turn_id int, chamber string, date string, order int, name string, name_id string, question int, answer int, body string").withColumn("date", F.to_date("date")))


def test_search(spark):
    e = engine(spark)
    r = e.search(Request("water"))
    assert r.total == 2 and [x.turn_id for x in r.hits.collect()] == [1, 2] and e.search(Request("water")) is r
    assert {(x.period, x.senate, x.house) for x in r.series.collect()} == {(2001, 2, 0)}
    x = {y.turn_id: y for y in e.exchanges(Request("'question about'")).collect()}
    assert set(x) == {2, 3} and x[3].match_source == "question_answer" and x[3].exchange_id == "senate-2001-01-01-xch2" and x[2].debate_heading == "WATER BILL"
    assert e.find_page(2, Request("water", size=1)).first().page == 2
    assert e.by_hash(spark.range(1).select(S.turn_hash(F.lit("senate"), F.lit("2001-01-01"), F.lit("A1"), F.lit("Question about water"))).first()[0]).count() == 1
    assert [y.turn_id for y in e.day("senate", "2001-01-01").collect()] == [1, 2, 3]


def test_tables_and_streams(spark, tmp_path):
    d = spark.createDataFrame([("senate", "2001-01-01", 1), ("senate", "2001-01-02", 2)], "chamber string, date string, n int")
    p = str(tmp_path / "corpus")
    tables.replace_days(d, p)
    tables.replace_days(spark.createDataFrame([("senate", "2001-01-02", 3)], d.schema), p)
    assert sorted(r.n for r in spark.read.parquet(p).collect()) == [1, 3]
    assert tables.sitting_days(spark, "2024-01-05", "2024-01-09").count() == 3
    assert tables.conform(d, "n string, x int").columns == ["n", "x"]
    ev = spark.createDataFrame([(1, "2024-01-01 10:00:00", "a"), (1, "2024-01-01 10:10:00", "a"), (1, "2024-01-01 12:00:00", "b")], "user_id int, ts string, event_type string").withColumn("ts", F.to_timestamp("ts"))
    src = str(tmp_path / "events")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    for name, build in (("usage", logs.daily_usage), ("sessions", logs.sessions)):
        q = build(stream).writeStream.format("memory").queryName(name).outputMode("complete" if name == "usage" else "append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert sorted((r.event_type, r.n) for r in spark.table("usage").collect()) == [("a", 2), ("b", 1)]
    assert sorted(r.n for r in logs.sessions(ev).collect()) == [1, 2]
    logs.publish_days(spark.readStream.schema(d.schema).parquet(_days(d, tmp_path)), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def _days(d, tmp_path):
    d.write.parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def test_find_page_is_the_page_of_the_hits(spark):
    rows = [(i, ["senate", "house"][i % 2], f"2001-01-{1 + i % 9:02d}", i, ["ALP", None, "GRN", "LP"][i % 4], [None, "NSW", "Vic"][i % 3], "water here" if i % 5 else "dry") for i in range(60)]
    turns = spark.createDataFrame(rows, "turn_id int, chamber string, date string, order int, party string, state string, body string").withColumn("date", F.to_date("date")).withColumn("name_id", F.lit("n"))
    e = Engine(turns)
    for sort in ("date", "party", "state_or_electorate", "chamber"):
        for descending in (False, True):
            pages = {k: [x.turn_id for x in e.search(Request("water", sort=sort, descending=descending, page=k, size=10)).hits.collect()] for k in range(1, 6)}
            for turn in (1, 33, 58):
                page = e.find_page(turn, Request("water", sort=sort, descending=descending, size=10)).first().page
                assert turn in pages[page], (sort, descending, turn)
    wanted = turns.where("turn_id = 33").select(Engine._hash().alias("h")).first().h
    assert e.find_page(wanted, Request("water", size=10)).count() == 1


def test_search_by_token_table(spark, tmp_path):
    from rostrum.sources import tokens

    bodies = ["Water policy, the budget.", "the water-policy of the day", "WATÉR", "policy water", "", None, "budget the", "no such thing"]
    turns = spark.createDataFrame([(i, "senate", "2001-01-01", i, 0, 0, b) for i, b in enumerate(bodies)], "turn_id int, chamber string, date string, order int, question int, answer int, body string").withColumn("date", F.to_date("date")).withColumn("name_id", F.lit("n"))
    path = tokens.build(turns, "turn_id", "body", str(tmp_path / "tokens"), buckets=8)
    plain, table = Engine(turns), Engine(turns, tokens=tokens.Tokens(spark, path, 8), folder=str(tmp_path / "matches"))
    for text in ("water", "'water policy'", "'the budget' OR 'water policy'", "water & policy", "'...'", "absent", "(water OR budget) AND the"):
        for exact in (False, True):
            a, b = (e.search(Request(text, case_sensitive=exact)) for e in (plain, table))
            assert [x.turn_id for x in a.hits.collect()] == [x.turn_id for x in b.hits.collect()] and a.total == b.total
            assert sorted(map(tuple, a.facets.collect())) == sorted(map(tuple, b.facets.collect()))
    r = table.search(Request("water"))
    assert {x.turn_id: x.matched_terms for x in r.matches.collect()} == {0: "water", 1: "water", 2: "", 3: "water"}
    assert r.seeds.count() > 0 and "inputs" not in r.matches.columns and "body" not in r.matches.columns
    found = {(x.what, x.value) for x in plain.metadata().collect()}
    assert {("first_day", "2001-01-01"), ("senate_rows", "8")} <= found
    assert plain.aliases("water", ["water bill", "Dam", "dam", "rivers"]) == ["Dam", "rivers"]
    day = turns.select(S.day_hash(F.col("chamber"), F.col("date")).alias("h")).first().h
    assert plain.day_by_hash(day).count() == 8 and plain.day_by_hash("none").count() == 0


def test_repetitions_and_entries(spark):
    said = ["A", "Leave granted", "A", "", "", "B", "B", "order!", "Order!", "Order!", "Order!", "C", None, "C", "D", "D"]
    turns = spark.createDataFrame([("2000-01-01", i, 0, b) for i, b in enumerate(said)] + [("2000-01-01", 99, 1, "D"), ("2000-01-02", 1, 0, "D")], "date string, order int, interject int, body string")
    assert [r.message for r in V.t2_duplicates(turns).collect()] == ["2 consecutive duplicates"]  # B and D
    day = lambda *cols: (F.to_date(c).alias(c) for c in cols)
    entries = spark.createDataFrame([("a", "2000-01-01", None), ("a", "2005-01-01", "2006-01-01"), ("a", "2006-03-01", "2007-01-01"), ("a", "2008-01-01", None), ("b", "2000-01-01", "2001-01-01"), ("b", "2003-01-01", None)], "k string, start string, end string").select("k", *day("start", "end"))
    turns = spark.createDataFrame([("a", "2004-01-01", 1, True, 0), ("a", "2008-02-01", 2, False, 0), ("a", "2008-02-02", 3, True, 0), ("b", "1999-01-01", 4, True, 1), ("b", "2003-02-01", 5, True, 0)], "k string, date string, turn_id int, substantive boolean, first_speech int").select("k", *day("date"), "turn_id", "substantive", "first_speech")
    got = lambda **kw: {(r.k, r.start.year, r.turn_id) for r in W.first_events(entries, turns, "k", **kw).collect()}
    assert got() == {("a", 2000, 1), ("a", 2008, 3), ("b", 2003, 5)}  # an unknown end before 2005 makes no entry; b's first one is flagged
    assert got(override=True) == {("a", 2000, 1), ("a", 2008, 3), ("b", 2000, 5), ("b", 2003, 5)}


def test_talks_and_recovery(spark):
    talk = lambda name, person, witness, *paras: f"<talk><talk.start><talker><name>{name}</name><name.id>{person}</name.id><page.no>3</page.no><witness.data>{witness}</witness.data></talker></talk.start>{''.join(f'<para>{p}</para>' for p in paras)}</talk>"
    text = f"<committee><committee.name>Econ</committee.name><debate><debateinfo><title>Health</title></debateinfo><subdebate.1><subdebateinfo><title>A</title></subdebateinfo>{talk('Chair', '10000', 0, '[10.30 am]', '—Welcome', 'More')}</subdebate.1><subdebate.1><subdebateinfo><title>B</title></subdebateinfo>{talk('Dr X', 'Q7', 1, 'Hi')}{talk('Silent', 'Q8', 0)}</subdebate.1></debate></committee>"
    broken = text.replace("More", "More & <b>more").replace("</committee>", "")
    files = spark.createDataFrame([("a.xml", text.encode()), ("b.xml", broken.encode()), ("c.xml", b"no tags")], "path string, content binary")
    rows = proceedings.parse(files, "committee").collect()
    want = [("Chair", None, 0, 3, "Health — A", "Welcome\n\nMore"), ("Dr X", "Q7", 1, 3, "Health — B", "Hi")]
    assert [(r.name, r.name_id, r.witness_flag, r.page_no, r.portfolio, r.body) for r in rows if r.path == "a.xml"] == want
    assert [(r.name, r.body) for r in rows if r.path == "b.xml"] == [("Chair", "Welcome\n\nMore & more"), ("Dr X", "Hi")]
    assert [r.error is not None for r in rows if r.path == "c.xml"] == [True]


def test_report_parts(spark):
    reports = spark.createDataFrame([(1, "a [7, 3] b [3] c"), (2, "none"), (3, "x [9, 8, 7, 6] [stray]")], "k int, text string")
    assert [r.rewritten for r in X.rewritten(reports, "k", "text").orderBy("k").collect()] == ["a <sup>1, 2</sup> b <sup>2</sup> c", "none", "x <sup>1, 2, 3, 4</sup> [stray]"]
    known = spark.createDataFrame([(i, f"label {i}") for i in (3, 7, 9, 8)], "ref int, label string")
    assert sorted((r.k, r.number, r.label) for r in X.references(reports, "k", "text", known, "ref", "label").collect())[:2] == [(1, 1, "label 7"), (1, 2, "label 3")]
    assert sorted((r.k, r.fault) for r in X.citation_faults(reports, "k", "text", known, "ref").collect()) == [(3, "raw bracket: [stray]"), (3, "too many: 9, 8, 7, 6"), (3, "unknown 6")]
    listed = spark.createDataFrame([(1, 7), (1, 5)], "k int, ref int")
    assert sorted(r.fault for r in X.list_faults(reports.where("k = 1"), "k", "text", listed).collect()) == ["not cited 5", "not listed 3"]
    load = R.workload(spark, {"easy": (3.0, ["a"]), "worst": (1.0, ["b", "c"])}, 200).collect()
    assert len(load) == 200 and {r.expression for r in load} == {"a", "b", "c"} and load == R.workload(spark, {"easy": (3.0, ["a"]), "worst": (1.0, ["b", "c"])}, 200).collect()
    df = spark.range(10_000)
    a, b = (sorted(r.id for r in R.sampled(d, "id", 0.25).collect()) for d in (df, df.repartition(7)))
    assert a == b and 2300 < len(a) < 2700


def test_versions_and_manifest(spark, tmp_path):
    root = str(tmp_path / "table")
    tables.publish(spark, root, tables.new_version(spark.range(5), root))
    before = tables.current(spark, root)
    tables.rewrite(spark, root, lambda df: df.where("id > 2"))
    assert before.count() == 5 and sorted(r.id for r in tables.current(spark, root).collect()) == [3, 4]
    path = str(tmp_path / "manifest.json")
    assert tables.manifest(spark, path) == {}
    tables.update_manifest(spark, path, {"2001-01-01": "done"})
    assert tables.update_manifest(spark, path, {"2001-01-02": "ö"}) == tables.manifest(spark, path) == {"2001-01-01": "done", "2001-01-02": "ö"}
    hits = spark.createDataFrame([(1, "search"), (2, "question_answer")], "i int, match_source string")
    tables.write_results(hits, str(tmp_path / "out"))
    assert [spark.read.option("header", "true").csv(str(tmp_path / "out" / x)).first().i for x in ("matches", "exchanges")] == ["1", "2"]


def test_lookup_order(spark, tmp_path):
    """Rows of several files and splits stand in the order of the files."""
    folder = tmp_path / "lookup"
    folder.mkdir()
    for k in range(3):
        (folder / f"part{k}.csv").write_text("key,value\n" + "".join(f"k{i % 50},{k:02d}-{i:05d}\n" for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        first = W.first_rows(tables.read_lookup(spark, str(folder)), ["key"], ["ordinal"])
        assert {r.key: r.value for r in first.collect()} == {f"k{i}": f"00-{i:05d}" for i in range(50)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_quantiles_are_exact_on_every_pass(spark):
    """Odd values, and buckets so coarse that many passes follow, against ``percentile``."""
    rng, at = random.Random(24), [0.0, 0.05, 0.3, 0.5, 0.95, 1.0]
    inf, nan = float("inf"), float("nan")
    some = [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(300)]
    close = [1.0 + rng.randrange(400) * 2.0**-52 for _ in range(300)]
    cases = [[None], [None, 2.0, None, 2.0], [0.0, -0.0, 0.0], [1.0, 2.0, 3.0, 10.0], [5e-324, 1e-323, -5e-324, 0.0], [-1.7e308, 1.7e308, 5.0], [nan, 1.0, 2.0, inf, -inf, None], [3.0] * 200 + close + some]
    for values in cases:
        d = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        want = d.agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.percentile("v", at).alias("q")).first()
        for octave, parts in ((256, 65_536), (1, 3))[len(values) < 99 :]:
            got = A.quantiles(d, "v", at, octave=octave, parts=parts).first()
            assert got.n == want.n and all(x == y or str(x) == str(y) for x, y in zip(got.q, want.q or [None] * len(at), strict=True))
            assert str(got.mean) == str(want.mean) or abs(got.mean - want.mean) <= 1e-9 * max(map(abs, filter(None, values)))
    whole = spark.range(1, 1001).select((F.col("id") * 3).alias("v"))
    assert A.quantiles(whole, "v", [0.999], octave=1, parts=3).first().q == whole.agg(F.percentile("v", [0.999]).alias("q")).first().q


def test_ratio_figures_hold_no_map_of_values(spark, monkeypatch):
    """``percentile`` keeps each different value in one task's map, which 36 million ratios don't fit."""
    d = spark.range(5000).select((F.col("id") / 7).alias("ratio"))
    want = d.agg(F.round(F.avg("ratio"), 4).alias("mean"), *(F.round(F.percentile("ratio", q), 4).alias(c) for c, q in (("p5", 0.05), ("median", 0.5), ("p95", 0.95)))).first()
    monkeypatch.setattr(F, "percentile", lambda *_: 1 / 0)
    assert R.ratio_figures(d).first() == want
    assert R.ratio_figures(d.where("false")).first().asDict() == dict.fromkeys(("mean", "p5", "median", "p95"))
