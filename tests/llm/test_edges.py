"""Edges of the training-data operators: clashing names, thresholds at which a plan changes, long texts, the shared folder, and models against plain recomputation."""

import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rostrum.llm import bpe, decontaminate, hamming, jaccard_join, line_dedup, pii, runtime, suffix_dedup, token_files, toxicity, warc
from tests.llm.test_llm import BYTE, WORD, brute_distance, group, near_copies, shingle_set, table, words
from tests.oracle import DATA

#: Names that operators use inside, or return.
INNER = """row rows text_ texts doc docs key keys line at kept n n_lines n_removed token node info level ell a b block part side role family comp component component_id cls
items hub best load lo hi head pos least most begin end hash k lang_ site value score _score held_out predicted id kind start match left right base grp i target revisit html_ url_ uri n_docs n_ids null
query code query_id rank distance neighbour_id item_id word bit""".split()


def widened(df):
    """``df`` with a column of every inner name that it doesn't have."""
    taken = {c.lower() for c in df.columns}
    return df.select("*", *(F.lit(f"x{i}").alias(c) for i, c in enumerate(INNER) if c.lower() not in taken))


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(120).cache()
    return {t: docs if t == "documents" else spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels", "benchmark", "pages", "embeddings")}


OPERATORS = {
    "op1": lambda t: jaccard_join.similar_groups(t["documents"], 4, 85),
    "op2": lambda t: toxicity.toxicity(t["documents"], t["labels"]),
    "op3": lambda t: hamming.top_k(t["embeddings"], F.col("id") % 100 == 0),
    "op4": lambda t: decontaminate.contaminations(t["documents"], t["benchmark"]),
    "op5": lambda t: token_files.read(token_files.write(t["documents"], WORD, end_id=2)),
    "op6": lambda t: suffix_dedup.repeated_passages(t["documents"]),
    "op7": lambda t: line_dedup.dedup_lines(t["documents"].select("doc_id", "text", "source"), 3),
    "op8": lambda t: warc.read(warc.write(t["pages"])),
    "op9": lambda t: bpe.round_trip(t["documents"], BYTE),
    "op10": lambda t: pii.digests(pii.find(t["documents"])),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_change_nothing(spark, small, name):
    plain = OPERATORS[name](small)
    wide = OPERATORS[name]({k: widened(v) for k, v in small.items()})
    assert wide.columns == plain.columns
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, plain.collect()))


def test_lines_pass_all_columns(spark, small, monkeypatch):
    docs = widened(small["documents"])
    for sent in (line_dedup.SENT, 0):
        monkeypatch.setattr(line_dedup, "SENT", sent)
        out = line_dedup.dedup_lines(docs, 3)
        assert out.columns == [*docs.columns, "_n_lines", "_n_removed"]
        assert sorted(r.asDict()["n_lines"] for r in out.collect()) == sorted(r.n_lines for r in docs.collect())
        assert out.agg(F.sum("_n_removed")).first()[0] > 0


def test_pipeline_edges(spark, small):
    docs = small["documents"].limit(60)
    extra = spark.createDataFrame(
        [(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (9003, "  \n ", "en", None, 0), (None, "no id " * 30, "en", "s", 0), (9004, "z" * 300_000 + " tail", "en", "s", 5), (9005, "one two three four five six seven", "en", "s", 5), (9005, "one two three four five six seven", "en", "s", 5), (9005, "another text under the same id altogether", "en", "s", 5)],
        docs.schema,
    )
    wide = widened(docs.union(extra))
    #: what the few labels of this table make of odd texts is no matter here: the first stage keeps what scores below one half
    mild = corpus_pipeline.STAGES[0][1](spark, wide, DATA)
    weights = toxicity.train(wide, small["labels"])
    scores = toxicity.score(wide, weights, keep=("doc_id", "n_chars")).where("score < 0.5")
    assert mild.dtypes == wide.dtypes and Counter(r.doc_id for r in mild.select("doc_id").collect()) == Counter(r.doc_id for r in scores.collect())
    kept = wide
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, kept, DATA)
        assert kept.dtypes == wide.dtypes
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids[9001] == ids[9002] == ids[9003] == ids[9004] == ids[None] == 1 and ids[9005] == 2
    assert corpus_pipeline.STAGES[-1][1](spark, kept, DATA).count() == sum(ids.values())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, wide.where("false"), DATA).count() == 0


def test_pipeline_stages_against_brute_force(spark, small):
    """Line dedup and decontamination; near-duplicates and encoding are held elsewhere, toxicity by the query's scores."""
    docs = small["documents"]
    rows = docs.collect()
    sites = defaultdict(set)
    for r in rows:
        for x in (r.text or "").split("\n"):
            if x.strip(" ") and r.source:
                sites[x.strip(" ")].add(r.source)
    want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if len(sites[x.strip(" ")]) < line_dedup.MIN_SITES) for r in rows if r.text is not None}
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_boilerplate(spark, docs, DATA).collect() if r.text is not None}
    assert got == want
    scored = {r.doc_id: r.score for r in toxicity.toxicity(docs, small["labels"]).collect()}
    assert {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, DATA).collect()} == {i for i, s in scored.items() if s < 0.5}
    held = {r.doc_id for r in decontaminate.contaminations(docs, small["benchmark"]).collect()}
    assert {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, DATA).collect()} == {r.doc_id for r in rows} - held


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_jaccard_in_small_blocks(spark, monkeypatch, size, percent):
    """A family of hundreds of near copies about the threshold, over many blocks of members, outsiders and partners."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 1500)
    monkeypatch.setattr(jaccard_join, "HELD", 900)
    monkeypatch.setattr(jaccard_join, "PARTNERS", 7)
    rng = random.Random(percent)
    texts = near_copies(rng, 300, families=1, length=90, edits=6) + near_copies(rng, 20, families=3, length=60, edits=5)
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(table(spark, texts), size, percent).collect()}
    sets = [shingle_set(t, size) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    assert got == group(range(len(texts)), links)


def test_jaccard_of_shared_ids(spark):
    """Rows of one id are one node, whatever their texts: none of them is ruled out by the size of another."""
    rng = random.Random(31)
    long = [f"l{i}" for i in range(400)]
    short = [f"s{i}" for i in range(60)]
    edited = lambda x, k: " ".join(w if rng.random() > k else "other" + str(rng.randrange(99)) for w in x)
    rows = [(1, edited(long, 0.01)), (1, edited(short, 0.01)), (2, edited(short, 0.01)), (3, edited(long, 0.01)), (4, "no relation to anything at all here"), *((10 + i, edited(short, 0.03)) for i in range(30)), (10, edited(long, 0.01)), (12, "no relation to anything at all here")]
    ids, texts = zip(*rows, strict=True)
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(table(spark, texts, ids), 4, 85).collect()}
    sets = [shingle_set(t, 4) for t in texts]
    links = [(ids[i], ids[j]) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert got == group(set(ids), links)


def test_jaccard_of_extreme_ids(spark):
    """Ids at both ends of 64 bits, and ids that differ by multiples of a table's size."""
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(500)}" for _ in range(80))
    ids = [-(2**63), -(2**63) + 1, 2**63 - 1, 2**63 - 2, 0, 2**33, 5 << 33, -(7 << 33)]
    texts = [text.replace("w17 ", f"x{i} ") + f" end{i % 3}" for i in range(len(ids))]
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(table(spark, texts, ids), 4, 85).collect()}
    assert got == dict.fromkeys(ids, -(2**63))


def test_long_texts(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(3000)]
    long = " ".join(rng.choice(vocab) for _ in range(220_000))
    assert len(long) > 1_000_000
    near = long.replace("w17 ", "other ")
    docs = table(spark, [long, near, "short text of a few words here", long[:400_000].replace(" ", "\n") + "\nline"])
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(docs, 4, 85).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3}
    passages = {r.doc_id for r in suffix_dedup.repeated_passages(docs).collect()}
    assert passages == {0, 1, 3}
    item = " ".join(words(long)[150_000:150_040])
    found = decontaminate.contaminations(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} >= {0}
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert out[0].text == long and out[3].n_lines == len(long[:400_000].split(" ")) + 1
    assert bpe.round_trip(docs, BYTE).where("n_tokens > 100000").count() == 3
    assert pii.digests(pii.find(docs)).count() == 4


def test_suffix_plans(spark, monkeypatch):
    """The same passages whichever neighbours are compared, whatever is left to the hashes, with and without the join on heads."""
    rng = random.Random(16)
    w = [f"w{i}" for i in range(4000)]
    text = lambda n: [rng.choice(w) for _ in range(n)]
    base = text(120)
    docs = []
    for _ in range(70):  # left and right parts shared with different texts
        i, n = rng.randint(0, 60), rng.randint(30, 90)
        docs.append(" ".join(text(rng.randint(0, 30)) + base[i : i + n] + text(rng.randint(0, 30))))
    seen, want = defaultdict(set), defaultdict(set)
    runs = [(i, k, tuple(x[k : k + 50])) for i, t in enumerate(docs) for x in [words(t)] for k in range(len(x) - 49)]
    for i, _, g in runs:
        seen[g].add(i)
    for i, k, g in runs:
        if len(seen[g]) > 1:
            want[i].update(range(k, k + 50))
    for steps, full in ((suffix_dedup.STEPS, suffix_dedup.FULL), (1, -1.0), (3, 1.0)):
        monkeypatch.setattr(suffix_dedup, "STEPS", steps)
        monkeypatch.setattr(suffix_dedup, "FULL", full)
        got = defaultdict(set)
        for r in suffix_dedup.repeated_passages(table(spark, docs)).collect():
            got[r.doc_id].update(range(r.begin, r.end))
        assert got == want, steps


def test_neighbours_settle_nearly_all():
    """One sorted range: what neighbours settle needs no hashes, and is right."""
    rng = np.random.default_rng(3)
    n, half = 3000, suffix_dedup.SIDE
    right = np.cumprod(rng.random((n, half)) < 0.97, axis=1) + rng.integers(2, 5, (n, half)) * (rng.random((n, half)) < 0.02) + 1
    left = np.cumprod(rng.random((n, half)) < 0.95, axis=1) + 1
    heads = rng.integers(0, 40, n).astype(">u8")
    key = np.concatenate([heads[:, None].view(np.uint8), right.astype(">u4").view(np.uint8), left.astype(">u4").view(np.uint8)], axis=1)
    order = np.lexsort(key.T[::-1])
    key = np.ascontiguousarray(key[order])
    low = rng.integers(0, 12, n)
    info = np.stack([rng.integers(0, 900, n), np.arange(n) * 100, low, low + rng.integers(0, 12, n)], axis=1)
    out = suffix_dedup._match(key, info, 0, n)
    unsettled = {x for x in out.column(3).to_pylist() if x is not None}
    got = defaultdict(set)
    for i, b, e in zip(*(out.column(c).to_pylist() for c in range(3)), strict=True):
        if i is not None:
            for x in range(b, e - 49):
                got[b // 100 * 0 + round(x / 100)].add(x)
    for h in np.unique(heads):
        rows = np.flatnonzero(key[:, :8].view(">u8").ravel() == h)
        if int(np.uint64(h).astype(np.int64)) in unsettled:
            continue
        for i in rows:
            a, b = suffix_dedup._reach(np.repeat(key[i : i + 1], len(rows), axis=0), key[rows])
            other = info[rows, 0] != info[i, 0]
            for x in range(info[i, 2], info[i, 3] + 1):
                real = bool((other & (b >= x) & (a >= 50 - x)).any())
                assert (info[i, 1] - x in got[round((info[i, 1] - x) / 100)]) == real
    assert len(unsettled) < 40


def test_warc_bundles(spark):
    rng = random.Random(3)
    pages = spark.createDataFrame([(i, f"http://h/{i}", rng.randbytes(700).hex()) for i in range(40)] + [(99, None, None)], "page_id long, url string, html string").coalesce(1)
    want = {**dict.fromkeys(range(40), 1400), 99: 0}
    for sizes in ({"frame": 500, "bundle": 2000}, {"records": 7}):
        bundles = warc.write(pages, **sizes)
        assert bundles.count() > 4
        assert {r.page_id: r.payload_bytes for r in warc.read(bundles).collect()} == want



def test_decontamination_places_and_groups(spark, monkeypatch):
    """Begin and end are a place of the least distance, whatever the number of groups of items."""
    rng = random.Random(12)
    make = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    items = [(i, make(rng.randint(20, 70))) for i in range(9)]
    docs = []
    for _ in range(50):
        x = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 5)):
            x[rng.randrange(len(x))] = rng.choice("abcz")
        docs.append(make(rng.randint(0, 120)) + " " + "".join(x) + " " + make(30))
    d, b = table(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    norm = lambda xs: decontaminate.normalise(pa.array(xs, pa.string())).to_pylist()
    texts, patterns = norm(docs), norm([t for _, t in items])
    results = []
    for size in (decontaminate.GROUP_BYTES, 100):
        monkeypatch.setattr(decontaminate, "GROUP_BYTES", size)
        rows = decontaminate.contaminations(d, b, 10).collect()
        for r in rows:
            p, t = patterns[r.item_id], texts[r.doc_id]
            assert r.distance == brute_distance(p, t)[0]
            found = t[r.begin : r.end]  # the whole of it is as near
            row = list(range(len(found) + 1))
            for i, c in enumerate(p):
                new = [i + 1]
                for j, x in enumerate(found):
                    new.append(min(row[j] + (c != x), row[j + 1] + 1, new[j] + 1))
                row = new
            assert row[-1] == r.distance
        results.append(sorted(map(tuple, rows)))
        kept = {r.doc_id for r in decontaminate.decontaminate(d, b, 10).collect()}
        assert kept == set(range(len(docs))) - {r.doc_id for r in rows}
    assert results[0] == results[1] and results[0]


def test_hamming_blocks(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(70)]) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 340)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    codes = {i: tuple(x > 0 for x in v) for i, v in rows}
    want = {q: sorted((sum(a != b for a, b in zip(codes[q], c, strict=True)), i) for i, c in codes.items() if i != q)[:7] for q in codes if q % 20 == 0}
    for block, queries, at_once in ((hamming.BLOCK, hamming.QUERIES, hamming.AT_ONCE), (50, 5, 64)):
        monkeypatch.setattr(hamming, "BLOCK", block)
        monkeypatch.setattr(hamming, "QUERIES", queries)
        monkeypatch.setattr(hamming, "AT_ONCE", at_once)
        got = defaultdict(list)
        for r in hamming.top_k(df, F.col("id") % 20 == 0, 7).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.distance, r.neighbour_id))
        assert got == want
    assert hamming.top_k(df.where("false"), F.col("id") % 20 == 0).count() == 0


def test_toxicity_against_plain_recomputation():
    """Log-count ratios and scores from plain counters and a plain descent over the same n-grams."""
    rng = random.Random(21)
    calm, rude = ["calm", "tree", "water", "stone", "light"], ["moron", "idiot", "filth"]
    texts = [" ".join(rng.choice(calm) for _ in range(rng.randint(3, 12))) + (f" you {rng.choice(rude)}" if i % 3 == 0 else "") for i in range(90)]
    labels = np.array([int(i % 3 == 0) for i in range(90)])
    weights = toxicity.fit([pa.array(texts[:50]), pa.array(texts[50:])], labels)
    sets = [set(x.tolist()) for x in toxicity.features(pa.array(texts))]
    count = [Counter(), Counter()]
    for x, y in zip(sets, labels.tolist(), strict=True):
        count[y].update(x)
    rows = [60, 30]
    ratio = {}
    for f in set(count[0]) | set(count[1]):
        p, q = count[1][f] + 1, count[0][f] + 1
        r = math.log(p / (rows[1] + 2)) - math.log(q / (rows[0] + 2))
        if count[0][f] + count[1][f] > toxicity.RARE and abs(r) > toxicity.NOISE * math.sqrt(1 / p + 1 / q):
            ratio[f] = r
    w, bias = dict.fromkeys(ratio, 0.0), math.log(rows[1] / rows[0])
    step = 4 / (sum(ratio[f] ** 2 for x in sets for f in x if f in ratio) / len(sets) + 1)
    ahead, ahead_bias, v, vb = dict(w), bias, dict(w), bias
    for t in range(toxicity.STEPS):
        slope, slope_bias = {f: toxicity.RIDGE * a for f, a in ahead.items()}, 0.0
        for x, y in zip(sets, labels.tolist(), strict=True):
            s = ahead_bias + sum(ratio[f] * ahead[f] for f in x if f in ratio)
            e = 0.5 / rows[y] * (1 / (1 + math.exp(-s)) - y)
            slope_bias += e
            for f in x:
                if f in ratio:
                    slope[f] += ratio[f] * e
        w, bias = {f: ahead[f] - step * slope[f] for f in w}, ahead_bias - step * slope_bias
        beta = t / (t + 3)
        ahead, ahead_bias = {f: w[f] + beta * (w[f] - v[f]) for f in w}, bias + beta * (bias - vb)
        v, vb = w, bias
    assert set(np.flatnonzero(weights[:-1])) == set(ratio)
    assert np.allclose([weights[f] for f in ratio], [w[f] * ratio[f] for f in ratio], rtol=1e-3, atol=1e-6) and abs(weights[-1] - bias) < 1e-3
    wanted = weights[:-1] != 0
    scores = toxicity.probability(pa.array(texts), weights, wanted)
    assert np.allclose(scores, [1 / (1 + math.exp(-(bias + sum(w[f] * ratio[f] for f in x if f in ratio)))) for x in sets], atol=1e-3)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{os.path.dirname(DATA)}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).where("held_out").join(labels.where("toxic is not null"), "doc_id").select("predicted", "toxic").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic == 1], [r.predicted for r in rows if r.toxic == 0]
    print("held out:", sum(toxic), len(toxic), sum(clean), len(clean))
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean), (sum(toxic), len(toxic), sum(clean), len(clean))


def test_pii_model_against_plain_recomputation(spark):
    rng = random.Random(13)
    parts = ["mail a@b.com", "call +1 (988) 555-2485", "tel (988) 555-2485", "ip 10.2.3.4", "300.1.2.3", "4539578763621486", "4539578763621487", 'token = "5d190bd7c06284de91015a36"', "password: incorrect", "Dr. Smith", "Anna Miller", "123-45-6789", "page 123-45-6789", "12 Long Road", "DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", "words only"]
    docs = table(spark, [" ; ".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(150)])
    found = [r.asDict() for r in pii.features(pii.votes(pii.candidates(docs)).where("kind is not null")).collect()]
    right, prior = dict.fromkeys(pii.LABELERS, 0.8), 0.7
    odds = lambda r: 1 / (1 + math.exp(-(math.log(prior / (1 - prior)) + sum(r[x] * math.log(right[x] / (1 - right[x])) for x in pii.LABELERS))))
    for _ in range(pii.ROUNDS):
        q = [odds(r) for r in found]
        new = {}
        for x in pii.LABELERS:
            voted = [(r[x], p) for r, p in zip(found, q, strict=True) if r[x]]
            new[x] = min(0.99, max(0.55, (sum(p if v == 1 else 1 - p for v, p in voted) + 4) / (len(voted) + 5)))
        right, prior = new, min(0.99, max(0.01, (sum(q) + 1) / (len(q) + 2)))
    q = [odds(r) for r in found]
    yes, no = sum(q) + 1, sum(1 - x for x in q) + 1
    by = defaultdict(lambda: [0.0, 0.0])
    for r, x in zip(found, q, strict=True):
        for f in r["feature"]:
            by[f][0] += x
            by[f][1] += 1 - x
    want = {}
    for r in found:
        s = math.log(yes / no) + sum(math.log((by[f][0] + 1) / (yes + 2)) - math.log((by[f][1] + 1) / (no + 2)) for f in r["feature"])
        keep = r["base"] or not r["failed"] and s >= 0
        if keep:
            want[r["id"], r["kind"], r["start"], r["end"]] = 1.0 if r["base"] else 1 / (1 + math.exp(-s))
    got = {(r.id, r.kind, r.start, r.end): r.score for r in pii.find(docs).where("kind is not null").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    texts = {m for (_, k, *_), m in zip(want, want, strict=True) if k in ("secret", "phone", "iban", "name")}
    assert {k for _, k, *_ in texts} >= {"secret", "phone"}
    assert not any(r["failed"] and (r["id"], r["kind"], r["start"], r["end"]) in got for r in found)


def test_shared_folder(spark, monkeypatch):
    real, says = type(spark.conf).get, {}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: says.get(key) if key == "spark.checkpoint.dir" else real(self, key, *a))
    says["spark.checkpoint.dir"] = "/ckpt"
    assert runtime.shared_dir(spark) == "file:/ckpt"  # the default file system here is the local one
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.defaultFS", "viewfs://store/")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./ckpt", "file:///tmp")
    try:
        assert runtime.shared_dir(spark) == "viewfs://store/ckpt"
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().set("fs.defaultFS", "file:///")
    says.clear()
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(spark)
    monkeypatch.undo()
    df = runtime.materialise(spark.range(5), "test")
    assert df.count() == 5
    runtime.discard(df)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(df.scratch_path).count()


def test_words_encoder_path_is_a_parameter():
    assert token_files.encoder(public_tokenizers.path("word_bpe_49k.json")).by_word
