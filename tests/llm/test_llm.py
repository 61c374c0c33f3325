"""Training-data operators against brute force on small tables with every awkward row: null and empty texts, ties, repeats, clashing columns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rostrum.llm import bpe, components, decontaminate, entry, hamming, jaccard_join, line_dedup, pii, simple8b, suffix_dedup, token_files, toxicity, warc
from tests.oracle import DATA, connect, same

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, id string, n long, cls string, source string"


def table(spark, texts, ids=None):
    """Texts as documents with columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", 1, "y", f"s{k % 3}") for k, (i, t) in enumerate(zip(ids, texts, strict=True))], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingle_set(text, size):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def group(nodes, links):
    parent = {i: i for i in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in nodes}


def near_copies(rng, n, families=4, length=120, edits=12):
    vocab = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(families):
        base = [rng.choice(vocab) for _ in range(length)]
        for _ in range(n):
            x = list(base)
            for _ in range(rng.randint(0, edits)):
                x[rng.randrange(len(x))] = rng.choice(vocab)
            out.append(" ".join(x))
    return out


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_jaccard(spark, size, percent):
    rng = random.Random(size)
    texts = [None, "", " \n", "a b", "A B", "a b c", *near_copies(rng, 25), *(" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 30))) for _ in range(60))]
    texts += texts[6:9]
    docs = table(spark, texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(docs, size, percent).collect()}
    sets = [shingle_set(t, size) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    comp = group(range(len(texts)), links)
    assert got == {i: (len(s), comp[i]) for i, s in enumerate(sets)}


def test_jaccard_edges(spark):
    assert jaccard_join.similar_groups(table(spark, []), 4, 85).count() == 0
    r = jaccard_join.similar_groups(table(spark, ["a b c d e", "a b c d e", "x", "a b c d e"], [None, 7, 9, 3]), 4, 85).collect()
    assert sorted((x.doc_id if x.doc_id is not None else -1, x.component_id if x.component_id is not None else -1) for x in r) == [(-1, -1), (3, 3), (7, 3), (9, 9)]


def test_prefix_holds_what_similar_sets_share():
    rng = np.random.default_rng(3)
    excess = np.where(rng.random(jaccard_join.BUCKETS) < 0.1, rng.integers(1, 5000, jaccard_join.BUCKETS), 0).astype(float)
    for _ in range(300):
        base = np.unique(rng.integers(0, 1 << 63, rng.integers(3, 200), dtype=np.uint64))
        a, b = (np.unique(np.concatenate([base[rng.random(len(base)) > 0.06], rng.integers(0, 1 << 63, len(base) // 25, dtype=np.uint64)])) for _ in range(2))
        both = len(np.intersect1d(a, b))
        if not len(a) or not len(b) or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        (ta, la, ea), (tb, lb, eb) = (jaccard_join.prefix(x, excess, 85) for x in (a, b))
        ell = min(ea, eb)
        assert len(np.intersect1d(ta[la <= ell], tb[lb <= ell])) >= ell


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(None, 3), (4, 4)]
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = group({x for e in real for x in e}, real)
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rng = random.Random(1)
    mild = [" ".join(rng.choice(["calm", "tree", "water", "stone", "light", "paper"]) for _ in range(40)) for _ in range(300)]
    texts = [t + (" you awful moron" if i % 4 == 0 else "") for i, t in enumerate(mild)]
    d = table(spark, [*texts, None, "", "x" * 50_000])
    y = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(d, y).collect()
    assert len(rows) == 303 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 300]
    assert held and all(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert toxicity.toxicity(table(spark, []), y).count() == 0
    assert {r.predicted for r in toxicity.toxicity(docs, labels.where("false")).collect()} == {0}


def test_features_are_distinct_ngrams():
    texts = ["Aba\tba", "", None, "é" * 9]
    count = []
    for t in texts:
        s = " " + re.sub(r"\s", " ", (t or "").lower()) + " "
        count.append(len({s[i : i + n] for n in toxicity.LENGTHS for i in range(len(s) - n + 1)}))
    assert [len(x) for x in toxicity.features(pa.array(texts))] == count


def test_hamming(spark):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(40)]) for i in range(0, 400)] + [(i, [1.0] * 40) for i in range(400, 430)]
    rows += [(900, None), (None, [1.0] * 40), (901, [1.0] * 3), (402, [1.0] * 40), (1000, [float("nan")] * 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in hamming.top_k(df, F.col("id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.distance, r.neighbour_id))
    codes = {i: tuple(x > 0 for x in v) for i, v in rows if i is not None and v is not None and len(v) == 40}
    for q in (i for i in codes if i % 50 == 0):
        want = sorted((sum(a != b for a, b in zip(codes[q], c, strict=True)), i) for i, c in codes.items() if i != q)[:5]
        assert got[q] == want, q
    assert set(got) == {i for i in codes if i % 50 == 0}


def brute_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, x in enumerate(t):
            new.append(min(row[j] + (c != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row), row.index(min(row))


def test_myers():
    rng = random.Random(3)
    for _ in range(1500):
        p, t = ("".join(rng.choice("abc ") for _ in range(rng.randint(a, b))) for a, b in ((1, 15), (0, 40)))
        assert decontaminate.distance(p, t) == brute_distance(p, t)


def test_decontamination(spark):
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abcdefghij é") for _ in range(n))
    items = [(i, make(rng.randint(1, 80))) for i in range(8)] + [(8, None), (9, "..!"), (3, "same text twice here"), (10, "same text twice here")]
    docs = [None, "", "?!"]
    for _ in range(60):
        x = list(rng.choice(items)[1] or "")
        for _ in range(rng.randint(0, 7)):
            x.insert(rng.randrange(len(x) + 1), rng.choice("abcé "))
        docs.append(make(rng.randint(0, 200)) + "".join(x) + make(20))
    d, b = table(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contaminations(d, b, 10).collect()}
    norm = lambda xs: decontaminate.normalise(pa.array(xs, pa.string())).to_pylist()
    texts, patterns = norm(docs), norm([t for _, t in items])
    want = set()
    for i, t in enumerate(texts):
        for (j, _), p in zip(items, patterns, strict=True):
            if p and t:
                k, _ = brute_distance(p, t)
                if k <= len(p) * 10 // 100:
                    want.add((i, j, k))
    assert got == want
    kept = {r.doc_id for r in decontaminate.decontaminate(d, b, 10).collect()}
    assert kept == set(range(len(docs))) - {i for i, _, _ in want} and decontaminate.decontaminate(d, b).columns == d.columns
    assert decontaminate.contaminations(table(spark, []), b).count() == 0 and decontaminate.decontaminate(d, b.where("false")).count() == len(docs)


def test_simple8b():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 61, 300, 4096, 4097, 20_000):
        for top in (1, 2, 5, 300, 49_408, 1 << 31, 1 << 60, 1 << 63):
            v = rng.integers(0, top, n).astype(np.uint64)
            if n > 100:
                v[10:60], v[70], v[71], v[72] = 0, (1 << 64) - 1, (1 << 60) - 1, 1 << 60
            out = [simple8b.decode(*b) for b in simple8b.encode(v)]
            assert (np.concatenate(out) if out else v).tolist() == v.tolist()


AWKWARD = [None, "", " ", "The  quick\n\nfox's 123", "<|endoftext|> x<|startoftext|>", "é́ ǅ漢字 😀\x1c\x85\xa0y", "a" * 70_000, "The  quick\n\nfox's 123", "don't  STOP", " lead and trail "]


def test_token_files(spark):
    t = Tokenizer.from_file(WORD)
    ids = [5, 3, None, 9, 1, 0, 7, 3, 12, 4]
    got = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in token_files.read(token_files.write(table(spark, AWKWARD, ids), WORD, end_id=2)).collect()}
    rows = sorted(zip(ids, AWKWARD, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, {}
    for i, text in rows:
        x = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want[i, start] = (len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        start += len(x)
    assert got == want
    assert token_files.read(token_files.write(table(spark, []), WORD)).count() == 0


def test_word_encoder():
    e, rng = token_files.Encoder(WORD), random.Random(2)
    assert e.by_word
    alphabet = " \n\t\r\x0b\x1c\x85\xa0'sdtT1aZéÉ漢١²½😀́‍<|endoftext|>ǅ՘ᲊ ́İΣ"
    for _ in range(4000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert e.encode(s) == np.array(e.tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes(), repr(s)


def test_suffixes(spark):
    rng = random.Random(6)
    w = [f"w{i}" for i in range(5000)]
    text = lambda n: [rng.choice(w) for _ in range(n)]
    passages = [text(n) for n in (49, 50, 60, 74, 200)]
    docs = [None, "", "short"]
    for i in range(40):
        docs.append(" ".join(text(rng.randint(0, 60)) + passages[i % 5] + text(rng.randint(0, 60))))
    docs += [docs[5], " ".join(p := text(60)) + " " + " ".join(p)]
    got = defaultdict(set)
    for r in suffix_dedup.repeated_passages(table(spark, docs)).collect():
        got[r.doc_id].update(range(r.begin, r.end))
    seen, want = defaultdict(set), defaultdict(set)
    runs = [(i, k, tuple(x[k : k + 50])) for i, t in enumerate(docs) for x in [words(t)] for k in range(len(x) - 49)]
    for i, _, g in runs:
        seen[g].add(i)
    for i, k, g in runs:
        if len(seen[g]) > 1:
            want[i].update(range(k, k + 50))
    assert got == want
    assert suffix_dedup.repeated_passages(table(spark, [])).count() == 0


def test_lines(spark, monkeypatch):
    rng = random.Random(8)
    wide, narrow = [f"wide {i}" for i in range(5)], [f"narrow {i}" for i in range(5)]
    rows = []
    for i in range(120):
        lines = [rng.choice(wide), f"own {i}", "", "  " + rng.choice(wide) + " "] + ([narrow[i % 5]] if i % 12 < 4 else [])
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), f"s{i % 12}"))
    rows += [(200, None, "s1"), (201, "", "s2"), (202, "wide 1", None), (202, "wide 1", None), (203, "x" * 30_000, "s3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("key", F.lit("clash"))
    sites = defaultdict(set)
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            if x.strip(" ") and s:
                sites[x.strip(" ")].add(s)
    gone = {x for x, s in sites.items() if len(s) >= 10}
    assert gone == set(wide)
    want = sorted((i, None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in gone), 0 if t is None else len(t.split("\n"))) for i, t, _ in rows if i != 200)
    for sent in (line_dedup.SENT, 0):
        monkeypatch.setattr(line_dedup, "SENT", sent)
        out = line_dedup.dedup_lines(docs).collect()
        assert sorted((r.doc_id, r.text, r.n_lines) for r in out if r.doc_id != 200) == want
        assert [(r.text, r.n_lines, r.n_removed) for r in out if r.doc_id == 200] == [(None, 0, 0)]
        assert all(r.key == "clash" for r in out)
    assert line_dedup.dedup_lines(docs.where("false")).count() == 0


def test_warc(spark):
    rows = [(1, "http://a", "same"), (2, None, "same"), (3, "u\r\nX: 1", None), (4, "v", ""), (5, "w", "é" * 200_000), (None, "n", "same"), (2, "again", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("target", F.lit(9))
    bundles = warc.write(pages)
    got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(bundles).collect()), key=str)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        best = {"same": 2, "": 4}.get(h or "", i)
        want.append((i or 0, len(data), warc.digest(data), "response" if i == best else "revisit", None if i == best else best))
    assert got == sorted(want, key=str)
    uris = [r.uri for r in bundles.collect()]
    found = [x for u in uris for x in warc.Reader(u).records(warc.record_id(5))]
    assert len(found) == 1 and warc.parse(found[0])[2] == ("é" * 200_000).encode()
    assert warc.read(warc.write(pages.where("false"))).count() == 0
    assert {r.record_type for r in warc.read(warc.write(pages, min_revisit=5)).where("page_id < 5").collect()} == {"response"}


def test_bpe(spark):
    t = Tokenizer.from_file(BYTE)
    rows = bpe.round_trip(table(spark, AWKWARD), BYTE).collect()
    for r, text in zip(sorted(rows, key=lambda r: r.doc_id), AWKWARD, strict=True):
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decode(bpe.encode(table(spark, AWKWARD), BYTE), BYTE).collect()
    assert {r.doc_id: r.text for r in back} == {i: x or "" for i, x in enumerate(AWKWARD)}
    assert bpe.round_trip(table(spark, []), BYTE).count() == 0
    b, rng = bpe.load(BYTE), random.Random(1)
    alphabet = " \n\t\r\x0b\x1c\x85\xa0'sdt1aZé漢١²½😀́‍<|endoftext|>ǅ՘Ᲊ"
    for _ in range(4000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert b.encode(s) == t.encode(s, add_special_tokens=False).ids, repr(s)
    assert b.decode([10**6, 220]) == " " and b.decode([94]) == "�"


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for i, c in enumerate(reversed(s))) % 10 == 0


def base_spans(text):
    out = []
    for k, p in PATTERNS.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            bad = (k == "ip" and any(int(x) > 255 for x in m[0].split("."))) or (k == "card" and not (13 <= len(d) <= 19 and luhn(d))) or (k == "phone" and not 9 <= len(d) <= 15)
            if not bad:
                out.append(f"{k}:{m.start()}:{m.end()}")
    return out


def test_pii(spark):
    rng = random.Random(4)
    parts = ["a", "B", ".", "@", "-", "_", "+", "1", "22", "255", "256", "4539578763621486", " ", "é", "😀", "(", ")", "\n", "a@b.c", "1.2.3.4", "+1 (988) 555-2485", "123-45-6789", "Dr. Smith", "bob (at) mail (dot) com"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(500)] + [None, "", "a" * 60_000 + "1" * 60_000, "1-" * 30_000, "a@b." * 2000 + "@" * 9000]
    texts += texts[:3]
    for r in pii.digests(pii.find(table(spark, texts))).collect():
        b = base_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(b).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in b) for k in PATTERNS]
        assert set(b) <= set(r.spans.split(",")) or not b
    assert pii.digests(pii.find(table(spark, []))).count() == 0
    added = pii.digests(pii.find(table(spark, ["call me at (988) 555-2485 now", "mail bob (at) mail (dot) com", "nothing here"] + ["mail a@b.com or call +1 (988) 555-2485 today"] * 20))).collect()
    assert {r.doc_id: r.spans for r in added}[2] == "" and {r.doc_id: r.spans for r in added}[0] == "phone:11:25"


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, name):
    same(spark, connect(), entry.queries()[name], entry.oracle_sql()[name])


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = {r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()}
    assert out and out <= {r.doc_id for r in docs.select("doc_id").collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, DATA).cache()
        assert kept.columns == docs.columns, name
        if name == "near_duplicates":
            sets = {r.doc_id: shingle_set(r.text, 5) for r in before.collect()}
            ids = sorted(sets)
            links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            comp = group(ids, links)
            assert {r.doc_id for r in kept.collect()} == {i for i in ids if comp[i] == i}
    assert {r.doc_id for r in kept.collect()} == out
