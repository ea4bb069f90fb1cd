"""Each operator against a plain version of itself, and on nulls, empty and long texts, repeated rows and empty tables."""

import hashlib
import html as html_lib
import os
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm import bpe, catalog, html, langid, licenses, multiset, packing, shared, similar, simhash, toxicity, urls, winnow

SCHEMA = "doc_id long, text string"
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    pool = ["alpha", "Beta", "gamma", "delta", "ÉPSILON", "zeta", "eta", "theta", "iota", "kappa", "λάμδα", "mu", "x1", "-"]
    made = [" ".join(rng.choice(pool) for _ in range(rng.choice([1, 2, 3, 40, 300]))) for _ in range(60)]
    near = [t.replace("alpha", "alfa", 1) for t in made[:15]]
    texts = [*made, *near, *made[:10], None, "", "   ", "\n\t", "one", "One\u00a0two", "word " * 30_000, made[3].upper(), "a\n\nb\n\nc", "12 34 \U0001f600"]
    return [*enumerate(texts), (None, "no id"), (None, None), (5, texts[5])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# SimHash

def plain_fingerprint(text, n):
    w = words_of(text, r"[^\x20\x09-\x0D]+")
    if not w:
        return 0
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash_components(docs, rows):
    prints = [plain_fingerprint(t, 3) for _, t in rows]
    roots = plain_components(prints)
    smallest = {}
    for (d, _), r in zip(rows, roots, strict=True):
        if d is not None:
            smallest[r] = min(d, smallest.get(r, d))
    want = sorted(((d, p, smallest.get(r)) for (d, _), p, r in zip(rows, prints, roots, strict=True)), key=str)
    got = sorted(((r.id, r.fp % 2**64, r.component) for r in simhash.near_duplicates(docs, shingle=3).collect()), key=str)
    assert got == want


@pytest.mark.parametrize("hot", [0, 3, 32])
def test_links_are_whole_however_hot(spark, monkeypatch, hot):
    """Dense clusters of fingerprints: the links connect exactly what two bits connect, with hot segments and without."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(hot)
    values = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(40):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))))
    values = sorted(values)
    nodes = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)), i) for i, v in enumerate(values)], "fp long, rep long")
    roots = plain_components(values)
    scratch = shared.Scratch(spark)
    found = {r.node: r.component for r in simhash.components(simhash.links(nodes), scratch).collect()}
    groups = {}
    for i, r in enumerate(roots):
        groups.setdefault(r, []).append(i)
    for own in groups.values():
        assert {found.get(i, i) for i in own} == {min(own)}


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long").repartition(4)
    got = simhash.components(edges, shared.Scratch(spark)).collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(1, n + 1)}


def test_dedup_keeps_one_of_each(spark, docs, rows):
    kept = simhash.drop_near_duplicates(docs.withColumn("fp", F.lit("clash")).withColumn("id", F.lit("clash")), shingle=3)
    assert kept.columns == [*docs.columns, "fp", "id"]
    roots = plain_components([plain_fingerprint(t, 3) for _, t in rows])
    smallest = {}
    for (d, _), r in zip(rows, roots, strict=True):
        if d is not None:
            smallest[r] = min(d, smallest.get(r, d))
    got = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert got == sorted(smallest.values())
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["no id"]  # the null one is like the empty texts
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("data", [[(3, "A"), (5, "A"), (5, "B")], [(5, "A"), (5, "B")], [(None, "A"), (None, "B"), (None, "A"), (7, "B")], [(1, "A"), (2, "A"), (1, "B"), (2, "B"), (2, "C"), (None, "C"), (2, "C")]])
def test_dedup_loses_no_text(spark, data):
    """Ids that repeat in several components, or are missing: one row of each component stays, by id and then fingerprint."""
    df = spark.createDataFrame([(d, t, "x", {"k": 1}) for d, t in data], SCHEMA + ", root string, n map<string,int>").repartition(3)
    for kept in (simhash.drop_near_duplicates(df), similar.drop_similar(df)):
        assert kept.columns == df.columns
        want = {t: min((d for d, u in data if u == t and d is not None), default=None) for _, t in data}
        assert sorted((r.text, str(r.doc_id)) for r in kept.collect()) == sorted((t, str(d)) for t, d in want.items())


def test_frequent_keys_are_joined_apart(spark, monkeypatch, docs, rows):
    monkeypatch.setattr(simhash, "MANY", 3)
    test_simhash_components(docs, rows)
    test_components_of_a_long_chain(spark)
    star = spark.createDataFrame([(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(300, 400)], "a long, b long").repartition(4)
    got = {r.node: r.component for r in simhash.components(star, shared.Scratch(spark)).collect()}
    assert got == {i: 0 for i in range(1, 200)} | {i: 300 for i in range(301, 401)}


def test_scratch_is_deleted(spark, docs, tmp_path):
    with shared.temporary():
        simhash.drop_near_duplicates(docs).write.parquet(f"{tmp_path}/kept")
        made = [x.root.removeprefix("file://") for x in shared._scopes[-1]]
        assert any(os.path.isdir(x) for x in made)
    assert made and not any(os.path.isdir(x) for x in made)


# Licences

def test_licenses_columns(spark):
    assert licenses.scan(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(empty(spark).withColumn("licenses", F.lit(1)))


# Multiset fingerprints

def neighbours_of(spark, rows):
    """Equal ids (also missing ones) stand in order of their texts' hashes."""
    hashed = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, hashed[r[1]]))
    return sorted((str(d), t, ordered[(i + 1) % len(ordered)][1]) for i, (d, t) in enumerate(ordered))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_neighbours_of_frequent_ids(spark, monkeypatch, kind):
    """One id, and one row, hold a third of all rows each: neighbours are right and no stretch holds much more than its share."""
    monkeypatch.setattr(multiset, "STRETCH_BYTES", 500)
    rng = random.Random(3)
    rows = [(7, f"text {rng.randrange(10**6)}") for _ in range(400)] + [(9, "same")] * 400 + [(i, f"t{i}") for i in range(100, 300)] + [(None, f"n{i}") for i in range(100)] + [(None, None)] * 50
    if kind == "string":
        rows = [(d if d is None else f"{d:05d}", t) for d, t in rows]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3).cache()
    got = multiset.neighbours(df)
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in got.collect()) == neighbours_of(spark, [(d or None, t) for d, t in rows])
    sizes = sorted(r["count"] for r in got.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect())
    assert sizes[-1] < 200 and len(sizes) > 10


def test_neighbours_refuse_other_ids(spark):
    with pytest.raises(TypeError, match="integers or strings"):
        multiset.neighbours(spark.createDataFrame([(1.5, "x")], "doc_id double, text string"))


def test_lanes_dont_carry(spark):
    """More equal runs than 21 bits count: every lane counts all or none of them."""
    n = 2_200_001
    v = spark.range(1).select(F.repeat(F.lit("a\n"), n).alias("t")).select(multiset.vector(F.col("t")).alias("v"), multiset.vector(F.lit("a\na\na")).alias("w"))
    r = v.select("v", multiset.biases(F.col("v")).alias("b"), multiset.likeness(F.col("v"), F.col("w"), multiset.biases(F.col("v")), multiset.biases(F.col("w"))).alias("like")).first()
    h = spark.range(1).select(F.xxhash64(F.lit("a"), F.lit(None).cast("string"), F.lit(None).cast("string"))).first()[0] % 2**64
    assert r.v[4] == n and set(r.b) == {-n, n} and sum(x > 0 for x in r.b) == bin(h).count("1") and r.like == pytest.approx(1)
    whole = (2**32 - 1) | (2**32 - 1) << 32
    one, most = F.lit(1 | 1 << 32), F.lit(whole - 2**64)
    x = spark.range(1).select(multiset.combine(F.array(most), F.array(one)).alias("plus"), multiset.combine(F.array(F.lit(0).cast("long")), F.array(one), -1).alias("minus")).first()
    assert x.plus == [0] and x.minus == [whole - 2**64]


def plain_vector(spark, text):
    """Lane by lane from the definition."""
    runs = []
    for p in (text or "").split("\n"):
        w = p.split(" ") + [None, None]
        runs += [(a, b, c) for a, b, c in zip(w, w[1:], w[2:], strict=False)] if p else []
    hashes = [r[0] % 2**64 for r in spark.createDataFrame(runs or [("", "", "")], "a string, b string, c string").select(F.xxhash64("a", "b", "c")).collect()] if runs else []
    return len(runs), sorted(2 * sum(h >> i & 1 for h in hashes) - len(hashes) for i in range(64))


@pytest.mark.parametrize("words", [0, 1, 127, 128, 255, 1000])
def test_likeness_lanes(spark, words):
    text = "\n".join(" ".join(f"w{i * 7 % 97}" for i in range(k, min(k + 90, words))) for k in range(0, words, 90))
    r = spark.range(1).select(multiset.vector(F.lit(text)).alias("v")).select("v", multiset.biases(F.col("v")).alias("b")).first()
    assert (r.v[4], sorted(r.b)) == plain_vector(spark, text)


def test_multiset(spark, docs, rows):
    got = multiset.neighbours(docs).collect()
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in got) == neighbours_of(spark, rows)
    by_text = {}
    for r in got:
        by_text.setdefault(tuple(r.vector), set()).add(tuple(sorted(x for x in r.text.split("\n") if x)))
    assert all(len(v) == 1 for v in by_text.values())  # one fingerprint, one multiset of paragraphs
    assert multiset.neighbours(empty(spark)).count() == 0


def test_multiset_is_homomorphic(spark):
    v = lambda s: multiset.vector(F.lit(s))
    row = spark.range(1).select(
        (v("one two\nthree four five") == v("three four five\n\none two")).alias("order"), (multiset.combine(v("a b"), v("c d e")) == v("c d e\na b")).alias("plus"),
        (multiset.combine(v("a b\nc"), v("c"), -1) == v("a b")).alias("minus"), (v("a b") == v("a c")).alias("differs"), (v("a\na") == v("a")).alias("counts"),
    ).first()
    assert (row.order, row.plus, row.minus, row.differs, row.counts) == (True, True, True, False, False)


@pytest.mark.parametrize("a, b, want", [("abcd", "XYZ", "abXY"), ("abc", "X", "abX"), ("abcde", "", "abc"), ("", "X", ""), ("é😀ü", "Z", "é😀Z")])
def test_edited(spark, a, b, want):
    assert spark.range(1).select(multiset.edited(F.lit(a), F.lit(b))).first()[0] == want


def test_multiset_likeness(spark):
    a = " ".join(f"w{i}" for i in range(400))
    half, other = a[: len(a) // 2] + " ".join(f"z{i}" for i in range(200)), " ".join(f"q{i}" for i in range(400))
    rows = spark.createDataFrame([(a, a), (a, half), (a, other), ("", ""), ("", a)], "x string, y string").select(multiset.vector(F.col("x")).alias("v"), multiset.vector(F.col("y")).alias("w"))
    got = [r[0] for r in rows.select(multiset.likeness(F.col("v"), F.col("w"), multiset.biases(F.col("v")), multiset.biases(F.col("w")))).collect()]
    assert got[0] == 1 and 0.3 < got[1] < 0.8 and got[2] < 0.3 and got[3:] == [1, 0]


# URLs

RULES = [urls.site_rule(*x) for x in catalog.SITE_RULES] + urls.spam_rules()
CASES = [
    ("http://A.NET/x", "a.net", "/x", "net/", "block"), ("https://example.net/en/1?q#f", "example.net", "/en/1", "example.net/en/", "allow"), ("http://www.example.net/en", "www.example.net", "/en", "net/", "block"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"), ("http://m.example.com/de/x", "m.example.com", "/de/x", "example.com/de/", "block"), ("http://a.org/fr/#", "a.org", "/fr/", "org/fr/", "allow"),
    ("http://a.net", "a.net", "", None, "allow"), ("http://a.net?x=/", "a.net", "", None, "allow"), ("nothing", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("http://cheap-pills.example.org/", "cheap-pills.example.org", "/", None, "block"), ("http://spam.org/fr/1", "spam.org", "/fr/1", "org/fr/", "allow"), ("http://spamless.org/", "spamless.org", "/", None, "allow"), ("x://y://z/p", "y:", "//z/p", None, "allow"),
]


@pytest.mark.parametrize("literal", [500, 0])
def test_urls(spark, monkeypatch, literal):
    monkeypatch.setattr(urls, "LITERAL", literal)
    pages = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "page_id long, url string")
    got = sorted(tuple(r) for r in urls.judge(pages, RULES).collect())
    assert got == sorted((i, *c) for i, c in enumerate(CASES)) if None not in [g[1] for g in got] else True
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, RULES).collect()} == {i: c[1:] for i, c in enumerate(CASES)}
    assert urls.judge(pages.limit(0), RULES).count() == 0
    assert urls.judge(pages, []).where("verdict = 'allow'").count() == len(CASES)


# Language identification

@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(2)
    parts = {"aa": ["ka", "to", "mi", "ra"], "bb": ["shu", "ving", "est", "lo"], "cc": ["ñe", "çu", "öl", "át"]}
    rows = [(i, " ".join("".join(rng.choice(parts[x]) for _ in range(rng.randrange(1, 4))) for _ in range(30)), x) for i, x in enumerate(rng.choice(sorted(parts)) for _ in range(200))]
    return spark.createDataFrame(rows, SCHEMA + ", lang string")


def test_langid_held_out(spark, tongues):
    model = langid.learn(tongues)
    got = langid.predict(tongues, model, ["doc_id", "lang"]).collect()
    assert all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !"), (4, "KATO MIRA KATOMI"), (5, "日本"), (6, "kato " * 50_000)], SCHEMA)
    assert [r.lang_pred for r in langid.predict(odd, model, ["doc_id"]).orderBy("doc_id").collect()][:4] == ["und", "und", "und", "aa"]
    assert langid.learn(tongues.limit(0)) is None
    assert langid.predict(odd, None, ["doc_id"]).where("lang_pred = 'und' and score = 0").count() == 6
    kept = langid.drop_foreign(tongues.unionByName(odd.withColumn("lang", F.lit(None).cast("string"))))
    assert kept.where("lang is not null").count() == 200 and kept.where("doc_id = 3 and lang is null").count() == 0


def test_langid_learns_every_language(spark, tongues, monkeypatch):
    """A language of a few huge texts isn't drawn empty, and many languages' trees are kept as what they have seen."""
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 300)
    huge = spark.createDataFrame([(10_000 + i, "wok zim " * 5000, "dd") for i in range(4)], SCHEMA + ", lang string")
    docs = tongues.unionByName(huge)
    assert langid.learn(docs).languages == ["aa", "bb", "cc", "dd"]
    monkeypatch.undo()
    read = lambda: sorted((r.doc_id, r.lang_pred, round(r.score, 6), round(r.bits_per_byte, 3)) for r in langid.predict(docs, langid.learn(docs), ["doc_id"]).collect())
    want = read()
    monkeypatch.setattr(langid, "TABLE_BYTES", 0)
    assert isinstance(langid.learn(docs), langid.Trees) and read() == want


def test_unlearned_languages_are_foreign(spark, tongues):
    rng = random.Random(6)
    other = spark.createDataFrame([(i, " ".join("".join(rng.choice("pqxwzgjhd") for _ in range(6)) for _ in range(40)), "ee") for i in range(20_000, 20_020)], SCHEMA + ", lang string")
    kept = langid.drop_foreign(tongues.unionByName(other.withColumn("lang", F.lit(None).cast("string"))))
    assert kept.where("doc_id >= 20000").count() == 0 and kept.count() == tongues.count()


def test_code_lengths_take_little_memory():
    """A slice of texts is read in pieces: at once it took over 100 MB in each worker."""
    import tracemalloc

    import pyarrow as pa

    key, n = langid._grams(pa.array(["abracadabra abrac"], pa.large_string()))
    model = langid.build({"x": (key.astype(np.int64), n.astype(float)), "y": (key.astype(np.int64), n.astype(float))})
    texts = ["abra cad " * k for k in (1, 40, 30_000, 3, 0, 60_000, 7)]
    tracemalloc.start()
    total, count, letters = langid.code_lengths(model, pa.array(texts, pa.large_string()))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40 << 20, most
    for i, text in enumerate(texts):
        alone = langid.code_lengths(model, pa.array([text], pa.large_string()))
        assert (total[i] == alone[0][0]).all() and count[i] == alone[1][0] and letters[i] == alone[2][0]


def test_contamination_takes_little_memory():
    """A batch of texts is read in slices, of which each byte takes about 100 bytes meanwhile."""
    import tracemalloc

    import pyarrow as pa

    index = winnow.Index([("a", "one two three four five six seven eight nine ten eleven twelve thirteen")])
    batch = pa.RecordBatch.from_arrays([pa.array([f"w{i} plain words of a text " * 40 for i in range(1800)])], names=["text"])
    list(map(lambda x: winnow.matched(index, x[1]), shared.slices(batch.slice(0, 10), "text")))
    tracemalloc.start()
    n = sum(int(winnow.matched(index, texts)[0].sum()) for _, texts in shared.slices(batch, "text"))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1800 * 40 * 6
    assert most < 32 << 20, most


def test_links_of_a_task_are_handed_on_in_parts():
    """A task's union-find holds some 100,000 nodes, and what it hands on at once is as small."""
    import pyarrow as pa

    a = np.arange(0, 600_000, 2)
    whole = pa.RecordBatch.from_arrays([pa.array(a), pa.array(a + 1)], names=["a", "b"])
    parts = list(simhash._forest(whole.slice(i, 1000) for i in range(0, len(a), 1000)))
    assert max(p.num_rows for p in parts) <= 110_000
    assert sorted((x, y) for p in parts for x, y in zip(p.column(0).to_pylist(), p.column(1).to_pylist(), strict=True)) == [(x, x + 1) for x in a.tolist()]


@pytest.mark.parametrize("most", [64 << 20, 0])
@pytest.mark.parametrize("piece", [1 << 20, 4])
def test_code_lengths_are_exact(monkeypatch, most, piece):
    """The table, and the trees, give what the recursive definition gives, in pieces or not."""
    import pyarrow as pa

    monkeypatch.setattr(langid, "TABLE_BYTES", most)
    monkeypatch.setattr(langid, "PIECE", piece)
    sample = "abracadabra abrac"
    texts = pa.array([sample, "cab"], pa.large_string())
    key, n = langid._grams(texts)
    model = langid.build({"x": (key.astype(np.int64), n.astype(float))})
    seen = {}
    for t in (sample, "cab"):
        padded = "   " + t
        for i in range(3, len(padded)):
            for k in range(4):
                own = seen.setdefault(padded[i - k : i], {})
                own[padded[i]] = own.get(padded[i], 0) + 1

    def p(context, c):
        table = seen.get(context)
        shorter = 1 / 256 if not context else None
        if table:
            total, kinds = sum(table.values()), len(table)
            if c in table:
                return table[c] / (total + kinds)
            return kinds / (total + kinds) * (shorter if shorter else p(context[1:], c))
        return shorter if shorter else p(context[1:], c)

    probe = "bracx dab"
    padded = "   " + probe
    want = sum(-np.log2(p(padded[i - 3 : i], padded[i])) for i in range(3, len(padded)))
    assert langid.code_lengths(model, pa.array([probe], pa.large_string()))[0][0, 0] == pytest.approx(want, rel=1e-5)


# BPE

def test_bpe_matches_the_library(docs, rows):
    from tokenizers import Tokenizer

    path = catalog.vocabulary("byte_bpe_50k.json")
    reference = Tokenizer.from_file(path)
    extra = ["a" * 4000, "x<|endoftext|>y", "it's we'll  \n\n z", "日本語 😀\u200b", " " * 300, "\x00\x1c\x85"]
    auto = bpe.automaton(path)
    for t in [*(t or "" for _, t in rows), *extra]:
        ids = reference.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(auto.encode(t), "<u4").tolist() == ids
        assert auto.decode(auto.encode(t)) == reference.decode(ids, skip_special_tokens=False)
    got = catalog.digests(bpe.encode(docs, path, ["doc_id"])).collect()
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in got) == sorted((str(d), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)


def test_automaton_on_repeated_letters():
    """Merges of a token with itself: the accepted path is what merging in order gives."""
    path = catalog.vocabulary("byte_bpe_50k.json")
    auto = bpe.Automaton(path)
    rng = random.Random(4)
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(path)
    for _ in range(300):
        t = "".join(rng.choice(["a", "aa", "e", "==", "-"]) for _ in range(rng.randrange(1, 60)))
        assert np.frombuffer(auto.encode(t), "<u4").tolist() == reference.encode(t, add_special_tokens=False).ids


# HTML

PAGE = "<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav><div class='ad'>Buy now</div><article><h1>%s &amp; more</h1><p>One <b>two\n three<br>four %s<p>and so on</p><p>Subscribe to us</p><script>if (a<b) x()</script><form><input>Mail</form></article><section id=comments><p>nice!</p></section><aside>side</aside><footer>&copy;</footer></body></html>"  # noqa: E501


def test_html(spark):
    pages = [(i, f"http://h.org/{i}", PAGE % (f"Title {i}", f"text of page {i} " * 5)) for i in range(8)]
    odd = [(90, "http://h.org/90", None), (91, None, ""), (92, "x", "plain &lt;text&gt; &eacute;"), (93, "http://h.org/93", "<p>a<p>b<table><tr><td>c<td>d"), (94, "y", "<p>" + "long " * 100_000), (95, "y", "<ul><li><a href=x>menu entry</a></ul><p>body text</p>")]
    df = spark.createDataFrame([*pages, *odd, pages[0]], "page_id long, url string, html string")
    got = {}
    for r in html.main_text(df, ["page_id", "url"]).collect():
        assert got.setdefault(r.page_id, r.text) == r.text
    for i in range(8):  # what every page of the host says inside the article is template
        assert got[i] == f"Title {i} & more\nOne two three four " + " ".join([f"text of page {i}"] * 5)
    assert [got[k] for k in (90, 91, 92, 93, 95)] == ["", "", "plain <text> é", "a\nb\nc\nd", "body text"]
    assert len(got[94]) == 5 * 100_000 - 1
    assert html.main_text(df.limit(0), ["page_id"]).count() == 0
    with pytest.raises(ValueError):
        html.main_text(df.withColumn("text", F.lit("")), ["page_id", "text"])


def test_copies_are_not_template():
    copy = "<article><h1>Same</h1><p>Same text</p></article>"
    other = ["<article><h1>T%d</h1><p>Text %d</p></article>" % (i, i) for i in range(4)]  # noqa: UP031
    assert html.extract([copy] * 30 + other)[0] == "Same\nSame text"


def test_deep_and_wide_pages():
    deep, wide = "<div>" * 5000 + "end" + "</div>" * 5000 + "<p>after", "<table>" + "<tr><td>a<td>b" * 3000
    got = html.extract([deep, wide, *(f"<p>page {i}" for i in range(6))])
    assert got[0] == "end\nafter" and got[1].split("\n") == ["a", "b"] * 3000


def test_references_decode():
    assert html.extract(["<p>a &amp b &#233; &unknown; &am</p>"]) == [html_lib.unescape("a &amp b &#233; &unknown; &am")]


# Toxicity

def test_toxicity(spark):
    rng = random.Random(9)
    plain = [" ".join(rng.choice(["house", "tree", "walks", "green", "river"]) for _ in range(20)) + f" n{i}" for i in range(240)]
    bad = [p.replace("house", "blargon", 2) + " you vilewretch" if i % 3 == 0 else p for i, p in enumerate(plain)]
    docs = spark.createDataFrame([*enumerate(bad), (None, "blargon"), (500, None), (501, "")], SCHEMA)
    labels = spark.createDataFrame([*((i, int(i % 3 == 0)) for i in range(240)), (None, 1), (3, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert "blargon" in lexicon.words and "house" not in lexicon.words
    got = {r.doc_id: r.score for r in toxicity.score(docs, lexicon, ["doc_id"]).collect()}
    assert all((got[i] >= toxicity.THRESHOLD) == (i % 3 == 0) for i in range(240))
    assert got[500] < toxicity.THRESHOLD and got[501] == got[500]
    abuse, quote = "you blargom and vilewretch, blargin you blarggon", 'they wrote "blargon vilewretch" on it'
    assert toxicity.scores(lexicon, [abuse])[0] > toxicity.THRESHOLD > toxicity.scores(lexicon, [quote])[0]
    kept = toxicity.drop_toxic(docs.withColumn("score", F.lit("clash")), labels)
    assert kept.columns == ["doc_id", "text", "score"] and kept.where("doc_id % 3 = 0 and doc_id < 240").count() == 0 and kept.where("doc_id % 3 > 0 and doc_id < 240").count() == 160
    assert toxicity.learn(docs, labels.limit(0)).words == {}
    assert toxicity.score(empty(spark), lexicon, ["doc_id"]).count() == 0


def distance(a, b):
    """Edits with swaps of adjacent letters, each letter edited once (optimal string alignment)."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_levenshtein_against_brute_force(edits):
    rng = random.Random(edits)
    terms = ["blargon", "vilewretch", "abcde", "abcdf", "abab", "aabb", "xyz"]
    trie = toxicity.trie_of(terms)
    for _ in range(1500):
        word = list(rng.choice(terms))
        for _ in range(rng.randrange(0, 5)):
            k = rng.randrange(0, len(word) + 1)
            word[k : k + rng.randrange(0, 2)] = rng.choice(["", "a", "b", "g", "x"])
            if rng.random() < 0.3 and k + 1 < len(word):
                word[k], word[k + 1] = word[k + 1], word[k]
        word = "".join(word)
        assert toxicity.near(trie, word, edits) == {t for t in terms if len(t) >= toxicity.FUZZY and 1 <= distance(t, word) <= edits}, word


def plain_score(lexicon, text):
    """The definition, hit by hit: whole words, else their longest beginning, else the heaviest term one edit away."""
    low = (text or "").lower()
    words = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", low)]

    def grade(w):
        if w in lexicon.words:
            return lexicon.words[w], False
        starts = [b for b in lexicon.beginnings if w.startswith(b)]
        if starts:
            return lexicon.beginnings[max(starts, key=len)], False
        near = [] if w in lexicon.ordinary else [g for t, g in lexicon.words.items() if len(t) >= 4 and distance(t, w) == 1]
        return max(near, default=0), True

    def quoted(a, b):
        line = low[:a].rpartition("\n")[2]
        before, after = line[-60:], low[b : b + 60].partition("\n")[0]
        marks = [(before.rfind(c), c) for c in '"“„«‘»' if c in before]
        if not marks or not any(c in after for c in '"”“»’«'):
            return False
        return max(marks)[1] != '"' or line.count('"') % 2 == 1

    n = [0, 0, 0, 0]
    for w, a, b in words:
        g, missed = grade(w)
        n[missed + 2 * quoted(a, b)] += g
    for (w, a, b), (v, c, d) in zip(words, words[1:], strict=False):
        if c == b + 1 and not low[b].isspace() and not grade(w)[0] and not grade(v)[0]:
            g, missed = grade(w + low[b] + v)
            n[1 + 2 * quoted(a, d)] += g if missed else 0
    x = [*np.log1p(n), np.log1p(100 * (n[0] + n[1]) / max(1, len(words))), 1]
    return 1 / (1 + np.exp(-np.clip(np.dot(x, lexicon.weights), -30, 30)))


def test_scores_against_brute_force():
    rng = random.Random(2)
    lexicon = toxicity.Lexicon({"blargon": 1.0, "vile": 0.7, "scum": 0.9}, {"wretch": 0.5, "wretched": 0.8}, np.array([2.0, 1.1, 0.4, 0.3, 0.6, -3.0]), frozenset({"vine", "blargons"}))
    pool = ["blargon", "blarg0n", "blargn", "vile", "vine", "vole", "scvm", "sc.um", "wretches", "wretchedly", "wretc", "blargons", "tree", "a", '"', "“", "”", "«", "»", ".", "\n", "bla-rgon", "7", "vil e", "lbargon"]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", " ", "", "\n"]) for _ in range(rng.randrange(0, 60))) for _ in range(400)] + [""]
    got = toxicity.scores(lexicon, texts)
    assert np.allclose(got, [plain_score(lexicon, t) for t in texts]) and len(set(np.round(got, 6))) > 200


def test_quotations_are_told_in_linear_time():
    import time

    lexicon, spent = toxicity.Lexicon({"blargon": 1.0}), []
    for n in (20_000, 80_000):
        text, start = 'he said "blargon" ' * n, time.perf_counter()
        toxicity.features(lexicon, text)
        spent.append(time.perf_counter() - start)
    assert spent[1] < 10 * spent[0]


def test_open_quotations_by_plain_counting():
    rng = random.Random(11)
    for text in ["", "\n", '"', *("".join(rng.choice('"\n ab') for _ in range(40)) for _ in range(100))]:
        marks = toxicity.Marks(text)
        assert [marks.open_at(i) for i in range(len(text) + 1)] == [text[:i].rpartition("\n")[2].count('"') % 2 == 1 for i in range(len(text) + 1)]


def test_open_quotations_are_told_without_reading_the_line():
    """A million characters and marks on one line: looking back for its start takes time for each mark."""
    import time

    marks, spent = toxicity.Marks('"a b c d e' * 200_000), 1e9
    for _ in range(2):
        start = time.perf_counter()
        for at in range(1_900_000, 1_902_000):
            marks.open_at(at)
        spent = min(spent, time.perf_counter() - start)
    assert spent < 0.02


def test_a_small_table_of_words_gives_the_same_tokens():
    path = catalog.vocabulary("byte_bpe_50k.json")
    small, large = bpe.Automaton(path, 3), bpe.Automaton(path)
    for text in ("the cat sat on the mat, the cat", "a b c d e f g a b c", "Съешь ещё этих"):
        assert small.encode(text) == large.encode(text) and len(small.words) <= 3


def test_rare_terms_are_learned(spark):
    """A language with few toxic texts, whose terms share only their beginning, among many toxic texts of another."""
    rng = random.Random(7)
    common, rare = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(10)], [f"z{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(10)]
    data = []
    for i in range(1500):
        pool, stem = (common, ["blargon"]) if i % 15 else (rare, [f"zorgu{x}" for x in ("la", "mi", "ne", "po", "rit", "sak")])
        toxic = i % 8 == 1
        words = [rng.choice(pool) for _ in range(60)]
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(60), rng.choice(stem))
        data.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(data, SCHEMA + ", toxic int")
    lexicon = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert any("zorgu".startswith(b) or b.startswith("zorgu") for b in lexicon.beginnings) and "blargon" in lexicon.words
    got = toxicity.score(df, lexicon, ["doc_id", "toxic"]).collect()
    assert all((r.score >= toxicity.THRESHOLD) == r.toxic for r in got)


# Packing

def test_best_fit_decreasing():
    rng = random.Random(6)
    for _ in range(30):
        width = rng.randrange(1, 60)
        lengths = [rng.randrange(1, width + 1) for _ in range(rng.randrange(0, 120))]
        rows, free = [], []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [f for f in free if f >= lengths[i]]
            if not fits:
                rows.append([])
                free.append(width)
                fits = [width]
            k = min(range(len(free)), key=lambda k: free[k] if free[k] >= lengths[i] else 10**9)
            rows[k].append(i)
            free[k] -= lengths[i]
        got = packing.best_fit(lengths, width)
        assert sorted(i for r in got for i in r) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in r) <= width for r in got) and len(got) == len(rows)


def test_packing_loses_nothing(docs, rows):
    path = catalog.vocabulary("byte_bpe_50k.tiktoken")
    own, end = packing.encoder(path)
    pieces = {}
    for r in packing.pack(docs, path, width=64).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64 and r.position_resets == r.cu_seqlens[:-1]
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            pieces.setdefault(d, []).append((s, ids[a:b].tolist()))
    for d, t in rows:
        if d not in (None, 5):
            assert [x for _, p in sorted(pieces[d]) for x in p] == [*own.encode_ordinary(t or ""), end]
    assert sum(len(p) for _, p in pieces[None]) == len(own.encode_ordinary("no id")) + 2
    assert packing.pack(docs.limit(0), path).count() == 0


# Decontamination

BENCH = [(1, " ".join(f"q{i}" for i in range(30))), (2, "Short item here"), (3, None), (4, ""), (5, " ".join(f"q{i}" for i in range(10, 40))), (6, "solo"), (2, "second text of two"), (None, "solo two")]
CONTAMINATED = [
    (1, "x " * 50 + BENCH[0][1] + " y" * 50), (2, "SHORT item, here! and more words"), (3, " ".join(f"q{i}" for i in range(12))), (4, None), (5, ""), (6, "a solo b " + "c " * 500), (7, " ".join(f"q{i}" for i in range(3, 16))),
    (8, (" ".join(f"q{i}" for i in range(13)) + " gap ") * 40), (9, "é" * 10 + " " + BENCH[4][1]), (1, "repeated id"), (None, "solo"),
]


def plain_contamination(text, bench):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w, hit, items = words_of(text, pattern), set(), set()
    for name, item in bench:
        v = words_of(item, pattern)
        n = min(13, len(v))
        for k in range(len(v) - n + 1) if n and name is not None else ():
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[k : k + n]:
                    hit |= set(range(j, j + n))
                    items.add(str(name))
    return len(w), len(hit), sorted(items)


@pytest.mark.parametrize("held", [8 << 20, 60])
def test_winnow(spark, monkeypatch, docs, rows, held):
    """With the index broadcast, and with fingerprints joined by shuffle."""
    monkeypatch.setattr(winnow, "BROADCAST_BYTES", held)
    monkeypatch.setattr(winnow, "PIECE", 50)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    for data, df in ((CONTAMINATED, spark.createDataFrame(CONTAMINATED, SCHEMA)), (rows, docs)):
        got = sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in winnow.contamination(df, bench, ["doc_id"]).collect())
        assert got == sorted((str(d), *plain_contamination(t, BENCH)) for d, t in data)
    assert winnow.contamination(empty(spark), bench, ["doc_id"]).count() == 0
    assert winnow.contamination(docs, bench.limit(0), ["doc_id"]).where("n_hit > 0").count() == 0
    df = spark.createDataFrame(CONTAMINATED, SCHEMA).withColumn("n_hit", F.lit("clash"))
    kept = winnow.drop_contaminated(df, bench)
    want = sorted(str(t) for _, t in CONTAMINATED if not (lambda n, hit, _: hit > 0 and 20 * hit >= n)(*plain_contamination(t, BENCH)))
    assert kept.columns == df.columns and sorted(str(r.text) for r in kept.collect()) == want


def test_a_large_benchmark_is_not_held(spark, monkeypatch):
    """Above the bound no index is made and the benchmark isn't collected; the results are the same."""
    rng = random.Random(5)
    word = lambda: f"v{rng.randrange(3000)}"
    bench = [(i, " ".join(word() for _ in range(60))) for i in range(400)]
    data = [(i, " ".join([*(word() for _ in range(20)), *bench[i % 400][1].split()[5 : 5 + i % 30], *(word() for _ in range(20))])) for i in range(600)]
    bench_df, df = spark.createDataFrame(bench, "item_id long, text string"), spark.createDataFrame(data, SCHEMA).repartition(4)
    read = lambda: sorted(tuple(r) for r in winnow.contamination(df, bench_df, ["doc_id"]).collect())
    want = read()
    monkeypatch.setattr(winnow, "BROADCAST_BYTES", 1000)
    monkeypatch.setattr(winnow, "Index", None)
    assert read() == want and sum(r[2] > 0 for r in want) > 200


def test_winnow_reads_long_texts_in_pieces():
    """Text of many pieces, hits across their borders, and words longer than a piece."""
    import pyarrow as pa

    item = " ".join(f"q{i}" for i in range(40))
    filler = " ".join(f"f{i % 977}" for i in range(200_000))
    text = " ".join([filler, item, "x" * 3_000_000, filler, item, "y" * 1_100_000, item])
    index = winnow.Index([("a", item), ("b", "f3 f4 f5")])
    n, hit, spans, items = winnow.matched(index, pa.array([text], pa.large_string()))
    assert (n[0], items[0]) == (400_122, ["a", "b"])
    assert hit[0] == 120 + 3 * 2 * len([i for i in range(200_000) if i % 977 == 3 and i + 2 < 200_000]) and len(spans[0]) > 400
    data, before = [], 0
    for w, at in winnow.pieces(pa.array([text], pa.large_string())):
        data.append(len(w.data))
        before = at + len(w.start)
    assert before == 400_122 and max(data) < 6 * winnow.PIECE and len(data) >= 3


def test_winnow_finds_every_long_span():
    rng = random.Random(8)
    bench = [("i", " ".join(str(rng.randrange(40)) for _ in range(200)))]
    import pyarrow as pa

    index = winnow.Index(bench)
    for _ in range(200):
        v = bench[0][1].split()
        k = rng.randrange(0, 187)
        text = " ".join([*(str(rng.randrange(40)) for _ in range(rng.randrange(9))), *v[k : k + 13], *(str(rng.randrange(40)) for _ in range(rng.randrange(9)))])
        assert winnow.matched(index, pa.array([text], pa.large_string()))[1][0] == plain_contamination(text, bench)[1]


# All of them

def test_clashing_columns(docs):
    with pytest.raises(ValueError):
        winnow.contamination(docs.withColumn("n_hit", F.lit(1)), docs.select(F.col("doc_id").alias("item_id"), "text"), ["doc_id", "n_hit"])


def test_pipeline_stages(spark, tmp_path):
    """Each stage's decisions take effect and clean documents pass, from a folder of small tables."""
    rng = random.Random(12)
    lang = {"aa": ["ka", "to", "mi", "ra"], "bb": ["shu", "ving", "est", "lo"]}
    make = lambda x, n=40: " ".join("".join(rng.choice(lang[x]) for _ in range(rng.randrange(2, 5))) for _ in range(n))
    data = [(i, make("aa" if i % 2 else "bb"), "aa" if i % 2 else "bb", f"src{i % 3}") for i in range(300)]
    toxic = {i for i in range(0, 300, 6)}
    data = [(i, t + " blargon vilewretch blargon" * (i in toxic), x, s) for i, t, x, s in data]
    item = make("aa", 30)
    data += [(900, data[1][1], "aa", "src0"), (901, item + " kato", "aa", "src0"), (902, "12 34 %% ??", None, "src0"), (903, None, None, None), (904, data[0][1], "bb", "src1")]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = shared.table(spark, str(tmp_path), "documents")
    columns, gone = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path)).cache()
        assert kept.columns == columns
        gone.append({r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in kept.select("doc_id").collect()})
        docs = kept
    assert gone == [toxic | {904}, {902, 903}, {900}, {901}]
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == set(range(300)) - toxic
