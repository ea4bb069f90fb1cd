"""The pipeline's near-duplicates against brute force over all pairs of shingle sets."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioforge.llm import similar, simhash

SCHEMA = "doc_id long, text string"


def shingle_set(text, k=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)} or ({b" ".join(w)} if w else set())


def plain_components(texts):
    sets, parent = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 10 * len(a & b) >= 8 * len(a | b):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def made():
    """Families of copies with one to many edits, a large family, a common line, short and empty texts, repeated and missing ids."""
    rng = random.Random(5)
    line = " ".join(f"common{i}" for i in range(20))
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]

    def edited(words, edits):
        words = list(words)
        for _ in range(edits):
            k = rng.randrange(len(words))
            words[k : k + rng.randrange(2)] = [f"e{rng.randrange(9999)}"] * rng.randrange(2)
        return " ".join(words)

    texts = []
    for edits in range(6):
        for n in (30, 120, 200):
            base = text(n)
            texts += [" ".join(base), edited(base, edits), edited(base, 2 * edits)]
    family = text(150)
    texts += [edited(family, rng.randrange(6)) for _ in range(60)]
    texts += [" ".join(text(12)) + "\n" + line for _ in range(40)] + [line, line + " x", "A b", "a  B", "one", None, "", " \n"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [*rows, (None, texts[0]), (None, "alone"), (3, texts[3])]


@pytest.mark.parametrize("hot", [0, 3, 32])
def test_groups_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(similar, "HOT", hot)
    rows = made()
    roots, smallest = plain_components([t for _, t in rows]), {}
    for (d, _), r in zip(rows, roots, strict=True):
        if d is not None:
            smallest[r] = min(d, smallest.get(r, d))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(((r.id, r.component) for r in similar.groups(docs).collect()), key=str)
    assert got == sorted(((d, smallest.get(r)) for (d, _), r in zip(rows, roots, strict=True)), key=str)
    assert len(set(roots)) < len(rows) - 60  # the families are found at all
    kept = similar.drop_similar(docs)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(smallest.values())
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["alone"]
    assert similar.drop_similar(docs.limit(0)).count() == 0


def test_pipeline_stage_drops_edited_copies(spark):
    """Copies with a word changed here and there, which fingerprints within two bits mostly miss."""
    rng = random.Random(3)
    bases = [[f"w{rng.randrange(3000)}" for _ in range(200)] for _ in range(20)]
    rows = [(i, " ".join(b)) for i, b in enumerate(bases)]
    rows += [(100 + i, " ".join("edit" if j in (20, 90, 160) else w for j, w in enumerate(b))) for i, b in enumerate(bases)]
    rows += [(200 + i, " ".join("edit" if j % 20 == 7 else w for j, w in enumerate(b))) for i, b in enumerate(bases)]  # similarity about 0.6
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("lang", F.lit("xx"))
    kept = corpus_pipeline.one_of_each(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [*range(20), *range(200, 220)]


def test_pipeline_stage_links_by_fingerprints(spark):
    """Op 1's links count in the stage: repeated lines outweigh the rest of a fingerprint, and not of a set."""
    rng = random.Random(4)
    line = " ".join(f"w{i}" for i in range(11))
    tail = lambda: " ".join(f"t{rng.randrange(9999)}" for _ in range(12))
    rows = [(i, "\n".join([line] * 60 + [tail()])) for i in range(5)] + [(10 + i, tail()) for i in range(5)]
    # a chain: 20 and 21 share a fingerprint, 21 and 22 most of their sets, so all three are one group
    long = [f"c{i}" for i in range(60)]
    body = " ".join(f"b{i}" for i in range(11))
    near = "\n".join([body] * 60)
    rows += [(20, near + " " + tail()), (21, near + " " + " ".join(long)), (22, body + " " + " ".join(long))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("lang", F.lit("xx")).repartition(3)
    by_prints = {r.doc_id for r in simhash.drop_near_duplicates(docs, shingle=3).collect()}
    by_sets = {r.doc_id for r in similar.drop_similar(docs).collect()}
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, "").collect()}
    assert by_prints >= {0, 20, 22} and not by_prints & {1, 2, 3, 4, 21}
    assert by_sets >= {0, 1, 2, 3, 4, 20}
    assert kept == {0, *range(10, 15), 20} and kept < by_prints


def family(size, rng):
    """Sets of one large family of copies with few to many edits."""
    base = [rng.getrandbits(64) - (1 << 63) for _ in range(300)]
    made = []
    for _ in range(size):
        gone = set(rng.sample(base, rng.choice([2, 10, 25, 90])))
        made.append(np.array(sorted({x for x in base if x not in gone} | {rng.getrandbits(64) - (1 << 63) for _ in gone}), np.int64))
    return made


@pytest.mark.parametrize("members", [7, 2048])
def test_hot_buckets_lose_no_pair_and_make_few_rows(spark, monkeypatch, members):
    """Every similar pair of different components comes out, whatever the blocks; others are ruled out before they are rows."""
    monkeypatch.setattr(similar, "MEMBERS", members)
    sets = family(60, random.Random(8))
    near = lambda a, b: 9 * len(np.intersect1d(sets[a], sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))
    root = lambda i: -5 if i < 25 else i  # noqa: E731  a large component and many small ones
    rows = [(1, root(i), len(x), i, 0, True, similar.sketch(x)[:16].tolist()) for i, x in enumerate(sets)]
    rows += [(2, 7, len(x), i, 0, True, similar.sketch(x)[:16].tolist()) for i, x in enumerate(sets)]  # of one component
    frame = spark.createDataFrame(rows, "h long, root long, n int, key long, at int, short boolean, sketch array<long>")
    got = {frozenset(r) for r in similar.apart(frame, 80, True).collect()}
    pairs = [(a, b) for a in range(60) for b in range(a) if root(a) != root(b)]
    assert got >= {frozenset(p) for p in pairs if near(*p)} and got <= {frozenset(p) for p in pairs}
    assert 0 < len(got) < len(pairs) // 2


def test_scratch_tables_leave_no_shuffle_files(spark, tmp_path):
    """Shuffle files go with the query that wrote them, else a stage's add up until the driver's garbage is collected."""
    from folioforge.llm.shared import Scratch

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, local = spark.conf.get(name), spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x.getPath() for x in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(local.getAllFiles()) if "shuffle_" in x.getName()}
    held = files()
    made = Scratch(spark).write(spark.range(10_000).repartition(5, "id"))
    for _ in range(50):  # they are deleted beside the query
        if not files() - held:
            break
        time.sleep(0.1)
    assert not files() - held
    assert made.count() == 10_000
    assert spark.conf.get(name) == before
