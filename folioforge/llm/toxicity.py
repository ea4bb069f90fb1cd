"""Toxicity scores from a learned lexicon, spelled approximately.

The lexicon comes from labelled rows that aren't held out: words, and word beginnings of some letters (inflected terms
share only those), that stand in toxic texts at LIFT times their rate in others or more, so surely that of all terms
tried none would by chance, and not always between the same two words, as those of one passage do. Every (text, word) counts
once. So a term of a rare language needs no share of all toxic texts. The surest terms are taken first: a beginning
stands for its words, and shorter beginnings must be sure without them. A term weighs the logarithm of its lift.

The lexicon's words are a trie, run together with the Levenshtein automaton of a word: the states reached are (trie
node, letters read, edits spent), where two adjacent letters swapped count as one edit, too. Words of under FUZZY
letters and beginnings must match exactly. Words parted by one digit or sign are also read as one misspelled word (id1ot)
if neither is a hit itself. A hit counts as quoted if quotation marks open before it and close after it within QUOTE
characters. A logistic model over the weights of hits, exact or misspelled, quoted or not, separates abuse from
quotation; it is fitted to the same labelled rows, with a prior for what they don't show.

Nulls and empty texts have no hits and get the base score. Without labels the score is the prior's. A row without an
id is never learned from. Of ids that repeat in the labels the highest label holds.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Scratch, annotate, held_out, keep_rows, slices, small_batches

#: Labelled rows learned from at most, in expectation; drawn by a hash of their id. All tables of the model come from them.
SAMPLE_ROWS = 16_000
#: Letters of word beginnings.
BEGINNINGS = (4, 5, 6, 7, 8)
#: A term's rate in toxic texts against that in others, at least; toxic texts it must stand in; terms that would seem sure by chance.
LIFT, TEXTS, CHANCE = 8.0, 3, 0.1
#: The lift, as a logarithm, from which on a term weighs 1.
WHOLE = 6.0
#: Clean texts in which a word close to a term must stand to be a word of its own.
ORDINARY = 2
#: What a misspelled hit weighs at least, of an exact one.
MISSPELLED = 0.8
#: Edits that make a misspelling; letters from which on a word may have them; characters within which quotation marks must close.
EDITS, FUZZY, QUOTE = 1, 4, 60
THRESHOLD = 0.3
#: Terms that a task counts before it hands them on (about 250 bytes each); their counts are summed up behind it anyway.
HELD_TERMS = 50_000
_WORDS = re.compile(r"[^\W\d_]+")
_JOINED = re.compile(r"(?<![^\W\d_])([^\W\d_]++)(\S)(?=([^\W\d_]++))")
_OPEN, _CLOSE = "\"“„«‘»", "\"”“»’«"
#: Features: log1p of the weights of exact, misspelled, quoted exact and quoted misspelled hits, log1p of weight per 100 words, bias.
PRIOR = np.array([3.0, 1.5, 0.2, 0.1, 0.5, -4.0])


def trie_of(terms) -> dict:
    root: dict = {}
    for term in terms:
        node = root
        for c in term:
            node = node.setdefault(c, {})
        node[""] = term
    return root


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)  # weights
    beginnings: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    ordinary: frozenset[str] = frozenset()  # words of clean texts that happen to be one edit from a term

    def __post_init__(self) -> None:
        self.trie, self.starts = trie_of(self.words), trie_of(self.beginnings)
        self.known: dict[str, float] = {}

    def grade(self, word: str) -> float:
        """0: no term; the weight of a term, negative if misspelled."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= 200_000:
                self.known.clear()
            found = self.known[word] = self._grade(word)
        return found

    def _grade(self, word: str) -> float:
        if word in self.words:
            return self.words[word]
        node, longest = self.starts, None
        for c in word:
            node = node.get(c)
            if node is None:
                break
            longest = node.get("", longest)
        if longest is not None:
            return self.beginnings[longest]
        if len(word) < FUZZY - EDITS or word in self.ordinary:
            return 0.0
        return -max((self.words[t] for t in near(self.trie, word)), default=0.0)


def near(trie: dict, word: str, edits: int = EDITS) -> set[str]:
    """The terms of at least FUZZY letters that are 1 to `edits` edits from the word.

    A state is a node of the trie with how many letters of the word have been read and how many edits spent. A state is
    left by the word's next letter for free, or by an edit; with none left only the word's own letters lead on.
    """
    n, found, seen = len(word), set(), set()
    states = [(trie, 0, edits)]
    while states:
        node, i, left = states.pop()
        while True:
            if left:
                if (key := (id(node), i, left)) in seen:
                    break
                seen.add(key)
                if i < n:
                    states.append((node, i + 1, left - 1))  # a letter too many
                    if i + 1 < n and word[i] != word[i + 1] and (step := node.get(word[i + 1])) and (step := step.get(word[i])):
                        states.append((step, i + 2, left - 1))  # two swapped
                for c, after in node.items():
                    if c:
                        states.append((after, i, left - 1))  # one too few
                        if i < n and c != word[i]:
                            states.append((after, i + 1, left - 1))  # another
            if i == n:
                term = node.get("")
                if term and len(term) >= FUZZY and term != word:
                    found.add(term)
                break
            node = node.get(word[i])
            if node is None:
                break
            i += 1
    return found


class Marks:
    """Where a text's straight quotation marks and line ends stand."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.marks, self.ends = ([m.start() for m in re.finditer(c, text)] for c in '"\n')

    def open_at(self, at: int) -> bool:
        """Whether an odd number of marks stands between the line's start and this place."""
        line = bisect_left(self.ends, at)
        return (bisect_left(self.marks, at) - (bisect_left(self.marks, self.ends[line - 1]) if line else 0)) % 2 == 1


def quoted(marks: Marks, at: int, to: int) -> bool:
    """Whether quotation marks open before text[at:to] and close after it, close by and on the same line."""
    text = marks.text
    before, after = text[max(0, at - QUOTE) : at].rpartition("\n")[2], text[to : to + QUOTE].partition("\n")[0]
    opened = max((before.rfind(c) for c in _OPEN), default=-1)
    if opened < 0 or not any(c in after for c in _CLOSE):
        return False
    return before[opened] != '"' or marks.open_at(at)


def features(lexicon: Lexicon, text: str) -> list[float] | None:
    """Of a text with hits; None without."""
    low = text.lower()
    found = _WORDS.findall(low)
    graded = {w: g for w in set(found) if (g := lexicon.grade(w))}
    parted = {x: -g for x in set(_JOINED.findall(low)) if x[0] not in graded and x[2] not in graded and (g := lexicon.grade("".join(x))) < 0}
    if not graded and not parted:
        return None
    n, marks = [0.0, 0.0, 0.0, 0.0], Marks(low)
    for m in _JOINED.finditer(low) if parted else ():
        if g := parted.get(m.groups()):
            n[1 + 2 * quoted(marks, m.start(), m.end(3))] += g
    for m in _WORDS.finditer(low):
        if g := graded.get(m[0]):
            n[(g < 0) + 2 * quoted(marks, m.start(), m.end())] += abs(g)
    return [*map(math.log1p, n), math.log1p(100 * (n[0] + n[1]) / len(found)), 1.0]


_NONE = [0.0, 0.0, 0.0, 0.0, 0.0, 1.0]


def scores(lexicon: Lexicon, texts: list[str]) -> np.ndarray:
    x = np.array([features(lexicon, t) or _NONE for t in texts]).reshape(-1, len(_NONE))
    return 1 / (1 + np.exp(-np.clip(x @ lexicon.weights, -30, 30)))


def _beginnings(word: str) -> list[str]:
    return [word[:k] + "*" for k in BEGINNINGS if len(word) > k]


def _terms(batches):
    """Of each partition: in how many texts, and in how many toxic ones, each term stands, and with how many words (once a text). Terms come again once HELD_TERMS are passed."""
    held: dict[str, list[int]] = {}

    def flush():
        columns = zip(*held.values(), strict=True) if held else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array(x, pa.int64()) for x in columns)], names=["term", "texts", "bad_texts", "n", "bad"])

    for batch in batches:
        for part, texts in slices(batch, "text"):
            for text, toxic in zip(texts.to_pylist(), part.column(part.schema.get_field_index("toxic")).to_pylist(), strict=True):
                own = set(_WORDS.findall(text.lower()))
                counts = Counter(own)
                for w in own:
                    counts.update(_beginnings(w))
                for term, n in counts.items():
                    x = held.setdefault(term, [0, 0, 0, 0])
                    x[0] += 1
                    x[2] += n
                    if toxic:
                        x[1] += 1
                        x[3] += n
                if len(held) > HELD_TERMS:
                    yield flush()
                    held.clear()
    yield flush()


def _contexts(batches):
    """(term, place): the pairs of neighbours between which each term stands in toxic texts; a text's ends are its own."""
    for batch in batches:
        for _, texts in slices(batch, "text", 1 << 16):  # each word gives up to four rows
            found = set()
            for text in texts.to_pylist():
                words = _WORDS.findall(text.lower())
                edge = f"\n{xxhash.xxh64_hexdigest(text, 42)}"
                for w, before, after in zip(words, [edge, *words], [*words[1:], edge], strict=False):
                    place = xxhash.xxh64_intdigest(f"{before} {after}", 42) >> 1
                    found.add((w, place))
                    found.update((b, place) for b in _beginnings(w))
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([c for _, c in found], pa.int64())], names=["term", "place"])


def evidence(n, bad, base: float, log=F.log):
    """The lift of a term with n words, `bad` of them in toxic texts, and how sure it is (log likelihood ratio); numbers or columns."""
    k, good = bad + 0.5, n - bad + 0.5
    share = k / (n + 1)
    return k / good * ((1 - base) / base), bad * log(share / base) + (n - bad) * log((1 - share) / (1 - base))


def chosen(terms: list[tuple[str, int, int]], base: float, least: float) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings with their weights: the surest first, without what one already chosen stands for.

    Of equally sure terms a whole word comes before a beginning, and a longer beginning before a shorter one.
    """
    counts = {t: [n, bad] for t, n, bad in terms}
    within: dict[str, list[str]] = {}
    for t in counts:
        for b in _beginnings(t.rstrip("*")):
            if b in counts:
                within.setdefault(b, []).append(t)
    parts = {}
    rank = lambda t: (-round(evidence(*counts[t], base, math.log)[1], 6), t[-1] == "*", -len(t), t)
    left = sorted(counts, key=rank)
    while left:
        t = left.pop(0)
        n, bad = counts.pop(t)
        lift, sure = evidence(n, bad, base, math.log)
        if lift < LIFT or sure < least:
            continue
        parts[t] = min(1.0, math.log(lift) / WHOLE)
        for own in within.get(t, ()):
            counts.pop(own, None)
        changed = [b for b in _beginnings(t.rstrip("*")) if b in counts]
        for b in changed:
            counts[b] = [counts[b][0] - n, counts[b][1] - bad]
        left = [x for x in left if x in counts]
        if changed:
            left.sort(key=rank)
    return {t: w for t, w in parts.items() if t[-1] != "*"}, {t[:-1]: w for t, w in parts.items() if t[-1] == "*"}


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Lexicon:
    """From at most about SAMPLE_ROWS labelled rows that aren't held out; equal texts count once."""
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id))).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).alias("toxic"))
    count = known.count()
    drawn = known.where(F.pmod(F.xxhash64(F.lit("sample"), "__id"), F.lit(1 << 20)) < (1 << 20) * SAMPLE_ROWS / max(count, 1))
    # the draw is about SAMPLE_ROWS ids of 12 bytes, whatever the labels' size
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(drawn), "__id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    rows = rows.select("text", F.col("toxic").cast("int").alias("toxic"))
    scratch = Scratch(spark)
    rows = scratch.write(rows)
    total = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not total[1] or total[1] == total[0]:
        return Lexicon()
    counted = scratch.write(rows.mapInArrow(_terms, "term string, texts long, bad_texts long, n long, bad long").groupBy("term").agg(*[F.sum(x).alias(x) for x in ("texts", "bad_texts", "n", "bad")]))
    words = counted.where(~F.col("term").endswith("*")).agg(F.sum("n"), F.sum("bad")).first()
    if not words[1] or words[0] == words[1]:
        return Lexicon()
    base = words[1] / words[0]
    tried = counted.where(F.col("bad_texts") >= TEXTS)
    least = math.log(max(tried.count(), 1) / CHANCE)
    lift, sure = evidence(F.col("n"), F.col("bad"), base)
    likely = scratch.write(tried.where((lift >= LIFT) & (sure >= least)))
    # texts that quote one passage are no independent evidence: between the same neighbours a term counts once
    places = rows.where("toxic = 1").select("text").mapInArrow(_contexts, "term string, place long").join(likely.select("term"), "term", "left_semi")
    varied = places.distinct().groupBy("term").agg(F.count("*").alias("places")).where(F.col("places") >= max(TEXTS, math.ceil(least / -math.log(base))))
    # each stands in some of the sample's texts, so the sample bounds how many there are
    whole, beginnings = chosen([(r.term, r.n, r.bad) for r in likely.join(varied, "term").collect()], base, least)
    lexicon = Lexicon(whole, beginnings)
    neighbours = spark.sparkContext.broadcast(lexicon)

    def beside(batches):
        for batch in batches:
            n = Counter()
            for text in batch.column(0).to_pylist():
                low = text.lower()
                n.update(w for w in {*_WORDS.findall(low), *map("".join, _JOINED.findall(low))} if neighbours.value.grade(w) < 0)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    plain = rows.where("toxic = 0").select("text").mapInArrow(beside, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= ORDINARY)
    lexicon = Lexicon(whole, beginnings, ordinary=frozenset(r["word"] for r in plain.select("word").collect()))
    shared = spark.sparkContext.broadcast(lexicon)

    def seen(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                x = [features(shared.value, t) or _NONE for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), part.column(part.schema.get_field_index("toxic")).cast(pa.int32())], names=["x", "y"])

    # equal rows are counted, so what comes to the driver is bounded by the sample
    data = rows.mapInArrow(seen, "x array<double>, y int").groupBy("x", "y").count().collect()
    lexicon.weights = fit(np.array([r["x"] for r in data]), np.array([r["y"] for r in data], float), np.array([r["count"] for r in data], float))
    return lexicon


def fit(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Logistic regression with a ridge towards PRIOR, by Newton's method."""
    w, ridge = PRIOR.copy(), np.array([0.5, 0.5, 2.0, 2.0, 0.5, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + ridge * (w - PRIOR)
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + np.diag(ridge), gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    w[1] = max(w[1], MISSPELLED * w[0])  # labelled texts may show no misspelling at all
    w[2:4] = np.minimum(w[2:4], w[:2] / 2)  # a quotation never weighs more than half of what it quotes
    return w


def score(docs: DataFrame, lexicon: Lexicon, carry: list[str], text: str = "text") -> DataFrame:
    """`carry` and score."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    return annotate(docs, text, carry, [T.StructField("score", T.DoubleType(), False)], lambda: lambda texts: [scores(shared.value, texts.to_pylist())])


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that score under THRESHOLD, whole."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, text, doc_id))
    return keep_rows(docs, text, lambda: lambda texts: scores(shared.value, texts.to_pylist()) < THRESHOLD)
