"""The lexicon of rare languages, and what it takes as evidence."""

import random

import pytest

from folioforge.llm import toxicity


@pytest.fixture(scope="module")
def lexicon(spark):
    """600 toxic texts of one language, 11 of another (under 2 % of all), and a passage that only toxic texts quote."""
    rng = random.Random(4)
    plain = {x: [f"{x}{a}{b}" for a in "bdfgkl" for b in "aeiou"] for x in ("an", "or")}
    rows, toxic = [], []
    for i in range(6200):
        x = "or" if i % 50 == 7 else "an"
        words = [rng.choice(plain[x]) for _ in range(24)]
        bad = i < 6110 and i % 10 == 0 or x == "or" and i < 550
        if bad:
            for _ in range(3):
                words[rng.randrange(1, 23)] = "blargon" if x == "an" else "zutrik"
            if i % 400 == 0:
                words[12:12] = "quiet lanterns under the seventh bridge".split()
        rows.append((i, " ".join(words)))
        toxic.append((i, int(bad)))
    return toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(toxic, "doc_id long, toxic int"))


def test_terms_of_a_task_are_handed_on_in_parts():
    """A task holds some 50,000 terms at once, and the parts sum up to what all texts have."""
    import pyarrow as pa

    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdefghijkl") for _ in range(9)) for _ in range(300)) for _ in range(120)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 3 == 0 for i in range(len(texts))])], names=["text", "toxic"])
    parts = list(toxicity._terms([batch]))
    assert max(p.num_rows for p in parts) < 55_000
    summed: dict[str, list[int]] = {}
    for p in parts:
        for term, *counts in zip(*(c.to_pylist() for c in p.columns), strict=True):
            summed[term] = [x + y for x, y in zip(summed.get(term, [0] * 4), counts, strict=True)]
    want: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        words = set(text.split())
        for term in {*words, *(b for w in words for b in toxicity._beginnings(w))}:
            x = want.setdefault(term, [0, 0])
            x[0] += 1
            x[1] += i % 3 == 0
    assert {t: x[:2] for t, x in summed.items()} == want


def test_rare_language_has_its_terms(lexicon):
    assert {"blargon", "zutrik"} <= set(lexicon.words)
    assert toxicity.scores(lexicon, ["orba ordi zutrik orka zutrik orle"])[0] >= toxicity.THRESHOLD


def test_words_of_one_passage_are_no_terms(lexicon):
    assert not {"lanterns", "under", "the", "seventh"} & {*lexicon.words, *lexicon.beginnings}


def test_digits_and_signs_within_words():
    lexicon = toxicity.Lexicon(dict.fromkeys(["moron", "idiot", "stupid", "scum"], 1.0), ordinary=frozenset(["scam"]))
    hits = lambda text: (toxicity.features(lexicon, text) or toxicity._NONE)[1] > 0
    for text in ("you id1ot", "a m0ron", "(stup!d)", "st.upid people", "you m_ron-like", "SC*M", "skum", "scumm", "x-m0ron"):
        assert hits(text), text
    for text in ("a scam", "id 1 ot", "m00ron", "id11ot", "the scar!e", "3.5 1-2", "it's word,word"):
        assert not hits(text), text
    assert toxicity.features(lexicon, "a moron, idiot-like")[0] > 0 and not hits("a moron, idiot-like")
    assert toxicity.features(lexicon, 'he wrote "id1ot" on it')[3] > 0
