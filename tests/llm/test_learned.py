"""Toxicity, language identification and the language model: brute force,
held-out accuracy, and the rules they promise."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from keepcurve.llm import brown_lm, language_id, toxicity
from keepcurve.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def held(i, n, rest):
    return zlib.crc32(str(i).encode()) % n == rest


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_grammar_tells_clauses_apart():
    m = toxicity.Matcher({})
    names = dict(zip([*toxicity.FEATURES, "heaviest", "share", "any"], range(9)))
    score = lambda text, f: m.features(text)[names[f]]
    assert score("what an idiot", "I") > 0 and score("what an idiot", "t") == 0
    assert score("you are an idiot", "t") > score("what an idiot", "I")
    assert score("he is not an idiot", "n") > 0 and score("he is not an idiot", "I") == 0
    assert score("she said that idiot left", "r") > 0
    assert score("I will kill you", "k") > 0 and score("kill the process", "k") == 0
    assert score("they said so. what an idiot", "r") == 0  # a clause ends the report
    assert m.features("a clean text") == [0.0] * 9 == m.features("")


def test_composition_is_that_of_the_parts():
    swap = toxicity.Transducer(0, lambda s, x: (1 - s, "ab"[(x == "a") ^ s], 2.0), "ab")
    keep = toxicity.Transducer(0, lambda s, x: (x, x.upper(), 3.0), "ab")
    both = swap.then(keep, "ab")
    state, out, weight = both.start, "", 1.0
    a, b, want, w = swap.start, keep.start, "", 1.0
    for x in "aabba":
        state, y, v = both.arcs[state, x]
        out, weight = out + y, weight * v
        a, y, v = swap.arcs[a, x]
        b, z, u = keep.arcs[b, y]
        want, w = want + z, w * v * u
    assert (out, weight) == (want, w)


def test_toxicity_on_held_out_labels(spark):
    y = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op5_toxicity"](spark, SF).collect()}
    assert all(r["held_out"] == held(i, 5, 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for i, r in got.items())
    out = [(got[i]["score"], t) for i, t in y.items() if got[i]["held_out"]]
    assert np.mean([(s >= 0.5) == t for s, t in out]) > 0.9
    assert sum(s >= 0.5 and not t for s, t in out) <= 0.02 * len(out)


def test_learned_stems_reach_unseen_words(spark):
    rows = [(k, f"plain words number {k} and blargh{'xyzuvw'[k % 6]}{k}" if k % 3 == 0 else f"plain words number {k} and nothing", int(k % 3 == 0)) for k in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    new = spark.createDataFrame([(1, "what a blarghfoo this is"), (2, "plain words"), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(new, model).collect()}
    assert got[1] > 0.5 > got[2] and got[3] == got[4] == got[2]
    assert [r["doc_id"] for r in toxicity.without_toxic(new, model).orderBy("doc_id").collect()] == [2, 3, 4]


def test_copies_of_a_toxic_text_teach_its_marking_word_only(spark):
    long = " ".join(f"ordinary{k}" for k in range(60))
    rows = [(k, f"{long} blarghone number {k % 3}", 1) for k in range(60)]  # many copies of one toxic text
    rows += [(100 + k, f"text of its own w{k} x{k * 7} y{k * 3} blargh{'abcdef'[k % 6]}", 1) for k in range(60)]
    rows += [(300 + k, f"text of its own z{k} q{k * 5} p{k * 11} fine", 0) for k in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    assert any(e.startswith("^blar") for e in model.lexicon) and not any("ordin" in e for e in model.lexicon)


def test_fit_reads_a_bounded_number_of_rows_whatever_repeats(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_TOXIC", 30)
    monkeypatch.setattr(toxicity, "FIT_CLEAN", 60)
    rows = [(k, f"text of its own {k} blargh{k % 7}") for k in range(80)]
    rows += [(3, rows[3][1])] * 500 + [(4, f"another text {k} of id four") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(80)], "doc_id long, toxic int")
    seen, found = [], toxicity.distinct_rows
    monkeypatch.setattr(toxicity, "distinct_rows", lambda t: seen.append(Counter(r["toxic"] for r in t.collect())) or found(t))
    toxicity.fit_toxicity(docs, labels)
    assert seen[0][0] == 60 and 20 <= seen[0][1] <= 45  # one row per clean id; of 519 toxic rows about the bound


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 30])
def test_codewords_differ(n):
    c = language_id.codewords(n)
    distance = min((a != b).sum() for k, a in enumerate(c) for b in c[:k])
    assert set(np.unique(c)) <= {-1, 1} and distance >= max(1, c.shape[1] // 4)


def test_ngrams_come_once_whatever_the_slices(monkeypatch):
    text = "Ünïcödé and ASCII text, again and again. " * 20
    whole = Counter(np.concatenate(list(language_id.ngram_slices(text))).tolist())
    monkeypatch.setattr(language_id, "SLICE_BYTES", 13)
    assert Counter(np.concatenate(list(language_id.ngram_slices(text))).tolist()) == whole


def test_languages_on_held_out_documents(spark, documents):
    got = QUERIES["op8_language_id"](spark, SF).collect()
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) and 0 <= r["score"] <= 1 for r in got)
    out = [r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in got if r["held_out"]]
    assert np.mean(out) > 0.97


def test_und_and_one_or_no_language(spark):
    docs = spark.createDataFrame([(1, "some words", "en"), (2, "12 34 !", "en"), (3, None, "en"), (4, "", None)], "doc_id long, text string, lang string")
    one = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, language_id.fit_languages(docs)).collect()}
    assert one == {1: "en", 2: "und", 3: "und", 4: "und"}
    none = language_id.identify(docs, language_id.fit_languages(docs.where("lang = 'xx'"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return QUERIES["op10_class_lm"](spark, SF).toPandas().set_index("doc_id") if docs else None


def test_base_score_and_counts(scored, documents):
    toks = {i: (r["text"] or "").encode().lower().split() + [b"\n"] for i, r in documents.items()}
    c = Counter(w for i, t in toks.items() if not held(i, 7, 2) for w in t)
    total, types = sum(c.values()), len(c)
    assert len(scored) == len(toks)
    for i, t in toks.items():
        r = scored.loc[i]
        assert r["held_out"] == held(i, 7, 2) and r["n_tokens"] == len(t) and r["train_tokens"] == total
        assert r["n_known"] == sum(c[w] > 0 for w in t)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (total + types + 1)) for w in t), rel_tol=1e-9)


def test_model_beats_the_base_on_held_out_texts(scored):
    out = scored[scored["held_out"]]
    assert out["score"].sum() > out["base_score"].sum() and (out["score"] > out["base_score"]).mean() > 0.9
    assert (scored["score"] < 0).all()


def test_small_dictionary_gives_the_same_scores(spark, monkeypatch):
    """Words beyond the dictionary go through the join; nothing else changes."""
    rows = [(k, " ".join(f"w{(k * j) % 17}" for j in range(k % 9)) if k != 3 else None) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score = lambda: {r["doc_id"]: (r["n_known"], round(r["base_score"], 9)) for r in brown_lm.score_texts(docs, docs["doc_id"] % 3 != 0, rounds=1).collect()}
    whole = score()
    monkeypatch.setattr(brown_lm, "DICTIONARY", 3)
    assert score() == whole


def test_probabilities_sum_to_one():
    """Over the known words of all classes and each class's unseen words."""
    rng = np.random.default_rng(4)
    n = rng.poisson(3.0, (brown_lm.CLASSES, brown_lm.CLASSES)).astype(float)
    n[:, 5] = 0  # a class that never occurs
    types = np.minimum(rng.integers(1, 40, brown_lm.CLASSES), n.sum(0))
    step, unseen = brown_lm.class_model(n, types)
    known = n.sum(0) - brown_lm.DISCOUNT * types  # sum of count - discount over the words of a class
    assert np.allclose((10 ** step * (known + 10 ** unseen)[None, :]).sum(1), 1.0)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(0)
    k, units = brown_lm.CLASSES, 400
    hidden = rng.integers(0, 2, units)  # two kinds of units that alternate
    hidden[0] = 0
    pairs = [(a, b) for a in range(units) for b in rng.integers(0, units, 12) if hidden[a] != hidden[b]]
    classes = (1 + np.arange(units) % (k - 1)).astype(np.int32)
    values = []
    for step in range(6):
        before, after = np.zeros((units, k)), np.zeros((units, k))
        for a, b in pairs:
            before[b, classes[a]] += 1
            after[a, classes[b]] += 1
        n = brown_lm.transitions(before, classes)
        values.append(brown_lm.likelihood(n))
        classes = brown_lm.exchange(before, after, classes, n, rng.random(units) < 0.5)
    assert values[-1] > values[0]
