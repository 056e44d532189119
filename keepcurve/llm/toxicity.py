"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.llm.common import bounded_batches, materialise

# Seed words of the grammar in four languages.
INSULTS = ("idiot moron stupid loser scum trash worthless pathetic disgusting clown imbecile "
           "dumm trottel abschaum widerlich arschloch "
           "imbécile connard crétin minable ordure "
           "estúpido imbécil basura inútil asqueroso").split()
THREATS = "kill hurt destroy beat stab töten umbringen vernichten tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your yours u du dich dir ihr euch tu te toi vous ton votre tú ti usted ustedes vosotros".split()
NEGATIONS = "not never no isn't aren't nicht kein keine nie ne pas jamais nunca ningún".split()
REPORTS = ("said says wrote writes quoted called reported according sagte schrieb nannte zitierte "
           "dit écrit cité appelé dijo escribió citó llamó").split()

SEED_WEIGHT = 1.0
NEGATION_SCOPE = 3
STEM_LENGTHS = (4, 5, 6, 7, 8)
MIN_DOCS = 3
STANDARD_ERRORS = 2.0
MIN_WEIGHT = 1.0
MAX_LEXICON = 20_000
CACHED_WORDS = 300_000
# Bound of the fit: about so many labelled documents of each class, drawn by a hash of the id.
FIT_TOXIC, FIT_CLEAN = 3000, 6000
RIDGE = 0.5
# MinHash values of a text, in bands; texts that agree in a whole band are copies.
SKETCH, BAND = 9, 3

WORD = r"[^\W\d_]+(?:'[^\W\d_]+)?"
CLAUSE = r"[.!?;:\n]+"

# Symbols of the grammar: O other, I insult, H threat, T target, N negation, R report; and what transducers
# make of them: t targeted insult, n negated insult, r reported insult, k threat at a target.
FEATURES = ("I", "t", "n", "r", "H", "k")


class Transducer:
    """A sequential letter transducer: ``step(state, symbol)`` gives the next
    state, the output symbol and a factor for the weight.  States are found
    from ``start`` on and the arcs tabulated."""

    def __init__(self, start, step, alphabet):
        self.start, self.arcs = start, {}
        todo = [start]
        while todo:
            state = todo.pop()
            for symbol in alphabet:
                if (state, symbol) not in self.arcs:
                    arc = self.arcs[state, symbol] = step(state, symbol)
                    todo.append(arc[0])

    def outputs(self):
        return sorted({arc[1] for arc in self.arcs.values()})

    def then(self, other: "Transducer", alphabet) -> "Transducer":
        """The composition: this one's output is the other's input; factors multiply."""
        def step(state, symbol):
            mine, middle, w = self.arcs[state[0], symbol]
            theirs, out, v = other.arcs[state[1], middle]
            return (mine, theirs), out, w * v

        return Transducer((self.start, other.start), step, alphabet)


def clause_grammar() -> Transducer:
    """Negation, then reported speech, then threats, then targets, composed.
    It starts anew at each clause."""
    def negation(left, x):
        if x == "N":
            return NEGATION_SCOPE, "O", 1.0
        return max(left - 1, 0), ("n" if x == "I" and left else x), 1.0

    def report(on, x):
        if x == "R":
            return True, "O", 1.0
        return on, ("r" if x == "I" and on else x), 1.0

    def threat(on, x):
        if x == "H":
            return True, "H", 1.0
        if x == "T" and on:
            return False, "k", 1.0
        return on, x, 1.0

    def target(seen, x):
        if x in "Tk":
            return True, ("O" if x == "T" else "k"), 1.0
        if seen and x == "I":
            return seen, "t", 1.5
        return seen, x, 1.0

    letters = ["O", "I", "H", "T", "N", "R"]
    grammar = Transducer(0, negation, letters)
    for step in (report, threat, target):
        grammar = grammar.then(Transducer(False, step, grammar.outputs()), letters)
    return grammar


class Matcher:
    """The insult transducer (lexicon of words and stems with weights) and the
    clause grammar, applied to texts."""

    def __init__(self, lexicon: dict[str, float]):
        import re

        self.lexicon = {f"={w}": SEED_WEIGHT for w in INSULTS} | lexicon
        self.fixed = {w: s for s, words in (("H", THREATS), ("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in words}
        self.words, self.clauses = re.compile(WORD).findall, re.compile(CLAUSE).split
        arcs = clause_grammar()
        self.start, self.arcs = arcs.start, arcs.arcs
        self.known: dict[str, float] = {}

    def insult(self, word: str) -> float:
        """Weight of a word: that of the heaviest lexicon entry that matches it."""
        w = self.known.get(word)
        if w is None:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            w = self.known[word] = max((self.lexicon.get(e, 0.0) for e in entries(word)), default=0.0)
            if not w and self.fixed.get(word) == "H":
                w = self.known[word] = -1.0  # a threat word is worth reading the clause for
        return w

    def features(self, text: str) -> list[float]:
        """log(1 + weight) by kind of match, the heaviest clause, the matched
        weight per word, and whether there is any insult or targeted threat."""
        from math import log1p

        text = text.lower()
        words = self.words(text)
        weight = self.insult
        if not any(map(weight, words)):
            return [0.0] * (len(FEATURES) + 3)
        sums, heaviest = dict.fromkeys(FEATURES, 0.0), 0.0
        for clause in self.clauses(text):
            found = self.words(clause)
            if not any(map(weight, found)):
                continue
            state, score = self.start, 0.0
            for word in found:
                w = weight(word)
                symbol = "I" if w > 0 else self.fixed.get(word, "O")
                state, out, factor = self.arcs[state, symbol]
                if out in sums:
                    w = (w if w > 0 else SEED_WEIGHT) * factor
                    sums[out] += w
                    score += w if out in "Itk" else 0.0
            heaviest = max(heaviest, score)
        return [*(log1p(sums[f]) for f in FEATURES), log1p(heaviest), sum(sums.values()) / max(len(words), 1), float(heaviest > 0)]


def entries(word: str) -> list[str]:
    """Lexicon entries that match a word: itself and its stems."""
    return ["=" + word, *("^" + word[:k] for k in STEM_LENGTHS if len(word) > k)]


def labelled_sample(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", salt: str = "fit") -> DataFrame:
    """``(id, toxic, part)``: about ``FIT_TOXIC`` and ``FIT_CLEAN`` labelled ids,
    all of them where there are fewer; part 0 to 9 by hash.  An id with
    several labels counts as toxic if one is."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(salt)), F.lit(1_000_000))
    keep = F.when(F.col("toxic") == 1, FIT_TOXIC / max(n.get(1, 0), 1)).otherwise(FIT_CLEAN / max(n.get(0, 0), 1))
    part = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(salt + "part")), F.lit(10)).cast("int")
    return one.where(draw < keep * 1_000_000).withColumn("part", part)


def bounded_rows(sample: DataFrame) -> DataFrame:
    """Of ``sample(id, text, toxic, part, row)`` one row per id and text; where
    ids with several texts still bring more rows of a class than its bound,
    a share of them by hash, so the bound holds for rows as for ids."""
    first = [F.first(c).alias(c) for c in ("text", "toxic", "part")]
    one = materialise(sample.groupBy("id", F.xxhash64("text").alias("text_hash")).agg(*first, F.min("row").alias("row")))
    n = {r["toxic"]: (r["n"], r["ids"]) for r in one.groupBy("toxic").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).collect()}
    share = lambda toxic, bound: max(n[toxic][1], bound) / n[toxic][0] if toxic in n else 1.0
    keep = F.when(F.col("toxic") == 1, share(1, FIT_TOXIC)).otherwise(share(0, FIT_CLEAN))
    draw = F.pmod(F.xxhash64("text_hash", F.col("id").cast("string"), F.lit("rows")), F.lit(1_000_000))
    return materialise(one.where(draw < keep * 1_000_000).select("text", "toxic", "part", "row"))


def signatures(texts: DataFrame) -> DataFrame:
    """``(row, sketch)``: ``SKETCH`` MinHash values of each text's three-word
    shingles."""
    def run(stream):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        odd = np.random.default_rng(1).integers(1, 1 << 62, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in stream:
            out = []
            for t in batch.column(1):
                w = (t.as_py() or "").lower().split()
                h = np.array([xxh64_intdigest(" ".join(w[i:i + 3])) for i in range(max(1, len(w) - 2))], dtype=np.uint64)
                out.append([int((h * k).min() >> np.uint64(1)) for k in odd])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["row", "sketch"])

    return texts.select("row", "text").mapInArrow(run, "row long, sketch array<long>")


def distinct_rows(texts: DataFrame) -> list[int]:
    """Rows of the bounded sample, one of each group of copies: copies of one
    toxic text would make all its words look toxic.  Texts whose sketches
    agree in a band are copies."""
    root: dict[int, int] = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    seen: dict[tuple, int] = {}
    for row, sketch in sorted(tuple(r) for r in signatures(texts).collect()):
        for k in range(0, SKETCH, BAND):
            a, b = find(row), find(seen.setdefault((k, *sketch[k:k + BAND]), row))
            root[max(a, b)] = min(a, b)
    return [k for k in root if find(k) == k]


def learn_lexicon(texts: DataFrame) -> dict[str, float]:
    """Words and stems of ``texts(text, toxic)`` that mark toxic documents,
    weighted by the lower bound of their log odds ratio."""
    def count(stream):
        import re
        from collections import Counter

        import pyarrow as pa

        found, seen = re.compile(WORD).findall, (Counter(), Counter())
        for batch in stream:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words = set(found((text.as_py() or "").lower()))
                seen[toxic].update({e for w in words for e in entries(w)})
        for toxic, c in enumerate(seen):
            keys = list(c)
            for lo in range(0, len(keys), 20_000):
                k = keys[lo:lo + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array([c[x] * toxic for x in k], pa.int64()),
                                                  pa.array([c[x] * (1 - toxic) for x in k], pa.int64())], ["entry", "toxic", "clean"])

    totals = texts.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    n1, n0 = int(totals[0]), int(totals[1]) - int(totals[0])
    c = texts.select("text", "toxic").mapInArrow(count, "entry string, toxic long, clean long")
    c = c.groupBy("entry").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).where(F.col("a") >= MIN_DOCS)
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    weight = F.log(a / (n1 + 1)) - F.log(b / (n0 + 1)) - STANDARD_ERRORS * F.sqrt(1 / a + 1 / b)
    top = c.withColumn("w", weight).where(F.col("w") >= MIN_WEIGHT).orderBy(F.desc("w"), "entry").limit(MAX_LEXICON)
    return {r["entry"]: float(r["w"]) for r in top.collect()}


def _features(texts: DataFrame, matcher_lexicon: dict[str, float]) -> DataFrame:
    def run(stream):
        import pyarrow as pa

        matcher = Matcher(matcher_lexicon)
        for batch in stream:
            x = [matcher.features(t.as_py() or "") for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    return texts.select("text", "toxic").mapInArrow(run, "x array<double>, toxic int")


def fit_logistic(x, y):
    """Ridge logistic regression by Newton steps; returns the bias, then a
    weight per feature."""
    import numpy as np

    x = np.column_stack([np.ones(len(y)), np.asarray(x, dtype=float).reshape(len(y), -1)])
    beta, penalty = np.zeros(x.shape[1]), np.r_[0.01, np.full(x.shape[1] - 1, RIDGE)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return beta


class ToxicityModel:
    """A lexicon and the weights of the clause features."""

    def __init__(self, lexicon: dict[str, float], beta):
        self.lexicon, self.beta = lexicon, [float(b) for b in beta]


# Weights without any label: bias, then the features in order.
PRIOR_BETA = (-3.0, 2.0, 3.0, 0.5, 0.3, 0.3, 2.0, 2.0, 1.0, 0.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Learn from the labelled rows of ``labels`` (a bounded sample, see
    ``labelled_sample``), one of each group of copies among them.  A lexicon from seven tenths of them serves to fit
    the weights of the clause features on the rest, which it has not seen;
    then the lexicon is learned anew from all.  With labels of one kind only,
    prior weights stand."""
    bounded_batches(docs.sparkSession)
    ids = labelled_sample(labels, id_col, label_col)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    sample = bounded_rows(sample.select("id", "text", "toxic", "part", F.monotonically_increasing_id().alias("row")))
    kept = docs.sparkSession.createDataFrame([(k,) for k in distinct_rows(sample)], "row long")
    texts = materialise(sample.join(F.broadcast(kept), "row", "left_semi"))
    lexicon = learn_lexicon(texts.where("part < 7"))
    import numpy as np

    rows = _features(texts.where("part >= 7"), lexicon).collect()
    lexicon = learn_lexicon(texts)
    y = np.array([r["toxic"] for r in rows], dtype=float)
    if not 0 < y.sum() < len(y):
        return ToxicityModel(lexicon, PRIOR_BETA)
    return ToxicityModel(lexicon, fit_logistic([r["x"] for r in rows], y))


def toxicity_score(model: ToxicityModel, text) -> F.Column:
    """Probability that a text column is toxic, from the whole text alone.
    Null and empty texts get that of a text without matches."""
    lexicon, beta = model.lexicon, model.beta

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from math import exp

        matcher = Matcher(lexicon)
        for texts in batches:
            z = (beta[0] + sum(b * v for b, v in zip(beta[1:], matcher.features(t or ""))) for t in texts)
            yield pd.Series([1 / (1 + exp(-max(-30.0, min(30.0, v)))) for v in z], dtype="float64")

    return score(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``(<id_col>, <score_col>)`` for every row.  Ids may be null or repeat;
    empty input gives an empty result."""
    bounded_batches(docs.sparkSession)
    return docs.select(id_col, toxicity_score(model, F.col(text_col)).alias(score_col))


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, unchanged."""
    bounded_batches(docs.sparkSession)
    return docs.where(toxicity_score(model, F.col(text_col)) < threshold)
