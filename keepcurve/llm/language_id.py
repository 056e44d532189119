"""Language identification by error-correcting output codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.llm.common import bounded_batches

ORDERS = (2, 3, 4)
FEATURES = 1 << 15
SLICE_BYTES = 1 << 20
SMOOTHING = 0.5
EXHAUSTIVE_UP_TO = 6
# n-grams beyond which more text adds no confidence
FULL_EVIDENCE = 60
AMBIGUOUS_MARGIN = 0.25


def codewords(n: int):
    """Code matrix (n classes x bits) of -1 and 1.  Up to
    ``EXHAUSTIVE_UP_TO`` classes every split of the classes is a bit; beyond
    it, 15 * log2(n) seeded random splits with both sides filled."""
    import numpy as np

    if n < 2:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= EXHAUSTIVE_UP_TO:
        splits = np.arange(1, 1 << (n - 1))
        bits = (splits[None, :] >> np.arange(n)[:, None]) & 1
    else:
        rng, columns = np.random.default_rng(n), []
        while len(columns) < int(np.ceil(15 * np.log2(n))):
            c = rng.integers(0, 2, n)
            if 0 < c.sum() < n:
                columns.append(c)
        bits = np.stack(columns, axis=1)
    return (2 * bits - 1).astype(np.int8)


def ngram_slices(text: str):
    """Arrays of hashed byte n-grams of the lower-cased text, a slice of it at
    a time; slices overlap so that each n-gram comes once."""
    import numpy as np

    data = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    for lo in range(0, len(data), SLICE_BYTES):
        a = data[lo:lo + SLICE_BYTES + max(ORDERS) - 1].astype(np.uint32)
        for n in ORDERS:
            k = min(len(a) - n + 1, SLICE_BYTES)
            if k > 0:
                h = np.full(k, n, dtype=np.uint32)
                for i in range(n):
                    h = h * np.uint32(0x01000193) + a[i:i + k]
                h ^= h >> np.uint32(15)
                yield (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURES.bit_length() + 1)


def ngram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``(lang, feature, n)`` over all rows of ``docs``, counted within each
    partition before the shuffle."""
    def count(stream):
        import numpy as np
        import pyarrow as pa

        total: dict[str, np.ndarray] = {}
        for batch in stream:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                acc = total.setdefault(lang, np.zeros(FEATURES, dtype=np.int64))
                for h in ngram_slices(text.as_py()):
                    if len(h) < FEATURES:
                        np.add.at(acc, h, 1)
                    else:
                        acc += np.bincount(h, minlength=FEATURES)
        for lang, acc in total.items():
            at = np.flatnonzero(acc)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(acc[at])], ["lang", "feature", "n"])

    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    bounded_batches(docs.sparkSession)
    counts = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).mapInArrow(count, "lang string, feature int, n long")
    return counts.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Languages in order, their code matrix, and per bit a weight for each
    n-gram: the log odds of its mean share among languages coded 1 and -1."""

    def __init__(self, counts):
        import numpy as np

        self.languages = sorted(set(counts["lang"]))
        self.codes = codewords(len(self.languages))
        place = {x: k for k, x in enumerate(self.languages)}
        table = np.full((len(self.languages), FEATURES), SMOOTHING)
        table[[place[x] for x in counts["lang"]], counts["feature"]] += counts["n"]
        share = table / table.sum(axis=1, keepdims=True)
        self.weights = np.zeros((FEATURES, self.codes.shape[1]), dtype=np.float32)
        for b in range(self.codes.shape[1]):
            one = self.codes[:, b] > 0
            self.weights[:, b] = np.log(share[one].mean(axis=0)) - np.log(share[~one].mean(axis=0))

    def decode(self, text: str):
        """(language, score, ambiguous): each bit's classifier gives its mean
        log odds, weighted by the evidence; the language whose codeword has
        the least logistic loss wins, its score is its share of exp(-loss)."""
        import numpy as np

        if not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0, True
        total, n = np.zeros(self.codes.shape[1]), 0
        for h in ngram_slices(text):
            total += self.weights[h].sum(axis=0, dtype=np.float64)
            n += len(h)
        margin = total / max(n, 1) * min(n, FULL_EVIDENCE)
        loss = np.logaddexp(0, -self.codes * margin[None, :]).sum(axis=1)
        best = int(loss.argmin())
        p = float(1 / np.exp(loss[best] - loss).sum())
        others = np.delete(loss, best)
        close = bool(len(others)) and float(others.min() - loss[best]) < AMBIGUOUS_MARGIN * self.codes.shape[1]
        return self.languages[best], min(max(p, 0.0), 1.0), close


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from every row whose text and language are not null.  What comes
    to the driver is one count per language and hashed n-gram."""
    return LanguageModel(ngram_counts(docs, text_col, lang_col).toPandas())


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, lang_pred, score, ambiguous)`` for every row of ``docs``.

    ``und`` with score 0 where the text is null or has no letter, or nothing
    was learned; ``ambiguous`` where a second language's codeword is nearly
    as close.  Ids may be null or repeat.  Empty input gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(stream):
        import pyarrow as pa

        for batch in stream:
            got = [model.decode(t.as_py() or "") for t in batch.column(1)]
            lang, score, close = ([g[k] for g in got] for k in range(3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(close, pa.bool_())],
                                             ["id", "lang_pred", "score", "ambiguous"])

    bounded_batches(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {id_type}, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("id", id_col)
