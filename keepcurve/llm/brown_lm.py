"""Class-based bigram language model with classes from exchange clustering."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.llm.common import bounded_batches, materialise

# The end of a text as a token; no word contains white space.
END = b"\n"
# Bounds of what every task holds, whatever the corpus: words known to the tasks, words clustered one by
# one, units of words that share an ending, classes.
DICTIONARY = 1 << 18
CLUSTERED = 8192
ENDING_UNITS = 4096
ENDING_BYTES = 4
CLASSES = 64
ROUNDS = 12
EXCHANGE_STEPS = 256
DISCOUNT = 0.75
TRANSITION_PRIOR = 200.0
PARTIAL_WORDS = 400_000
ROWS_PER_BATCH = 20_000
UNITS_PER_BLOCK = 64
FAN_IN = 64


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a text, ASCII letters lowered, then the end."""
    return [*(text or b"").lower().split(), END]


def ending_unit(word: bytes) -> int:
    """Unit of a word that is not clustered itself: by its last bytes."""
    from zlib import crc32

    return CLUSTERED + crc32(word[-ENDING_BYTES:]) % ENDING_UNITS


def word_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``(word, n)`` over all rows, words as bytes, counted within each
    partition as far as ``PARTIAL_WORDS`` distinct words fit."""
    def count(stream):
        from collections import Counter

        import pyarrow as pa

        def flush(c):
            keys = list(c)
            for lo in range(0, len(keys), ROWS_PER_BATCH):
                k = keys[lo:lo + ROWS_PER_BATCH]
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), pa.array([c[x] for x in k], pa.int64())], ["word", "n"])

        c: Counter = Counter()
        for batch in stream:
            for text in batch.column(0):
                c.update(tokens(text.as_py()))
                if len(c) >= PARTIAL_WORDS:
                    yield from flush(c)
                    c = Counter()
        yield from flush(c)

    return docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The words of the highest counts, in order: all words from some count
    up, so that there are at most ``most``.  The count comes from a table of
    how many words have each count, never from sorting the words."""
    from itertools import accumulate

    by_count = sorted(((r["n"], r["k"]) for r in counts.groupBy("n").agg(F.count("*").alias("k")).collect()), reverse=True)
    fits = [n for (n, _), total in zip(by_count, accumulate(k for _, k in by_count)) if total <= most]
    if not fits:
        return []
    found = counts.where(F.col("n") >= fits[-1]).toArrow()
    words, n = found.column("word").to_pylist(), found.column("n").to_pylist()
    return sorted(zip(words, n), key=lambda x: (-x[1], x[0]))


def encode(docs: DataFrame, frequent: list[tuple[bytes, int]], text_col: str) -> DataFrame:
    """Texts as units.  Adds to the other columns of ``docs`` (the text goes):
    ``units`` (little-endian uint16 per token), ``n_tokens``, of tokens in the
    dictionary ``n_frequent``, ``log_base`` (sum of log10(count + 1)) and
    ``log_emit`` (sum of log10(count - discount)), and ``rare``: the other
    words with their number and unit."""
    known = {w: k for k, (w, _) in enumerate(frequent)}
    counts = np.array([n for _, n in frequent] or [1], dtype=np.float64)
    units = np.array([k if k < CLUSTERED else ending_unit(w) for k, (w, _) in enumerate(frequent)] or [0], dtype=np.uint16)
    base, emit = np.log10(counts + 1), np.log10(counts - DISCOUNT)
    rest = [c for c in docs.columns if c != text_col]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)

    def run(stream):
        from collections import Counter

        import pyarrow as pa

        rare_type = pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64()), ("unit", pa.int32())]))
        for batch in stream:
            out = []
            for text in batch.column(batch.num_columns - 1):
                words = tokens(text.as_py())
                at = np.fromiter((known.get(w, -1) for w in words), dtype=np.int32, count=len(words))
                missing = np.flatnonzero(at < 0)
                found = at[at >= 0]
                unit = units[at]
                lost = [words[i] for i in missing.tolist()]
                unit_of = {w: ending_unit(w) for w in set(lost)}
                if lost:
                    unit[missing] = [unit_of[w] for w in lost]
                out.append((unit.astype("<u2").tobytes(), len(words), len(found), float(base[found].sum()), float(emit[found].sum()),
                            [{"word": w, "k": k, "unit": unit_of[w]} for w, k in Counter(lost).items()]))
            types = [pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), rare_type]
            new = [pa.array([o[k] for o in out], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], [*rest, "units", "n_tokens", "n_frequent", "log_base", "log_emit", "rare"])

    return docs.select(*rest, F.col(text_col).cast("binary").alias(text_col)).mapInArrow(
        run, schema + ", units binary, n_tokens long, n_frequent long, log_base double, log_emit double, rare array<struct<word: binary, k: long, unit: int>>")


def contexts(encoded: DataFrame, classes) -> tuple[np.ndarray, np.ndarray]:
    """How often each unit follows, and comes before, each class: two arrays
    units x classes over all texts; a text begins and ends with class 0.

    Every task adds up its own arrays and sends them in blocks of units; the
    blocks of ``FAN_IN`` tasks are added in one group, level by level, so no
    group grows with the number of tasks.  The result is bounded by units x
    classes."""
    n_units, width = len(classes), CLASSES

    def count(stream):
        import pyarrow as pa
        from pyspark import TaskContext

        both = np.zeros((2, n_units * width), dtype=np.int64)
        def add(u):
            c = classes[u].astype(np.int64)
            before, after = np.roll(c, 1), np.roll(c, -1)  # texts end with the class 0
            both[0] += np.bincount(u * width + before, minlength=n_units * width)
            both[1] += np.bincount(u * width + after, minlength=n_units * width)
        held, size = [], 0
        for batch in stream:
            for x in batch.column(0):
                held.append(np.frombuffer(x.as_py(), "<u2").astype(np.int64))
                size += len(held[-1])
                if size > 1 << 21:
                    add(np.concatenate(held))
                    held, size = [], 0
        if held:
            add(np.concatenate(held))
        blocks = both.reshape(2, n_units, width)
        pid = TaskContext.get().partitionId()
        starts = [b for b in range(0, n_units, UNITS_PER_BLOCK) if blocks[:, b:b + UNITS_PER_BLOCK].any()]
        yield pa.RecordBatch.from_arrays([pa.array([pid // FAN_IN] * len(starts), pa.int64()), pa.array(starts, pa.int32()),
                                          pa.array([np.ascontiguousarray(blocks[:, b:b + UNITS_PER_BLOCK]).tobytes() for b in starts], pa.binary())],
                                         ["part", "block", "counts"])

    def total(table):
        import pyarrow as pa

        acc = sum(np.frombuffer(x.as_py(), "<i8") for x in table.column("counts"))
        return pa.table([pa.array([table.column("part")[0].as_py() // FAN_IN], pa.int64()), pa.array([table.column("block")[0].as_py()], pa.int32()),
                         pa.array([np.ascontiguousarray(acc).tobytes()], pa.binary())], names=["part", "block", "counts"])

    schema = "part long, block int, counts binary"
    units = encoded.select("units")
    tasks = units.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0] or 0
    sums = units.mapInArrow(count, schema)
    while True:
        sums = sums.groupBy("part", "block").applyInArrow(total, schema)
        tasks //= FAN_IN
        if not tasks:
            break
    out = np.zeros((2, n_units, width))
    for r in sums.select("block", "counts").collect():
        x = np.frombuffer(r["counts"], "<i8").reshape(2, -1, width)
        out[:, r["block"]:r["block"] + x.shape[1]] += x
    return out[0], out[1]


def transitions(before, classes):
    """Class bigram counts [previous, class] from the units' contexts."""
    n = np.zeros((CLASSES, CLASSES))
    np.add.at(n.T, classes, before)
    return n


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(n) -> float:
    """Log-likelihood of the class bigram model, but for a constant."""
    return float(_xlogx(n).sum() - _xlogx(n.sum(0)).sum() - _xlogx(n.sum(1)).sum())


def exchange(before, after, classes, n, movable):
    """One exchange round: each movable unit, the most frequent first, goes to
    the class that raises the likelihood most.  The class bigram counts follow
    every few moves; the units' own contexts are those counted at the start."""
    new, n = classes.copy(), n.copy()
    size = before.sum(1) + after.sum(1)
    units = np.flatnonzero(movable & (size > 0))
    units = units[np.argsort(-size[units], kind="stable")]
    at_once = max(1, len(units) // EXCHANGE_STEPS)
    for lo in range(0, len(units), at_once):
        rows, cols = n.sum(1), n.sum(0)
        g, g_rows, g_cols = _xlogx(n), _xlogx(rows), _xlogx(cols)
        u = units[lo:lo + at_once]
        l, r, a = before[u], after[u], new[u]
        lm, rm = l.sum(1), r.sum(1)
        leave = ((_xlogx(np.maximum(n[a] - r, 0)) - g[a]).sum(1) + (_xlogx(np.maximum(n[:, a].T - l, 0)) - g[:, a].T).sum(1)
                 - (_xlogx(np.maximum(rows[a] - rm, 0)) - g_rows[a]) - (_xlogx(np.maximum(cols[a] - lm, 0)) - g_cols[a]))
        join = ((_xlogx(n[None] + r[:, None, :]) - g[None]).sum(2) + (_xlogx(n.T[None] + l[:, None, :]) - g.T[None]).sum(2)
                - (_xlogx(rows[None] + rm[:, None]) - g_rows[None]) - (_xlogx(cols[None] + lm[:, None]) - g_cols[None]))
        gain = join + leave[:, None]
        gain[np.arange(len(u)), a] = 0
        gain[:, 0] = -np.inf  # class 0 is the end's alone
        best = gain.argmax(1)
        moves = np.flatnonzero((gain[np.arange(len(u)), best] > 0) & (best != a))
        for k in moves:
            n[a[k]] -= r[k]
            n[best[k]] += r[k]
            n[:, a[k]] -= l[k]
            n[:, best[k]] += l[k]
        np.maximum(n, 0, out=n)
        new[u[moves]] = best[moves]
    return new


def cluster(encoded: DataFrame, end_unit: int, rounds: int = ROUNDS):
    """Classes of the units by exchange clustering; returns (classes, class
    bigram counts) of the best round by likelihood.

    Each round counts every unit's contexts over all texts, then exchanges a
    random part of the units, at first a half, starting from the best classes
    so far; the part is halved after a round that did not help.  The end keeps
    class 0 for itself."""
    n_units = CLUSTERED + ENDING_UNITS
    rng, part = np.random.default_rng(0), 0.5
    classes = (1 + np.arange(n_units) % (CLASSES - 1)).astype(np.int32)
    best = None
    for k in range(rounds + 1):
        classes[end_unit] = 0
        before, after = contexts(encoded, classes)
        n = transitions(before, classes)
        value = likelihood(n)
        if best is None or value > best[0]:
            best = (value, classes, n, before, after)
        else:
            part /= 2
        movable = rng.random(n_units) < part
        movable[end_unit] = False
        _, classes, n, before, after = best
        if k < rounds:
            classes = exchange(before, after, classes, n, movable)
    return best[1], best[2]


def types_per_class(counts: DataFrame, units: dict[bytes, int], classes):
    """Number of distinct training words in each class."""
    def run(stream):
        import pyarrow as pa

        acc = np.zeros(CLASSES, dtype=np.int64)
        for batch in stream:
            u = [units[w] if w in units else ending_unit(w) for w in batch.column(0).to_pylist()]
            acc += np.bincount(classes[u], minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(acc)], ["class", "n"])

    out = np.zeros(CLASSES)
    for r in counts.select("word").mapInArrow(run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        out[r["class"]] = r["n"]
    return out


def class_model(n, types):
    """From class bigram counts and distinct words per class: log10 of
    P(class | previous) / class count, and of a class's mass of unseen words
    times its count.  With log10(count - discount) for a known word the sum is
    the word's log10 probability."""
    in_class = n.sum(0)
    share = (in_class + 1) / (in_class.sum() + CLASSES)
    step = np.log10((n + TRANSITION_PRIOR * share[None, :]) / (n.sum(1, keepdims=True) + TRANSITION_PRIOR))
    unseen = np.log10(np.maximum(DISCOUNT * types, 1e-12))
    unseen[types == 0] = 0.0  # nothing known in the class: all of it is unseen words
    return step - np.log10(np.maximum(in_class, 1))[None, :], unseen


def score_texts(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Train on the rows of ``docs`` where the boolean column ``learn`` holds
    and score all of them.

    Words are runs of anything but ASCII white space, ASCII letters lowered;
    each text ends with an end token.  Every word has one unit: the most
    frequent words are units themselves, the others share the unit of their
    last bytes, known or not.  Exchange clustering puts the units into
    classes.  P(word | previous) = P(class | previous class) P(word | class):
    transitions are smoothed towards the classes' shares; of the words in a
    class each count is discounted, and what that frees is the class's mass
    for words never seen, taken as one event as in the base.  The base is the
    add-one unigram model over the same counts.

    All counts are over the whole training rows.  Words outside the bounded
    dictionary meet their counts in a join on the word, once per text and
    word.  Null texts count as empty; rows whose ``learn`` is null are not
    learned from; ids may be null or repeat.  Without training rows all
    tokens are unknown.  Empty input gives an empty result.

    Returns per row ``(<id_col>, learned, n_tokens, n_known, train_tokens,
    base_score, score, perplexity)``, scores as log10 probabilities.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(learn, F.lit(False)).alias("learned"), F.col(text_col).alias("text"))
    counts = materialise(word_counts(rows.where("learned"), "text"))
    total, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = most_frequent(counts, DICTIONARY)
    encoded = materialise(encode(rows.withColumn("row", F.monotonically_increasing_id()), frequent, "text"))
    units = {w: k for k, (w, _) in enumerate(frequent[:CLUSTERED])}
    end_unit = units.get(END, ending_unit(END))
    classes, n = cluster(encoded.where("learned"), end_unit, rounds)
    types = types_per_class(counts, units, classes)

    step, unseen = class_model(n, types)

    def walk(stream):
        import pyarrow as pa

        for batch in stream:
            out = []
            for x in batch.column(batch.num_columns - 1):
                c = classes[np.frombuffer(x.as_py(), "<u2")]
                out.append(float(step[np.roll(c, 1), c].sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], [*batch.schema.names[:-1], "path"])

    keep = ["row", "id", "learned", "n_tokens", "n_frequent", "log_base", "log_emit"]
    id_type = docs.schema[id_col].dataType.simpleString()
    paths = encoded.select(*keep, "units").mapInArrow(
        walk, f"row long, id {id_type}, learned boolean, n_tokens long, n_frequent long, log_base double, log_emit double, path double")
    by_unit = F.broadcast(docs.sparkSession.createDataFrame([(k, float(unseen[c])) for k, c in enumerate(classes.tolist())], "unit int, log_unseen double"))
    rare = encoded.select("row", F.inline("rare")).join(counts, "word", "left").join(by_unit, "unit")
    known = F.col("n").isNotNull()
    rare = rare.groupBy("row").agg(
        F.sum(F.when(known, F.col("k")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_base"),
        F.sum(F.col("k") * F.when(known, F.log10(F.col("n") - DISCOUNT)).otherwise(F.col("log_unseen"))).alias("rare_emit"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    denominator = float(np.log10(total + 1.0 * (n_types + 1)))
    score = F.col("path") + F.col("log_emit") + zero("rare_emit")
    return paths.join(rare, "row", "left").select(
        F.col("id").alias(id_col), "learned", "n_tokens", (F.col("n_frequent") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("log_base") + zero("rare_base") - F.col("n_tokens") * denominator).alias("base_score"),
        score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"))
