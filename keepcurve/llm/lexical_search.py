"""Ranked lexical search by a dual-tree: the best documents for every item."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepcurve.llm.common import bounded_batches, materialise
from keepcurve.operators.ordered import row_prefix

# Of the UTF-8 bytes: runs of ASCII letters and digits and of anything beyond ASCII.
TERM_BYTES = rb"[0-9A-Za-z\x80-\xFF]+"
K = 50
ITEMS_PER_BLOCK = 512
# Items of a block have so many terms at most, a longer item alone.
TERMS_PER_BLOCK = 1 << 15
DOCS_PER_BLOCK = 4096
# A block's matrix of leaf maxima has at most so many cells.
CELLS = 1 << 22
DOC_LEAF, ITEM_LEAF, FAN_OUT = 16, 8, 8
EXACT = 1 << 53
LONG = 1 << 63


def _terms_of(text):
    """Terms of UTF-8 bytes; ``bytes.lower`` lowers A-Z alone."""
    import re

    return re.findall(TERM_BYTES, text.lower()) if text else []


def _indexer(vocabulary: dict[bytes, int]):
    """Per document with a term: its number of terms, and the vocabulary's
    terms in it with their occurrences."""
    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        for b in batches:
            keep, size, terms, tfs, ends = [], [], [], [], [0]
            for row, text in enumerate(b.column("text")):
                found = _terms_of(text.as_py())
                if not found:
                    continue
                keep.append(row)
                size.append(len(found))
                for t, c in Counter(found).items():
                    at = vocabulary.get(t)
                    if at is not None:
                        terms.append(at)
                        tfs.append(c)
                ends.append(len(terms))
            ends = pa.array(np.array(ends, np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.array(x, np.int64))) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(keep, pa.int64())), pa.array(size, pa.int64()), *lists], ["id", "n", "terms", "tfs"])
    return run


def impacts(tf, n, n_docs: int, n_terms: int):
    """(10^9 tf) div (1000 tf + 20 m), m = 50 + (50 n N) div L, as longs."""
    import numpy as np

    if len(n) and 50 * int(n.max()) * n_docs >= LONG:
        m = np.array([50 + 50 * int(x) * n_docs // n_terms for x in n], np.int64)
    else:
        m = 50 + 50 * n * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


@dataclass
class ItemTree:
    """Items of a block as a hierarchy: ``columns[i]`` are item i's terms;
    level 0 is the root; a node is a range of items, and its coordinate
    maxima are the weights of the terms that any of its items has."""

    numbers: list[int]
    columns: list
    weight: object
    levels: list[list[tuple[int, int]]]

    def masks(self, used):
        """Per level, a matrix (used terms x nodes) of 0 and 1."""
        import numpy as np

        where = np.full(len(self.weight), -1)
        where[used] = np.arange(len(used))
        leaves = np.zeros((len(used), len(self.levels[-1])), self.weight.dtype)
        for k, (a, b) in enumerate(self.levels[-1]):
            at = where[np.concatenate(self.columns[a:b])]
            leaves[at[at >= 0], k] = 1
        out = [leaves]
        for _ in self.levels[:-1]:
            starts = np.arange(0, out[0].shape[1], FAN_OUT)
            out.insert(0, np.maximum.reduceat(out[0], starts, axis=1))
        return out


def item_tree(numbers, terms, weight, frequency) -> ItemTree:
    """Items that share frequent terms (a language, a topic) become neighbours."""
    import numpy as np

    signature = [tuple(sorted(t, key=lambda c: (-frequency[c], c))[:6]) for t in terms]
    order = sorted(range(len(numbers)), key=lambda i: (signature[i], numbers[i]))
    columns = [np.array(sorted(terms[i]), np.int64) for i in order]
    most = max((int(weight[c].sum()) for c in columns), default=0) * 1_000_000
    levels = [[(a, min(a + ITEM_LEAF, len(order))) for a in range(0, len(order), ITEM_LEAF)]]
    while len(levels[0]) > 1:
        levels.insert(0, [(g[0][0], g[-1][1]) for g in (levels[0][k:k + FAN_OUT] for k in range(0, len(levels[0]), FAN_OUT))])
    # doubles add integers exactly below 2^53, for which a node's bound may stand too: beyond, it only rounds as longs
    node = int(weight.sum()) * 1_000_000
    return ItemTree([numbers[i] for i in order], columns, weight.astype(np.float64 if max(most, node) < EXACT else np.int64), levels)


class DocBlock:
    """A hierarchy over some documents (``doc``, ``col``, ``x`` their entries):
    documents whose weightiest term agrees become neighbours, and a node holds
    the weighted coordinate maxima of its documents."""

    def __init__(self, n_docs, doc, col, x, weight):
        import numpy as np

        self.used, col = np.unique(col, return_inverse=True)
        w = weight[self.used]
        value = x.astype(w.dtype) * w[col]
        top, lead = np.zeros(n_docs, w.dtype), np.full(n_docs, -1)
        np.maximum.at(top, doc, value)
        best = value == top[doc]
        lead[doc[best]] = col[best]
        self.order = np.lexsort((-top, lead))  # place -> document
        place = np.empty(n_docs, np.int64)
        place[self.order] = np.arange(n_docs)
        leaves = np.zeros((-(-n_docs // DOC_LEAF), len(self.used)), w.dtype)
        np.maximum.at(leaves, (place[doc] // DOC_LEAF, col), value)
        self.levels = [leaves]
        while len(self.levels[0]) > 1:
            self.levels.insert(0, np.maximum.reduceat(self.levels[0], np.arange(0, len(self.levels[0]), FAN_OUT), axis=0))
        by_col = np.lexsort((place[doc], col))
        self.place, self.value = place[doc][by_col], value[by_col]
        self.start = np.searchsorted(col[by_col], np.arange(len(self.used) + 1))
        self.n_docs = n_docs

    def at(self, cols):
        """Places of the terms ``cols`` in ``used``, those that occur."""
        import numpy as np

        at = np.searchsorted(self.used, cols)
        at = np.minimum(at, len(self.used) - 1)
        return at[self.used[at] == cols]

    def scores(self, cols, places):
        """Exact scores, for the item with terms ``cols``, of the documents at ``places``."""
        import numpy as np

        row = np.full(self.n_docs, -1)
        row[places] = np.arange(len(places))
        out = np.zeros(len(places), self.value.dtype)
        for c in self.at(cols):
            rows, value = row[self.place[self.start[c]:self.start[c + 1]]], self.value[self.start[c]:self.start[c + 1]]
            inside = rows >= 0
            out[rows[inside]] += value[inside]
        return out


def live_pairs(block: DocBlock, tree: ItemTree, least, count=None):
    """Pairs (document leaf, item) that may hold a score of at least the
    item's ``least``: both hierarchies are descended together, and a pair of
    nodes whose bound, the items' maxima times the documents' maxima, stays
    below the weakest ``least`` of the node's items goes with all below it."""
    import numpy as np

    masks = tree.masks(block.used)
    alive = np.ones((len(block.levels[0]), masks[0].shape[1]), bool)
    for step in range(max(len(block.levels), len(masks))):
        d, i = min(step, len(block.levels) - 1), min(step, len(masks) - 1)
        if step and step == d:
            alive = np.repeat(alive, FAN_OUT, axis=0)[: len(block.levels[d])]
        if step and step == i:
            alive = np.repeat(alive, FAN_OUT, axis=1)[:, : masks[i].shape[1]]
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        bound = block.levels[d][rows] @ masks[i][:, cols]
        weakest = np.array([least[a:b].min() for a, b in (tree.levels[i][c] for c in cols)], bound.dtype)
        alive[np.ix_(rows, cols)] &= bound >= weakest
    # the last level: single items, only where their node is alive
    out = np.zeros((len(alive), len(tree.numbers)), bool)
    for node, (a, b) in enumerate(tree.levels[-1]):
        rows = np.flatnonzero(alive[:, node])
        for item in range(a, b) if len(rows) else ():
            bound = block.levels[-1][np.ix_(rows, block.at(tree.columns[item]))].sum(axis=1)
            out[rows, item] = bound >= least[item]
    if count is not None:
        count[0] += int(out.sum())
        count[1] += out.size
    return out


def _blocks(batches, n_columns: int):
    """(ids, n, terms, tfs, document of each entry) of up to DOCS_PER_BLOCK documents."""
    import numpy as np
    import pyarrow as pa

    most = max(DOC_LEAF, min(DOCS_PER_BLOCK, CELLS // max(1, n_columns) * DOC_LEAF))
    held, rows = [], 0

    def flush():
        t = pa.Table.from_batches(held).combine_chunks()
        lists = t.column("terms").chunk(0) if t.num_rows else None
        size = np.diff(lists.offsets.to_numpy())
        return (t.column("id"), t.column("n").to_numpy(), lists.flatten().to_numpy(), t.column("tfs").chunk(0).flatten().to_numpy(),
                np.repeat(np.arange(t.num_rows), size))

    for b in batches:
        while b.num_rows:
            part = b.slice(0, most - rows)
            held.append(part)
            rows += part.num_rows
            b = b.slice(part.num_rows)
            if rows == most:
                yield flush()
                held, rows = [], 0
    if rows:
        yield flush()


def _searcher(tree: ItemTree, stats, k: int, least, seeds_only: bool):
    """Task: the k best documents of its partition for every item; with
    ``seeds_only`` just the scores of each block's most promising leaf."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        weakest = np.maximum(least, 1).astype(tree.weight.dtype)
        best: list[list] = [[] for _ in tree.numbers]  # (-score, no id, id)
        id_type = None
        for ids, n, col, tf, doc in _blocks(batches, len(tree.weight)):
            id_type = ids.type
            if not len(col):
                continue
            block = DocBlock(len(n), doc, col, impacts(tf, n[doc], *stats), tree.weight)
            if seeds_only:
                leaves = block.levels[-1]
                alive = np.zeros((len(leaves), len(best)), bool)
                alive[[leaves[:, block.at(c)].sum(axis=1).argmax() for c in tree.columns], np.arange(len(best))] = True
            else:
                alive = live_pairs(block, tree, weakest)
            for i, cols in enumerate(tree.columns):
                hit = np.flatnonzero(alive[:, i])
                if not len(hit):
                    continue
                places = (hit[:, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
                places = places[places < block.n_docs]
                s = block.scores(cols, places)
                bar = weakest[i] if len(s) <= k else max(weakest[i], np.partition(s, len(s) - k)[len(s) - k])
                at = np.flatnonzero(s >= bar)
                if not len(at):
                    continue
                found = ids.take(pa.array(block.order[places[at]])).to_pylist()
                best[i] = sorted(best[i] + [(-int(v), x is None, x) for v, x in zip(s[at], found)], key=_rank_key)[:k]
                if len(best[i]) == k:
                    weakest[i] = max(weakest[i], -best[i][-1][0])
        rows = [(number, x, -s) for number, found in zip(tree.numbers, best) for s, _, x in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], id_type),
                                              pa.array([r[2] for r in rows], pa.int64())], ["item", "id", "score"])
    return run


def _rank_key(x):
    return (x[0], x[1], 0 if x[1] else x[2])


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item, in two steps, with their ``rank``."""
    order = [F.desc("score"), F.asc_nulls_last("id")]
    part = Window.partitionBy("item", "part").orderBy(*order)
    some = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64))).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    whole = Window.partitionBy("item").orderBy(*order)
    return some.drop("part", "rank").withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``(item, item_id, terms, block)``, rows with a term only, numbered, and
    the number of blocks: of ITEMS_PER_BLOCK items and TERMS_PER_BLOCK terms
    at most, but for the last item's."""
    def terms(batches):
        import pyarrow as pa

        for b in batches:
            found = [sorted(set(_terms_of(t.as_py()))) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.list_(pa.binary()))], ["id", "terms"])

    kind = items.schema[id_col].dataType.simpleString()
    t = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(terms, f"id {kind}, terms array<binary>")
    t = materialise(t.where(F.size("terms") > 0).withColumn("place", F.monotonically_increasing_id()))
    cost = F.greatest(F.lit(1), F.ceil(F.size("terms") / (TERMS_PER_BLOCK / ITEMS_PER_BLOCK))).cast("long")
    t = row_prefix(t, "place", measures={"cost": cost})
    before = F.col("cum_cost") - cost
    t = materialise(t.select((F.col("rn") - 1).alias("item"), F.col("id").alias("item_id"), "terms", F.floor(before / ITEMS_PER_BLOCK).cast("int").alias("block")))
    last = t.agg(F.max("block")).first()[0]
    return t, 0 if last is None else last + 1


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """The ``k`` highest-scoring documents for every item: ``(<item_id_col>,
    rank, <id_col>, score)``, scores above 0, ties to the smaller id.

    Terms, weights and scores are those of the module's constants: a term
    weighs floor(1000 ln((2N+2)/(2df+1))), an occurrence count saturates with
    the document's length against the mean, all in integers.  Items are taken
    in blocks of bounded vocabulary.  For a block one pass over the texts
    writes each document's counts of the block's terms; aggregates give N, L
    and df.  Tasks cut their documents into blocks of at most DOCS_PER_BLOCK,
    build a hierarchy of coordinate maxima over each and descend it together
    with the hierarchy over the items.  A first round scores only the leaf
    with the highest bound, which gives every item a kth score that is surely
    reached; the second prunes by the larger of that and the task's own, and
    scores what is left exactly.  A bound equal to it is kept, so ties are
    whole.  A task returns at most k rows per item.

    Null and term-less texts match nothing and do not count in N; null ids
    rank after others of the same score.  Rows that repeat an item's or
    document's id are items and documents of their own.  Empty tables give an
    empty result; other columns take no part.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    asked, n_blocks = item_blocks(items, item_id_col, item_text_col)
    out = None
    for number in range(n_blocks):
        mine = asked.where(F.col("block") == number)
        rows = sorted(mine.select("item", "terms").collect())
        vocabulary: dict[bytes, int] = {}
        terms = [[vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r["terms"]] for r in rows]
        found = _search_block(docs, id_col, text_col, kind, [r["item"] for r in rows], terms, vocabulary, k)
        found = found.join(mine.select("item", "item_id"), "item")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = asked.select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(kind).alias("id"), F.lit(0).cast("long").alias("score")).limit(0)
    return out.select(F.col("item_id").alias(item_id_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def _search_block(docs, id_col, text_col, kind, numbers, terms, vocabulary, k) -> DataFrame:
    import numpy as np

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    index = materialise(source.mapInArrow(_indexer(vocabulary), f"id {kind}, n long, terms array<long>, tfs array<long>"))
    n_docs, n_terms = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in index.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    tree = item_tree(numbers, terms, weight, df)
    stats, schema = (n_docs, n_terms), f"item long, id {kind}, score long"

    least = np.zeros(len(numbers), np.int64)
    seeds = _best(index.mapInArrow(_searcher(tree, stats, k, least, True), schema), k)
    place = {n: i for i, n in enumerate(tree.numbers)}
    for r in seeds.where(F.col("rank") == k).select("item", "score").collect():
        least[place[r["item"]]] = r["score"]
    return _best(index.mapInArrow(_searcher(tree, stats, k, least, False), schema), k)
