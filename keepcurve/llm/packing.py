"""Packing tokenised documents into fixed-length training sequences."""

from __future__ import annotations

import array
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepcurve.llm.common import bounded_batches, materialise

MAX_TOKENS = 2048
OPEN_WINDOWS = 16
MERGED_PARTITIONS = 64
CACHED_WORDS, CACHED_PARTS = 600_000, 600_000
ROWS_PER_BATCH = 2048
TOKEN_BYTES = 4


class Recent(dict):
    """Results of ``compute`` by word, in two generations: ``turn`` makes the
    entries the older generation once there are ``most / 2`` and drops the
    one before, so that what was looked up lately stays."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most // 2, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.compute(word)
        self[word] = ids
        return ids

    def turn(self) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()


class WordEncoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    The vocabulary's pre-tokeniser drops white space and no token spans it,
    so a text's ids are those of its words one after the other, and words seen
    lately need no second look.  A word of Latin-1 letters, perhaps with ASCII
    punctuation after it, is one or two pre-tokens (apostrophes start others
    and are left out): such parts are lowered and go to the vocabulary's model
    at once, as all its normalisers and splits would do.  Any other word takes
    the whole tokenizer.  Texts are split only at space, tab and line ends;
    other white space stays for the tokenizer.  The caches are bounded, but
    for the words of the text at hand."""

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokens = self.tokenizer.model.tokenize
        # byte-level models write a byte that is no visible Latin-1 character as the next one from 256 on
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.shown = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in visible)}
        self.latin = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
        self.simple = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
        self.words, self.parts = Recent(self._word, CACHED_WORDS), Recent(self._part, CACHED_PARTS)

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.shown)
        return _pack([t.id for t in self.tokens(part)])

    def _word(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or self.latin(word)):
            return self.parts[word.lower()]
        two = self.simple(word)
        if two is None:
            return _pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        letters, marks = two.groups()
        return self.parts[letters.lower()] + self.parts[marks]

    def encode(self, text: str) -> bytes:
        self.words.turn()
        self.parts.turn()
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.words.__getitem__, words))


def _pack(ids: list[int]) -> bytes:
    out = array.array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary, kept on the tokenizers
    module so that later tasks of the worker find its caches warm."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_encoders_by_path", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


class Packer:
    """Bounded-space online packing with at most ``k`` open windows.

    A piece goes whole to the open window that it leaves the fullest (best
    fit).  If it fits none it opens a new one while fewer than ``k`` are
    open; then the fullest window is topped up with the piece's head and
    emitted, and the rest is placed again.  Pieces are tuples
    ``(doc, start, ids, doc_tokens)``."""

    def __init__(self, size: int, k: int):
        self.size, self.k = size, k
        self.open: list[list] = []  # [used tokens, pieces]

    def add(self, doc, start: int, ids: bytes, doc_tokens: int):
        """Yield the windows (lists of pieces) that become full."""
        size, b = self.size, TOKEN_BYTES
        n, at = len(ids) // b, 0
        while n - at >= size:
            yield [(doc, start + at, ids[at * b:(at + size) * b], doc_tokens)]
            at += size
        while at < n:
            left = n - at
            best = None
            for w in self.open:
                if w[0] + left <= size and (best is None or w[0] > best[0]):
                    best = w
            if best is None and len(self.open) < self.k:
                best = [0, []]
                self.open.append(best)
            take = left
            if best is None:
                best = max(self.open, key=lambda w: w[0])
                take = size - best[0]
            best[0] += take
            best[1].append((doc, start + at, ids[at * b:(at + take) * b], doc_tokens))
            at += take
            if best[0] == size:
                self.open = [w for w in self.open if w is not best]
                yield best[1]

    def drain(self):
        """Yield the open windows joined end to end: full windows, then the
        rest cut into power-of-two lengths, which need no padding."""
        b = TOKEN_BYTES
        pieces = [p for w in self.open for p in w[1]]
        self.open = []
        left = sum(len(p[2]) for p in pieces) // b
        while left:
            want = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            left -= want
            window = []
            while want:
                doc, start, ids, doc_tokens = pieces.pop(0)
                n = len(ids) // b
                if n > want:
                    pieces.insert(0, (doc, start + want, ids[want * b:], doc_tokens))
                    ids, n = ids[:want * b], want
                window.append((doc, start, ids, doc_tokens))
                want -= n
            yield window


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                   max_tokens: int = MAX_TOKENS, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """Pack the tokens of all documents into sequences of ``max_tokens``.

    A document is its text's ids followed by ``end_id``; null and empty texts
    are the end id alone.  Each input partition packs online with a fixed
    number of open windows (see ``Packer``), so memory does not grow with the
    partition.  What is open at its end is merged: ``MERGED_PARTITIONS``
    partitions' leftovers (at most ``open_windows`` windows each) are packed
    again in one group, largest piece first, and the last rest of a group is
    cut into power-of-two lengths.  Thus no sequence needs padding.

    Returns a row per piece: ``(<id_col>, start, length, doc_tokens,
    sequence_id, offset, ids)`` with ``ids`` the piece's little-endian
    unsigned 32-bit token ids.  Each token lies in exactly one piece, offsets
    are gapless from 0.  Ids may be null or repeat; every row is a document.
    Empty input gives an empty result.  Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    piece = T.StructType([
        T.StructField("id", id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("merge_group", T.LongType())])
    end = int(end_id).to_bytes(TOKEN_BYTES, "little")

    def rows_of(window, sequence, group):
        at = 0
        for doc, start, ids, doc_tokens in window:
            n = len(ids) // TOKEN_BYTES
            yield doc, start, n, doc_tokens, sequence, at, ids, group
            at += n

    def batches(rows, schema):
        import itertools

        import pyarrow as pa

        rows = iter(rows)
        while chunk := list(itertools.islice(rows, ROWS_PER_BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*chunk), schema.types)], schema=schema)

    def arrow_schema():
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(piece)

    def pack(stream):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        packer, encoder = Packer(max_tokens, open_windows), _encoder(tokenizer_path)

        def rows():
            n = pid << 34
            for batch in stream:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = encoder.encode(text.as_py() or "") + end
                    for window in packer.add(doc, 0, ids, len(ids) // TOKEN_BYTES):
                        yield from rows_of(window, n, None)
                        n += 1
            for w in packer.open:
                yield from rows_of(w[1], None, pid // MERGED_PARTITIONS)

        yield from batches(rows(), arrow_schema())

    def merge(key, table):
        import pyarrow as pa

        group = key[0].as_py()
        packer = Packer(max_tokens, open_windows)
        pieces = list(zip(*(table.column(c).to_pylist() for c in ("id", "start", "ids", "doc_tokens"))))
        pieces.sort(key=lambda p: (-len(p[2]), p[1], str(p[0]), p[2]))

        def rows():
            n = 1 << 62 | group << 34
            for p in pieces:
                for window in packer.add(*p):
                    yield from rows_of(window, n, group)
                    n += 1
            for window in packer.drain():
                yield from rows_of(window, n, group)
                n += 1

        schema = arrow_schema()
        return pa.Table.from_batches(batches(rows(), schema), schema)

    packed = materialise(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(pack, piece))
    closed = packed.where("merge_group IS NULL")
    merged = packed.where("merge_group IS NOT NULL").groupBy("merge_group").applyInArrow(merge, piece)
    return closed.unionByName(merged).select(F.col("id").alias(id_col), "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
