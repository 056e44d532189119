"""Pre-filters on keys: a bitmap of hashed keys, joined as a small table.

A key sets one bit of ``words`` 64-bit words.  The bitmap is a table of at
most ``words`` rows (word number, bits), so broadcasting it is bounded
whatever the number of keys: the default of 2^17 words takes 2 MB and tells
8.4 million bits apart.  A row whose bit is not set surely has no key; a row
whose bit is set may have one, so an exact join follows where it matters.
More keys than bits only let more rows pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 17


def _place(cols: Sequence[str], words: int):
    """(word, bit) of a key; -1 and null for a key that holds a null."""
    h = F.xxhash64(*cols)
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    word = F.when(known, F.pmod(F.shiftright(h, 6), F.lit(words)).cast("int")).otherwise(-1)
    return word, F.expr("shiftleft(1L, cast(_h & 63 AS int))"), h


def key_bitmap(keys: DataFrame, cols: Sequence[str], words: int = WORDS) -> DataFrame:
    """The bitmap of ``keys``: ``(_word, _bits)``, at most ``words`` rows.
    Keys with a null set no bit."""
    word, bit, h = _place(cols, words)
    k = keys.select(word.alias("_word"), h.alias("_h")).where("_word >= 0")
    return k.groupBy("_word").agg(F.bit_or(bit).alias("_bits"))


def flag_keys(df: DataFrame, bitmap: DataFrame, cols: Sequence[str], flag: str, words: int = WORDS) -> DataFrame:
    """``df`` with a boolean column ``flag``: false where the key is surely not
    in the bitmap (or holds a null).  ``df`` is not shuffled."""
    word, bit, h = _place(cols, words)
    out = df.withColumns({"_word": word, "_h": h}).join(F.broadcast(bitmap), "_word", "left")
    hit = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    return out.withColumn(flag, hit).drop("_word", "_h", "_bits")


def prefilter(df: DataFrame, keys: DataFrame, cols: Sequence[str], words: int = WORDS) -> DataFrame:
    """Rows of ``df`` whose key may be in ``keys``; column names in ``cols``
    are the same on both sides.  ``df`` is not shuffled."""
    word, bit, h = _place(cols, words)
    out = df.withColumns({"_word": word, "_h": h}).join(F.broadcast(key_bitmap(keys, cols, words)), "_word")
    return out.where(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_h", "_bits")
