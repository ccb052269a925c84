"""Exact bitmap index of stored keys, so that a load never opens the stored rows.

A row of the index is (word, bits): bit ``key % 64`` of word ``floor(key / 64)``
is set when the key is stored. Requests are numbered in sequence, so a word
usually stands for many keys; at worst (one key a word) the index is as long as
the key column. It is sorted by word whatever the order of the stored rows, so a
batch's word range reaches Parquet and skips the files and row groups of other
keys. There are no false answers, hence no second look at the rows.

Nothing here uses Python on rows: words and bits are integer expressions, sets
meet by ``bit_or`` and ``&``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import KEY

KEYS_SCHEMA = T.StructType([T.StructField("word", T.LongType(), True), T.StructField("bits", T.LongType(), True)])
#: Most words (16 bytes each) of a batch that are broadcast to the index; more meet it by shuffle.
BROADCAST_WORDS_MAX = 2_000_000


def word_of(key: Column) -> Column:
    return F.shiftright(key, 6)


def bit_of(key: Column) -> Column:
    """The key's bit in its word (the low six bits count from 0, for negative keys too)."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))


def key_words(rows: DataFrame, key: str = KEY) -> DataFrame:
    """(word, bits) of the distinct keys of ``rows``; null keys have none."""
    k = F.col(key).cast("long")
    return merge_words(rows.where(k.isNotNull()).select(word_of(k).alias("word"), bit_of(k).alias("bits")))


def merge_words(words: DataFrame) -> DataFrame:
    """One row a word of any number of indexes."""
    return words.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def write_index(words: DataFrame, path: str) -> None:
    """Store an index in order of its words: each file holds one range, so statistics tell ranges apart."""
    words.repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(path)


def stored_words(batch_words: DataFrame, index: DataFrame) -> DataFrame:
    """(word, bits) of the batch's keys that ``index`` holds; at most as many rows as the batch has words.

    ``batch_words`` is measured (rows, least and greatest word), so the caller
    should have cached it. The word range is pushed to the index; the batch's words
    are broadcast to it up to ``BROADCAST_WORDS_MAX`` and meet it by shuffle beyond.
    """
    n, lo, hi = batch_words.agg(F.count(F.lit(1)), F.min("word"), F.max("word")).first()
    near = index.where(F.col("word").between(F.lit(lo).cast("long"), F.lit(hi).cast("long")))
    mine = batch_words.select("word", F.col("bits").alias("_mine"))
    if n <= BROADCAST_WORDS_MAX:
        mine = F.broadcast(mine)
    both = F.col("bits").bitwiseAND(F.col("_mine"))
    # several indexes may hold bits of one word
    return merge_words(near.join(mine, "word").where(both != 0).select("word", both.alias("bits")))


def absent_rows(batch: DataFrame, stored: DataFrame, key: str = KEY, small: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is not set in ``stored`` (word, bits); rows without a key stay.

    ``small`` says that ``stored`` was measured to fit a broadcast.
    """
    k = F.col(key).cast("long")
    held = stored.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    if small:
        held = F.broadcast(held)
    free = F.col("_bits").isNull() | (F.col("_bits").bitwiseAND(bit_of(k)) == 0)
    return batch.join(held, word_of(k) == F.col("_word"), "left").where(free).select(*batch.columns)
