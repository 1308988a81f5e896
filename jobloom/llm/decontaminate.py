"""Benchmark decontamination by a prefix-filtered join with exact containment; DataFrame functions only.

An item's windows are what must not occur.  Containment is exact, so all words of a window have to occur and a prefix
of one word is enough: the window's rarest word in the documents.  Documents meet windows on that word alone; its
place in the window fixes where the window would lie, which bounds position and length, the second rarest word is
compared next, and the whole window last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null has none."""
    # lower() is much faster and the same thing where all characters are ASCII.
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), _NO_WORD), "")


def windows_of(items: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows (``words``, ``items``: the ids, as text, of all items that have it)."""
    given = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), words_of(F.col(text_col)).alias("w"))
    n = F.size("w")
    starts = F.when(n >= size, F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))).when(n > 0, F.array(F.lit(1)))
    cut = given.select("item", "w", F.explode(starts).alias("i")).select("item", F.slice("w", F.col("i"), F.lit(size)).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item").alias("items"))


def find_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    size: int = 10,
    block_windows: int = 200_000,
) -> DataFrame:
    """Where windows of the items occur: one row per row of ``docs``.

    Returns ``doc_id``, ``text_hash`` (XXH64 of the text, null kept), ``n_words``, ``spans`` (``start`` from 1 and
    ``stop``, in words, of each occurrence), ``n_hit`` (words inside any) and ``items`` (sorted ids, as text, of the items that occur).
    A window is ``size`` consecutive words of an item; an item of fewer words, but not none, is one window.

    The items are the query set: they are worked off in blocks of at most ``block_windows`` windows, each against all
    documents, and only such a block is broadcast.  Document words never leave their task unless they lie in a hit.
    Null texts have no words.  Rows with equal id and text get equal results.  A null item id counts as ``null``.
    Without items nothing is hit; an empty document table gives an empty result.  Other columns are not read.
    """
    windows = written(windows_of(items, size, item_id_col, item_text_col), "leak-windows")
    n_blocks = -(-windows.count() // block_windows)
    text_hash = F.when(F.col(text_col).isNotNull(), F.xxhash64(text_col))
    given = docs.select(F.col(id_col).alias("doc_id"), text_hash.alias("text_hash"), F.col(text_col).alias("text"))
    base = given.select(
        "doc_id",
        "text_hash",
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.lit(None).cast("struct<start:int,stop:int>").alias("span"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    block = F.pmod(F.xxhash64("words"), F.lit(max(1, n_blocks)))
    found = [_hits(given, windows.where(block == i)) for i in range(n_blocks)]
    rows = reduce(DataFrame.unionByName, found, base)
    per_doc = rows.groupBy("doc_id", "text_hash").agg(
        F.count("n_words").alias("n_rows"),
        F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    out = per_doc.select("doc_id", "text_hash", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), F.col("n_rows"))))
    inside = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["stop"])))
    n_hit = F.size(F.array_distinct(inside)).cast("long")
    return out.select("doc_id", "text_hash", "n_words", "spans", n_hit.alias("n_hit"), "items")


def _hits(given: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows (doc_id, text_hash, span, items) for each occurrence of a window of one block."""
    listed = windows.withColumn("window", F.xxhash64("words"))
    asked = listed.select(F.explode("words").alias("word")).distinct()
    said = given.select(F.explode(words_of(F.col("text"))).alias("word"))
    # A block's words: at most block_windows * size of them.
    counts = said.join(F.broadcast(asked), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    counts = written(counts, "leak-counts")
    places = listed.select("window", F.posexplode("words").alias("at", "word")).join(F.broadcast(counts), "word", "left")
    # A word that no document has makes its window impossible: it is the rarest, joins nothing, and is dropped here.
    rarest = places.groupBy("window").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at"))).alias("by_rarity")
    )
    rarest = rarest.where(F.element_at("by_rarity", 1)["n"] > 0)
    first, second = F.element_at("by_rarity", 1), F.coalesce(F.try_element_at("by_rarity", F.lit(2)), F.element_at("by_rarity", 1))
    prefix = listed.join(rarest, "window").select(
        first["word"].alias("word"),
        first["at"].alias("at"),
        second["word"].alias("word_2"),
        second["at"].alias("at_2"),
        F.size("words").alias("length"),
        F.array_join("words", " ").alias("whole"),
        "items",
    )
    prefix = written(prefix, "leak-prefixes")
    split = given.select("doc_id", "text_hash", words_of(F.col("text")).alias("w"))
    each = split.select("doc_id", "text_hash", "w", F.posexplode("w").alias("place", "word"))
    start = F.col("place") - F.col("at") + 1
    met = each.join(F.broadcast(prefix), "word").where(
        (start >= 1)
        & (start + F.col("length") - 1 <= F.size("w"))
        & (F.try_element_at("w", start + F.col("at_2")) == F.col("word_2"))
    )
    met = met.where(F.array_join(F.slice("w", F.greatest(start, F.lit(1)), F.col("length")), " ") == F.col("whole"))
    return met.select(
        "doc_id",
        "text_hash",
        F.lit(None).cast("long").alias("n_words"),
        F.struct(start.alias("start"), (start + F.col("length") - 1).alias("stop")).alias("span"),
        "items",
    )
