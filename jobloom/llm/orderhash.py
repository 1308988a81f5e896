"""Order MinHash fingerprints of documents; DataFrame functions only.

A text is read as words, words longer than twelve characters in pieces, and its k-mers are ``k`` words in a row.  Each
k-mer is numbered by occurrence, and k-mer and number are hashed together.  The hash deals the numbered k-mers to
cells; in a cell the ``tuple_size`` least ones are selected, put back into text order, and hashed as a tuple.  A cell
with fewer is filled up from the next cells, else short texts would have many tuples of one, which have no order.  Two
texts agree in a cell when they share its least k-mers and their order, so the share of equal cells falls with edit
distance and with moved passages, not only with what words occur.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobloom.functions.json import with_settled

_PLACE_BITS = 30
_CELL_BITS = 6
CELLS = 1 << _CELL_BITS
#: K-mers that occur up to so many times are numbered by looking back.
_SELDOM = 4


def _packed(value: Column, place: Column) -> Column:
    """33 bits of hash above 30 bits of place: a positive long that sorts by hash, then place."""
    return F.shiftleft(F.shiftrightunsigned(value, 31), _PLACE_BITS).bitwiseOR(place.cast("long"))


def _hash_part(packed: Column) -> Column:
    return F.shiftright(packed, _PLACE_BITS)


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))


def _cell(packed: Column) -> Column:
    return F.shiftright(packed, 63 - _CELL_BITS)


def with_signature(df: DataFrame, text_col: str, out_col: str, *, k: int = 2, tuple_size: int = 2, filled: bool = False) -> DataFrame:
    """Adds ``out_col``: an int, or null for an empty cell, per cell.

    With ``filled``, a cell of fewer than ``tuple_size`` k-mers, but not an empty one, takes those that follow in hash
    order, going round at the end, so that its tuple has an order too; only a text of fewer k-mers has shorter tuples.

    Only the text counts: equal texts have equal signatures.  A text of fewer than ``k`` words is one k-mer; one
    without a word has only empty cells; a null text has a null signature.  All steps are linear in the text but for
    two sorts of longs.
    """
    kept = df.columns
    step = with_settled(df, {"o_words": F.regexp_extract_all(text_col, F.lit(r"[^\x20\x09-\x0D]{1,12}"), F.lit(0))})
    n = F.size("o_words")
    n_kmers = F.greatest(n - (k - 1), F.least(n, F.lit(1)))
    places = F.when(n_kmers > 0, F.sequence(F.lit(0), F.greatest(n_kmers - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    kmer = lambda i: F.xxhash64(*[F.get("o_words", i + d) for d in range(k)])
    step = with_settled(step, {"o_kmers": F.sort_array(F.transform(places, lambda i: _packed(kmer(i), i)))})
    # Equal k-mers now lie together in text order.  A k-mer's number is how many equal ones lie before it: most occur
    # a few times only, which a look back tells; where one occurs more often, numbering starts where its stretch does.
    size = F.size("o_kmers")
    equal = lambda x, i, back: (i >= back) & (_hash_part(x) == _hash_part(F.get("o_kmers", i - back)))
    later = lambda first: F.when(size > first, F.sequence(F.lit(first), size - 1)).otherwise(F.array().cast("array<int>"))
    often = F.exists(later(_SELDOM), lambda i: _hash_part(F.get("o_kmers", i)) == _hash_part(F.get("o_kmers", i - _SELDOM)))
    begins = F.filter(later(0), lambda i: (i == 0) | (_hash_part(F.get("o_kmers", i)) != _hash_part(F.get("o_kmers", i - 1))))
    step = with_settled(step, {"o_often": often})
    step = with_settled(step, {"o_begins": F.when(F.col("o_often"), begins)})

    def pair(x: Column, number: Column) -> Column:
        return _packed(F.xxhash64(_hash_part(x), number), _place(x))

    def seldom(x: Column, i: Column) -> Column:
        number = F.lit(_SELDOM - 1)
        for back in range(_SELDOM - 1, 0, -1):
            number = F.when(equal(x, i, back), number).otherwise(F.lit(back - 1))
        return pair(x, number)

    def stretch(begin: Column, j: Column) -> Column:
        length = F.coalesce(F.get("o_begins", j + 1), size) - begin
        return F.transform(F.slice("o_kmers", begin + 1, length), pair)

    pairs = F.when(~F.col("o_often"), F.transform("o_kmers", seldom)).otherwise(F.flatten(F.transform("o_begins", stretch)))
    step = with_settled(step, {"o_pairs": F.sort_array(pairs)})
    least = F.filter("o_pairs", lambda x, i: (i < tuple_size) | (_cell(x) != _cell(F.get("o_pairs", i - tuple_size))))
    step = with_settled(step, {"o_least": least})
    n_least = F.size("o_least")
    heads = F.filter(
        F.when(n_least > 0, F.sequence(F.lit(0), n_least - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: (i == 0) | (_cell(F.get("o_least", i)) != _cell(F.get("o_least", i - 1))),
    )
    # What follows a cell's own k-mers are the least of the next cells, so the selected ones hold it.
    circle = F.concat("o_least", F.slice("o_least", 1, tuple_size - 1)) if filled else F.col("o_least")
    step = with_settled(step, {"o_heads": heads, "o_circle": circle})

    def entry(head: Column, j: Column) -> Column:
        own = F.coalesce(F.get("o_heads", j + 1), n_least) - head
        length = F.least(F.lit(tuple_size), n_least) if filled else own
        by_place = F.transform(
            F.slice("o_circle", head + 1, length), lambda x: F.shiftleft(_place(x), 33).bitwiseOR(_hash_part(x))
        )
        ordered = F.transform(F.sort_array(by_place), lambda y: y.bitwiseAND(F.lit((1 << 33) - 1)))
        return F.struct(
            _cell(F.get("o_least", head)).cast("int").alias("cell"), F.xxhash64(ordered).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("hash")
        )

    step = with_settled(step, {"o_cells": F.map_from_entries(F.transform("o_heads", entry))})
    signature = F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda c: F.try_element_at("o_cells", c))
    signature = F.when(F.col(text_col).isNotNull(), signature)
    return with_settled(step, {out_col: signature}).select(*kept, out_col)


def as_text(signature: Column) -> Column:
    """Four hex digits per cell, four dashes for an empty one."""
    return F.array_join(F.transform(signature, lambda x: F.coalesce(F.lower(F.lpad(F.hex(x), 4, "0")), F.lit("----"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal cells among those that either signature fills; 1 for two texts without a word."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()), lambda e: e))
    return F.when(either == 0, F.lit(1.0)).otherwise(same / either)


def with_next(
    docs: DataFrame, columns: list[str], *, id_col: str = "doc_id", tie_col: str = "tie", parts: int, narrow: DataFrame | None = None
) -> DataFrame:
    """Adds ``next_<c>`` for each of ``columns``: that of the next row by descending id, the first row's after the last.

    Null ids come last, equal ids in descending order of ``tie_col``, a hash of what tells rows of one id apart.  A
    global order without a global sort: rows go to ranges, inside a range the next row is the following one, and a copy
    of the first row of the next range stands behind each range's last.  Ranges come from approximate quantiles of the
    id; an id that fills several of them, and null ids, are cut into as many ranges of the tie.  Rows that equal each
    other in id and tie and would fill a range alone go through the order as one row with a count: each of them but one
    is followed by its equal.  The driver sees one bound and one (id, tie) per range.  ``narrow`` may give the same ids
    and ties without costly columns.
    """
    spark = docs.sparkSession
    narrow = (docs if narrow is None else narrow).select(id_col, tie_col)
    cuts = [i / parts for i in range(1, parts)]
    quantiles = F.percentile_approx(id_col, cuts, 20 * parts) if cuts else F.lit(None)
    found, n, with_id = narrow.agg(quantiles, F.count("*"), F.count(id_col)).first()
    times = Counter(found or [])
    bounds = sorted(times)
    # Into how many ranges of the tie an id goes; 0: it shares a range with the ids below it.
    split = [times[b] + 1 if times[b] > 1 else 0 for b in bounds]
    split_null = -(-(n - with_id) * parts // max(1, n))
    known = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(bounds).bit_length())))])
    # Binary search for the number of bounds below the id; null ids have ranges of their own.
    below = F.aggregate(steps, F.lit(0), lambda p, s: F.when(F.try_element_at(known, p + s) < F.col(id_col), p + s).otherwise(p))
    part = F.when(F.col(id_col).isNull(), F.lit(-1)).otherwise(below).cast("long")
    hot = any(split) or split_null > 1
    if hot:
        is_bound = F.try_element_at(known, below + 1) == F.col(id_col)
        ties = F.when(F.col(id_col).isNull(), F.lit(split_null)).when(
            is_bound, F.try_element_at(F.array(*[F.lit(x) for x in split or [0]]), below + 1)
        )
        # The tie's upper 32 bits, moved to start at zero, as a place among so many ranges; they begin at 1.
        tie_range = F.shiftright((F.shiftright(tie_col, 32) + F.lit(1 << 31)) * ties, 32) + 1
        in_id = F.coalesce(F.when(ties > 0, tie_range), F.lit(0))
        part = part * (parts + 2) + in_id
    heavy = None
    if hot:
        often = narrow.where(in_id > 0).groupBy(id_col, tie_col).agg(F.count("*").alias("n")).where(F.col("n") > max(1, n // parts))
        listed = [tuple(r) for r in often.collect()]  # at most one per range
        if listed:
            heavy = F.broadcast(spark.createDataFrame(listed, "o_id long, o_tie long, o_copies long"))
    rows = docs
    if heavy is not None:
        alike_ = docs[id_col].eqNullSafe(heavy["o_id"]) & docs[tie_col].eqNullSafe(heavy["o_tie"])
        rest = [c for c in docs.columns if c not in (id_col, tie_col)]
        one = docs.join(heavy, alike_).groupBy(id_col, tie_col).agg(*[F.first(c).alias(c) for c in rest], F.max("o_copies").alias("o_copies"))
        rows = docs.join(heavy, alike_, "left_anti").withColumn("o_copies", F.lit(1).cast("long")).unionByName(one)
    heads = narrow.select(part.alias("part"), F.struct(id_col, tie_col).alias("head")).groupBy("part").agg(F.max("head").alias("head"))
    firsts = [(r.part, r["head"][0], r["head"][1]) for r in heads.collect()]
    firsts.sort(reverse=True)
    guards = [(here[0], after[1], after[2]) for here, after in zip(firsts, firsts[1:] + firsts[:1], strict=True)]
    guards = F.broadcast(spark.createDataFrame(guards, "o_part long, o_id long, o_tie long"))
    copies = rows.join(guards, rows[id_col].eqNullSafe(guards["o_id"]) & rows[tie_col].eqNullSafe(guards["o_tie"]))
    copies = copies.select(*rows.columns, "o_part", F.lit(True).alias("o_guard"))
    order = Window.partitionBy("o_part").orderBy("o_guard", F.col(id_col).desc_nulls_last(), F.col(tie_col).desc_nulls_last())
    both = rows.withColumns({"o_part": part, "o_guard": F.lit(False)}).unionByName(copies)
    both = both.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    out = both.where(~F.col("o_guard")).drop("o_part", "o_guard")
    if heavy is None:
        return out
    # Equal rows come back in chunks of a thousand, which are spread over the tasks.
    chunks = out.where("o_copies > 1").withColumn("o_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("o_copies") - 1) / 1000))))
    chunks = chunks.repartition(parts, id_col, tie_col, "o_chunk")
    begin = F.col("o_chunk") * 1000
    copy = F.explode(F.sequence(begin, F.least(begin + 1000, F.col("o_copies")) - 1))
    equal = chunks.withColumn("o_copy", copy).withColumns(
        {f"next_{c}": F.when(F.col("o_copy") > 0, F.col(c)).otherwise(F.col(f"next_{c}")) for c in columns}
    )
    return out.where("o_copies = 1").drop("o_copies").unionByName(equal.drop("o_copies", "o_chunk", "o_copy"))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n/2) of a text's n characters replaced by the first as many, or all, of the following text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half))


def fingerprint_edits(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 2, tuple_size: int = 2, parts: int | None = None
) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and how alike they are.

    Returns ``doc_id``, ``text``, ``edited``, ``signature``, ``edited_signature``, ``near_edited`` (likeness of text and
    edited text) and ``near_next`` (of text and next document's text).  Null texts count as empty.  Ids are integers or
    null; rows stay rows.  A single row is its own next one.  Other columns are not read.  An empty table gives an
    empty result.  Texts are shuffled once.  An id, or null, may hold any share of the rows, and so may one text under it.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    marked = with_signature(given, "text", "signature", k=k, tuple_size=tuple_size, filled=True)
    paired = with_next(marked, ["text", "signature"], parts=parts, narrow=given)
    paired = with_settled(paired, {"edited": edited(F.col("text"), F.col("next_text"))})
    both = with_signature(paired, "edited", "edited_signature", k=k, tuple_size=tuple_size, filled=True)
    return both.select(
        "doc_id",
        "text",
        "edited",
        "signature",
        "edited_signature",
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
