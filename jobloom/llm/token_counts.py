"""Token counts of a document's sections by offset-mapped attribution.

A document is encoded once, as a whole, so no section changes how its neighbour is cut into tokens.  Each token's
bytes give its character span; spans and section spans, both in order, are interval-joined, and a token that crosses
a boundary is allotted by an explicit rule:

``most``   the section that holds most of its characters, the earlier one on a tie
``first``  the section of its first character that lies in a section
``split``  every section it touches, in proportion to characters

A token that touches no section is counted outside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import slices
from jobloom.llm.tokens import default_vocabulary, encoder

RULES = ("most", "first", "split")
OUTSIDE = -1


def token_spans(text: bytes, ids: np.ndarray, byte_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and the one behind the last, per token; tokens inside one character share its span."""
    end = np.cumsum(byte_lengths[ids])
    begin = end - byte_lengths[ids]
    if len(ids) and int(end[-1]) != len(text):
        raise ValueError("tokens do not cover the text")
    char = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1
    return char[begin], char[end - 1] + 1


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines with their line feed; a text without a character has none."""
    data = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.flatnonzero(data == 0x0A) + 1
    if len(data) and (not len(ends) or ends[-1] != len(data)):
        ends = np.append(ends, len(data))
    return np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends.astype(np.int64), ends.astype(np.int64)


def attribute(begin: np.ndarray, end: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str):
    """(tokens per section, crossing tokens per section, tokens outside) for sections in order that do not overlap."""
    counts, crossing = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
    first = np.searchsorted(stops, begin, "right")
    last = np.searchsorted(starts, end, "left") - 1
    outside = int(np.count_nonzero(first > last))
    inside = first == last
    np.add.at(counts, first[inside], 1.0)
    for t in np.flatnonzero(first < last).tolist():
        i, j = int(first[t]), int(last[t]) + 1
        overlap = np.minimum(stops[i:j], end[t]) - np.maximum(starts[i:j], begin[t])
        crossing[i:j] += overlap > 0
        if rule == "split":
            counts[i:j] += overlap / overlap.sum()
        else:
            counts[i + (0 if rule == "first" else int(np.argmax(overlap)))] += 1.0
    return counts, crossing, outside


_COUNTED = "doc_id long, section int, name string, start long, stop long, n_tokens double, n_crossing long"


def _count(vocabulary: str, rule: str, given_sections: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        lengths = coder.byte_lengths()
        for batch in slices(batches, lambda b: b.column(1)):
            out: list[list] = [[] for _ in range(7)]
            ids_, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sections = batch.column(2).to_pylist() if given_sections else [None] * len(ids_)
            for doc_id, text, own, tokens in zip(ids_, texts, sections, coder.encode(batch.column(1)), strict=True):
                text = text or ""
                if given_sections:
                    names, starts, stops = clean_sections(own, len(text))
                else:
                    starts, stops = line_spans(text)
                    names = [None] * len(starts)
                begin, end = token_spans(text.encode(), tokens, lengths)
                counts, crossing, outside = attribute(begin, end, starts, stops, rule)
                n = len(starts)
                for column, values in zip(
                    out, ([doc_id] * n, range(n), names, starts.tolist(), stops.tolist(), counts.tolist(), crossing.tolist()), strict=True
                ):
                    column.extend(values)
                if outside or not n:
                    for column, value in zip(out, (doc_id, OUTSIDE, None, None, None, float(outside), 0), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["doc_id", "section", "name", "start", "stop", "n_tokens", "n_crossing"],
            )

    return run


def clean_sections(sections: list[dict] | None, n_chars: int):
    """Names, starts and stops in order, inside the text; an overlap belongs to the section that starts first."""
    names, starts, stops, at = [], [], [], 0
    for s in sorted((s for s in sections or [] if s and s["start"] is not None and s["stop"] is not None), key=lambda s: (s["start"], s["stop"])):
        lo, hi = max(s["start"], at, 0), min(s["stop"], n_chars)
        if lo < hi:
            names.append(s["name"])
            starts.append(lo)
            stops.append(hi)
            at = hi
    return names, np.array(starts, np.int64), np.array(stops, np.int64)


def count_tokens(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    sections: Column | None = None,
    rule: str = "most",
    vocabulary: str | None = None,
) -> DataFrame:
    """Tokens per document and section: ``doc_id``, ``section`` (number, from 0), ``name``, ``start``, ``stop``,
    ``n_tokens`` and ``n_crossing`` (tokens that cross into or out of it).

    ``sections`` is an array of (``name``, ``start``, ``stop``) in characters; without it the lines are the sections.
    Null, empty and inverted sections are left out, overlaps go to the section that starts first, and sections end
    with the text.  Tokens outside all sections are in a row with section -1, which a document without any section
    always has, so every document appears and the counts of one add up to its tokens.  A null text is empty.  Rows
    with equal ids stay apart only by their place in the result.  Other columns are not read; an empty table gives an
    empty result.
    """
    if rule not in RULES:
        raise ValueError(f"rule has to be one of {RULES}")
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    if sections is not None:
        columns.append(sections.cast("array<struct<name:string,start:long,stop:long>>").alias("sections"))
    return docs.select(*columns).mapInArrow(_count(vocabulary or default_vocabulary(), rule, sections is not None), _COUNTED)
