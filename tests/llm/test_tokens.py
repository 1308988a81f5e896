"""Token ids (5) and token counts (7) against the library itself."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, empty, key, texts_of, words
from tokenizers import Tokenizer

from jobloom.llm import rans, token_counts, token_files
from jobloom.llm.tokens import PieceEncoder, default_vocabulary

ODD = [
    "  a  b ", "\n \n x", "a\x1c b \x1c", "can't  we'll 'x  ", "é ü    a", "12 3a b_c  _ <|endoftext|> x", "😀 😀a a😀", " ", "\n", "a ",
    "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x <|endoftext|>", " <|endoftext|>y <|endoftex",
    "²³ ⅷ x²", "tab\tand nbsp   em", "漢字 漢字漢字", "don't'll 's", "x\u0085 y", "ab" * 5000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_vocabulary())


@pytest.mark.parametrize("kept", [(100_000, 100_000), (3, 2), (0, 0)])
def test_pieces_give_the_ids_of_whole_texts(library, kept):
    coder = PieceEncoder(default_vocabulary(), *kept)
    texts = [*ODD, *ODD[::-1], *(words(i, 200) for i in range(20))]
    assert [x.tolist() for x in coder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode([None])[0].tolist() == []


class Counted:
    """A tokenizer that counts how often something of it is used."""

    def __init__(self, tokenizer):
        self.tokenizer, self.used = tokenizer, 0

    def __getattr__(self, name):
        self.used += 1
        return getattr(self.tokenizer, name)


def test_new_words_go_through_the_library_many_in_a_call():
    coder = PieceEncoder(default_vocabulary(), 0, 0)
    coder.tokenizer = Counted(coder.tokenizer)
    coder.encode(["".join([" ", words(i, 200), ", ", words(i, 100).replace(" ", "; ")]) for i in range(20)])
    assert 0 < coder.tokenizer.used < 20


@pytest.mark.parametrize("kept", [(100_000, 100_000), (1, 1)])
def test_any_characters_give_the_ids_of_whole_texts(library, kept):
    signs = [*" '.,;A1aeé", "the", "don't", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "漢", "ǆ", "Ж", "ʰ", "\u0301", "²", "😀", "\0", "<|endoftext|>", "<|"]
    weights = [30, *[3] * (len(signs) - 3), 0.2, 1]
    r = random.Random(5)
    texts = ["".join(r.choices(signs, weights, k=r.randint(0, 40))) for _ in range(3000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    coder = PieceEncoder(default_vocabulary(), *kept)
    assert [x.tolist() for x in coder.encode(texts)] == want
    assert [x.tolist() for x in coder.encode(pa.array([None, *texts[:99]]).slice(1, 98))] == want[:98]
    assert [x.tolist() for x in coder.encode(["", None])] == [[], []] and coder.encode([]) == []


def test_special_strings_as_text_on_demand():
    plain = Tokenizer.from_file(default_vocabulary())
    plain.encode_special_tokens = True
    coder = PieceEncoder(default_vocabulary(), special_as_text=True)
    assert [x.tolist() for x in coder.encode(ODD)] == [e.ids for e in plain.encode_batch(ODD, add_special_tokens=False)]
    assert 50256 not in coder.encode(["a <|endoftext|> b"])[0] and 50256 in PieceEncoder(default_vocabulary()).encode(["a <|endoftext|> b"])[0]


@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 70_000])
def test_blocks_round_trip(n):
    tokens = (np.random.default_rng(n).zipf(1.3, n) % 50_257).astype(np.uint16)
    table = rans.Table.load(rans.Table.of_counts(np.bincount(tokens, minlength=1 << 16)).dump())
    block = rans.encode_block(tokens, table)
    assert (rans.decode_block(block, table) == tokens).all()
    if n > 5000:
        with pytest.raises(ValueError):
            rans.decode_block(block[:-40] + bytes(36) + block[-4:], table)


def test_every_symbol_keeps_a_share():
    counts = np.ones(1 << 16, np.int64)
    counts[5] = 10**12
    table = rans.Table.of_counts(counts)
    assert table.freqs.min() == 1 and int(table.freqs.sum()) == 1 << rans.SCALE_BITS


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 9000])
def test_files_hold_all_documents_in_order(spark, library, bucket_bytes):
    docs = awkward(spark, *[(7, words(70 + i, 300)) for i in range(30)])
    files, table = token_files.write_ids(docs, bucket_bytes=bucket_bytes)
    assert (len(files) > 2) == (bucket_bytes == 9000)
    got = token_files.read_ids(spark, files, table).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    ends = np.cumsum([r.n_tokens for r in got]).tolist()
    assert [r.start for r in got] == [0, *ends[:-1]]
    coded = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
    want = [(d, len(coded(t)), zlib.crc32(coded(t).tobytes())) for d, t in texts_of(docs)]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    # A stretch from the middle of a file, decoded from the blocks that hold it alone.
    first = token_files.IdFile(files[0][0], table)
    whole = np.concatenate([first.block(i) for i in range(len(first.head["blocks"]))])
    assert (first.tokens(3, 11) == whole[3:14]).all()


def test_no_documents_no_files(spark):
    files, table = token_files.write_ids(empty(spark))
    assert files == [] and token_files.read_ids(spark, files, table).count() == 0


def test_spans_equal_the_library(library):
    lengths = PieceEncoder(default_vocabulary()).byte_lengths()
    for text in [*ODD, words(3, 50)]:
        e = library.encode(text, add_special_tokens=False)
        begin, end = token_counts.token_spans(text.encode(), np.array(e.ids), lengths)
        assert list(zip(begin.tolist(), end.tolist())) == e.offsets


def test_rules_for_crossing_tokens():
    arrays = lambda *x: [np.array(v) for v in x]
    begin, end, starts, stops = arrays([0, 2, 6, 20], [2, 6, 8, 21], [0, 3, 7], [3, 7, 9])
    counts = {rule: token_counts.attribute(begin, end, starts, stops, rule)[0].tolist() for rule in token_counts.RULES}
    assert counts["most"] == [1, 2, 0] and counts["first"] == [2, 1, 0] and counts["split"] == [1.25, 1.25, 0.5]
    assert token_counts.attribute(begin, end, starts, stops, "most")[1:][1] == 1
    assert token_counts.attribute(begin, end, starts, stops, "most")[1].tolist() == [1, 2, 1]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_lines_add_up_to_documents(spark, library, rule):
    docs = awkward(spark)
    got = token_counts.count_tokens(docs, rule=rule).groupBy("doc_id").sum("n_tokens").collect()
    want = {}
    for d, t in texts_of(docs):
        want[d] = want.get(d, 0) + len(library.encode(t or "", add_special_tokens=False).ids)
    assert {r[0]: round(r[1], 6) for r in got} == want


def test_given_sections(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "the old dog ran"), (2, None)], "doc_id long, text string")
    spans = F.expr("array(named_struct('name','head','start',0,'stop',7), named_struct('name','over','start',5,'stop',11), named_struct('name','none','start',12,'stop',12), null)")
    got = {(r.doc_id, r.section, r.name): (r.start, r.stop, r.n_tokens) for r in token_counts.count_tokens(df, sections=spans).collect()}
    assert got == {(1, 0, "head"): (0, 7, 2.0), (1, 1, "over"): (7, 11, 1.0), (1, -1, None): (None, None, 1.0), (2, -1, None): (None, None, 0.0)}
    assert token_counts.count_tokens(empty(spark)).count() == 0


def test_slices_keep_all_rows_in_order():
    import pyarrow as pa

    from jobloom.llm.common import slices

    texts = ["x" * n if n else None for n in (0, 3, 9, 0, 1, 20, 0, 2, 2, 2, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "t"])
    cut = list(slices(iter([batch, batch.slice(0, 0)]), lambda b: b.column(1), most=5))
    assert [v for b in cut for v in b.column(1).to_pylist()] == texts
    sizes = [[len(t or "") for t in b.column(1).to_pylist()] for b in cut]
    assert all(sum(x) - max(x) <= 5 for x in sizes) and len(cut) == 4
