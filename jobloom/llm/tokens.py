"""Whole texts to token ids with a public byte-level BPE file, fast enough for a whole corpus.

Runs in Python workers.  A byte-level BPE splits text at fixed places before it merges.  A blank followed by a
non-blank character is always such a place, and so is one between a letter and an ASCII character that is none.  Texts
are therefore cut there, all at once as Arrow columns; of the distinct parts, those met before come from a table and the
others go through the tokenizers library many in a call, whose ids are told apart by their bytes.  Ids equal those of
encoding the whole text.  The rare text that holds the string of a special token goes through the library whole.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Endings and words kept per worker; beyond it they are encoded once in each batch they occur in.
ENDINGS_KEPT = 100_000
WORDS_KEPT = 400_000
#: Characters that go through the library in one call, unless a single part has more.
_AT_ONCE = 8192
#: A blank before one of Python's white space characters or the end.
_ODD_BLANK = r" (?:[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)"
#: Letters up to a Latin one, and what follows from an ASCII character on that is no letter.
_WORD_AND_ENDING = r"(?s)^(?P<word>\pL*[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}])(?P<ending>[\x00-\x40\x5b-\x60\x7b-\x7f].*)$"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _gather(flat: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``wanted`` of ``flat``, which lie there one after the other with ``sizes``, in that order, and their sizes."""
    begin, size = (np.cumsum(sizes) - sizes)[wanted], sizes[wanted]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    place = np.repeat((begin - ends + size).astype(kind), size)
    place += np.arange(total, dtype=kind)
    return flat[place], size


class PieceEncoder:
    """Ids of texts under a byte-level BPE vocabulary of at most 65,536 ids.

    The strings of special tokens become these tokens, as the library has it, or plain text with ``special_as_text``.
    """

    def __init__(self, vocabulary: str, endings_kept: int = ENDINGS_KEPT, words_kept: int = WORDS_KEPT, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = special_as_text
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids have to fit 16 bits")
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if not special_as_text or not t.special}
        self.endings_kept, self.words_kept = endings_kept, words_kept
        self.words: dict[str, bytes] = {}  # ids of words and whole pieces after a blank, keyed without it
        self.endings: dict[str, bytes] = {}  # ids of what follows a word, or begins a text
        self.cut = re.compile(r" (?=\S)")
        self.lengths = self.byte_lengths()

    def _library(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _together(self, parts: list[str], lead: str, dropped: int) -> list[bytes]:
        """Ids of each part behind ``lead``, without those of the first ``dropped`` bytes of ``lead``."""
        text = "".join([lead + p for p in parts])
        if parts and not any(name in text for name in self.special):
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)
            after = np.concatenate([[0], np.cumsum(self.lengths[ids])])  # bytes before each id and after the last
            ends = np.cumsum([len(p.encode()) + len(lead) for p in parts])
            begins = np.concatenate([[0], ends[:-1]]) + dropped
            lo, hi = np.searchsorted(after, begins), np.searchsorted(after, ends)
            if after[-1] == ends[-1] and (after[lo] == begins).all() and (after[hi] == ends).all():
                raw = ids.tobytes()
                return [raw[i:j] for i, j in zip((2 * lo).tolist(), (2 * hi).tolist(), strict=True)]
        return [self._library(lead[dropped:] + p) for p in parts]

    def _ids(self, parts: list[str], table: dict[str, bytes], kept: int, lead: str, dropped: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts one after the other, and the number of each."""
        found = list(map(table.get, parts))
        new = [i for i, known in enumerate(found) if known is None]
        call = np.cumsum([len(parts[i]) for i in new], dtype=np.int64) // _AT_ONCE
        edges = [0, *(np.flatnonzero(np.diff(call)) + 1).tolist(), len(new)]
        for k, stop in zip(edges, edges[1:], strict=False):
            some = new[k:stop]
            for i, ids in zip(some, self._together([parts[i] for i in some], lead, dropped), strict=True):
                found[i] = ids
                if len(table) < kept and len(parts[i]) <= 64:
                    table[parts[i]] = ids
        return np.frombuffer(b"".join(found), np.uint16), np.fromiter(map(len, found), np.int64, len(found)) // 2

    def _beginning(self, piece: str) -> bytes:
        known = self.endings.get(piece) if piece else b""
        if known is None:
            known = self._library(piece)
            if len(self.endings) < self.endings_kept and len(piece) <= 64:
                self.endings[piece] = known
        return known

    def encode(self, texts: Sequence[str | None] | pa.Array) -> list[np.ndarray]:
        """One uint16 array per text; null counts as empty."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = pc.fill_null(column.cast(pa.large_string()), "")
        whole = np.zeros(len(column), bool)
        for name in self.special:
            whole |= pc.match_substring(column, name).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(column, _ODD_BLANK).to_numpy(zero_copy_only=False) & ~whole
        out = [np.empty(0, np.uint16)] * len(column)
        for i in np.flatnonzero(whole).tolist():
            out[i] = np.frombuffer(self._library(column[i].as_py()), np.uint16)
        for rows, cut in (
            (np.flatnonzero(~odd & ~whole), lambda given: pc.split_pattern(given, " ")),
            (np.flatnonzero(odd), lambda given: pa.array([self.cut.split(t) for t in given.to_pylist()], pa.large_list(pa.large_string()))),
        ):
            if len(rows):
                for i, ids in zip(rows.tolist(), self._encode(cut(column.take(pa.array(rows)))), strict=True):
                    out[i] = ids
        return out

    def _encode(self, pieces: pa.Array) -> list[np.ndarray]:
        """Ids of texts that are given as lists of pieces, which were cut at single blanks."""
        offsets = pieces.offsets.to_numpy().astype(np.int64)
        given, offsets = pieces.flatten(), offsets - offsets[0]
        begin = np.zeros(len(given), bool)
        begin[offsets[:-1]] = True
        first = list(map(self._beginning, given.filter(pa.array(begin)).to_pylist()))
        coded = given.filter(pa.array(~begin)).dictionary_encode()
        distinct = coded.dictionary
        mixed = pc.if_else(pc.utf8_is_alpha(distinct), None, distinct)
        split = pc.extract_regex(mixed, _WORD_AND_ENDING)
        words = pc.coalesce(pc.struct_field(split, "word"), distinct).dictionary_encode()
        endings = pc.fill_null(pc.struct_field(split, "ending"), "").dictionary_encode()
        word_ids, word_sizes = self._ids(words.dictionary.to_pylist(), self.words, self.words_kept, " ", 0)
        # Any Latin letter in front has an ending begin where the library cuts; its own id is left out.
        ending_ids, ending_sizes = self._ids(endings.dictionary.to_pylist(), self.endings, self.endings_kept, " A", 2)
        both = np.stack([words.indices.to_numpy(), endings.indices.to_numpy() + np.int64(len(word_sizes))], axis=1).ravel()
        piece_ids, sizes = _gather(np.concatenate([word_ids, ending_ids]), np.concatenate([word_sizes, ending_sizes]), both)
        piece_sizes = sizes.reshape(-1, 2).sum(axis=1)
        wanted = np.empty(len(given), np.int64)
        wanted[~begin] = coded.indices.to_numpy()
        wanted[begin] = len(piece_sizes) + np.arange(len(first))
        first_sizes = np.fromiter(map(len, first), np.int64, len(first)) // 2
        ids, sizes = _gather(
            np.concatenate([piece_ids, np.frombuffer(b"".join(first), np.uint16)]), np.concatenate([piece_sizes, first_sizes]), wanted
        )
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets].tolist()
        return [ids[i:j] for i, j in zip(ends, ends[1:], strict=False)]

    def byte_lengths(self) -> np.ndarray:
        """Bytes of text behind each id."""
        lengths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for name, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            lengths[i] = len(name)
        for name, i in self.special.items():
            lengths[i] = len(name.encode())
        return lengths


def encoder(vocabulary: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file.

    Functions are pickled by value, so their modules' globals start anew in every task; what should last as long as
    the worker hangs on a module that does not.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_piece_encoders", {})
    if vocabulary not in kept:
        kept[vocabulary] = PieceEncoder(vocabulary)
    return kept[vocabulary]


assert sys.byteorder == "little", "arrays are written as they lie in memory"
