"""Static range asymmetric numeral system for token ids, many lanes at a time.

A state of 64 bits stays in [2**31, 2**63) and moves 32-bit words.  Token ``i`` of a block belongs to lane
``i % lanes``; all lanes step together, and the words of one step lie in lane order, so that the decoder meets them in
the order it needs them.  A block holds its final states and words and depends on nothing but the frequency table.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SCALE_BITS = 20
LANES = 1024
BLOCK_TOKENS = 1 << 18
_LOW = np.uint64(1 << 31)
_HEAD = "<QII"  # tokens, lanes, words


class Table:
    """Frequencies scaled to a sum of ``2**SCALE_BITS``; every symbol that occurs keeps at least 1."""

    def __init__(self, freqs: np.ndarray):
        self.freqs = np.asarray(freqs, np.uint64)
        if int(self.freqs.sum()) != 1 << SCALE_BITS:
            raise ValueError("frequencies do not add up")
        self.cums = np.cumsum(self.freqs) - self.freqs
        self.symbols = np.repeat(np.arange(len(self.freqs), dtype=np.uint16), self.freqs.astype(np.int64))

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        counts = np.asarray(counts, np.float64)
        if not counts.any():
            counts = np.ones_like(counts)
        room = 1 << SCALE_BITS
        freqs = np.where(counts > 0, np.maximum(1, np.floor(counts / counts.sum() * room)), 0).astype(np.int64)
        off = room - int(freqs.sum())
        order = np.argsort(-freqs, kind="stable")
        while off:  # what rounding left over or took too much, spread over the most frequent symbols
            for i in order:
                if off > 0:
                    step = off
                else:
                    step = max(off, -(int(freqs[i]) // 2))
                freqs[i] += step
                off -= step
                if not off:
                    break
        return cls(freqs)

    def dump(self) -> bytes:
        used = np.flatnonzero(self.freqs)
        body = struct.pack("<II", len(self.freqs), len(used)) + used.astype("<u4").tobytes() + self.freqs[used].astype("<u4").tobytes()
        return b"RANSTAB1" + body + struct.pack("<I", zlib.crc32(body))

    @classmethod
    def load(cls, data: bytes) -> Table:
        body = data[8:-4]
        if data[:8] != b"RANSTAB1" or zlib.crc32(body) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged frequency table")
        size, n = struct.unpack_from("<II", body)
        freqs = np.zeros(size, np.uint64)
        freqs[np.frombuffer(body, "<u4", n, 8)] = np.frombuffer(body, "<u4", n, 8 + 4 * n)
        return cls(freqs)


def encode_block(tokens: np.ndarray, table: Table, lanes: int = LANES) -> bytes:
    """One independent block; its head holds token count, lanes and words."""
    n = len(tokens)
    lanes = max(1, min(lanes, n))
    freqs, cums = table.freqs[tokens], table.cums[tokens]
    state = np.full(lanes, _LOW, np.uint64)
    limit_shift, scale, word = np.uint64(43), np.uint64(SCALE_BITS), np.uint64(32)
    pieces = []
    for lo in range((n - 1) // lanes * lanes, -1, -lanes):
        f, c = freqs[lo : lo + lanes], cums[lo : lo + lanes]
        x = state[: len(f)]
        full = x >= (f << limit_shift)
        if full.any():
            pieces.append(x[full].astype(np.uint32))
            x = np.where(full, x >> word, x)
        whole = x // f
        state[: len(f)] = (whole << scale) + (x - whole * f) + c
    words = np.concatenate(pieces[::-1]) if pieces else np.empty(0, np.uint32)
    return struct.pack(_HEAD, n, lanes, len(words)) + state.tobytes() + words.tobytes()


def decode_block(data: bytes, table: Table) -> np.ndarray:
    n, lanes, n_words = struct.unpack_from(_HEAD, data)
    state = np.frombuffer(data, np.uint64, lanes, struct.calcsize(_HEAD)).copy()
    words = np.frombuffer(data, np.uint32, n_words, struct.calcsize(_HEAD) + 8 * lanes).astype(np.uint64)
    out = np.empty(n, np.uint16)
    mask, scale, word = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    at = 0
    for lo in range(0, n, lanes):
        x = state[: min(lanes, n - lo)]
        slot = x & mask
        symbol = table.symbols[slot]
        out[lo : lo + len(x)] = symbol
        x = table.freqs[symbol] * (x >> scale) + slot - table.cums[symbol]
        low = x < _LOW
        k = int(np.count_nonzero(low))
        if k:
            x[low] = (x[low] << word) | words[at : at + k]
            at += k
        state[: len(x)] = x
    if at != n_words or (n and not (state == _LOW).all()):
        raise ValueError("damaged block")
    return out
