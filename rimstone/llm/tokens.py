"""Words of whole batches of texts, cut by numpy on their UTF-8 bytes and numbered by Arrow."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD, GAP, BREAK = 0, 1, 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_kinds(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """What each byte is: `gaps` stand between words, `breaks` between pieces too, all others are in words."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(gaps)] = GAP
    kinds[list(breaks)] = BREAK
    return kinds


@dataclass
class Words:
    """Every word of some texts in order."""

    values: pa.StringArray  # distinct words, A-Z lower-cased
    codes: np.ndarray  # place of each word in `values`
    row: np.ndarray  # text of each word
    first: np.ndarray  # whether a word is the first of its piece (and so of its text)


def words_of(texts: pa.Array, kinds: np.ndarray) -> Words:
    """Words of texts (null: none). The separators are ASCII bytes, so no character is cut."""
    texts = texts.fill_null("").cast(pa.string())
    none = np.zeros(0, np.int32)
    if not len(texts) or texts.buffers()[2] is None:
        return Words(pa.array([], pa.string()), none, none, np.zeros(0, bool))
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    ends = ends.astype(np.int64) - ends[0]
    full = ends[1:] > ends[:-1]
    heads, tails = ends[:-1][full], ends[1:][full] - 1
    kind = kinds[data]
    inside = kind == WORD
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    opens[heads], closes[tails] = inside[heads], inside[tails]
    start = np.flatnonzero(opens)
    if not len(start):
        return Words(pa.array([], pa.string()), none, none, np.zeros(0, bool))
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(np.flatnonzero(closes) - start + 1, out=offsets[1:])
    letters = LOWER[data[inside]]
    every = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = every.dictionary_encode()
    row = np.searchsorted(ends, start, side="right").astype(np.int32) - 1
    piece = np.searchsorted(np.flatnonzero(kind == BREAK), start)
    first = np.ones(len(start), bool)
    first[1:] = (row[1:] != row[:-1]) | (piece[1:] != piece[:-1])
    return Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), row, first)
