"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

Within a word the merges of a prefix decide all but the end of the encoding: if a prefix of a text is cut at a token
boundary, its own encoding is the same. The token that ends at each place is therefore fixed once the text up to it is
known, and what follows can only choose among the places of the last `lookahead` symbols (the longest token of the
merge list) where a token may end. Tokens on which all those choices agree are stable and leave the buffer.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import batched, chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.llm.common import per_slice

# How the vocabulary's files split a text (White_Space as Unicode has it).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
ODD_SPACE = re.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\p{White_Space}+")
SLICE = 1 << 20
SHORT = 40  # characters of a piece that may be remembered
WINDOW = 1 << 16  # characters that are split at a time
RUN = 4096  # ids that a long word hands on at a time
CACHE_ROWS = 500_000  # words remembered by a worker, those that it meets first; others are encoded each time


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Merges:
    """The merge list of a vocabulary file, with the symbols numbered by their ids."""

    def __init__(self, file: str):
        model = json.loads(file)
        vocab = model["model"]["vocab"]
        self.end = model["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.rank: dict[tuple[int, int], int] = {}
        self.whole: list[int] = []
        self.parts: dict[int, tuple[int, int]] = {}
        for order, (a, b) in enumerate(model["model"]["merges"]):
            whole = vocab[a + b]
            self.rank[vocab[a], vocab[b]] = order
            self.whole.append(whole)
            self.parts.setdefault(whole, (vocab[a], vocab[b]))
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.end] for s in symbols]
        self.text = {i: s for s, i in (vocab | self.special).items()}
        self.spelled = {i: self._spell(i) for i in self.text if i not in self.special.values()}
        self.lookahead = max(map(len, self.spelled.values()))
        self.fits: dict[tuple[int | None, int], bool] = {}
        # Tokens that an encoding can hold, by their symbols as characters: a slice of a string is quick to look up.
        self.by_spelling = {"".join(map(chr, s)): i for i, s in self.spelled.items() if self.merge(s) == [i]}

    def _spell(self, token: int) -> tuple[int, ...]:
        out, todo = [], [token]
        while todo:
            t = todo.pop()
            if t in self.parts:
                todo += reversed(self.parts[t])
            else:
                out.append(t)
        return tuple(out)

    def symbols(self, word: bytes) -> Iterator[int]:
        inner, end = self.inner, len(word) - 1
        return (inner[b] if i < end else self.last[b] for i, b in enumerate(word))

    def merge(self, symbols: Iterable[int]) -> list[int]:
        """Plain encoding of a few symbols: the earliest rule first, its leftmost place first."""
        out, rank, never = list(symbols), self.rank, len(self.whole)
        orders = [rank.get(pair, never) for pair in zip(out, out[1:], strict=False)]
        while orders:
            best = min(orders)
            if best == never:
                break
            i = orders.index(best)
            out[i : i + 2] = [self.whole[best]]
            del orders[i]
            if i:
                orders[i - 1] = rank.get((out[i - 1], out[i]), never)
            if i < len(orders):
                orders[i] = rank.get((out[i], out[i + 1]), never)
        return out

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the two tokens stand side by side in an encoding: whether their joint text is encoded so."""
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            known = self.merge([*self.spelled[left], *self.spelled[right]]) == [left, right]
            self.fits[left, right] = known
        return known

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """Encoding of any number of symbols of one word, in memory of the lookahead's order.

        Keeps, for each place since the last stable one, the token that ends there and the place where it starts.
        """
        token_of, known, lookahead = self.by_spelling.get, self.fits.get, self.lookahead
        spelled = ""  # symbols since the last stable place, as characters
        ending: list[int | None] = [None]  # at the stable place the last token sent
        starts = [0]
        for symbol in map(chr, symbols):
            spelled += symbol
            here = len(spelled)
            for start in range(here - lookahead if here > lookahead else 0, here):  # the longest token that fits
                token = token_of(spelled[start:])
                if token is None:
                    continue
                left = ending[start]
                fits = left is None or known((left, token))
                if fits or (fits is None and self.may_follow(left, token)):
                    ending.append(token)
                    starts.append(start)
                    break
            if here >= 2 * lookahead and here % lookahead == 0:
                paths = [self._path(ending, starts, place) for place in range(here - lookahead + 1, here + 1)]
                agreed = 0
                while all(len(p) > agreed and p[agreed] == paths[0][agreed] for p in paths):
                    agreed += 1
                if agreed:
                    yield from (token for token, _ in paths[0][:agreed])
                    before, cut = paths[0][agreed - 1]
                    spelled = spelled[cut:]
                    # Places whose token starts before the cut lie too far back to be looked at again.
                    ending = [before, *ending[cut + 1 :]]
                    starts = [0, *(start - cut for start in starts[cut + 1 :])]
        yield from (token for token, _ in self._path(ending, starts, len(spelled)))

    @staticmethod
    def _path(ending: list, starts: list[int], place: int) -> list[tuple[int, int]]:
        """Tokens up to a place, each with the place where it ends."""
        out = []
        while place > 0:
            out.append((ending[place], place))
            place = starts[place]
        return out[::-1]

    def encode_word(self, word: bytes) -> Iterator[int]:
        """Tokens of one word, each as soon as it is stable."""
        return self.stream(self.symbols(word))


def windows(text: str, most: int = WINDOW) -> Iterator[str]:
    """A text in stretches of about `most` characters that end before a blank; a longer word is not cut."""
    done = 0
    while len(text) - done > most:
        cut = text.find(" ", done + most)
        if cut < 0:
            break
        yield text[done:cut]
        done = cut
    yield text[done:]


class Encoder:
    """Encodes texts piece by piece and remembers what the transducer gave for the short pieces it has met."""

    def __init__(self, file: str):
        self.merges = Merges(file)
        self.known: dict[str, list[int]] = {}
        self.pieces: dict[str, list[int]] = {}
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.spelled = {i: s.encode() for i, s in self.merges.text.items()}

    def piece(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        if found is None:
            found = list(self.merges.encode_word(piece.encode()))
            if len(self.pieces) < CACHE_ROWS:
                self.pieces[piece] = found
        return found

    def chunk(self, chunk: str) -> list[int]:
        """Ids of a short stretch without white space."""
        pieces = PIECES.findall(chunk)
        ids = self.piece(chunk) if pieces == [chunk] else [i for piece in pieces for i in self.piece(piece)]
        if len(self.known) < CACHE_ROWS:
            self.known[chunk] = ids
        return ids

    def long_chunk(self, chunk: str) -> Iterator[list[int]]:
        """The same of a long stretch, in lists of bounded length."""
        for m in PIECES.finditer(chunk):
            if m.end() - m.start() <= SHORT:
                yield self.piece(m.group())
            else:
                yield from map(list, batched(self.merges.encode_word(m.group().encode()), RUN))

    def plain(self, text: str) -> Iterator[list[int]]:
        """Ids of a text without special tokens: composed form, lower case letter by letter, pieces, merges."""
        known = self.known.get
        for window in windows(text):
            window = unicodedata.normalize("NFC", window).replace("Σ", "σ").lower()
            # Unless a text has characters that only Python takes for white space, its own splitting is right.
            chunks = SPACE.split(window) if ODD_SPACE.search(window) else window.split()
            out: list[int] = []
            for chunk in chunks:
                if len(chunk) <= SHORT:
                    out += known(chunk) or self.chunk(chunk)
                else:
                    yield out
                    yield from self.long_chunk(chunk)
                    out = []
            yield out

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a text in lists of bounded length, in order."""
        done = 0
        if "<|" in text or self.special.search(text):
            for m in self.special.finditer(text):
                yield from self.plain(text[done : m.start()])
                yield [self.merges.special[m.group()]]
                done = m.end()
        yield from self.plain(text[done:] if done else text)


def decode_bytes(runs: Iterable[list[int]], text: dict[int, bytes]) -> Iterator[bytes]:
    """Bytes of each run of tokens, with the blank that the vocabulary's own decoding puts between tokens."""
    first = True
    for ids in runs:
        if ids:
            part = b" ".join([text[i] for i in ids])
            yield part if first else b" " + part
            first = False


def to_text(parts: Iterable[bytes]) -> Iterator[str]:
    """Text of a stream of bytes: holds back the bytes of an unfinished character, at most three."""
    state = codecs.getincrementaldecoder("utf-8")("replace")
    for part in parts:
        if out := state.decode(part):
            yield out
    if out := state.decode(b"", True):
        yield out


KINDS = (pa.int64(), pa.string(), pa.string())


def read_vocabulary(spark: SparkSession, path: str | None = None) -> str:
    """Content of a tokenizers file; by default the public 49k word vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Path(path).read_text(encoding="utf-8")


def encode_documents(docs: DataFrame, path: str | None = None, digest: bool = False) -> DataFrame:
    """Token ids of every whole text and the text they decode to, one row per row of `docs`.

    Columns doc_id, text, ids, decoded; with `digest`, doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned
    32-bit integers) and decoded_sha256 instead. A null or empty text has no ids and decodes to the empty text; other
    columns are ignored. The vocabulary (a file of fixed size) is sent to the executors once. With `digest` a text's ids
    are counted, digested and decoded as they become stable, so memory does not grow with a word's or text's ids.
    A Python worker reads the vocabulary once and keeps the words it remembers from task to task.
    """
    spark = docs.sparkSession
    # Spark hands every task of a worker the same object, so what the first one adds is there for the others.
    held = spark.sparkContext.broadcast({"file": read_vocabulary(spark, path)})

    def run(batches):
        kept = held.value
        if "encoder" not in kept:
            kept["encoder"] = Encoder(kept["file"])
        encoder = kept["encoder"]
        spelled = encoder.spelled

        def convert(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            doc_ids, texts = batch.column(0), batch.column(1)
            if not digest:
                ids = [list(chain.from_iterable(encoder.encode(t or ""))) for t in texts.to_pylist()]
                decoded = ["".join(to_text(decode_bytes([i], spelled))) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, texts, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                    ["doc_id", "text", "ids", "decoded"],
                )
                return
            columns = zip(*(digests(encoder.encode(t or ""), spelled) for t in texts.to_pylist()), strict=True)
            columns = [pa.array(c, kind) for c, kind in zip(columns, KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [doc_ids, *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

        yield from per_slice(convert, most=SLICE)(batches)

    whole = "doc_id long, text string, ids array<int>, decoded string"
    short = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", F.col("text")).mapInArrow(run, short if digest else whole)


def digests(runs: Iterable[list[int]], text: dict[int, bytes]) -> tuple[int, str, str]:
    """Number of ids, digest of the ids and digest of their text, run by run."""
    n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()

    def counted() -> Iterator[list[int]]:
        nonlocal n
        for ids in runs:
            n += len(ids)
            of_ids.update(np.array(ids, "<u4").tobytes())
            yield ids

    for part in to_text(decode_bytes(counted(), text)):
        of_text.update(part.encode())
    return n, of_ids.hexdigest(), of_text.hexdigest()
