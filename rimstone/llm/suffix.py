"""Removal of repeated passages with hash-compared suffix sorts.

A passage of `length` bytes that stands in two places holds, at the same offset in both, the same anchor: the leftmost
smallest hash among its SEED-byte strings. So only the surroundings of anchors are compared. All that a passage with
that anchor can cover is the context: length - SEED bytes before the anchor and length bytes from it. Equal contexts
are counted; different contexts of one anchor string are sorted as suffixes, to the right and, reversed, to the left of
the anchor. Prefix polynomial hashes and binary search give common extensions, so a comparison takes a logarithmic
number of steps in the merge sort; neighbours' common extensions are verified on their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimstone.llm.common import keyed_texts, materialize, same_doc, shuffles, slices
from rimstone.llm.decontam import merged
from rimstone.llm.hashing import BASE, Prefixes, byte_values

SEED = 128  # bytes of an anchor string
SLICE = 1 << 20
SORT_CONTEXTS = 4096  # about as many contexts are sorted at a time
HOT_CONTEXTS = 8192  # anchor strings with more different contexts are answered by counting their passages


def anchors(data: np.ndarray, limits: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, Prefixes]:
    """Positions and string hashes of the anchors of texts data[limits[i]:limits[i + 1]]."""
    prefixes = Prefixes(data)
    n = len(data)
    starts = np.arange(max(n - seed + 1, 0))
    hashes = prefixes.of(starts, starts + seed) if len(starts) else np.zeros(0, np.uint64)
    width = length - seed + 1
    # The place breaks ties, so that the leftmost of equal hashes is the smallest.
    smallest = (hashes & np.uint64(2**64 - 2**24)) | starts.astype(np.uint64)
    span = 1
    while span * 2 <= width:
        smallest = np.minimum(smallest[:-span], smallest[span:])
        span *= 2
    if width > span:
        smallest = np.minimum(smallest[: -(width - span)], smallest[width - span :])
    text = np.searchsorted(limits, np.arange(len(smallest)), "right")
    inside = np.arange(len(smallest)) + length <= limits[np.minimum(text, len(limits) - 1)]
    places = np.unique((smallest[inside] & np.uint64(2**24 - 1)).astype(np.int64))
    return places, hashes[places], prefixes


def anchor_rows(texts: DataFrame, length: int, seed: int) -> DataFrame:
    """Contexts of all anchors, once for each text with their number there, and spans that repeat within a text.

    Columns anchor, context_a, context_b, place, n and the context's start and end in the text; spans known to go
    have no anchor.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            coded = [t.encode() for t in part["text"].to_pylist()]
            data = np.frombuffer(b"".join(coded), np.uint8)
            limits = np.cumsum([0] + [len(c) for c in coded])
            if not len(data):
                continue
            if len(data) >= 1 << 24:  # places would not fit beside the hashes: a single text of 16 MB or more
                places, hashes, prefixes = long_anchors(data, length, seed)
            else:
                places, hashes, prefixes = anchors(data, limits, length, seed)
            text = np.searchsorted(limits, places, "right") - 1
            start = np.maximum(places - (length - seed), limits[text])
            end = np.minimum(places + length, limits[text + 1])
            cut = (places - start).astype(np.uint64)
            with np.errstate(over="ignore"):
                one = prefixes.of(start, end) + cut * np.uint64(BASE)
                two = Prefixes(data, 1).of(start, end) + cut * np.uint64(BASE)
            key = np.lexsort((places, two, one, text))
            new = np.ones(len(key), bool)
            new[1:] = (text[key][1:] != text[key][:-1]) | (one[key][1:] != one[key][:-1]) | (two[key][1:] != two[key][:-1])
            first = key[new]
            counts = np.diff(np.append(np.flatnonzero(new), len(key)))
            again = key[np.repeat(counts > 1, counts)]
            spans = [
                (t, a, b)
                for t in np.unique(text[again]).tolist()
                for a, b in merged(list(zip(start[again[text[again] == t]].tolist(), end[again[text[again] == t]].tolist(), strict=True)))
            ]
            at = limits[text]
            n_spans = len(spans)
            rows = np.concatenate([text[first], np.array([s[0] for s in spans], np.int64)])
            local = [np.concatenate([(c - at)[first], np.array([s[i] - limits[s[0]] for s in spans], np.int64)])
                     for c, i in ((places, 1), (start, 1), (end, 2))]
            none = [None] * n_spans
            hashed = [pa.array(c[first].view(np.int64).tolist() + none, pa.int64()) for c in (hashes, one, two)]
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"].take(pa.array(rows)), part["text_hash"].take(pa.array(rows)), *hashed,
                    pa.array(local[0]), pa.array(np.concatenate([counts, np.full(n_spans, 2)])),
                    pa.array(local[1]), pa.array(local[2]),
                ],
                ["doc_id", "text_hash", "anchor", "context_a", "context_b", "place", "n", "start", "end"],
            )

    schema = (
        "doc_id long, text_hash long, anchor long, context_a long, context_b long, place long, n long, start long, "
        "end long"
    )
    return texts.mapInArrow(run, schema)


def long_anchors(data: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, Prefixes]:
    """Anchors of one very long text, found in overlapping stretches."""
    step = 1 << 23
    found = []
    for at in range(0, len(data), step):
        piece = data[at : at + step + length]
        found.append(at + anchors(piece, np.array([0, len(piece)]), length, seed)[0])
    places = np.unique(np.concatenate(found))
    prefixes = Prefixes(data)
    return places, prefixes.of(places, places + seed), prefixes


class Suffixes:
    """Suffixes as rows of a byte matrix with their lengths, compared through prefix hashes."""

    def __init__(self, text: np.ndarray, lengths: np.ndarray):
        self.text, self.lengths = text, lengths
        values = byte_values(7)
        self.sums = np.zeros((text.shape[1] + 1, len(text)), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(text.shape[1]):
                self.sums[j + 1] = self.sums[j] * np.uint64(BASE) + values[text[:, j]]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of rows a and b, by binary search for the longest prefixes of equal hash."""
        low, high = np.zeros(len(a), np.int64), np.minimum(self.lengths[a], self.lengths[b])
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = self.sums[middle, a] == self.sums[middle, b]
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1; a suffix comes before its extensions."""
        n = self.common(a, b)
        short = np.minimum(self.lengths[a], self.lengths[b])
        at = np.minimum(n, self.text.shape[1] - 1)
        bytes_differ = np.sign(self.text[a, at].astype(np.int16) - self.text[b, at])
        return np.where(n < short, bytes_differ, np.sign(self.lengths[a] - self.lengths[b]))

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes and the common extension of each with the next one.

        A bottom-up merge sort: each row's rank in the run beside its own is found by binary search, all rows at once.
        """
        m = len(self.text)
        order, width, place = np.arange(m), 1, np.arange(m)
        while width < m:
            run = place // width
            other = (run ^ 1) * width
            low, high = np.minimum(other, m), np.minimum(other + width, m)
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                found = self.compare(order[middle], order[open_])
                before = (found < 0) | ((found == 0) & (run[open_] % 2 == 1))
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            rank = low - np.minimum(other, m)
            merged_order = np.empty(m, np.int64)
            merged_order[(run // 2) * 2 * width + (place - run * width) + rank] = order
            order, width = merged_order, width * 2
        common = self.common(order[:-1], order[1:])
        return (order, common) if self._verified(order, common) else self._plain()

    def _verified(self, order: np.ndarray, common: np.ndarray) -> bool:
        """Whether neighbours agree up to their common extension, differ behind it, and stand in order."""
        a, b = order[:-1], order[1:]
        column = np.arange(self.text.shape[1])
        differ = (self.text[a] != self.text[b]) & (column < common[:, None])
        short = np.minimum(self.lengths[a], self.lengths[b])
        at = np.minimum(common, self.text.shape[1] - 1)
        sorted_ = np.where(common < short, self.text[a, at] < self.text[b, at], self.lengths[a] <= self.lengths[b])
        return not differ.any() and bool(sorted_.all())

    def _plain(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted by the bytes themselves, should hashes have collided."""
        rows = [self.text[i, : n].tobytes() for i, n in enumerate(self.lengths)]
        order = np.array(sorted(range(len(rows)), key=rows.__getitem__))
        common = []
        for a, b in zip(order[:-1], order[1:], strict=True):
            n = min(len(rows[a]), len(rows[b]))
            unlike = np.flatnonzero(self.text[a, :n] != self.text[b, :n])
            common.append(int(unlike[0]) if len(unlike) else n)
        return order, np.array(common, np.int64)


def padded(rows: list[bytes], width: int, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    text = np.zeros((len(rows), width), np.uint8)
    for i, row in enumerate(rows):
        own = np.frombuffer(row, np.uint8)
        text[i, : len(own)] = own[::-1] if reverse else own
    return text, np.array([len(r) for r in rows], np.int64)


def classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """Number of the class of each suffix when those that agree to a depth are alike."""
    out = np.empty(len(order), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(common < depth)])
    return out


def repeated_reach(left: list[bytes], right: list[bytes], length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context, how far a passage that another context also holds reaches before and from the anchor.

    Each such passage holds the anchor, so together they cover what lies between the two reaches; 0 and 0 if none.
    """
    to_left, n_left = padded(left, length - seed, reverse=True)
    to_right, n_right = padded(right, length)
    left_sorted, right_sorted = Suffixes(to_left, n_left).sort(), Suffixes(to_right, n_right).sort()
    before, after = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    for part in range(length - seed + 1):  # bytes of the passage before the anchor
        able = np.flatnonzero((n_left >= part) & (n_right >= length - part))
        if len(able) < 2:
            continue
        pair = classes(*left_sorted, part)[able] * len(left) + classes(*right_sorted, length - part)[able]
        _, at, counts = np.unique(pair, return_inverse=True, return_counts=True)
        hit = able[counts[at] > 1]
        before[hit] = part
        after[hit] = np.maximum(after[hit], length - part)
    return before, after


def repeated_spans(texts: DataFrame, length: int, seed: int) -> DataFrame:
    """doc_id, text_hash, start and end of spans that together are all repeated passages."""
    rows = materialize(anchor_rows(texts, length, seed), "anchors")
    inside = rows.where("anchor is null").select("doc_id", "text_hash", "start", "end")
    known = rows.where("anchor is not null")
    distinct = known.groupBy("context_a", "context_b").agg(
        F.sum("n").alias("n"), F.min("anchor").alias("anchor"), F.min(F.struct("doc_id", "text_hash", "place")).alias("at")
    )
    distinct = materialize(distinct, "contexts")
    twice = distinct.where("n > 1").select("context_a", "context_b")
    equal = known.join(twice, ["context_a", "context_b"]).select("doc_id", "text_hash", "start", "end")
    strings = distinct.groupBy("anchor").agg(F.count("*").alias("k"), F.min("n").alias("fewest")).where("k > 1 and fewest = 1")
    compared = distinct.join(strings.select("anchor", "k"), "anchor").select(
        "anchor", F.col("at.doc_id").alias("id"), F.col("at.text_hash").alias("hash"), F.col("at.place").alias("place"),
        "n", "k",
    )
    wanted = compared.groupBy("id", "hash").agg(F.collect_list(F.struct("anchor", "place", "n", "k")).alias("wanted"))
    wanted = materialize(wanted, "open-contexts")
    met = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["id"]) & (texts["text_hash"] == wanted["hash"]))
    cut = cut_contexts(met, length, seed)
    sorted_spans = by_suffix_sort(cut.where(F.col("k") <= HOT_CONTEXTS), length, seed)
    counted = by_counting(met.where(F.exists("wanted", lambda w: w["k"] > HOT_CONTEXTS)), length, seed)
    return inside.unionByName(equal).unionByName(sorted_spans).unionByName(counted)


def cut_contexts(met: DataFrame, length: int, seed: int) -> DataFrame:
    """The bytes to the left and right of each wanted anchor."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            out: dict[str, list] = {c: [] for c in ("anchor", "doc_id", "text_hash", "place", "n", "k", "left", "right")}
            columns = (part[c].to_pylist() for c in ("doc_id", "text_hash", "text", "wanted"))
            for doc_id, text_hash, text, wanted in zip(*columns, strict=True):
                coded = text.encode()
                for w in wanted:
                    at = w["place"]
                    row = (w["anchor"], doc_id, text_hash, at, w["n"], w["k"],
                           coded[max(at - (length - seed), 0) : at], coded[at : at + length])
                    for c, v in zip(out, row, strict=True):
                        out[c].append(v)
            kinds = [pa.int64()] * 6 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    schema = (
        "anchor long, doc_id long, text_hash long, place long, n long, k long, left binary, right binary"
    )
    return met.select("doc_id", "text_hash", "text", "wanted").mapInArrow(run, schema)


def by_suffix_sort(cut: DataFrame, length: int, seed: int) -> DataFrame:
    """Spans of the contexts that stand in one place only; all contexts of an anchor string are in one sort."""
    dealt = cut.repartition(shuffles(cut.sparkSession), "anchor").sortWithinPartitions("anchor")

    def answer(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(held) < 2:
            return
        before, after = repeated_reach([h[5] for h in held], [h[6] for h in held], length, seed)
        hits = [i for i in np.flatnonzero(after).tolist() if held[i][4] == 1]
        columns = [[held[i][1] for i in hits], [held[i][2] for i in hits], [held[i][3] - int(before[i]) for i in hits]]
        columns.append([held[i][3] + int(after[i]) for i in hits])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "text_hash", "start", "end"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            names = ("anchor", "doc_id", "text_hash", "place", "n", "left", "right")
            for row in zip(*(batch[c].to_pylist() for c in names), strict=True):
                if len(held) >= SORT_CONTEXTS and row[0] != held[-1][0]:
                    yield from answer(held)
                    held = []
                held.append(row)
        yield from answer(held)

    return dealt.drop("k").mapInArrow(run, "doc_id long, text_hash long, start long, end long")


def by_counting(met: DataFrame, length: int, seed: int) -> DataFrame:
    """Spans around hot anchor strings: every passage that holds one is counted by a 128-bit hash, in all tasks."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE // 4):
            columns = (part[c].to_pylist() for c in ("doc_id", "text_hash", "text", "wanted"))
            for doc_id, text_hash, text, wanted in zip(*columns, strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                hot = np.array([w["place"] for w in wanted if w["k"] > HOT_CONTEXTS])
                starts = np.unique((hot[:, None] - np.arange(length - seed + 1)).ravel())
                starts = starts[(starts >= 0) & (starts + length <= len(data))]
                one, two = (Prefixes(data, s).of(starts, starts + length).view(np.int64) for s in (0, 1))
                ids = [pa.array([v] * len(starts), pa.int64()) for v in (doc_id, text_hash)]
                yield pa.RecordBatch.from_arrays(
                    [*ids, pa.array(starts, pa.int64()), pa.array(one), pa.array(two)],
                    ["doc_id", "text_hash", "start", "one", "two"],
                )

    passages = met.select("doc_id", "text_hash", "text", "wanted").mapInArrow(
        run, "doc_id long, text_hash long, start long, one long, two long"
    )
    again = passages.groupBy("one", "two").count().where("count > 1").select("one", "two")
    return passages.join(again, ["one", "two"]).select(
        "doc_id", "text_hash", "start", (F.col("start") + length).alias("end")
    )


def remove_repeats(docs: DataFrame, length: int = 400, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, the kept bytes and the removed `spans` (start and end, in bytes) of every row of `docs`.

    A byte goes if it lies in a string of `length` bytes that also starts elsewhere, in the same text or another;
    strings are judged on the input and never cross texts. Texts are read whole as UTF-8, a null text as empty; texts
    shorter than `length` stay. Repeated rows count as places of their own, so each loses what it shares. Kept bytes
    may begin or end within a character and are therefore binary. Other columns are ignored; an empty table gives no
    rows. With `digest`: n_removed, n_spans and kept_sha256 instead of spans and bytes.
    """
    if length < 2:
        raise ValueError("passages of two bytes at least")
    texts = keyed_texts(docs)
    found = repeated_spans(texts, length, min(SEED, length // 2))
    spans = found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = texts.join(spans, same_doc(texts, spans), "left").select(texts["*"], "spans")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            coded = [t.encode() for t in part["text"].to_pylist()]
            gone = [merged([(s["start"], s["end"]) for s in row or ()]) for row in part["spans"].to_pylist()]
            kept = []
            for text, row in zip(coded, gone, strict=True):
                edges = [0, *(e for s in row for e in s), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            sizes = pa.array([len(c) for c in coded], pa.int64())
            if digest:
                removed = pa.array([len(c) - len(k) for c, k in zip(coded, kept, strict=True)], pa.int64())
                sums = pa.array([hashlib.sha256(k).hexdigest() for k in kept])
                columns = [part["doc_id"], sizes, removed, pa.array([len(g) for g in gone], pa.int64()), sums]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            else:
                span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
                listed = pa.array([[{"start": a, "end": b} for a, b in g] for g in gone], pa.list_(span))
                columns = [part["doc_id"], sizes, listed, pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])

    whole = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    short = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.select("doc_id", "text", "spans").mapInArrow(run, short if digest else whole)
