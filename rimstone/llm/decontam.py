"""Benchmark decontamination with a stored positional inverted index.

The index is a table of posting lists (term, segment, positions): a segment is a run of documents of about 4 MB of text,
so that a frequent term has many lists of bounded length and no list is gathered for a whole corpus. The lists of test
terms are dealt by segment, and the windows of test items are answered there: from the globally rarest term of a window
on, each next list is shifted by its term's offset and intersected with what is left.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimstone.llm.common import keyed_texts, materialize, per_slice, slices
from rimstone.llm.licenses import words_of

PLACE = 32  # bits of a position that tell the word's place in its document; those above tell the document
BLOCK_WINDOWS = 1 << 18  # windows of test items that are broadcast at a time

INDEX = (
    "segment long, term binary, n int, positions array<long>, doc_id long, text_hash long, row int, n_words long"
)
SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def build_index(texts: DataFrame) -> DataFrame:
    """The stored index of keyed texts: a row for each term of each segment, and one without term for each document.

    A position is the document's row in its segment and, in the lower bits, the word's place.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for segment, batch in enumerate(slices(batches, "text"), first):
            numbers: dict[bytes, int] = defaultdict(count().__next__)
            found = [[numbers[w] for w in words_of(text)] for text in batch["text"].to_pylist()]
            sizes = np.array([len(f) for f in found], np.int64)
            rows = np.arange(len(found))
            at = (np.repeat(rows, sizes) << PLACE) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            own = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
            counts = np.bincount(own, minlength=len(numbers))
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            positions = pa.ListArray.from_arrays(ends, at[np.argsort(own, kind="stable")])
            n_terms, n_docs = len(numbers), len(found)
            columns = {
                "segment": pa.array([segment] * (n_terms + n_docs), pa.int64()),
                "term": pa.array([*numbers, *[None] * n_docs], pa.binary()),
                "n": pa.array([*counts.tolist(), *[None] * n_docs], pa.int32()),
                "positions": pa.concat_arrays([positions, pa.nulls(n_docs, positions.type)]),
                "doc_id": pa.concat_arrays([pa.nulls(n_terms, pa.int64()), batch["doc_id"].cast(pa.int64())]),
                "text_hash": pa.concat_arrays([pa.nulls(n_terms, pa.int64()), batch["text_hash"]]),
                "row": pa.concat_arrays([pa.nulls(n_terms, pa.int32()), pa.array(rows, pa.int32())]),
                "n_words": pa.concat_arrays([pa.nulls(n_terms, pa.int64()), pa.array(sizes)]),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return materialize(texts.select("doc_id", "text", "text_hash").mapInArrow(run, INDEX), "postings")


def item_windows(items: DataFrame, width: int) -> DataFrame:
    """item_id and `terms` of each window: `width` consecutive words, or all of an item that has fewer."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for item_id, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            own = words_of(text)
            n = min(width, len(own))
            for at in range(0, len(own) - n + 1 if n else 0, 1024):
                rows = [own[i : i + n] for i in range(at, min(at + 1024, len(own) - n + 1))]
                ids = pa.array([item_id] * len(rows), pa.string())
                yield pa.RecordBatch.from_arrays([ids, pa.array(rows, pa.list_(pa.binary()))], ["item_id", "terms"])

    return items.mapInArrow(per_slice(run), "item_id string, terms array<binary>")


class Lists:
    """Posting lists of one segment."""

    def __init__(self, terms: list[bytes], positions: list[np.ndarray]):
        self.of = dict(zip(terms, positions, strict=True))
        self.met: dict[tuple, np.ndarray | None] = {}  # what is left after two lists; windows that overlap share it

    def step(self, places: np.ndarray, term: bytes, distance: int, slack: int) -> np.ndarray | None:
        """Those of `places` (of a window's rarest term) with `term` within `slack` words of `distance` behind them."""
        if (own := self.of.get(term)) is None:
            return None
        wanted = places + (distance - slack)
        found = own[np.minimum(np.searchsorted(own, wanted), len(own) - 1)]
        left = places[(found >= wanted) & (found <= wanted + 2 * slack)]
        return left if len(left) else None

    def match(self, terms: list[bytes], distances: list[int], slack: int) -> np.ndarray | None:
        """Positions of the rarest term at which all terms, the rarest first, stand at their distances from it."""
        if len(terms) == 1:
            return self.of.get(terms[0])
        key = terms[0], terms[1], distances[1], slack
        if key not in self.met:
            first = self.of.get(terms[0])
            self.met[key] = None if first is None else self.step(first, terms[1], distances[1], slack)
        left = self.met[key]
        for term, distance in zip(terms[2:], distances[2:], strict=True):
            if left is None:
                return None
            left = self.step(left, term, distance, slack)
        return left


def matches(index: DataFrame, ordered: DataFrame, slack: int | None) -> DataFrame:
    """window, segment, `p` (positions of the window's rarest term) and exact, for all matches of windows.

    `ordered` has window and `by_count`: structs (term, offset) from the rarest term on. Windows are broadcast in blocks
    of at most about BLOCK_WINDOWS; all blocks share one shuffle of the test terms' lists.
    """
    lists = index.where("term is not null").select("segment", "term", "positions")
    lists = lists.join(ordered.select(F.explode("by_count.term").alias("term")).distinct(), "term", "left_semi")
    n_blocks = 1 + ordered.count() // BLOCK_WINDOWS
    block = F.pmod(F.xxhash64("window"), F.lit(n_blocks))
    asked = ordered.select("window", F.col("by_count.term").alias("terms"), F.col("by_count.offset").alias("offsets"))

    def answers(part: DataFrame) -> DataFrame:
        rows = [(w, [bytes(t) for t in terms], [o - at[0] for o in at]) for w, terms, at in part.collect()]
        windows = index.sparkSession.sparkContext.broadcast(rows)

        def answer(own: pd.DataFrame) -> pd.DataFrame:
            here = Lists([bytes(t) for t in own["term"]], list(own["positions"]))
            none = np.array([], np.int64)
            numbers, places, exact = [none], [none], [none.astype(bool)]
            for window, terms, distances in windows.value:
                same = here.match(terms, distances, 0)
                near = here.match(terms, distances, slack) if slack is not None else None
                if near is not None and same is not None:
                    near = np.setdiff1d(near, same)
                for found, kind in ((same, True), (near, False)):
                    if found is not None:
                        numbers.append(np.full(len(found), window))
                        places.append(found)
                        exact.append(np.full(len(found), kind))
            columns = {"window": numbers, "p": places, "exact": exact}
            out = pd.DataFrame({name: np.concatenate(c) for name, c in columns.items()})
            return out.assign(segment=own["segment"].iloc[0])[["window", "segment", "p", "exact"]]

        return lists.groupBy("segment").applyInPandas(answer, "window long, segment long, p long, exact boolean")

    found = [answers(asked.where(block == b)) for b in range(n_blocks)]
    return reduce(DataFrame.unionByName, found)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


def merge_spans(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = {name: batch[name] for name in batch.schema.names}
        for name in ("hits", "near"):
            spans = [merged([(s["start"], s["end"]) for s in row]) for row in batch[name].to_pylist()]
            rows = [[{"start": a, "end": b} for a, b in row] for row in spans]
            columns[name] = pa.array(rows, pa.list_(SPAN))
        yield pa.RecordBatch.from_pydict(columns)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, slack: int | None = None) -> DataFrame:
    """For each row of `docs`: doc_id, text_hash, n_words, `hits` and `near` (merged word spans), `items` (sorted).

    A window is `width` consecutive words of an item, or a whole shorter item; an item without words has none. `hits`
    are the words inside exact occurrences. With `slack`, `near` has the places where all terms of a window stand
    within that many words of their place, counted from its rarest term, but not exactly. Null texts and items have no
    words; items that share an id count as one, and one without id hits but is not listed; repeated rows each get the same result; other columns are ignored.
    Without items all is empty.
    """
    index = build_index(keyed_texts(docs))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    whole = materialize(item_windows(items, width), "windows")
    windows = whole.select("terms").distinct().withColumn("window", F.monotonically_increasing_id())
    windows = materialize(windows, "distinct-windows")
    terms = windows.select("window", F.posexplode("terms").alias("offset", "term"))
    # Global counts: how often each test term stands in all documents; a window with an absent term matches nowhere.
    counts = index.where("term is not null").select("term", F.col("n").cast("long")).join(
        terms.select("term").distinct(), "term", "left_semi"
    ).groupBy("term").agg(F.sum("n").alias("n"))
    by_count = F.array_sort(F.collect_list(F.struct("n", "offset", "term")))
    ordered = terms.join(counts, "term").groupBy("window").agg(by_count.alias("by_count"))
    ordered = ordered.join(windows, "window").where(F.size("by_count") == F.size("terms"))
    ordered = materialize(ordered.select("window", "by_count"), "ordered-windows")
    found = matches(index, ordered, slack)
    placed = found.join(
        ordered.select("window", F.col("by_count")[0]["offset"].alias("from"), F.size("by_count").alias("len")), "window"
    ).select(
        "window", "segment", "exact", F.shiftright("p", PLACE).cast("int").alias("row"), "len",
        (F.col("p").bitwiseAND(F.lit((1 << PLACE) - 1)) - F.col("from")).alias("start"),
    )
    placed = materialize(placed, "matches")
    per_doc = index.where("term is null").select("segment", "row", "doc_id", "text_hash", "n_words")
    names = whole.join(windows, "terms").select("item_id", "window").distinct()
    named = placed.where("exact").select("segment", "row", "window").distinct().join(names, "window")
    named = named.groupBy("segment", "row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    start = F.greatest("start", F.lit(0).cast("long")).alias("start")  # a loose match may reach beyond its text
    span = F.struct(start, F.least(F.col("start") + F.col("len"), F.col("n_words")).alias("end"))
    spans = placed.join(per_doc.select("segment", "row", "n_words"), ["segment", "row"]).groupBy("segment", "row").agg(
        F.collect_set(F.when(F.col("exact"), span)).alias("hits"),
        F.collect_set(F.when(~F.col("exact"), span)).alias("near"),
    )
    kind = "array<struct<start: long, end: long>>"
    spans = spans.mapInArrow(merge_spans, f"segment long, row int, hits {kind}, near {kind}")
    hit = per_doc.join(spans, ["segment", "row"], "left").join(named, ["segment", "row"], "left")
    return hit.select(
        "doc_id", "text_hash", "n_words",
        *[F.coalesce(c, F.array().cast(kind)).alias(c) for c in ("hits", "near")],
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Rows of `docs` (all columns) that hold no window of a test item. Null and empty texts stay."""
    found = contamination(docs, benchmark, width).where(F.size("hits") > 0)
    bad = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__id"]) & (text_hash == bad["__hash"]), "left_anti")
