"""Ranked lexical search: short posting lists term at a time, long ones document at a time.

Documents are indexed in shards of bounded size. In a shard an item's short lists are summed into accumulators, which
then act as one more list: it has the items' gains by document and its own upper bounds. It and the long lists are read
together in document order, in blocks: a block of documents whose bounds do not add up to the item's tenth best score
is skipped, and within a block a document is dropped as soon as what it has and what the lists left can add does not
reach it. A task keeps its best scores from shard to shard, so that it skips more and more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rimstone.llm.common import materialize, shuffles, slices
from rimstone.llm.tokens import byte_kinds, words_of

# Bytes that are no part of a term, and the same as a pattern.
NO_TERM = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHARD_BYTES = 8 << 20  # of the texts in a shard
OWN = ""  # the term of a shard's own row, which no text has
LONG = 8  # a list is long if it has one document in so many of its shard
BLOCK = 64  # documents that share an upper bound
AT_ONCE = 32  # blocks that are read before the bar is looked at again
ITEM_TERMS = 1 << 18  # terms of the items that are broadcast together

INDEX = "shard long, term string, docs array<int>, counts array<int>, ids array<long>"


def index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Posting lists of one shard for each slice of texts, and one row with its doc_ids and numbers of terms."""
    kinds = byte_kinds(NO_TERM)
    first = TaskContext.get().partitionId() << 32
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    for shard, part in enumerate(slices(batches, "text", SHARD_BYTES), start=first):
        found = words_of(part["text"], kinds)
        n_docs = part.num_rows
        key, counts = np.unique(found.codes.astype(np.int64) * n_docs + found.row, return_counts=True)
        ends = np.searchsorted(key, np.arange(len(found.values) + 1, dtype=np.int64) * n_docs).astype(np.int32)
        lists = [
            pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))
            for values in (key % n_docs, counts)
        ]
        n_terms = np.bincount(found.row, minlength=n_docs)
        own = [pa.array([shard]), pa.array([OWN]), pa.array([None], ints), pa.array([n_terms], ints)]
        own.append(pa.array([part["doc_id"].to_pylist()], longs))
        names = ["shard", "term", "docs", "counts", "ids"]
        yield pa.RecordBatch.from_arrays(own, names)
        same = pa.array(np.full(len(found.values), shard))
        yield pa.RecordBatch.from_arrays([same, found.values, *lists, pa.nulls(len(same), longs)], names)


def item_terms(items: DataFrame) -> DataFrame:
    """`item_id`, `term`: each term of an item once."""
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    return items.select("item_id", F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def index_for(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The written index of `docs(doc_id, text)`: a posting list for each shard and each of `terms(term)`."""
    asked = terms.select("term").union(terms.sparkSession.sql(f"select '{OWN}'")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(index_rows, INDEX)
    return materialize(rows.join(asked, "term", "left_semi"), "postings")


def weighted(terms: DataFrame, index: DataFrame, n_docs: int) -> DataFrame:
    """`terms` of the items with `w`; terms that no document has are left out."""
    held = index.where(F.col("term") != OWN).groupBy("term").agg(F.sum(F.size("docs")).alias("df"))
    w = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    return terms.join(held, "term").select("item_id", "term", w.alias("w"))


class Best:
    """The highest scores of every item so far, at most `k` each; equal scores by doc_id, null last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * n_items

    def bar(self, item: int) -> int:
        """What a document must at least score."""
        scores = self.kept[item][0]
        return max(int(scores[-1]), 1) if len(scores) == self.k else 1

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        both = [np.concatenate(pair) for pair in zip(self.kept[item], (scores, ids, no_id), strict=True)]
        order = np.lexsort((both[1], both[2], -both[0]))[: self.k]
        self.kept[item] = tuple(column[order] for column in both)


class Shard:
    """Posting lists of one shard, with gains before weights."""

    def __init__(self, rows: pa.Table, n_docs: int, n_all_terms: int):
        terms = rows["term"].to_pylist()
        own = terms.index(OWN)
        ids = rows["ids"][own].values
        self.no_id = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()
        n_terms = rows["counts"][own].values.to_numpy().astype(np.int64)
        self.n = len(self.ids)
        self.n_blocks = -(-self.n // BLOCK)
        length = 10 + 90 * n_terms * n_docs // n_all_terms
        self.short: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.long: dict[str, tuple[np.ndarray, np.ndarray, int]] = {}
        for i, term in enumerate(terms):
            if i == own:
                continue
            docs = rows["docs"][i].values.to_numpy()
            tf = rows["counts"][i].values.to_numpy().astype(np.int64)
            gain = 1_000_000_000 * tf // (1000 * tf + 8 * length[docs])
            if len(docs) * LONG < self.n:
                self.short[term] = (docs, gain)
            else:
                each = np.zeros(self.n_blocks * BLOCK, np.int64)
                each[docs] = gain
                tops = each.reshape(self.n_blocks, BLOCK).max(axis=1)
                self.long[term] = (each, tops, int(tops.max()))

    def rank(self, item: int, terms: list[tuple[str, int]], best: Best) -> None:
        """Enters an item's best documents of this shard."""
        gains = np.zeros(self.n_blocks * BLOCK, np.int64)  # accumulators of the short lists
        shorts = [(w, *self.short[t]) for t, w in terms if t in self.short]
        for w, docs, gain in shorts:
            gains[docs] += w * gain
        bounds = gains.reshape(self.n_blocks, BLOCK).max(axis=1)
        longs = sorted(((w * self.long[t][2], w, t) for t, w in terms if t in self.long), reverse=True)
        for _, w, term in longs:
            bounds = bounds + w * self.long[term][1]
        bar = best.bar(item)
        alive = np.flatnonzero(bounds >= bar)
        for at in range(0, len(alive), AT_ONCE):
            blocks = alive[at : at + AT_ONCE]
            blocks = blocks[bounds[blocks] >= bar]
            docs = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            scores = gains[docs]
            left = sum(top for top, _, _ in longs)
            for top, w, term in longs:
                scores = scores + w * self.long[term][0][docs]
                left -= top
                open_ = scores + left >= bar
                docs, scores = docs[open_], scores[open_]
            enough = scores >= bar
            docs, scores = docs[enough], scores[enough]
            if len(docs):
                best.add(item, scores, self.ids[docs], self.no_id[docs])
                bar = best.bar(item)


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each shard, which stand together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        numbers = batch["shard"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start == end:
                continue
            if held and held[-1]["shard"][0].as_py() != numbers[start]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def top_of_block(index: DataFrame, block: list[tuple], item_type, n_docs: int, n_all_terms: int, k: int) -> DataFrame:
    """The best documents of each task for the items of one block."""
    spark = index.sparkSession
    sent = spark.sparkContext.broadcast([terms for _, terms in block])  # at most ITEM_TERMS terms, or one item
    wanted = spark.createDataFrame([(t,) for t in {t for _, terms in block for t, _ in terms} | {OWN}], "term string")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        best = Best(len(items), k)
        for rows in by_shard(batches):
            shard = Shard(rows, n_docs, n_all_terms)
            for item, terms in enumerate(items):
                shard.rank(item, terms, best)
        for item, (scores, ids, no_id) in enumerate(best.kept):
            if len(scores):
                number = pa.array(np.full(len(scores), item, np.int32))
                yield pa.RecordBatch.from_arrays([number, pa.array(ids, mask=no_id), pa.array(scores)], ["i", "doc_id", "score"])

    lists = index.join(wanted, "term", "left_semi").repartition(shuffles(spark), "shard").sortWithinPartitions("shard")
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], f"i int, item_id {item_type}")
    return lists.mapInArrow(search, "i int, doc_id long, score long").join(names, "i").drop("i")


def item_blocks(weights: DataFrame, most: int) -> Iterator[list[tuple]]:
    """Items with their terms and weights, in blocks of at most `most` terms (an item with more is a block)."""
    block, held = [], 0
    rows = weights.groupBy("item_id").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
    for row in rows.toLocalIterator():
        if block and held + len(row["terms"]) > most:
            yield block
            block, held = [], 0
        block.append((row["item_id"], [(t["term"], t["w"]) for t in row["terms"]]))
        held += len(row["terms"])
    if block:
        yield block


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, most: int = ITEM_TERMS) -> DataFrame:
    """`item_id`, `rank` (from 1), `doc_id`, `score`: the `k` best documents of every item of `items(item_id, text)`.

    Only documents with a score above 0 are listed; equal scores stand by ascending doc_id, null last. Each row of
    `docs` is a document, repeated rows too; a null text has no terms. Rows of `items` with one item_id (null is one)
    are one item with the terms of all; an item without terms, or whose terms no document has, has no rows. Other
    columns are left out, whatever their names. Empty tables give no rows.
    """
    spark = docs.sparkSession
    terms = materialize(item_terms(items), "item-terms")
    index = index_for(docs, terms)
    own = index.where(F.col("term") == OWN)
    n_each = F.size(F.filter("counts", lambda n: n > 0)), F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
    n_docs, n_all_terms = own.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in n_each]).first()
    item_type = items.schema["item_id"].dataType.simpleString()
    parts = []
    if n_docs:
        weights = materialize(weighted(terms, index, n_docs), "item-weights")
        for block in item_blocks(weights, most):
            parts.append(materialize(top_of_block(index, block, item_type, n_docs, n_all_terms, k), "shard-best"))
    if not parts:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
