"""Phrases whose words keep together: counted level by level with double-array tries of candidates.

Texts are cut into words once and kept as runs of word numbers. A candidate of k words has to have all its parts of k - 1
words among the frequent ones, and to have been seen often enough beside its last word (slices say how often; only sums
that reach the bound make a candidate). Candidates are packed into double-array tries in tasks, each trie of bounded
size, and broadcast; NumPy then moves the states of all positions of a run through the trie at once, one level after the
other, counts the accepting states with bincount, and Spark adds up the counts of all runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rimstone.llm.common import global_positions, materialize, slices
from rimstone.llm.tokens import byte_kinds, words_of

# What stands between words, and what ends a piece.
GAPS, BREAKS = b" \t", b".,;:!?\x0a\x0b\x0c\x0d"
NO_LANG = "und"

SLICE_BYTES = 8 << 20
TRIE_PHRASES = 1 << 19  # phrases in one trie, about: what is broadcast at once
MOST_KEYS = 1 << 22  # that a task holds before it hands them on
RARE, STOP = -1, -2  # in a run: a word that is not frequent, the end of a piece


def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each slice of texts and language: its distinct words with their counts, and its words by code as a run.

    Codes follow `values`; -1 is put before the first word of each piece.
    """
    kinds = byte_kinds(GAPS, BREAKS)
    number = TaskContext.get().partitionId() << 32
    names = ["run", "lang", "code", "word", "n", "codes"]
    for part in slices(batches, "text", SLICE_BYTES):
        langs = part["lang"].fill_null(NO_LANG).dictionary_encode()
        of = langs.indices.to_numpy(zero_copy_only=False)
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            found = words_of(part["text"].filter(pa.array(of == i)), kinds)
            n_words = len(found.values)
            if not n_words:
                continue
            run = np.full(len(found.codes) + int(found.first.sum()), -1, np.int32)
            run[np.arange(len(found.codes)) + np.cumsum(found.first)] = found.codes
            words = [
                pa.array(np.full(n_words, number)), pa.array([lang] * n_words, pa.string()),
                pa.array(np.arange(n_words, dtype=np.int32)), found.values,
                pa.array(np.bincount(found.codes, minlength=n_words)), pa.nulls(n_words, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(words, names)
            own = [pa.array([number]), pa.array([lang]), pa.array([-1], pa.int32()), pa.nulls(1, pa.string())]
            yield pa.RecordBatch.from_arrays([*own, pa.nulls(1, pa.int64()), pa.array([run.tobytes()])], names)
            number += 1


def numbered_run(runs: pa.Table, words: pa.Table) -> pa.Table:
    """One run with its codes replaced by the numbers of frequent words."""
    codes = np.frombuffer(runs["codes"][0].as_py(), np.int32)
    numbers = np.full(int(codes.max(initial=-1)) + 2, RARE, np.int32)
    numbers[words["code"].to_numpy()] = words["id"].to_numpy()
    numbers[-1] = STOP  # code -1
    return pa.table({"ids": [numbers[codes].tobytes()]})


def first_fit(owner: np.ndarray, symbols: np.ndarray, start: int) -> int:
    """The first free slot from `start` on for the first of these symbols, such that the slots of the others are free too.

    Whole windows of slots are tried at once, symbol by symbol, until none is left; slots past the end are free.
    """
    rest = symbols[1:] - symbols[0]
    width = 64
    while start < len(owner):
        slots = start + np.flatnonzero(owner[start : start + width] < 0)
        for step in rest:
            if not len(slots):
                break
            at = slots + step
            slots = slots[(at >= len(owner)) | (owner[np.minimum(at, len(owner) - 1)] < 0)]
        if len(slots):
            return int(slots[0])
        start += width
        width = min(width * 4, 1 << 14)
    return start


def placed(children: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bases for the states with these child symbols, and for all slots the state each belongs to (-1: none).

    States with most children come first. Those of about one size are looked for from the place of the last one on;
    what has one child takes the free slots left in order, all at once.
    """
    counts = np.array([len(c) for c in children])
    owner = np.full(counts.sum() + counts.sum() // 4 + size + 1, -1, np.int32)
    bases = np.zeros(len(children), np.int64)
    order = np.argsort(-counts, kind="stable")
    several = order[: int((counts > 1).sum())]
    start = 0
    for i, state in enumerate(several):
        symbols = children[state]
        if i and int(counts[state]).bit_length() != int(counts[several[i - 1]]).bit_length():
            start = 0  # smaller states may fit where larger ones did not
        start = first_fit(owner, symbols, start)
        slots = start + symbols - symbols[0]
        if slots[-1] >= len(owner):
            owner = np.concatenate([owner, np.full(max(len(owner) // 2, slots[-1] + 1 - len(owner)), -1, np.int32)])
        bases[state] = start - symbols[0]
        owner[slots] = state
    single = order[len(several) :]
    free = np.flatnonzero(owner < 0)
    if len(free) < len(single):
        owner = np.concatenate([owner, np.full(len(single), -1, np.int32)])
        free = np.flatnonzero(owner < 0)
    slots = free[: len(single)]
    bases[single] = slots - np.array([children[s][0] for s in single], np.int64)
    owner[slots] = single
    return bases, owner


class Trie:
    """Double-array trie of phrases of one length: `base` of a state, `check` and `to` of a slot.

    Words are numbered anew among those in the phrases (`symbols`, sorted), so its size follows its phrases alone.
    A phrase's accepting state is its row in the sorted phrases.
    """

    def __init__(self, phrases: np.ndarray):
        self.symbols = np.unique(phrases)
        local = np.searchsorted(self.symbols, phrases)
        self.depth = local.shape[1]
        self.n = len(local)
        children: list[np.ndarray] = []
        targets: list[np.ndarray] = []
        parent = np.zeros(self.n, np.int64)  # state of each phrase's prefix, within its level
        for level in range(self.depth):
            new = np.ones(self.n, bool)
            if self.n:
                new[1:] = (parent[1:] != parent[:-1]) | (local[1:, level] != local[:-1, level])
            heads = np.flatnonzero(new)
            cuts = np.flatnonzero(np.diff(parent[heads])) + 1
            nodes = np.cumsum(new) - 1
            children += np.split(local[heads, level], cuts) if len(heads) else []
            targets += np.split(nodes[heads], cuts) if len(heads) else []
            parent = nodes
        self.level_sizes = self._sizes(local)
        self.base, self.check = placed(children, len(self.symbols))
        self.to = np.full(len(self.check), -1, np.int32)
        for base, symbols, nodes in zip(self.base, children, targets, strict=True):
            self.to[base + symbols] = nodes

    def _sizes(self, local: np.ndarray) -> list[int]:
        """States in each level that have children: the number of distinct prefixes of each length."""
        sizes = [1]
        for level in range(1, self.depth):
            new = (local[1:, :level] != local[:-1, :level]).any(axis=1)
            sizes.append(int(new.sum()) + 1)
        return sizes

    def accept(self, ids: np.ndarray) -> np.ndarray:
        """For each position of a run the phrase that begins there, or -1; all positions move a level at a time."""
        local = np.searchsorted(self.symbols, ids)
        known = self.symbols[np.minimum(local, len(self.symbols) - 1)] == ids
        live = np.flatnonzero(known[: max(len(ids) - self.depth + 1, 0)])
        state = np.zeros(len(live), np.int64)
        passed = 0  # states of the levels above
        for level in range(self.depth):
            at = live + level
            slot = self.base[passed + state] + local[at]
            inside = known[at] & (slot >= 0) & (slot < len(self.check))
            slot = np.where(inside, slot, 0)
            good = inside & (self.check[slot] == passed + state)
            live, state = live[good], self.to[slot[good]].astype(np.int64)
            passed += self.level_sizes[level]
        found = np.full(len(ids), -1, np.int64)
        found[live] = state
        return found


def packed_trie(block: pa.Table) -> pa.Table:
    """One trie of the phrases of a block, and the phrases in its order."""
    words = block["words"].combine_chunks()
    phrases = words.flatten().to_numpy().reshape(len(words), -1)
    phrases = phrases[np.lexsort(phrases.T[::-1])]
    trie = Trie(phrases)
    arrays = {n: getattr(trie, n).astype(np.int32).tobytes() for n in ("symbols", "base", "check", "to")}
    arrays["sizes"] = np.array([trie.depth, trie.n, *trie.level_sizes], np.int32).tobytes()
    arrays["phrases"] = phrases.astype(np.int32).tobytes()
    return pa.table({"block": block["block"][:1], **{n: [a] for n, a in arrays.items()}})


def unpacked_trie(row) -> Trie:
    trie = Trie.__new__(Trie)
    trie.symbols, trie.base, trie.check, trie.to = (
        np.frombuffer(row[n], np.int32) for n in ("symbols", "base", "check", "to")
    )
    trie.base = trie.base.astype(np.int64)
    trie.depth, trie.n, *trie.level_sizes = np.frombuffer(row["sizes"], np.int32).tolist()
    return trie


def unpacked_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `block`, `no`, `words` of the phrases of tries."""
    for batch in batches:
        for row in batch.to_pylist():
            depth = int(np.frombuffer(row["sizes"], np.int32)[0])
            flat = np.frombuffer(row["phrases"], np.int32)
            n = len(flat) // depth
            words = pa.FixedSizeListArray.from_arrays(pa.array(flat), depth).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row["block"])), pa.array(np.arange(n)), words], ["block", "no", "words"]
            )


COUNTS = "no long, next int, n long"


class Beside:
    """How often each phrase stood before each frequent word, summed over runs until there are `MOST_KEYS`."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, found: np.ndarray, next_words: np.ndarray) -> None:
        seen = (found >= 0) & (next_words >= 0)
        keys, counts = np.unique((found[seen] << 32) | next_words[seen], return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)

    def full(self) -> bool:
        return sum(map(len, self.keys)) >= MOST_KEYS

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The sums so far, which are then forgotten."""
        if not self.keys:
            return
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        sums = np.add.reduceat(counts[order], heads) if len(keys) else counts
        keys = keys[heads]
        columns = [pa.array(keys >> 32), pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(sums)]
        self.keys, self.counts = [], []
        yield pa.RecordBatch.from_arrays(columns, ["no", "next", "n"])


def pairs_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent words (as phrases of one word) beside frequent words."""
    pairs = Beside()
    for batch in batches:
        for run in batch["ids"]:
            ids = np.frombuffer(run.as_py(), np.int32)
            pairs.add(ids[:-1].astype(np.int64), ids[1:])
            if pairs.full():
                yield from pairs.rows()
    yield from pairs.rows()


def count_block(runs: DataFrame, packed, look_on: bool) -> DataFrame:
    """Counts of the phrases of one trie (`next` -1) and, with `look_on`, of each beside the frequent word after it."""
    sent = runs.sparkSession.sparkContext.broadcast(packed)  # one trie of about TRIE_PHRASES phrases

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = unpacked_trie(sent.value)
        totals = np.zeros(trie.n, np.int64)
        after = Beside()
        for batch in batches:
            for run in batch["ids"]:
                ids = np.frombuffer(run.as_py(), np.int32)
                found = trie.accept(ids)
                totals += np.bincount(found[found >= 0], minlength=trie.n)
                if look_on and len(ids) > trie.depth:
                    after.add(found[: -trie.depth], ids[trie.depth :])
                if after.full():
                    yield from after.rows()
        yield from after.rows()
        no = np.flatnonzero(totals)
        columns = [pa.array(no), pa.array(np.full(len(no), -1, np.int32)), pa.array(totals[no])]
        yield pa.RecordBatch.from_arrays(columns, ["no", "next", "n"])

    return runs.mapInArrow(count, COUNTS)


def count_phrases(runs: DataFrame, candidates: DataFrame, look_on: bool, least: int, most: int) -> tuple[DataFrame, DataFrame]:
    """The candidates with their counts (`words`, `f`), and what may follow them (`words` with one word more)."""
    spark = runs.sparkSession
    n_blocks = max(-(-candidates.count() // most), 1)
    dealt = candidates.select("words", F.pmod(F.xxhash64("words"), F.lit(n_blocks)).alias("block"))
    arrays = "symbols binary, base binary, check binary, to binary, sizes binary, phrases binary"
    tries = materialize(dealt.groupBy("block").applyInArrow(packed_trie, f"block long, {arrays}"), "tries")
    phrases = materialize(tries.mapInArrow(unpacked_phrases, "block long, no long, words array<int>"), "phrases")
    counted = []
    for packed in tries.drop("phrases").toLocalIterator():  # one trie at a time
        sums = count_block(runs, packed.asDict(), look_on).groupBy("no", "next").agg(F.sum("n").alias("n"))
        kept = sums.where((F.col("n") >= least) | (F.col("next") < 0)).withColumn("block", F.lit(packed["block"]))
        counted.append(materialize(kept, "phrase-counts"))
    if not counted:
        none = spark.createDataFrame([], "words array<int>, f long")
        return none, none.select("words")
    every = counted[0]
    for part in counted[1:]:
        every = every.unionByName(part)
    named = every.join(phrases, ["block", "no"])
    found = named.where("next < 0").select("words", F.col("n").alias("f"))
    return found, named.where("next >= 0").select(F.concat("words", F.array("next")).alias("words"))


def frequent_words(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The texts as runs of word numbers; frequent words `id`, `lang`, `word`, `f`; and words per language, `lang`, `n`."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang")
    cut = docs.select(lang, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        cut_rows, "run long, lang string, code int, word string, n long, codes binary"
    )
    cut = materialize(cut, "cut-texts")
    local = cut.where("code >= 0")
    words = materialize(local.groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    numbered, _, _ = global_positions(words.where(F.col("f") >= least), ["lang", "word"])
    known = numbered.select(F.col("__row").cast("int").alias("id"), "lang", "word", "f")
    known = materialize(known, "frequent-words")
    with_id = local.join(known.select("id", "lang", "word"), ["lang", "word"]).select("run", "code", "id")
    own = cut.where("code < 0").select(F.col("run").alias("own_run"), "codes")
    runs = own.groupBy("own_run").cogroup(with_id.groupBy("run")).applyInArrow(numbered_run, "ids binary")
    return materialize(runs, "runs"), known, totals


def collocations(
    docs: DataFrame, max_words: int = 3, least: int = 10, covered: int = 50, top: int = 2000, most: int = TRIE_PHRASES
) -> DataFrame:
    """`lang`, `rank` (from 1), `phrase`, `a`, `l`, `r`, `n`, `score`: the `top` phrases of each language.

    A-Z are lower-cased; texts are cut into pieces at `.,;:!?` and line ends and those into words at blanks and tabs.
    `n` counts all words of a language, `a` the places of a phrase of 2 to `max_words` words within pieces, which must
    be at least `least`. Cut after k words, `l` and `r` are the counts of the two parts, and the score is
    floor(1000000 a a / (l r)) in exact arithmetic; the lowest of all cuts counts, of equal ones that with the smallest
    k. A phrase whose words stand in a longer one that occurs at least `covered` percent as often is left out. Phrases
    of one language are listed by score, then a (both descending), then the bytes of the phrase.

    A null text is empty; a null language counts as `und`. Repeated rows count each. Other columns are left out,
    whatever their names. An empty table, or one without such phrases, gives no rows.
    """
    runs, words, totals = frequent_words(docs, least)
    seen = runs.mapInArrow(pairs_seen, COUNTS).groupBy("no", "next").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    candidates = materialize(seen.select(F.array(F.col("no").cast("int"), "next").alias("words")), "candidates")
    levels = {1: words.select(F.array("id").alias("words"), "f")}
    for k in range(2, max_words + 1):
        found, longer = count_phrases(runs, candidates, k < max_words, least, most)
        levels[k] = found
        if k < max_words:
            # The last k words must be a frequent phrase too; the first k are.
            tails = found.select(F.col("words").alias("tail"))
            safe = longer.join(tails, F.slice("words", 2, k) == F.col("tail"), "left_semi")
            candidates = materialize(safe, "candidates")
    ranked = with_scores(levels, max_words)
    ranked = without_covered(ranked, levels, max_words, covered)
    return listed(ranked, words, totals, top)


def with_scores(levels: dict[int, DataFrame], max_words: int) -> DataFrame:
    """`words`, `a`, `l`, `r`, `score` of all candidates, by their worst cut."""
    parts = None
    for k in range(2, max_words + 1):
        scored = levels[k].withColumnRenamed("f", "a")
        cuts = []
        for cut in range(1, k):
            left = levels[cut].select(F.col("words").alias("left"), F.col("f").alias(f"l{cut}"))
            right = levels[k - cut].select(F.col("words").alias("right"), F.col("f").alias(f"r{cut}"))
            scored = scored.join(left, F.slice("words", 1, cut) == F.col("left")).drop("left")
            scored = scored.join(right, F.slice("words", cut + 1, k - cut) == F.col("right")).drop("right")
            # Decimals without fraction: 38 digits hold a million times the square of 10^15 occurrences.
            score = F.expr(
                "cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0))) "
                f"div (cast(l{cut} as decimal(18,0)) * cast(r{cut} as decimal(18,0)))"
            )
            parts_of = [F.col(f"{side}{cut}").alias(side) for side in "lr"]
            cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("k"), *parts_of))
        worst = F.array_min(F.array(*cuts)).alias("worst")
        part = scored.select("words", "a", worst).select("words", "a", "worst.l", "worst.r", "worst.score")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def without_covered(ranked: DataFrame, levels: dict[int, DataFrame], max_words: int, covered: int) -> DataFrame:
    """Phrases that no longer one covers."""
    inside = None
    for k in range(3, max_words + 1):
        for n in range(2, k):
            for start in range(1, k - n + 2):
                part = levels[k].select(F.slice("words", start, n).alias("part"), F.col("f").alias("longer"))
                inside = part if inside is None else inside.unionByName(part)
    if inside is None:
        return ranked
    longest = inside.groupBy("part").agg(F.max("longer").alias("longer"))
    joined = ranked.join(longest, F.col("words") == F.col("part"), "left")
    return joined.where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True))).drop("part", "longer")


def listed(ranked: DataFrame, words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The first phrases of each language, in words."""
    each = ranked.select("words", F.posexplode("words").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ")
    phrases = each.groupBy("words").agg(F.first("lang").alias("lang"), text.alias("phrase"))
    whole = ranked.join(phrases, "words")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    first = whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
