"""Exact Jaccard join of word shingles by partitioning the universe of shingles.

Sets are put in bands by size. For the pairs whose smaller set is in band f, the symmetric difference is at most
H = (largest size of f) // 3 at similarity 0.75. The shingles are hashed into segments; segment i counts e_i + 1, with
e_i = 0 (the two subsets must be equal) or 1 (they may differ by one shingle: each set also gives its subset with one
shingle left out). Segments that differ by more use up e_i + 1 of H, so if the counts sum to H + 1 + slack, segments of
count slack + 1 at least match. Allocation by cost: a set leaves out its subsets with the longest lists, as far as
their counts do not exceed slack: first all empty ones (if they do exceed it, the set leaves out nothing), then all
lists down to a length. Of two similar sets, the one that goes down further still shares lists with the other, since
what it keeps the other keeps as well: its rest of the slack tells how many, and only its.
Sets that share a list are candidates; clusters of candidates are verified exactly on all their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rimstone.llm.common import keyed_texts, materialize, shuffles, slices
from rimstone.llm.components import components
from rimstone.llm.hashing import Prefixes, mixed

WORDS = 5
SHORT = 24  # lists up to this length are never left out
LADDER = 4  # each level of longer lists is so many times longer
LEVELS = 8  # the last level; it has all longer lists as well
PASSES = 2  # over the texts, for the lists of some frames each, so that not all signatures are on disk at once
WHOLE = 127  # above all levels
BLOCK = 256  # sets of a cluster that are compared with each other at a time
SLICE = 1 << 20
SPACES = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the five-word shingles of each text; fewer words make one shingle."""
    coded = [t.encode() for t in texts]
    data = LOWER[np.frombuffer(b"\n".join([*coded, b""]), np.uint8)]
    space = SPACES[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    words = Prefixes(data).of(starts, ends)
    limits = np.cumsum([0] + [len(c) + 1 for c in coded])
    first = np.searchsorted(starts, limits)
    with np.errstate(over="ignore"):
        odd = [np.uint64(0x9E3779B97F4A7C15 ** (2 * j + 1) % 2**64) for j in range(WORDS)]
        spread = [words * f for f in odd]
        n = max(len(words) - WORDS + 1, 0)
        windows = mixed(sum((spread[j][j : j + n] for j in range(1, WORDS)), spread[0][:n]), 5)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= WORDS:
                out.append(np.unique(windows[a : b - WORDS + 1]))
            elif b > a:
                out.append(mixed(sum((spread[j][a + j : a + j + 1] for j in range(1, b - a)), spread[0][a : a + 1]), b - a))
            else:
                out.append(windows[:0])
    return out


def identity(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set, as signed numbers."""
    with np.errstate(over="ignore"):
        both = [[mixed(s, seed).sum(dtype=np.uint64) + np.uint64(len(s)) for s in sets] for seed in (11, 12)]
    return tuple(np.array(h, np.uint64).view(np.int64) for h in both)


def _bands(most: int = 1 << 40) -> list[int]:
    low = [1]
    while low[-1] < most:
        low.append(max(low[-1] + 1, -(-low[-1] * 3 // 2)))
    return low


BANDS = _bands()  # smallest size of each band; a set's partners are in its own band or a neighbouring one
_ALLOCATED: dict[int, tuple[int, int, int]] = {}


def allocation(frame: int) -> tuple[int, int, int]:
    """Segments, how many of them (the first) may differ by one shingle, and slack, for pairs of a frame.

    Chosen by cost: as few keys as possible for the smallest sets of the frame, with enough slack for the segments
    that are likely to be empty there (their mean and 2.5 deviations) and a few more.
    """
    if frame in _ALLOCATED:
        return _ALLOCATED[frame]
    low, high = BANDS[frame], BANDS[frame + 1]
    needed = (high - 1) // 3 + 1
    step = max(1, needed // 40)
    best = None
    for slack in range(0, needed + 2 * step, step):
        for wide in range(0, (needed + slack) // 2 + 1, step):
            total = needed + slack
            segments = total - wide
            hollow = (1 - 1 / segments) ** low * total
            missing = hollow + 2.5 * np.sqrt(hollow) + needed // 60 - slack
            keys = segments - hollow * segments / total + wide * low / segments
            option = (max(missing, 0.0), keys, segments, wide, slack)
            best = min(best or option, option)
    _ALLOCATED[frame] = best[2:]
    return _ALLOCATED[frame]


def frames(n: int) -> list[int]:
    """Frames in which a set of this size takes part: as one of its band, and as the larger of a pair."""
    if n < 3:
        return []  # different sets of one or two shingles are not similar to anything
    band = int(np.searchsorted(BANDS, n, "right")) - 1
    reach = band > 0 and 3 * n <= 4 * (BANDS[band] - 1)
    return [band - 1, band] if reach else [band]


def signatures(shingles: np.ndarray, turn: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and tags of one set. Tag: segment, count (1 or 2), frame, whether the set is whole, what is left of the slack.

    With `turn` only those of the frames that have their turn in this pass.

    Empty subsets, the longest lists of all, are left out where the slack allows it; else the set is whole and leaves
    out nothing. A subset that is empty without its only shingle costs one of the slack: another set with an empty
    segment there has used up one of the difference.
    """
    due = [f for f in frames(len(shingles)) if turn is None or f % PASSES == turn]
    if not due:
        return
    spread, value = mixed(shingles, 21) >> np.uint64(16), mixed(shingles, 22)
    for frame in due:
        n, wide, slack = allocation(frame)
        segment = (spread % np.uint64(n)).astype(np.int64)
        with np.errstate(over="ignore"):
            sums = np.zeros(n, np.uint64)
            np.add.at(sums, segment, value)
            counts = np.bincount(segment, minlength=n)
            weights = np.where(np.arange(n) < wide, 2, 1)
            unused = int(weights[counts == 0].sum()) + int((counts[:wide] == 1).sum())
            whole = unused > slack
            at, keys, loose = np.arange(n), sums, segment < wide
            if not whole:
                at, keys, slack = at[counts > 0], sums[counts > 0], slack - unused
                loose &= counts[segment] > 1
            if wide:
                at = np.concatenate([at, segment[loose]])
                keys = np.concatenate([keys, sums[segment[loose]] - value[loose]])
            keys = mixed(keys + at.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(frame), 23)
        tags = (at << 34) | (weights[at] << 32) | (frame << 24) | (int(whole) << 23) | min(slack, (1 << 23) - 1)
        yield keys.view(np.int64), tags


def list_levels(lengths: np.ndarray) -> np.ndarray:
    """0 for lists of up to SHORT sets, then one more for each LADDER times as many, LEVELS at most."""
    return np.searchsorted(SHORT * LADDER ** np.arange(LEVELS), lengths)


def shared_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and set, those whose key has another set as well, once for each key and set, with `level`.

    Between batches the last key's rows are held, until there are so many that its level is known to be the last; of
    longer lists only the last row.
    """
    enough = SHORT * LADDER ** (LEVELS - 1) + 1
    names = ["key", "node", "tag", "level"]
    held = [np.zeros(0, np.int64)] * 3
    sent = False  # whether the held row is the last of a list of the last level that has been sent so far

    def listed(columns: list[np.ndarray], levels: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(levels, pa.int32())], names)

    def closed(columns: list[np.ndarray], sent: bool) -> pa.RecordBatch:
        """Whole lists, the first of which has been sent up to its first row if `sent`."""
        key = columns[0]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        counts = np.diff(np.append(starts, len(key)))
        levels = np.repeat(list_levels(counts), counts)
        keep = np.repeat(counts > 1, counts)
        if sent:
            levels[: counts[0]] = LEVELS
            keep[: counts[0]] = np.arange(counts[0]) > 0
        return listed([c[keep] for c in columns], levels[keep])

    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if not len(columns[0]):
            continue
        columns = [np.concatenate(c) for c in zip(held, columns, strict=True)]
        key, node, _ = columns
        first = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
        columns = [c[first] for c in columns]
        last = int(np.searchsorted(columns[0], columns[0][-1]))  # the last key's first row
        if last:
            yield closed([c[:last] for c in columns], sent)
            sent = False
        held = [c[last:] for c in columns]
        if sent or len(held[0]) >= enough:
            yield listed([c[int(sent) :] for c in held], np.full(len(held[0]) - int(sent), LEVELS))
            held, sent = [c[-1:] for c in held], True
    if len(held[0]):
        yield closed(held, sent)


def set_rows(texts: DataFrame) -> DataFrame:
    """doc_id, text_hash, and the identity and size of the shingle set of every text that has words."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            sets = shingle_sets(part["text"].to_pylist())
            one, two = identity(sets)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            columns = [part["doc_id"], part["text_hash"], pa.array(one), pa.array(two), sizes]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "set_a", "set_b", "n"])

    return texts.mapInArrow(run, "doc_id long, text_hash long, set_a long, set_b long, n long")


def signature_rows(texts: DataFrame, turn: int | None = None) -> DataFrame:
    """key, node and tag of every set; sets that a task has met already are not sent again. `turn`: see `signatures`."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "text", SLICE):
            sets = shingle_sets(part["text"].to_pylist())
            keys, nodes, tags = [], [], []
            for shingles, node in zip(sets, identity(sets)[0].tolist(), strict=True):
                if len(shingles) and node not in seen:
                    seen.add(node)
                    for k, t in signatures(shingles, turn):
                        keys.append(k)
                        tags.append(t)
                        nodes.append(np.full(len(k), node, np.int64))
            if keys:
                columns = [pa.array(np.concatenate(c)) for c in (keys, nodes, tags)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "node", "tag"])

    return texts.select("text").mapInArrow(run, "key long, node long, tag long")


def candidate_edges(texts: DataFrame) -> DataFrame:
    """Edges `a`, `b` whose components hold all similar sets.

    Long lists that are in use give an edge from their smallest set to every other; short lists give the pairs that
    share as many as similar sets must.
    """
    n = shuffles(texts.sparkSession)
    passes = []
    for turn in range(PASSES):
        rows = signature_rows(texts, turn).repartition(n, "key").sortWithinPartitions("key", "node")
        passes.append(materialize(rows.mapInArrow(shared_lists, "key long, node long, tag long, level int"), "lists"))
    shared = reduce(DataFrame.unionByName, passes)  # a key belongs to one frame, so its list is in one of them
    frame = F.shiftright("tag", 24).bitwiseAND(0xFF).alias("frame")
    segment, weight = F.shiftright("tag", 34).alias("segment"), F.shiftright("tag", 32).bitwiseAND(3).alias("weight")
    slack = F.col("tag").bitwiseAND(0x7FFFFF).alias("slack")
    whole = (F.col("tag").bitwiseAND(1 << 23) > 0).alias("whole")
    used = shared.select("key", "node", frame, segment, weight, whole, slack, "level")
    # What each set would leave out: by segment the level of its longest list, then counts from the top down.
    long_ones = used.where("level > 0")
    spare = F.when(F.col("whole"), -1).otherwise(F.col("slack"))
    by_segment = long_ones.groupBy("node", "frame", "segment").agg(
        F.max("level").alias("level"), F.first("weight").alias("weight"), F.max(spare).alias("slack")
    )
    by_level = by_segment.groupBy("node", "frame", "level").agg(F.sum("weight").alias("w"), F.max("slack").alias("slack"))
    down = Window.partitionBy("node", "frame").orderBy(F.desc("level"))
    by_level = materialize(by_level.withColumn("above", F.sum("w").over(down)), "long-lists")
    bounds = by_level.groupBy("node", "frame").agg(
        F.max(F.when(F.col("above") > F.col("slack"), F.col("level"))).alias("top"),
        F.max(F.when(F.col("above") <= F.col("slack"), F.col("above"))).alias("left_out"),
    )
    kept_to = bounds.where("top is not null").select("node", "frame", "top")
    stay = long_ones.join(kept_to, ["node", "frame"]).where(F.col("level") <= F.col("top")).select("key", "node")
    # The smallest set of a long list may have left it: the list is led by the smallest that stays.
    lead = stay.groupBy("key").agg(F.min("node").alias("low"))
    long_edges = stay.join(lead, "key").select(F.col("low").alias("a"), F.col("node").alias("b")).where("a <> b")
    # Of short lists, similar sets share as many as must match and have not been left out as long ones by the set that
    # has gone down further: the low half of `bound`. The high half is larger the further a set has gone down.
    short = used.where("level = 0").join(bounds, ["node", "frame"], "left")
    must = F.col("slack") + 1 - F.coalesce("left_out", F.lit(0))
    top = F.when(F.col("whole"), WHOLE).otherwise(F.coalesce("top", F.lit(0)))
    bound = F.shiftleft((WHOLE - top).cast("long"), 32) + must
    # In one number, so that both sides of the join are the same rows, which are shuffled once.
    info = F.shiftleft(bound, 10) + F.shiftleft(F.col("frame"), 2) + F.col("weight")
    short = short.select("key", "node", info.alias("info"))
    one, other = short.alias("one"), short.alias("other")
    met = one.join(other, (F.col("one.key") == F.col("other.key")) & (F.col("one.node") < F.col("other.node")))
    frame = F.shiftright("one.info", 2).bitwiseAND(0xFF).alias("frame")
    counted = met.groupBy(F.col("one.node").alias("a"), F.col("other.node").alias("b"), frame).agg(
        F.sum(F.col("one.info").bitwiseAND(3)).alias("shared"),
        F.shiftright(F.greatest(F.max("one.info"), F.max("other.info")), 10).bitwiseAND(0xFFFFFFFF).alias("must"),
    )
    return counted.where("shared >= must").select("a", "b").unionByName(long_edges).distinct()


def similar_in(sets: list[np.ndarray], cut: int, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs that link the similar sets of a block, or of two blocks (before and from `cut`): a spanning forest.

    Intersections are counted for all pairs at once, as products of 0/1 matrices over the shingles of two sets or more.
    """
    sizes = np.array([len(s) for s in sets])
    tokens, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    column = np.cumsum(counts > 1) - 1
    shared = counts[at] > 1
    owner, at = owner[shared], column[at[shared]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    common = np.zeros((len(sets), len(sets)), np.float64)
    width = 2048
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        a, b = np.searchsorted(at, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], at[a:b] - start] = 1
        common += part @ part.T
    linked = common * 100 >= percent * (sizes[:, None] + sizes[None, :] - common)
    if cut:
        linked[:cut, :cut] = linked[cut:, cut:] = False
    group = list(range(len(sets)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i, j in np.argwhere(np.triu(linked, 1)).tolist():
        a, b = root(i), root(j)
        if a != b:
            group[max(a, b)] = min(a, b)
            yield i, j


def verify(texts: DataFrame, classes: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Edges between the representatives of similar sets of one cluster.

    A cluster larger than BLOCK is cut in blocks, and each pair of blocks is compared on its own.
    """
    n = shuffles(texts.sparkSession)
    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    units = clusters.join(sizes, "component").withColumn("mine", mine)
    members = classes.join(units, classes["set_a"] == units["node"]).select(
        F.col("rep_hash").alias("hash"), F.col("rep").alias("id"), "component", "mine", "blocks"
    )
    own = texts.join(members, (texts["doc_id"] == members["id"]) & (texts["text_hash"] == members["hash"]))

    def build(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            sets = [pa.array(s.view(np.int64)) for s in shingle_sets(part["text"].to_pylist())]
            named = {c: part[c] for c in ("id", "component", "mine", "blocks")}
            yield pa.RecordBatch.from_pydict(named | {"shingles": pa.array(sets, pa.list_(pa.int64()))})

    sets = own.select("id", "component", "mine", "blocks", "text").mapInArrow(
        build, "id long, component long, mine int, blocks int, shingles array<long>"
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    each = sets.withColumn("other", other).select(
        "component", F.least("mine", "other").alias("u"), F.greatest("mine", "other").alias("v"), "mine", "id", "shingles"
    )
    unit = ["component", "u", "v"]
    dealt = each.repartition(n, *unit).sortWithinPartitions(*unit, "mine")

    def compare(batches) -> Iterator[pa.RecordBatch]:
        held, ids, blocks, sets = None, [], [], []

        def links():
            cut = blocks.index(held[2]) if held[1] != held[2] and held[2] in blocks else 0
            if len(sets) > 1 and (cut or held[1] == held[2]):
                pairs = [(ids[i], ids[j]) for i, j in similar_in(sets, cut, percent)]
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], ["a", "b"])

        for batch in batches:
            shingles = batch.column(5)
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
            for k, (component, u, v, mine, doc) in enumerate(rows):
                if held != (component, u, v):
                    if held is not None:
                        yield from links()
                    held, ids, blocks, sets = (component, u, v), [], [], []
                ids.append(doc)
                blocks.append(mine)
                sets.append(np.array(shingles[k].values))
        if held is not None:
            yield from links()

    return dealt.mapInArrow(compare, "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, text_hash, n_shingles and component_id for every row of `docs`.

    A set is the distinct five-word shingles of the whole text, words standing between ASCII white space and A-Z read
    as a-z; with fewer words it is the whole sequence; a null or wordless text has the empty set and is alone. Two rows
    are linked when their Jaccard similarity is `percent` / 100 or more (0.75 and above only: the bands are made for
    it). component_id is the smallest doc_id that links reach. Rows that share a doc_id count as linked; rows without
    doc_id take no part and have no component. Other columns are ignored; an empty table gives no rows. Equality of
    shingles and of sets is that of 64-bit and 128-bit hashes.
    """
    if percent < 75:
        raise ValueError("similarities under 0.75 need wider bands")
    texts = keyed_texts(docs)
    rows = materialize(set_rows(texts), "sets")
    usable = rows.where("n > 0 and doc_id is not null")
    least = F.min(F.struct("doc_id", "text_hash")).alias("low")
    classes = usable.groupBy("set_a", "set_b", "n").agg(least, F.max("doc_id").alias("high"))
    classes = materialize(
        classes.select(
            "set_a", "set_b", "n", F.col("low.doc_id").alias("rep"), F.col("low.text_hash").alias("rep_hash"), "high"
        ),
        "set-classes",
    )
    with_ids = texts.where("doc_id is not null")
    clusters = components(candidate_edges(with_ids))
    links = verify(with_ids, classes, materialize(clusters, "clusters"), percent)
    # Several sets of one doc_id hang together as well.
    same = usable.join(classes, ["set_a", "set_b", "n"]).where("doc_id <> rep")
    of_id = usable.groupBy("doc_id").agg(F.count_distinct("set_a", "set_b").alias("k")).where("k > 1").select("doc_id")
    shared_id = same.join(of_id, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(shared_id))
    known = rows.join(classes.select("set_a", "set_b", "n", "rep"), ["set_a", "set_b", "n"], "left")
    known = known.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    alone = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "rep", "doc_id"))
    return known.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), alone.alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Rows of `docs`, all columns, without those that links connect to a smaller doc_id. Rows without id stay."""
    found = jaccard_components(docs, percent).where("component_id < doc_id")
    gone = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(gone, (docs["doc_id"] == gone["__id"]) & (text_hash == gone["__hash"]), "left_anti")
