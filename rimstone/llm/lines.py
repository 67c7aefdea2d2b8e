"""Removal of near-duplicate lines: an exact set-similarity join of the words of lines, in DataFrame functions only.

The words of a line are ordered by rarity. Lines of n and m words with Jaccard similarity t have sizes within t of each
other (length filter) and at least k = ceil(t (n + m) / (1 + t)) words in common. So they share one of the first
n - ceil(t n) + 1 words of that order (prefix filter), and the first they share leaves k words in both from there on
(positional filter). Pairs that pass, and whose parity bits do not tell that too many words differ, are verified on all
their words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimstone.llm.common import keyed_texts, materialize
from rimstone.session import discard

BUCKETS = 1 << 17  # of words; the number of word counts that are known, whatever the corpus
SIZES = 8  # size classes of lines that are told apart when leads are chosen
PASSES = 4  # over the prefix words, for the leads and pairs of some of them each, so that not all are on disk at once
SHIFT = 56  # a word's key: its rarity class, then 56 bits of its hash


def rarity_classes(texts: DataFrame) -> Column:
    """Class (0: rarest) of each bucket of words, counted over all texts: a literal of BUCKETS small numbers.

    Half a power of two makes a class, so that words of about equal counts are told apart by hash only.
    """
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line"))
    words = lines.select(F.explode(F.split("line", " ")).alias("word"))
    counted = words.groupBy(F.xxhash64("word").bitwiseAND(BUCKETS - 1).cast("int").alias("bucket")).count()
    found = counted.select("bucket", F.floor(2 * F.log2(F.col("count") + 1)).cast("int").alias("rarity"))
    every = texts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"), F.lit(0).alias("rarity"))
    highest = found.unionByName(every).groupBy("bucket").agg(F.max("rarity").alias("rarity"))
    # One text and not BUCKETS rows comes to the driver, where each row would be an object.
    in_order = F.array_sort(F.collect_list(F.struct("bucket", "rarity")))
    (listed,) = highest.agg(F.array_join(F.transform(in_order, lambda b: b["rarity"].cast("string")), ",")).first()
    return F.split(F.lit(listed), ",").cast("array<int>")


def word_keys(line: Column, classes: Column) -> Column:
    """Keys of a line's distinct words in the order of rarity."""

    def key(word: Column) -> Column:
        h = F.xxhash64(word)
        rarity = F.element_at(classes, h.bitwiseAND(BUCKETS - 1).cast("int") + 1).cast("long")
        return F.shiftleft(rarity, SHIFT).bitwiseOR(F.shiftrightunsigned(h, 64 - SHIFT))

    keys = F.array_distinct(F.transform(F.split(line, " "), key))
    return F.sort_array(F.array_remove(keys, key(F.lit(""))))


def at_least(n: Column, percent: int) -> Column:
    """ceil(percent / 100 * n) in whole numbers."""
    return F.floor((n * percent + 99) / 100).cast("int")


def smallest_paired(percent: int) -> int:
    """Words of the smallest line that a different line can be similar to: n with n / (n + 1) >= percent / 100."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 31


def overlap_needed(n: Column, m: Column, percent: int) -> Column:
    """Smallest overlap of sets of sizes n and m with the similarity: ceil(percent (n + m) / (100 + percent))."""
    return F.ceil((n + m) * percent / (100 + percent)).cast("int")


def lines_to_remove(docs: DataFrame, percent: int = 75) -> DataFrame:
    """`__id`, `__hash` and `__gone` (line numbers from 0) of the texts that lose lines.

    Lines end at a line feed; their words stand between blanks, as a set. A line goes if a line that stands before it
    (smaller doc_id, nulls first; then smaller text hash; then smaller line number) has a Jaccard similarity of at
    least `percent` / 100 with it, whether or not that earlier line stays. So the first of equal lines stays. Lines
    without words always stay. `percent` is from 1 to 100.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    texts = keyed_texts(docs)
    classes = rarity_classes(texts)
    keys = word_keys(F.col("line"), classes)

    def parity(half: int) -> Column:
        """Parity of the words of each of 64 kinds; the two halves have different kinds of words."""

        def flip(bits: Column, key: Column) -> Column:
            bit = F.shiftrightunsigned(key, 1).bitwiseAND(63).cast("int")
            mine = F.lit(1 - half).cast("long").bitwiseXOR(key.bitwiseAND(1))
            return bits.bitwiseXOR(F.call_function("shiftleft", mine, bit))

        return F.aggregate("keys", F.lit(0).cast("long"), flip)

    lines = texts.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    long_prefix = F.slice("keys", F.lit(1), F.size("keys") - at_least(F.size("keys"), percent) + 1)
    sets = (
        lines.where(F.trim("line") != "")
        .select("doc_id", "text_hash", "line_no", keys.alias("keys"))
        .select(
            F.struct("doc_id", "text_hash", "line_no").alias("place"),
            F.xxhash64("keys").alias("set_id"),
            F.xxhash64(F.lit(1), "keys").alias("check"),
            F.size("keys").alias("n"),
            parity(0).alias("bits"), parity(1).alias("more_bits"),
            # Half of a key is enough to meet; the words themselves are compared later.
            F.transform(long_prefix, lambda k: k.bitwiseAND(0x7FFFFFFF).cast("int")).alias("prefix"),
        )
    )
    sets = materialize(sets, "line-sets")
    # Equal lines are one set with its first place; what follows works on sets.
    one = sets.groupBy("set_id", "check", "n").agg(
        F.min("place").alias("first"), F.count("*").alias("copies"), F.first("bits").alias("bits"),
        F.first("more_bits").alias("more_bits"), F.first("prefix").alias("prefix"),
    )
    one = materialize(one.orderBy("first").withColumn("id", F.monotonically_increasing_id()), "distinct-lines")
    near = similar_sets(one, texts, classes, percent)
    earliest = near.groupBy("set_id", "check").agg(F.min("first").alias("neighbour"))
    many = one.where(F.col("copies") > 1).select("set_id", "check", F.col("first").alias("neighbour"))
    bounds = earliest.unionByName(many).groupBy("set_id", "check").agg(F.min("neighbour").alias("earliest"))
    gone = sets.join(bounds, ["set_id", "check"]).where(F.col("place") > F.col("earliest"))
    by_text = gone.groupBy(F.col("place.doc_id").alias("__id"), F.col("place.text_hash").alias("__hash"))
    return materialize(by_text.agg(F.collect_set("place.line_no").alias("__gone")), "lines-to-remove")


def remove_similar_lines(docs: DataFrame, percent: int = 75) -> DataFrame:
    """`docs` with the kept lines as `text`, and `n_lines` and `n_removed`; see `lines_to_remove`.

    A null text is empty: one line without words. Repeated rows are the same document and keep the same lines. Other
    columns pass through (those named n_lines or n_removed are replaced); an empty table gives no rows.
    """
    gone = lines_to_remove(docs, percent)
    text = F.coalesce(docs["text"], F.lit(""))
    joined = docs.withColumn("text", text).withColumn("__h", F.xxhash64("text"))
    joined = joined.join(gone, joined["doc_id"].eqNullSafe(gone["__id"]) & (joined["__h"] == gone["__hash"]), "left")
    all_lines = F.split("text", "\n")
    kept = F.filter(all_lines, lambda x, i: ~F.array_contains(F.col("__gone"), i))
    whole = joined.withColumns(
        {
            "n_lines": F.size(all_lines).cast("long"),
            "n_removed": F.coalesce(F.size("__gone"), F.lit(0)).cast("long"),
            "text": F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
        }
    )
    return whole.drop("__id", "__hash", "__gone", "__h")


def differing(bits: str, bits_to: str) -> Column:
    """Each word that only one line has changes the parity of one bit, so at least so many words differ."""
    return F.bit_count(F.col(bits).bitwiseXOR(F.col(bits_to)))


def may_be_similar(one: str, other: str, percent: int) -> Column:
    """The length, positional and parity filters for two rows of prefix words; a negative size of `other` never passes."""
    n, at, m, to = (
        (F.shiftright(c, 32) if upper else F.col(c).bitwiseAND(0xFFFFFFFF)).cast("int")
        for c in (f"{one}.packed", f"{other}.packed") for upper in (True, False)
    )
    n = F.abs(n)
    needed = overlap_needed(n, m, percent)
    return (
        (n * 100 >= m * percent) & (m * 100 >= n * percent) & (at <= n - needed) & (to <= m - needed)
        & (
            differing(f"{one}.bits", f"{other}.bits") + differing(f"{one}.more_bits", f"{other}.more_bits")
            <= n + m - needed * 2
        )
    )


def prefix_words(one: DataFrame, percent: int) -> DataFrame:
    """One row for each word of a set's prefix; size and place share a number, to keep the rows short.

    Sets too small to be similar to a different set have none.
    """
    packed = (F.shiftleft(F.col("n").cast("long"), 32) + F.col("at")).alias("packed")
    paired = one.where(F.abs("n") >= smallest_paired(percent))
    words = paired.select("id", "n", "bits", "more_bits", F.posexplode("prefix").alias("at", "key"))
    return words.select("key", "id", "bits", "more_bits", packed)


def lead_names() -> list[str]:
    return [f"lead{i}" for i in range(2 * SIZES)]


def with_leads(words: DataFrame) -> DataFrame:
    """Prefix words with the leads of their key, where one of these is an earlier set.

    A lead is the row of the earliest set of its kind. Kinds are SIZES size classes, half a power of two each and then
    again from the first, and two halves by a hash. So a set sees leads of the classes next to its own too. Leads are
    combined before they are shuffled, and written, so that both sides of the join have an exchange of their own and a
    word of very many lines can be split.
    """
    kind = F.pmod(F.floor(2 * F.log2(F.shiftright("packed", 32))), F.lit(SIZES)) * 2 + F.xxhash64("id").bitwiseAND(1)
    row = F.struct("id", "bits", "more_bits", "packed")
    mins = [F.min(F.when(kind == i, row)).alias(name) for i, name in enumerate(lead_names())]
    leads = words.groupBy("key").agg(*mins, F.count("*").alias("rows")).where("rows > 1").drop("rows")
    earliest = F.least(*(F.col(f"{name}.id") for name in lead_names()))
    return words.join(materialize(leads, "line-leads"), "key").where(earliest < F.col("id"))


def likeliest_lead(percent: int) -> Column:
    """`differ` and `id` of the earlier lead that passes the filters and seems to differ least from `own`; null if none."""

    def judged(lead: str) -> Column:
        differ = differing(f"{lead}.bits", "own.bits") + differing(f"{lead}.more_bits", "own.more_bits")
        passes = (F.col(f"{lead}.id") < F.col("own.id")) & may_be_similar(lead, "own", percent)
        return F.when(passes, F.struct(differ.alias("differ"), F.col(f"{lead}.id").alias("id")))

    return F.least(*map(judged, lead_names()))


def in_turn(words: DataFrame, turn: int) -> DataFrame:
    """The prefix words of one of PASSES passes.

    Told apart by text, which code generated for a query refers to and does not contain: all passes run the same code.
    """
    return words.where(F.pmod("key", F.lit(PASSES)).cast("string") == str(turn))


def led_by(words: DataFrame, percent: int) -> DataFrame:
    """Each set, `id_to`, with the likeliest leads, `id`, of some prefix words; written, and the leads removed."""
    found = with_leads(words)
    led = found.select(*lead_names(), F.struct("id", "bits", "more_bits", "packed").alias("own"))
    pairs = led.select(likeliest_lead(percent)["id"].alias("id"), F.col("own.id").alias("id_to"))
    pairs = materialize(pairs.where("id is not null").distinct(), "led-pairs")
    discard(found, "line-leads")
    return pairs


def met_by(words: DataFrame, percent: int) -> DataFrame:
    """Pairs of an open set, `id_to`, and an earlier set, `id`, that share some prefix word and pass the filters; written."""
    a, b = words.alias("a"), words.alias("b")
    earlier = (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id"))
    met = a.join(b, earlier & may_be_similar("a", "b", percent))
    return materialize(met.select(F.col("a.id").alias("id"), F.col("b.id").alias("id_to")).distinct(), "met-pairs")


def similar_sets(one: DataFrame, texts: DataFrame, classes: Column, percent: int) -> DataFrame:
    """set_id, check, and `first` place of an earlier similar set, for every set that has one.

    `id` follows the first places. One earlier similar set is enough, so each set is first compared, for each of its
    prefix words, with the likeliest of a few early sets of its size that have the word; in a large group of near
    copies that decides nearly all. Only sets still open are compared with all earlier sets that share a prefix word.
    """
    words = prefix_words(one, percent)
    led = [led_by(in_turn(words, turn), percent) for turn in range(PASSES)]
    found = verified(reduce(DataFrame.unionByName, led).distinct(), one, texts, classes, percent)
    # Decided sets are marked by a negative size. Both sides are then the same rows, which are shuffled once.
    done = found.select(F.col("id_to").alias("done")).distinct()
    sizes = F.when(F.col("done").isNull(), F.col("n")).otherwise(-F.col("n")).alias("n")
    marked = one.join(done, F.col("id") == F.col("done"), "left").select("id", sizes, "bits", "more_bits", "prefix")
    words = prefix_words(materialize(marked, "marked-lines"), percent)
    met = [met_by(in_turn(words, turn), percent) for turn in range(PASSES)]
    discard(words, "marked-lines")
    links = found.union(verified(reduce(DataFrame.unionByName, met).distinct(), one, texts, classes, percent))
    lowest = links.groupBy("id_to").agg(F.min("id").alias("id"))
    sets = one.select(F.col("id").alias("id_to"), "set_id", "check")
    return lowest.join(one.select("id", "first"), "id").join(sets, "id_to").select("set_id", "check", "first")


def verified(pairs: DataFrame, one: DataFrame, texts: DataFrame, classes: Column, percent: int) -> DataFrame:
    """The pairs `id`, `id_to` whose similarity, on all words of both lines, is high enough."""
    pairs = materialize(pairs, "line-pairs")
    # All words of the lines that are in a pair, from the first place of each.
    wanted = pairs.select("id").union(pairs.select("id_to")).distinct()
    places = one.join(wanted, "id").select("id", "first")
    per_doc = places.groupBy(F.col("first.doc_id").alias("doc"), F.col("first.text_hash").alias("hash")).agg(
        F.collect_list(F.struct("first.line_no", "id")).alias("wanted")
    )
    found = texts.join(per_doc, texts["doc_id"].eqNullSafe(per_doc["doc"]) & (texts["text_hash"] == per_doc["hash"]))
    one_line = lambda w: F.struct(w["id"].alias("id"), F.element_at(F.col("lines"), w["line_no"] + 1).alias("line"))
    found = found.select(F.split("text", "\n").alias("lines"), "wanted")
    full = found.select(F.explode(F.transform("wanted", one_line)).alias("w")).select(
        "w.id", word_keys(F.col("w.line"), classes).alias("keys")
    )
    full = materialize(full, "line-keys")
    both = pairs.join(full, "id").join(full.select(F.col("id").alias("id_to"), F.col("keys").alias("keys_to")), "id_to")
    common = F.size(F.array_intersect("keys", "keys_to"))
    similar = common * 100 >= percent * (F.size("keys") + F.size("keys_to") - common)
    return materialize(both.where(similar).select("id", "id_to").distinct(), "line-links")
