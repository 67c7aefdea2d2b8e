"""Table rows from the words and ruled lines of report pages, for all files in one job.

Inputs are tables: `words(file, page, idx, text, x0, x1, bottom)` with `idx` counting 0, 1, 2, ... in reading
order on each page, `lines(file, page, bottom)`, and `cells(file, pos, name)`, the first row of the table
found on a file's first page. Pages are numbered from 1.

What the words of a file have in common (its time, headers and column edges) is worked out from its first page, and
the ruled lines of a page are put in one list: both are bounded by what fits on one page. They meet the words in one
join on file and page. Words are shuffled in stretches, one for each part of a page that lies together in the input, and
placed a batch of pages at a time (`placing`), so that a word costs its values and no row of its own. Tables may have any
width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rimstone.errors import LayoutFault
from rimstone.functions import snake, snake_names
from rimstone.operators import placing
from rimstone.operators.placing import BODY_PLACES, DATA_FROM, FIRST_PLACES, LAST_COLUMN_WIDTH, SEPARATOR, STAMP_FROM
from rimstone.operators.skew import TINY_SIDE_SPREAD, spread_join
from rimstone.operators.stretches import per_chunk, stretched

# Fixed value: the page with a file's time and headers.
FIRST_PAGE = 1

# Stands for the text of a word that is no part of any header; no header contains it.
PLAIN = SEPARATOR + "\u001e" + SEPARATOR
# Kinds, by hash, of the texts that begin or end a header: which of them occur is all the driver learns of the headers.
KINDS = 1 << 15
# Words for one partition where the number of words is known: what a task sorts does not grow with the table.
PARTITION_WORDS = 2_000_000
# Files named in an error message; the whole list is in the fault table.
NAMED_FAULTS = 20

NO_TABLE = "no_table"
HEADER_NOT_PLACED = "header_not_placed"
NO_ROWS = "no_rows"


def header_lists(cells: DataFrame) -> DataFrame:
    """Column headers per file in table order; empty cells and names with a slash are left out."""
    named = cells.where(F.col("name").isNotNull() & ~F.contains("name", F.lit("/")))
    listed = named.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("headers"))
    numbered = F.transform("headers", lambda h, i: F.struct(i.alias("pos"), h["name"].alias("name")))
    return listed.withColumn("headers", numbered)


def packed(rows: DataFrame, keys: Sequence[str], counting: str | None = None) -> DataFrame:
    """Rows of one key that follow each other in the input as one row: the keys, and a list of each other column.

    A key has as many of these rows as there are stretches of it, so rows in any order are packed whole, only less.
    `counting` names an integer column that mostly counts on by one from row to row: its list has each value less its
    place in the list, counted from 0, which is nearly always the same number and shrinks to nothing in a shuffle.
    """
    others = [f for f in rows.schema.fields if f.name not in keys]
    schema = T.StructType([rows.schema[k] for k in keys] + [T.StructField(f.name, T.ArrayType(f.dataType)) for f in others])
    keys, listed = list(keys), [f.name for f in others]

    def pack(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.zeros(batch.num_rows, dtype=bool)
            starts[0] = True
            for k in keys:
                column = batch.column(k)
                differs = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)), True)
                starts[1:] |= differs.to_numpy(zero_copy_only=False)
            firsts = np.flatnonzero(starts)
            ends = pa.array(np.append(firsts, batch.num_rows), pa.int32())
            columns = [batch.column(k).take(pa.array(firsts)) for k in keys]
            for c in listed:
                column = batch.column(c)
                if c == counting:
                    places = np.arange(batch.num_rows) - firsts[np.cumsum(starts) - 1]
                    column = pc.subtract(column, pa.array(places, column.type))
                columns.append(pa.ListArray.from_arrays(ends, column))
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, *listed])

    return rows.select(*keys, *listed).mapInArrow(pack, schema)


def dealt(rows: DataFrame, keys: Sequence[str], n_words: int | None) -> DataFrame:
    """`rows` by `keys`, with PARTITION_WORDS of `n_words` to a partition, where that takes more partitions than the session's.

    They are dealt before they are put together, as a task of the input has a key in one stretch, or few.
    """
    wanted = -(-(n_words or 0) // PARTITION_WORDS)
    if wanted <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows.repartition(*keys)
    return rows.repartition(wanted, *keys)


def data_words(words: DataFrame) -> DataFrame:
    """Words after the title and time of their page."""
    return words.where(F.col("idx") >= DATA_FROM)


def words_per_file(words: DataFrame) -> DataFrame:
    """Report time of each file, words 2 to 4 of its first page in order, and its number of data words and their characters.

    Words are first counted apart from those of the time, in numbers only, so that no list or sort sees all of them.
    """
    in_stamp = (F.col("page") == FIRST_PAGE) & F.col("idx").between(STAMP_FROM, DATA_FROM - 1)
    in_body = F.col("idx") >= DATA_FROM
    counted = words.groupBy(
        "file", F.when(in_stamp, F.col("idx")).alias("stamp_idx"), F.when(in_stamp, F.col("text")).alias("stamp_text")
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(in_body).alias("n_words"),
        F.sum(F.when(in_body, F.length("text"))).alias("n_chars"),
    )
    stamp = F.struct("stamp_idx", "stamp_text", F.col("n_rows").cast("int").alias("n_rows"))
    found = F.array_sort(F.collect_list(F.when(F.col("stamp_idx").isNotNull(), stamp)))
    texts = F.flatten(F.transform(found, lambda w: F.array_repeat(w["stamp_text"], w["n_rows"])))
    return counted.groupBy("file").agg(
        F.array_join(texts, " ").alias("reported_at"),
        F.sum("n_words").alias("n_words"),
        F.coalesce(F.sum("n_chars"), F.lit(0).cast("long")).alias("n_chars"),
    )


def _kind(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(KINDS - 1).cast("int")


def header_part(text: Column, headers: DataFrame) -> Column:
    """Whether a text may begin or end a header of some file; false only if it does neither in any, null for null.

    All beginnings and ends of headers are told apart by KINDS hashes, so what is known of them has a fixed size, and
    with very many headers the answer is true for more texts.
    """
    names = headers.select(F.explode(F.transform("headers", lambda h: h["name"])).alias("name")).distinct()
    lengths = F.sequence(F.lit(0), F.length("name"))
    parts = F.concat(
        F.transform(lengths, lambda n: F.left("name", n)), F.transform(lengths, lambda n: F.right("name", n))
    )
    present = [0] * (KINDS // 64)
    for (kind,) in names.select(F.explode(F.transform(parts, _kind)).alias("kind")).distinct().collect():  # KINDS rows
        present[kind // 64] |= 1 << kind % 64
    bits = F.split(F.lit(",".join(str(b - (b >> 63 << 64)) for b in present)), ",").cast("array<long>")
    found = F.getbit(F.element_at(bits, F.shiftright(_kind(text), 6) + 1), _kind(text).bitwiseAND(63)) == 1
    listed = found | F.contains(text, F.lit(SEPARATOR))
    return F.when(text.isNotNull(), listed)


def stretch_lists(words: DataFrame, keys: Sequence[str], places: Sequence[str], n_words: int | None) -> DataFrame:
    """One row for each key, with the stretches of its words in `parts`; for `n_words` see `dealt`."""
    return dealt(stretched(words, keys, places), keys, n_words).groupBy(*keys).agg(F.collect_list("stretch").alias("parts"))


def file_layouts(words: DataFrame, headers: DataFrame, n_words: int | None = None) -> DataFrame:
    """One row per file that has a first page: `(file, reported_at, headers, ranges)`; for `n_words` see `dealt`.

    `ranges` holds position, name, left and right edge of every header found on that page. A word opens a header
    when it is the header, or when it begins it and the next word ends it. Going through the page in order, a word
    opens only the first unplaced header it matches, and a header is placed once; the last word of the page
    cannot open one.
    """
    pages = stretch_lists(words.where(F.col("page") == FIRST_PAGE), ["file"], FIRST_PLACES, n_words)
    ranges = "array<struct<pos:int,name:string,left_edge:double,right_edge:double>>"
    # Else conditions on the result would have it worked out once more.
    laid_out = F.arrow_udf(placing.layouts, f"reported_at string, ranges {ranges}").asNondeterministic()
    names = F.transform("headers", lambda h: h["name"])
    found = pages.join(headers, "file", "left").select("file", "headers", laid_out("parts", names).alias("found"))
    return found.select("file", "found.reported_at", "headers", "found.ranges")


def with_right_edges(edges: Column) -> Column:
    """Headers in table order with the right edge of their column: the next left edge, or 500 points on for the last."""
    return F.transform(
        edges,
        lambda e, i: F.struct(
            e["pos"].alias("pos"),
            e["name"].alias("name"),
            e["left_edge"].alias("left_edge"),
            F.coalesce(F.get(edges, i + 1)["left_edge"], e["left_edge"] + LAST_COLUMN_WIDTH).alias("right_edge"),
        ),
    )


def header_edges(words: DataFrame, headers: DataFrame) -> DataFrame:
    """Left edge of every header that is found on the first page: `(file, pos, name, left_edge)`."""
    return file_layouts(words, headers).select("file", F.inline("ranges")).drop("right_edge")


def column_ranges(edges: DataFrame) -> DataFrame:
    """Left and right edge of each column from the edges of `header_edges`."""
    entry = F.struct("pos", "name", "left_edge")
    listed = edges.groupBy("file").agg(F.array_sort(F.collect_list(entry)).alias("edges"))
    return listed.select("file", F.inline(with_right_edges(F.col("edges"))))


def row_boundaries(lines: DataFrame) -> DataFrame:
    """Distinct line heights of each page."""
    return lines.select("file", "page", "bottom").distinct()


def lines_below(words: DataFrame, lines: DataFrame) -> DataFrame:
    """For every height at which a page has words, the first ruled line at or below it: `(file, page, bottom, line)`.

    The line is NULL for heights below the last line: it is a running minimum over the distinct heights of the page,
    from the bottom up. Nothing here grows with the number of words at one height.
    """
    at_words = words.select("file", "page", "bottom", F.lit(None).cast("double").alias("line"))
    at_lines = lines.select("file", "page", "bottom").withColumn("line", F.col("bottom"))
    heights = (
        at_words.withColumn("has_word", F.lit(True))
        .unionByName(at_lines.withColumn("has_word", F.lit(False)))
        .groupBy("file", "page", "bottom")
        .agg(F.max("line").alias("line"), F.max("has_word").alias("has_word"))
    )
    up_to_here = (
        Window.partitionBy("file", "page").orderBy(F.col("bottom").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return heights.withColumn("line", F.min("line").over(up_to_here)).where("has_word").drop("has_word")


def words_to_lines(words: DataFrame, lines: DataFrame) -> DataFrame:
    """Each word with the first line at or below it; words below the last line are left out."""
    found = lines_below(words, lines).where(F.col("line").isNotNull())
    return spread_join(words, found, ["file", "page", "bottom"], by=["idx"])


def _containing(ranges: Column) -> Column:
    """Ranges that contain the word of this row."""
    return F.filter(ranges, lambda r: (F.col("x0") >= r["left_edge"]) & (F.col("x1") <= r["right_edge"]))


def range_lists(ranges: DataFrame) -> DataFrame:
    """Column ranges as one row per file."""
    entry = F.struct("pos", "name", "left_edge", "right_edge")
    return ranges.groupBy("file").agg(F.array_sort(F.collect_list(entry)).alias("ranges"))


def words_to_columns(words: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each word once per column that contains it; words crossing an edge are left out."""
    others = [c for c in words.columns if c != "file"]
    placed = spread_join(packed(words, ["file"]), range_lists(ranges), ["file"], spread=TINY_SIDE_SPREAD)
    each = placed.select("file", "ranges", F.inline(F.arrays_zip(*others)))
    named = each.withColumn("column", F.explode(F.transform(_containing(F.col("ranges")), lambda r: r["name"])))
    return named.drop("ranges")


def header_line(names: Column) -> Column:
    """All headers in one text, each between separators, in which words can be looked up."""
    return F.concat(F.lit(SEPARATOR), F.array_join(names, SEPARATOR), F.lit(SEPARATOR))


def begins_header(text: Column, joined: Column) -> Column:
    return F.contains(joined, F.concat(F.lit(SEPARATOR), text))


def ends_header(text: Column, joined: Column) -> Column:
    return F.contains(joined, F.concat(text, F.lit(SEPARATOR)))


def line_lists(words: DataFrame, lines: DataFrame) -> DataFrame:
    """Every page that has words, with its distinct line heights from the top down: `(file, page, stops)`."""
    listed = lines.groupBy("file", "page").agg(F.array_sort(F.collect_set("bottom")).alias("stops"))
    return words.select("file", "page").distinct().join(listed, ["file", "page"], "left")


def with_plain_texts(words: DataFrame, headers: DataFrame) -> DataFrame:
    """`words` with PLAIN for each text that is no part of any header, for jobs that only ask whether it is one."""
    return words.withColumn("text", F.when(~header_part(F.col("text"), headers), PLAIN).otherwise(F.col("text")))


def placed_words(
    words: DataFrame, lines: DataFrame, layouts: DataFrame, columns: Sequence[str] = (), n_words: int | None = None
) -> DataFrame:
    """The data words of the files whose headers are all placed, with what gives them their lines and columns.

    A row is a page: `(file, page, parts, stops, reported_at, others, joined, ranges)`. `parts` are stretches of its
    words, `stops` its line heights from the top down. Headers are known by their snake-case name, `joined` holds them
    as they are written. Each of `ranges` has its edges and a slot: the place of its header in `columns` followed by the
    file's `others`, counted from 1. For `n_words` see `dealt`.
    """
    known = F.array(*[F.lit(c) for c in snake_names(columns)]).cast("array<string>")
    names = F.transform("headers", lambda h: h["name"])
    complete = (
        layouts.where((F.size("headers") > 0) & (F.size("headers") == F.size("ranges")))
        .withColumn("others", F.array_except(F.transform(names, snake), known))
        .withColumn("slots", F.concat(known, "others"))
        .select(
            "file",
            "reported_at",
            "others",
            header_line(names).alias("joined"),
            F.transform(
                "ranges",
                lambda r: F.struct(
                    r["left_edge"].alias("left_edge"),
                    r["right_edge"].alias("right_edge"),
                    F.array_position("slots", snake(r["name"])).cast("int").alias("slot"),
                ),
            ).alias("ranges"),
        )
    )
    body = data_words(words).where(F.col("bottom").isNotNull())
    heights = lines.withColumn("bottom", F.col("bottom").cast("double"))
    targets = spread_join(line_lists(body, heights), complete, ["file"])
    return stretch_lists(body, ["file", "page"], BODY_PLACES, n_words).join(targets, ["file", "page"])


def rows_of(
    words: DataFrame, lines: DataFrame, layouts: DataFrame, columns: Sequence[str], n_words: int | None = None
) -> DataFrame:
    """`table_rows` of files whose layouts are known; for `n_words` see `dealt`."""
    pages, names = placed_words(words, lines, layouts, columns, n_words), snake_names(columns)
    kinds = [(c, words.schema[c].dataType) for c in ("file", "page")] + [("line", T.DoubleType())]
    kinds += [("row_order", words.schema["idx"].dataType)] + [(c, T.StringType()) for c in names]
    kinds += [("more", T.MapType(T.StringType(), T.StringType())), ("reported_at", T.StringType())]
    schema = T.StructType([T.StructField(*kind) for kind in kinds])
    made = pages.mapInArrow(per_chunk(placing.table_parts(names, to_arrow_type(words.schema["idx"].dataType))), schema)
    return made.withColumn("line", F.col("line").cast(lines.schema["bottom"].dataType))


def table_rows(
    words: DataFrame, lines: DataFrame, cells: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Rows of all reports with the given table columns, named in snake case; absent or empty cells are NULL.

    A header belongs to the column of the same snake-case name, however it is spelled; two headers of a file with one
    such name share a cell. Columns of a file that are not listed are kept in the map `more`. `row_order` is the
    index of a row's first word, the order in which rows come on their page. A row whose words all lie outside the
    columns is kept with NULL cells.
    """
    return rows_of(words, lines, file_layouts(words, header_lists(cells)), columns)


def dropped_words(words: DataFrame, lines: DataFrame, cells: DataFrame, n_words: int | None = None) -> DataFrame:
    """Number of words per file and reason for which they are not in any cell; `n_words`, if known, sizes the tasks.

    A text that is no part of any header need not be known: it goes without a value, like a word without text.
    """
    headers = header_lists(cells)
    parts_only = words.withColumn("text", F.when(header_part(F.col("text"), headers), F.col("text")))
    placed = placed_words(parts_only, lines, file_layouts(words, headers, n_words), n_words=n_words)
    schema = T.StructType([words.schema["file"], T.StructField("reason", T.StringType()), T.StructField("n_words", T.LongType())])
    in_body = placed.mapInArrow(per_chunk(placing.dropped), schema)
    in_title = words.where(F.col("idx") < DATA_FROM).groupBy("file", F.lit("title").alias("reason")).agg(F.count(F.lit(1)).alias("n_words"))
    return in_title.unionByName(in_body.groupBy("file", "reason").agg(F.sum("n_words").alias("n_words")))


def faults_of(words: DataFrame, headers: DataFrame, layouts: DataFrame, rows: DataFrame) -> DataFrame:
    """Files of `words` and `headers` that cannot be laid out, with the reason; `rows` has the files with rows.

    All four are brought to one row per file and one of their facts, which are then put together in one shuffle.
    """
    absent = F.lit(None).cast("int")
    facts = [
        (words, absent, absent, absent),
        (headers, F.size("headers"), absent, absent),
        (layouts, absent, F.size("ranges"), absent),
        (rows, absent, absent, F.lit(1)),
    ]
    known = None
    for frame, n_headers, n_placed, has_rows in facts:
        each = frame.select("file", n_headers.alias("n_headers"), n_placed.alias("n_placed"), has_rows.alias("has_rows"))
        known = each if known is None else known.unionByName(each)
    per_file = known.groupBy("file").agg(*[F.max(c).alias(c) for c in ("n_headers", "n_placed", "has_rows")])
    fault = (
        F.when(F.coalesce("n_headers", F.lit(0)) == 0, NO_TABLE)
        .when(F.coalesce("n_placed", F.lit(0)) < F.col("n_headers"), HEADER_NOT_PLACED)
        .when(F.col("has_rows").isNull(), NO_ROWS)
    )
    return per_file.select("file", fault.alias("fault")).where(F.col("fault").isNotNull())


def files_with_rows(words: DataFrame, lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Files with headers that have a word of a row: a data word, no part of a header, at or above its page's last line.

    Only the highest word of each text of a page is looked at, and all texts that are no part of a header count as one.
    """
    body = with_plain_texts(data_words(words).where(F.col("bottom").isNotNull()), headers)
    highest = body.groupBy("file", "page", "text").agg(F.min("bottom").alias("bottom"))
    last = lines.groupBy("file", "page").agg(F.max("bottom").alias("last"))
    above = highest.join(last, ["file", "page"]).where(F.col("last") >= F.col("bottom"))
    named = headers.select("file", header_line(F.transform("headers", lambda h: h["name"])).alias("joined"))
    in_row = ~(begins_header(F.col("text"), F.col("joined")) | ends_header(F.col("text"), F.col("joined")))
    return above.join(named, "file").where(in_row).select("file").distinct()


def layout_faults(words: DataFrame, lines: DataFrame, cells: DataFrame) -> DataFrame:
    """Files that cannot be laid out, with the reason."""
    headers = header_lists(cells)
    files = words.select("file").unionByName(cells.select("file"))
    return faults_of(files, headers, file_layouts(words, headers), files_with_rows(words, lines, headers))


def enforce_layout(faults: DataFrame, store: str | None = None) -> None:
    """Raise if any file has a fault: with their number, a few names, and where all of them are written, if anywhere."""
    if store is not None:
        faults.write.mode("overwrite").option("compression", "zstd").parquet(store)
        faults = faults.sparkSession.read.schema(faults.schema).parquet(store)
    some = faults.orderBy("file").limit(NAMED_FAULTS).collect()
    if some:
        named = "; ".join(f"{r['file']}: {r['fault']}" for r in some)
        n_faults = len(some) if len(some) < NAMED_FAULTS else faults.count()
        raise LayoutFault(f"{n_faults} files cannot be laid out: {named}" + (f"; all in {store}" if store else ""))
