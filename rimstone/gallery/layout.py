"""The layout job and its steps, over documents laid out as report pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.gallery.base import Registered
from rimstone.gallery.derived import PAGES_SQL, decoded_reports, landed_reports
from rimstone.operators import layout as lay
from rimstone.plans.injury_reports import REPORT_COLUMNS, parse_reports


def words_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lay.words_per_file(decoded_reports(spark, sf_dir).words)


WORDS_INDEX = f"""with {PAGES_SQL}
select file, string_agg(text, ' ' order by idx) filter (page = 1 and idx between 2 and 4) as reported_at,
  count(*) filter (idx >= 5) as n_words, cast(coalesce(sum(length(text)) filter (idx >= 5), 0) as bigint) as n_chars
from words group by 1
"""


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = decoded_reports(spark, sf_dir)
    return lay.header_edges(reports.words, lay.header_lists(reports.cells))


def header_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir).withColumn("pos", F.col("pos").cast("bigint"))


EDGES_SQL = """
pairs as (
  select file, idx, text, x0, lead(text) over (partition by file order by idx) as next_text from words where page = 1
),
edges as (
  select p.file, h.pos, h.name, arg_min(p.x0, p.idx) - 1 as left_edge
  from pairs p join heads h on p.file = h.file
  where p.next_text is not null and (p.text = h.name or (starts_with(h.name, p.text) and ends_with(h.name, p.next_text)))
  group by 1, 2, 3
)"""


def column_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lay.column_ranges(_edges(spark, sf_dir)).withColumn("pos", F.col("pos").cast("bigint"))


RANGES_SQL = f"""{EDGES_SQL},
ranges as (
  select *, coalesce(lead(left_edge) over (partition by file order by pos), left_edge + 500) as right_edge from edges
)"""


def row_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lay.row_boundaries(decoded_reports(spark, sf_dir).lines)


ROW_BOUNDARIES = f"with {PAGES_SQL} select distinct file, page, bottom from lines"


def word_to_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = landed_reports(spark, sf_dir)
    placed = lay.words_to_lines(lay.data_words(reports.words), reports.lines)
    return placed.groupBy("file", "page", "line").agg(
        F.count(F.lit(1)).alias("n_words"),
        F.min("idx").cast("bigint").alias("first_idx"),
        F.max("idx").cast("bigint").alias("last_idx"),
    )


WORD_TO_LINE = f"""with {PAGES_SQL}
select w.file, w.page, l.bottom as line, count(*) as n_words, min(w.idx) as first_idx, max(w.idx) as last_idx
from (select * from words where idx >= 5) w asof join lines l
  on w.file = l.file and w.page = l.page and w.bottom <= l.bottom
group by 1, 2, 3
"""


def word_to_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = landed_reports(spark, sf_dir)
    ranges = lay.column_ranges(lay.header_edges(reports.words, lay.header_lists(reports.cells)))
    sized = lay.data_words(reports.words).select("file", F.length("text").alias("n_chars"), "x0", "x1")
    placed = lay.words_to_columns(sized, ranges)
    return placed.groupBy("file", "column").agg(F.count(F.lit(1)).alias("n_words"), F.sum("n_chars").alias("n_chars"))


WORD_TO_COLUMN = f"""with {PAGES_SQL}, {RANGES_SQL}
select w.file, r.name as "column", count(*) as n_words, cast(sum(length(w.text)) as bigint) as n_chars
from words w join ranges r on w.file = r.file and w.x0 >= r.left_edge and w.x1 <= r.right_edge
where w.idx >= 5 group by 1, 2
"""


def layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = landed_reports(spark, sf_dir)
    # The number of words comes from the footers of the landed table.
    rows = parse_reports(reports, strict=False, n_words=reports.words.count())
    further = F.transform(F.array_sort(F.map_entries("more")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return rows.withColumns({"row_order": F.col("row_order").cast("bigint"), "more": F.array_join(further, ";")})


_CELLS = ", ".join(
    f"""nullif(trim(coalesce(string_agg(text, ' ' order by idx) filter (name in ('{name}', '{name.replace(' ', '')}')), ''), ' '), '') as {name.lower().replace(' ', '_')}"""
    for name in REPORT_COLUMNS
)
PLACED_SQL = f"""{RANGES_SQL},
complete as (
  select file from heads group by 1
  having count(*) = (select count(*) from edges e where e.file = heads.file)
),
body_words as (select w.* from words w where idx >= 5 and file in (select file from complete)),
marked as (
  select w.*, exists (select 1 from heads h where h.file = w.file and (starts_with(h.name, w.text) or ends_with(h.name, w.text))) as is_header
  from body_words w
),
lined as (
  select m.*, l.bottom as line from marked m asof left join lines l
    on m.file = l.file and m.page = l.page and m.bottom <= l.bottom
),
placed as (
  select d.file, d.page, d.idx, d.text, d.is_header, d.line, r.name from lined d left join ranges r
    on d.file = r.file and d.x0 >= r.left_edge and d.x1 <= r.right_edge
)"""
_LISTED = ", ".join(f"'{name}', '{name.replace(' ', '')}'" for name in REPORT_COLUMNS)
LAYOUT_ROWS = f"""with {PAGES_SQL}, {PLACED_SQL},
stamps as (select file, string_agg(text, ' ' order by idx) as reported_at from words where page = 1 and idx between 2 and 4 group by 1),
listed as (select * from placed where not is_header and line is not null),
further as (
  select file, page, line, lower(name) || '=' || string_agg(text, ' ' order by idx) as entry
  from listed where name not in ({_LISTED}) group by file, page, line, name
),
more as (select file, page, line, string_agg(entry, ';' order by entry) as more from further group by 1, 2, 3)
select p.file, p.page, p.line, min(idx) as row_order, {_CELLS}, min(reported_at) as reported_at, coalesce(min(more), '') as more
from listed p join stamps s on p.file = s.file left join more m on p.file = m.file and p.page = m.page and p.line = m.line
group by 1, 2, 3
"""


def layout_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = landed_reports(spark, sf_dir)
    # The number of words comes from the footers of the landed table.
    return lay.dropped_words(reports.words, reports.lines, reports.cells, reports.words.count())


LAYOUT_DROPS = f"""with {PAGES_SQL}, {PLACED_SQL}
select file, 'title' as reason, count(*) as n_words from words where idx < 5 group by 1
union all
select file, case when is_header then 'header' when line is null then 'below_last_line' else 'outside_columns' end as reason,
  count(*) as n_words
from placed where is_header or line is null or name is null group by 1, 2
"""


def layout_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = landed_reports(spark, sf_dir)
    return lay.layout_faults(reports.words, reports.lines, reports.cells)


LAYOUT_FAULTS = f"""with {PAGES_SQL}, {PLACED_SQL},
good as (select distinct file from placed where not is_header and line is not null),
faults as (
  select doc_id as file, case when doc_id not in (select file from heads) then 'no_table'
    when doc_id not in (select file from complete) then 'header_not_placed'
    when doc_id not in (select file from good) then 'no_rows' end as fault
  from documents
)
select * from faults where fault is not null
"""

QUERIES: Registered = {
    "words_index": (words_index, WORDS_INDEX),
    "header_edges": (header_edges, f"with {PAGES_SQL}, {EDGES_SQL} select * from edges"),
    "column_ranges": (column_ranges, f"with {PAGES_SQL}, {RANGES_SQL} select * from ranges"),
    "row_boundaries": (row_boundaries, ROW_BOUNDARIES),
    "word_to_line": (word_to_line, WORD_TO_LINE),
    "word_to_column": (word_to_column, WORD_TO_COLUMN),
    "layout_rows": (layout_rows, LAYOUT_ROWS),
    "layout_drops": (layout_drops, LAYOUT_DROPS),
    "layout_faults": (layout_faults, LAYOUT_FAULTS),
}
