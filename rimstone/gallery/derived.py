"""Bronze game logs derived from `orders`, and decoded report pages derived from `documents`.

The driver's tables hold no sports data, so these give the sports jobs input that grows with them. The
expressions are plain SQL that both engines read; faults are planted by column values, for the checks to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rimstone.gallery.base import split_up, table
from rimstone.plans.injury_reports import DecodedReports
from rimstone.session import materialize

# Orders in one partition: they become up to four times as many rows of thirty columns, which are sorted there.
PARTITION_ORDERS = 200_000

# One row per order: a game between two teams.
GAME = {
    "k": "o_orderkey",
    "c": "o_custkey",
    "played": "o_orderdate",
    "st": "o_orderstatus",
    "pr": "o_orderpriority",
    "y": "cast(year(o_orderdate) as bigint)",
    "t0": "o_custkey % 30",
    "t1": "(o_custkey + 1 + o_orderkey % 29) % 30",
    "fgm0": "28 + (o_orderkey * 7) % 30",
    "fgm1": "28 + (o_orderkey * 11 + 5) % 30",
    "tpm0": "(o_orderkey + o_custkey) % 20",
    "tpm1": "(o_orderkey * 3 + 1) % 20",
    "ftm0": "(o_orderkey * 5) % 35",
    "ftm1": "(o_custkey * 3) % 35",
}
# One row per game and side; side 1 plays away.
SIDE = {
    **{c: c for c in ("k", "c", "played", "st", "pr", "y", "side")},
    "t": "case when side = 0 then t0 else t1 end",
    "opp": "case when side = 0 then t1 else t0 end",
    "fgm": "case when side = 0 then fgm0 else fgm1 end",
    "tpm": "case when side = 0 then tpm0 else tpm1 end",
    "ftm": "case when side = 0 then ftm0 else ftm1 end",
    "margin": "case when side = 0 then 1 else -1 end * (2 * fgm0 + tpm0 + ftm0 - 2 * fgm1 - tpm1 - ftm1)",
}
# One row per game, side and ingest: games with status F come twice with different times, those with status O
# twice with the same time, the others once.
VERSION = {
    **{c: c for c in ("k", "c", "played", "st", "pr", "y", "side", "t", "opp", "fgm", "tpm", "ftm", "margin", "ver")},
    "fga": "fgm + 30 + c % 31 + case when ver = 0 then 3 else 0 end",
    "tpa": "tpm + 10 + c % 25",
    "fta": "ftm + k % 12",
    "code": "'T' || case when t >= 26 then 'B' else 'A' end || chr(cast(65 + t % 26 as int))",
    "opp_code": "'T' || case when opp >= 26 then 'B' else 'A' end || chr(cast(65 + opp % 26 as int))",
    "label": "cast(y as string) || '-' || lpad(cast((y + 1) % 100 as string), 2, '0')",
    "source": "'league-game-logs-00-t-regular-season'",
}


def _share(made: str, tried: str) -> str:
    """Exact half-up share with three decimals, by integer arithmetic."""
    n, d = f"(2000 * {made} + {tried})", f"(2 * {tried})"
    return (
        f"case when {tried} = 0 then null else cast(({n} - {n} % {d}) / {d} as double) / cast(1000 as double) end"
    )


BRONZE = {
    "SEASON_ID": "' 2' || cast(y as string) || ' '",
    "TEAM_ID": "1610612737 + t",
    "TEAM_ABBREVIATION": "code",
    "TEAM_NAME": "'Team ' || cast(t as string) || '  '",
    "GAME_ID": "'00' || lpad(cast(k as string), 8, '0')",
    "GAME_DATE": "cast(cast(played as date) as string)",
    "MATCHUP": "code || case when side = 0 then ' vs. ' else ' @ ' end || opp_code",
    "WL": "case when margin > 0 then 'W' else 'L' end",
    "MIN": "240 + 25 * (k % 5) + case when pr = '1-URGENT' then 25 else 0 end",
    "FGM": "fgm",
    "FGA": "fga",
    "FG_PCT": _share("fgm", "fga") + " + case when pr = '2-HIGH' and side = 0 then cast(0.002 as double) else cast(0 as double) end",
    "FG3M": "tpm",
    "FG3A": "tpa",
    "FG3_PCT": _share("tpm", "tpa"),
    "FTM": "ftm",
    "FTA": "fta",
    "FT_PCT": _share("ftm", "fta"),
    "OREB": "k % 18",
    "DREB": "20 + c % 30",
    "REB": "k % 18 + 20 + c % 30 + case when pr = '3-MEDIUM' and side = 1 then 1 else 0 end",
    "AST": "5 + k % 40",
    "STL": "c % 26",
    "BLK": "k % 21",
    "TOV": "c % 36",
    "PF": "k % 41",
    "PTS": "2 * fgm + tpm + ftm - case when ver = 0 then 1 else 0 end",
    "PLUS_MINUS": "margin + case when pr = '4-NOT SPECIFIED' and side = 1 then 1 else 0 end",
    "VIDEO_AVAILABLE": "1",
    "season": "label",
    "_bronze_path": "'/bronze/' || case when st = 'P' and side = 1 then 'lost' else label end || '/' || source || '-v' || cast(ver as string) || '.parquet'",
    "_source_name": "source",
    "_ingested_at": "case when ver = 0 and st = 'F' then played + interval 1 day else played + interval 2 day end",
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in columns.items())


BRONZE_SQL = f"""
game as (select {_select(GAME)} from orders),
side as (select {_select(SIDE)} from (select *, unnest([0, 1]) as side from game)),
version as (
  select {_select(VERSION)}
  from (select *, unnest(case when st = 'P' then [1] else [0, 1] end) as ver from side)
),
bronze as (select {_select(BRONZE)} from version)
"""


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])

def bronze_game_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team game logs in bronze form, lineage columns included."""
    used = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"]
    games = _project(split_up(table(spark, sf_dir, "orders").select(*used), "o_orderkey", PARTITION_ORDERS), GAME)
    sides = _project(games.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))), SIDE)
    ingests = F.when(F.col("st") == "P", F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1)))
    return _project(_project(sides.withColumn("ver", F.explode(ingests)), VERSION), BRONZE)


# Decoded pages: a document is a report file with 240 words to a page, in columns of 100 points.
PAGE_WORDS = 240
# Words of the header band on the first page: text and column number; a second word lies 50 points further.
BAND = [
    ("Game", 0, 0), ("Date", 0, 1), ("Game", 1, 0), ("Time", 1, 1), ("Matchup", 2, 0), ("Team", 3, 0),
    ("Player", 4, 0), ("Name", 4, 1), ("Current", 5, 0), ("Status", 5, 1), ("Reason", 6, 0),
]
HEADERS = ["Game Date", "Game Time", "Matchup", "Team", "Player Name", "Current Status", "Reason"]
SPELLED = [h.replace(" ", "") for h in HEADERS]
WIDE = [f"C{i:02d}" for i in range(7, 70)]
NO_TABLE_SOURCE = "src3"
# Header words, headers and columns by source: without spaces, with an eighth column, with seventy columns, and with
# a header that is nowhere on the page; the rest have the seven.
USUAL = (BAND, HEADERS, 7)
SHAPES = {
    "src1": ([(h, i, 0) for i, h in enumerate(SPELLED)], SPELLED, 7),
    "src2": ([*BAND, ("League", 7, 0)], [*HEADERS, "League"], 8),
    "src4": (BAND, [*HEADERS, "Return Date"], 7),
    "src5": ([*BAND, *[(h, i, 0) for i, h in enumerate(WIDE, start=7)]], [*HEADERS, *WIDE], 70),
}


def _band_x0(band: list[tuple[str, int, int]]) -> list[int]:
    return [21 + 100 * c + 50 * s for _, c, s in band]


def _shape_sql(part) -> str:
    cases = " ".join(f"when '{source}' then {part(shape)}" for source, shape in SHAPES.items())
    return f"case source {cases} else {part(USUAL)} end"


PAGES_SQL = f"""
tokens as (
  select doc_id, source, lang, [x for x in string_split_regex(text, '[ \n]') if x <> ''] as ws,
    {_shape_sql(lambda shape: [w for w, _, _ in shape[0]])} as band, {_shape_sql(lambda shape: _band_x0(shape[0]))} as band_x0,
    {_shape_sql(lambda shape: shape[2])} as n_cols
  from documents
),
sheets as (
  select doc_id, source, lang, ws, unnest(range(1, greatest((len(ws) + {PAGE_WORDS - 1}) // {PAGE_WORDS}, 1) + 1)) as page
  from tokens
),
title as (
  select doc_id, page, unnest(['Injury', 'Report:', source, lang, cast(doc_id as varchar)]) as text, unnest(range(0, 5)) as idx
  from sheets
),
band as (
  select doc_id, cast(1 as bigint) as page, unnest(band) as text, unnest(range(5, 5 + len(band))) as idx,
    unnest(band_x0) + doc_id % 7 as x0
  from tokens
),
body as (
  select doc_id, n // {PAGE_WORDS} + 1 as page, text, n % {PAGE_WORDS} as k, n_band, n_cols
  from (select doc_id, unnest(ws) as text, unnest(range(0, len(ws))) as n, len(band) as n_band, n_cols from tokens)
),
words as (
  select doc_id as file, page, idx, text, 0.0::double as x0, 1.0::double as x1, 20.0::double as bottom from title
  union all
  select doc_id, page, idx, text, x0::double, (x0 + 40)::double, 50.0::double from band
  union all
  select doc_id, page, case when page = 1 then 5 + n_band else 5 end + k, text,
    (20 + 100 * (k % n_cols) + doc_id % 7 + (k * 13) % 60)::double,
    (20 + 100 * (k % n_cols) + doc_id % 7 + (k * 13) % 60 + 5 * length(text))::double,
    (60 + 12 * (k // n_cols))::double
  from body
),
lines as (select doc_id as file, page, (60 + 36 * unnest(range(0, 12)))::double as bottom from sheets),
heads as (
  select doc_id as file, unnest(range(0, len(names))) as pos, unnest(names) as name
  from (select doc_id, {_shape_sql(lambda shape: shape[1])} as names from documents where source <> '{NO_TABLE_SOURCE}')
)
"""


def _by_source(part) -> Column:
    """The value that `part` gives for the shape of the row's source."""
    chosen = None
    for source, shape in SHAPES.items():
        case = (F.col("source") == source, F.lit(part(shape)))
        chosen = F.when(*case) if chosen is None else chosen.when(*case)
    return chosen.otherwise(F.lit(part(USUAL)))


def decoded_reports(spark: SparkSession, sf_dir: str) -> DecodedReports:
    """Words, lines and header cells of the documents laid out as report pages.

    Documents of one source have no table; those of some others have headers of their own, see `SHAPES`.
    """
    docs = split_up(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    tokens = docs.select(
        F.col("doc_id").alias("file"),
        "source",
        "lang",
        # A single character splits much faster than a pattern.
        F.array_remove(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " "), "").alias("tokens"),
    )
    n_pages = F.greatest(F.ceil(F.size("tokens") / PAGE_WORDS), F.lit(1))
    pages = F.transform(
        F.sequence(F.lit(1).cast("bigint"), n_pages),
        lambda p: F.struct(
            p.alias("page"),
            F.slice("tokens", ((p - 1) * PAGE_WORDS + 1).cast("int"), F.lit(PAGE_WORDS)).alias("body"),
        ),
    )
    sheets = tokens.select("file", "source", "lang", F.inline(pages))

    title = F.array(F.lit("Injury"), F.lit("Report:"), "source", "lang", F.col("file").cast("string"))
    band = _by_source(lambda shape: [w for w, _, _ in shape[0]])
    shown = F.when(F.col("page") == 1, band).otherwise(F.array().cast("array<string>"))
    # What depends on the page alone is worked out before its words come apart.
    n_first = _by_source(lambda shape: 5 + len(shape[0]))
    placed = sheets.select(
        "file",
        "source",
        "page",
        (F.col("file") % 7).alias("shift"),
        _by_source(lambda shape: shape[2]).alias("n_cols"),
        F.when(F.col("page") == 1, n_first).otherwise(5).alias("n_before"),
        F.posexplode(F.concat(title, shown, "body")).alias("idx", "text"),
    )

    shift, n_cols, n_before = F.col("shift"), F.col("n_cols"), F.col("n_before")
    is_title, is_band = F.col("idx") < 5, F.col("idx") < n_before
    k = F.col("idx") - n_before
    band_x0 = F.element_at(_by_source(lambda shape: _band_x0(shape[0])), F.col("idx") - 4) + shift
    body_x0 = 20 + 100 * (k % n_cols) + shift + (k * 13) % 60
    x0 = F.when(is_title, 0).when(is_band, band_x0).otherwise(body_x0)
    x1 = F.when(is_title, 1).when(is_band, band_x0 + 40).otherwise(body_x0 + 5 * F.length("text"))
    bottom = F.when(is_title, 20).when(is_band, 50).otherwise(60 + 12 * F.floor(k / n_cols))
    words = placed.select(
        "file",
        "page",
        "idx",
        "text",
        x0.cast("double").alias("x0"),
        x1.cast("double").alias("x1"),
        bottom.cast("double").alias("bottom"),
    )
    rules = F.array(*[F.lit(60.0 + 36 * j) for j in range(12) for _ in range(2)])
    page_list = tokens.select("file", F.explode(F.sequence(F.lit(1).cast("bigint"), n_pages)).alias("page"))
    lines = page_list.select("file", "page", F.explode(rules).alias("bottom"))
    names = _by_source(lambda shape: shape[1])
    unusable = F.array(F.lit(None).cast("string"), F.lit("Home/Away"))
    listed = F.concat(F.slice(names, 1, 3), unusable, F.slice(names, 4, F.size(names)))
    cells = docs.where(F.col("source") != NO_TABLE_SOURCE).select(
        F.col("doc_id").alias("file"), F.posexplode(listed).alias("pos", "name")
    )
    return DecodedReports(words, lines, cells)


def landed_reports(spark: SparkSession, sf_dir: str) -> DecodedReports:
    """The same with words and lines written to tables, as a decoder would leave them for the jobs after it."""
    decoded = decoded_reports(spark, sf_dir)
    return DecodedReports(materialize(decoded.words, "words"), materialize(decoded.lines, "lines"), decoded.cells)
