"""The layout job: step literals, golden rows, and random pages against SQL."""

import random

import duckdb
import pandas as pd
import pytest
from conftest import rows

from rimstone.errors import LayoutFault
from rimstone.gallery.layout import PLACED_SQL
from rimstone.operators import layout as lay
from rimstone.plans.injury_reports import PLACE_COLUMNS, REPORT_COLUMNS, DecodedReports, parse_reports
from rimstone.sources.datasets import INJURY_COLUMNS

WORDS = "file string, page int, idx int, text string, x0 double, x1 double, bottom double"
LINES = "file string, page int, bottom double"
CELLS = "file string, pos int, name string"
TITLE = [("Injury", 0, 1, 5), ("Report:", 2, 3, 5), ("06/13/26", 4, 5, 5), ("12:45", 6, 7, 5), ("PM", 8, 9, 5)]


def page(words, number=1, file="a"):
    return [(file, number, i, t, float(x0), float(x1), float(b)) for i, (t, x0, x1, b) in enumerate(words)]


def frames(spark, words, lines, cells, file="a"):
    return (
        spark.createDataFrame(words, WORDS),
        spark.createDataFrame([(file, p, float(b)) for p, b in lines], LINES),
        spark.createDataFrame([(file, i, c) for i, c in enumerate(cells)], CELLS),
    )


def edges_of(spark, words, names):
    w, _, c = frames(spark, words, [], names)
    return {r["name"]: r["left_edge"] for r in lay.header_edges(w, lay.header_lists(c)).collect()}


def test_header_cells_without_slash_or_null(spark):
    _, _, cells = frames(spark, page(TITLE), [], ["Game/Date", "Team", "Player Name", None])
    (row,) = lay.header_lists(cells).collect()
    assert [(h["pos"], h["name"]) for h in row["headers"]] == [(0, "Team"), (1, "Player Name")]


def test_header_of_one_and_of_two_words(spark):
    words = page(TITLE + [("Team", 100, 130, 20), ("Player", 200, 250, 20)])
    assert edges_of(spark, words, ["Team"]) == {"Team": 99.0}
    words = page(TITLE + [("Current", 300, 345, 20), ("Status", 347, 385, 20)])
    assert edges_of(spark, words, ["Current Status"]) == {"Current Status": 299.0}


def test_last_word_opens_no_header(spark):
    assert edges_of(spark, page(TITLE + [("Team", 100, 130, 20)]), ["Team"]) == {}


def test_a_word_opens_one_header_and_first_place_wins(spark):
    # "Game" + "Time" fits both headers that start with Game and end with Time: the first takes the first pair.
    words = page([("Game", 10, 20, 1), ("Time", 21, 30, 1), ("Game", 50, 60, 1), ("Time", 61, 70, 1), ("x", 80, 90, 1)])
    assert edges_of(spark, words, ["Game Time", "Game Over Time"]) == {"Game Time": 9.0, "Game Over Time": 49.0}


def test_ranges(spark):
    edges = spark.createDataFrame(
        [("a", 0, "Team", 10.0), ("a", 1, "Player", 100.0), ("a", 2, "Status", 200.0)],
        "file string, pos int, name string, left_edge double",
    )
    got = {r["name"]: (r["left_edge"], r["right_edge"]) for r in lay.column_ranges(edges).collect()}
    assert got == {"Team": (10.0, 100.0), "Player": (100.0, 200.0), "Status": (200.0, 700.0)}


def test_row_boundaries_are_distinct(spark):
    _, lines, _ = frames(spark, page(TITLE), [(1, 50), (1, 20), (1, 50), (1, 80)], [])
    assert [r["bottom"] for r in lay.row_boundaries(lines).orderBy("bottom").collect()] == [20.0, 50.0, 80.0]


def test_word_goes_to_the_first_line_at_or_below_it(spark):
    data = [("NYK", 50, 80, 30), ("Robinson", 100, 160, 60), ("edge", 0, 1, 70), ("low", 0, 1, 101), ("top", 0, 1, 1)]
    words, lines, _ = frames(spark, page(TITLE + data), [(1, 40), (1, 70), (1, 100)], [])
    got = {r["text"]: r["line"] for r in lay.words_to_lines(lay.data_words(words), lines).collect()}
    assert got == {"NYK": 40.0, "Robinson": 70.0, "edge": 70.0, "top": 40.0}


def test_lines_found_across_empty_bands(spark):
    far = 648.0
    words, lines, _ = frames(spark, page([("w", 0, 1, 3)]), [(1, far), (1, far + 1)], [])
    assert rows(lay.words_to_lines(words, lines).select("line")) == [(far,)]


HEADER = [
    ("GameDate", 21, 60, 50), ("GameTime", 101, 140, 50), ("Matchup", 201, 240, 50), ("Team", 301, 340, 50),
    ("PlayerName", 401, 440, 50), ("CurrentStatus", 501, 540, 50), ("Reason", 601, 640, 50),
]
GOLDEN_ROWS = [
    ("06/13/2026", 22, 90, 60), ("08:30(ET)", 102, 160, 60), ("NYK@SAS", 202, 260, 60),
    ("NewYorkKnicks", 302, 380, 60), ("Robinson,Mitchell", 402, 490, 60), ("Available", 502, 560, 60),
    ("Injury/Illness-RightHand;Fractured", 602, 800, 60), ("Right5thMetacarpal", 602, 700, 72),
    ("SanAntonioSpurs", 302, 380, 100), ("Kornet,Luke", 402, 490, 100), ("Questionable", 502, 560, 100),
    ('Injury/Illness-"";Illness', 602, 800, 100),
]
SPELLED = ["GameDate", "GameTime", "Matchup", "Team", "PlayerName", "CurrentStatus", "Reason"]


def golden(spark, cells=SPELLED):
    return DecodedReports(*frames(spark, page(TITLE + HEADER + GOLDEN_ROWS), [(1, 55), (1, 80), (1, 110)], cells))


def test_golden_report(spark):
    table = parse_reports(golden(spark))
    assert tuple(table.columns) == (*INJURY_COLUMNS, "more", *PLACE_COLUMNS)
    reported = "06/13/26 12:45 PM"
    assert rows(table.select(*INJURY_COLUMNS)) == sorted(
        [
            ("06/13/2026", "08:30(ET)", "NYK@SAS", "NewYorkKnicks", "Robinson,Mitchell", "Available",
             "Injury/Illness-RightHand;Fractured Right5thMetacarpal", reported),
            (None, None, None, "SanAntonioSpurs", "Kornet,Luke", "Questionable", 'Injury/Illness-"";Illness', reported),
        ],
        key=repr,
    )


@pytest.mark.parametrize(
    ("cells", "words", "fault"),
    [
        ([None, "Home/Away"], HEADER + GOLDEN_ROWS, lay.NO_TABLE),
        ([*SPELLED, "Return"], HEADER + GOLDEN_ROWS, lay.HEADER_NOT_PLACED),
        (SPELLED, [*HEADER, ("Team", 0, 1, 60)], lay.NO_ROWS),
    ],
)
def test_faults_are_named(spark, cells, words, fault):
    made = DecodedReports(*frames(spark, page(TITLE + words), [(1, 55), (1, 80), (1, 110)], cells))
    assert rows(lay.layout_faults(made.words, made.lines, made.cells)) == [("a", fault)]
    with pytest.raises(LayoutFault, match=fault):
        parse_reports(made)
    assert parse_reports(made, strict=False).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_random_pages_against_sql(spark, seed):
    duck = duckdb.connect()
    dice = random.Random(seed)
    names = ["Team", "Game Date", "Game Time", "Status"]
    # No word of these begins two headers at once, which the SQL does not tell apart.
    vocabulary = ["Game", "Date", "Time", "Team", "Status", "T", "us", "NYK", "out", "x", "Dat", "me"]
    words, lines = [], []
    for number in (1, 2, 3):
        band = [("Status", 310, 330, 9), ("Game", 110, 120, 9), ("Date", 121, 130, 9)] if number == 1 else []
        band += [("Game", 210, 220, 9), ("Time", 221, 230, 9), ("Team", 10, 30, 9)] if number == 1 else []
        body = [
            (dice.choice(vocabulary), x0 := dice.randrange(0, 400, 5), x0 + dice.randrange(1, 60), dice.randrange(10, 300))
            for _ in range(60)
        ]
        words += page(TITLE + band + body if seed % 2 else TITLE + body[:8] + band + body[8:], number)
        lines += [(number, dice.randrange(10, 280)) for _ in range(8)] * 2
    w, ln, c = frames(spark, words, lines, names)
    table = lay.table_rows(w, ln, c, names)
    duck.register("words", w.toPandas())
    duck.register("lines", ln.toPandas())
    duck.register("heads", pd.DataFrame({"file": "a", "pos": range(len(names)), "name": names}))
    cell = "nullif(coalesce(string_agg(text, ' ' order by idx) filter (name = '{}'), ''), '')"
    wanted = duck.sql(
        f"with {PLACED_SQL} select page, line, min(idx), {', '.join(map(cell.format, names))} from placed "
        "where not is_header and line is not null group by 1, 2"
    )
    got = {tuple(r) for r in table.select("page", "line", "row_order", "team", "game_date", "game_time", "status").collect()}
    assert got == set(wanted.fetchall()) and got
    counted = lay.dropped_words(w, ln, c).groupBy().sum("n_words").first()[0]
    assert 0 < counted < len(words)


def test_hot_page_is_laid_out_whole(spark):
    """One page holds most words, all at one height; nothing is lost."""
    many = [("w", 22, 30, 60)] * 3000
    w, ln, c = frames(spark, page(TITLE + HEADER + many) + page(TITLE + many[:5], 2), [(1, 55), (1, 80), (2, 80)], SPELLED)
    got = lay.table_rows(w.repartition(7), ln, c, SPELLED).select("page", "game_date").collect()
    assert {(r["page"], r["game_date"].count("w")) for r in got} == {(1, 3000), (2, 5)}


def test_report_column_names_are_the_seven():
    assert [c.replace(" ", "") for c in REPORT_COLUMNS] == SPELLED


def test_spellings_mix_and_all_columns_stay(spark):
    """Files with and without spaces in their headers, with an eighth column, and with eighty."""
    lines = [(1, 55), (1, 80), (1, 110)]
    spaced = [("Game", 21, 50, 50), ("Date", 51, 60, 50), ("League", 701, 740, 50), *HEADER[1:]]
    wide = [(f"C{i:02d}", 1000 + 100 * i, 1040 + 100 * i, 50) for i in range(80)]
    cells = {"a": SPELLED, "b": ["Game Date", *SPELLED[1:], "League"], "c": [*SPELLED, *[w[0] for w in wide]]}
    data = {"a": HEADER, "b": spaced, "c": HEADER + wide}
    extra = {"a": [], "b": [("summer", 702, 760, 60)], "c": [("far", 8902, 8930, 60)]}
    made = [frames(spark, page(TITLE + data[f] + GOLDEN_ROWS + extra[f], file=f), lines, cells[f], f) for f in cells]
    w, ln, c = (a.union(b).union(c) for a, b, c in zip(*made))
    table = parse_reports(DecodedReports(w, ln, c)).where("matchup is not null")
    got = {r["file"]: (r["game_date"], {k: v for k, v in r["more"].items() if v}) for r in table.collect()}
    day = "06/13/2026"
    assert got == {"a": (day, {}), "b": (day, {"league": "summer"}), "c": (day, {"c79": "far"})}


def test_all_faults_are_stored(spark, tmp_path):
    words = [w for i in range(30) for w in page([*TITLE, *HEADER, ("low", 22, 30, 60)], file=f"f{i:02d}")]
    w, ln, c = frames(spark, words, [(1, 55)], SPELLED, "f00")
    store = str(tmp_path / "faults")
    with pytest.raises(LayoutFault, match="30 files cannot be laid out: f00: no_rows; f01: no_table.*all in"):
        parse_reports(DecodedReports(w, ln, c), fault_store=store)
    assert spark.read.parquet(store).count() == 30


def test_stretches_hold_every_row_in_any_order(spark):
    """Repeated, missing and scattered words come back as they were, and words in order share a row."""
    made = [("a", 1, i, f"w{i}") for i in (0, 1, 2, 2, 5)] + [("b", 1, 0, None), (None, 1, 1, "n"), ("a", 1, 6, "late")]
    df = spark.createDataFrame(made, "file string, page int, idx int, text string").coalesce(1)
    stretches = lay.packed(df, ["file", "page"], counting="idx").collect()
    back = [(r["file"], r["page"], n + i, t) for r in stretches for i, (n, t) in enumerate(zip(r["idx"], r["text"]))]
    assert sorted(back, key=repr) == sorted(made, key=repr) and len(stretches) == 4


def test_words_per_file_counts_repeated_words_of_the_time(spark):
    w = spark.createDataFrame(page(TITLE + [("abc", 0, 1, 9)] * 2) * 2 + page(TITLE, 2), WORDS)
    assert rows(lay.words_per_file(w)) == [("a", "06/13/26 06/13/26 12:45 12:45 PM PM", 4, 12)]


def test_texts_that_are_part_of_no_header_are_not_carried(spark):
    texts = ["Pla", "Player", "me", "Team", "", None, "other", "a\u001fb"]
    words = spark.createDataFrame([("a", 1, i, t, 0.0, 1.0, 9.0) for i, t in enumerate(texts)], WORDS)
    cells = spark.createDataFrame([("a", 0, "Player Name"), ("b", 0, "Team")], CELLS)
    got = rows(lay.with_plain_texts(words, lay.header_lists(cells)).select("idx", "text"), "idx")
    assert [t for _, t in got] == ["Pla", "Player", "me", "Team", "", None, lay.PLAIN, "a\u001fb"]


def test_faults_gather_words_of_the_first_page_only_and_once(spark):
    """Lists of words are shuffled for the headers alone; which files have rows is found from one row for each text."""
    body = [("Team", 100, 130, 20), ("x", 110, 120, 30), ("y", 110, 120, 90), ("z", 110, 120, 70)]
    words, lines, cells = frames(spark, page(TITLE + body), [(1, 60)], ["Team"])
    faults = lay.layout_faults(words, lines, cells)
    assert rows(faults) == []
    assert faults._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    with_rows = lay.files_with_rows(words, lines.where("bottom < 30"), lay.header_lists(cells))
    assert rows(with_rows) == []
    unread = spark.createDataFrame([("a", 1, 9, None, 110.0, 120.0, 10.0)], WORDS)
    assert rows(lay.files_with_rows(unread, lines, lay.header_lists(cells))) == []


def test_columns_are_counted_without_texts(spark):
    from conftest import SF_DIR

    from rimstone.gallery.layout import word_to_column

    plan = word_to_column(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert [line for line in plan.splitlines() if "MapInArrow" in line and "n_chars" in line]


def test_drops_carry_texts_of_headers_only_and_deal_many_words_wider(spark, monkeypatch):
    body = [("Team", 100, 130, 20), ("x", 110, 120, 30), ("y", 90, 120, 30), ("z", 110, 120, 70)]
    words, lines, cells = frames(spark, page(TITLE + body), [(1, 60)], ["Team"])
    carried, plain = [], lay.placed_words

    def seen(given, *others, **named):
        carried.extend(r["text"] for r in given.where("idx >= 5").orderBy("idx").collect())
        return plain(given, *others, **named)

    monkeypatch.setattr(lay, "placed_words", seen)
    monkeypatch.setattr(lay, "PARTITION_WORDS", 1)
    want = [("a", "below_last_line", 1), ("a", "header", 1), ("a", "outside_columns", 1), ("a", "title", 5)]
    assert rows(lay.dropped_words(words, lines, cells)) == want
    assert carried == ["Team", None, None, None]
    sized = lay.dropped_words(words, lines, cells, 9)
    assert rows(sized) == want
    # Both shuffles of words, by file and by page, are as wide as their number asks for.
    assert sized._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 2


def test_stretches_of_words_are_read_as_they_were(spark):
    """Numbers that count on or not, texts that are long, empty or missing, and places that are missing or no number."""
    import numpy as np
    import pyarrow as pa

    from rimstone.operators.stretches import NO_IDX, NO_PLACE, NO_TEXT, per_chunk, read, stretched

    made = [("a", 1, 5, "é", 1.5, -2.0), ("a", 1, 6, "x" * 300, float("nan"), 1e300), ("a", 2, 0, "", None, 0.1)]
    made += [("a", 2, 0, None, 3.0, None), ("b", 1, 9, "z", 0.0, 0.0), ("b", 1, 4, "y", 7.0, 8.0), ("b", 1, None, "n", 1.0, 1.0)]
    words = spark.createDataFrame(made, "file string, page int, idx int, text string, x0 double, x1 double").coalesce(1)
    stretches = stretched(words, ["file", "page"], ["x0", "x1"]).collect()
    assert [(r["file"], r["page"]) for r in stretches] == [("a", 1), ("a", 2), ("b", 1)]
    parts = pa.array([[bytes(r["stretch"])] for r in stretches] + [None, []], pa.list_(pa.binary()))
    got = read(parts, 2)
    assert got.row.tolist() == [0, 0, 1, 1, 2, 2, 2] and got.bounds.tolist() == [0, 2, 4, 7, 7, 7]
    assert got.text.to_pylist() == [None if w[3] is None else w[3].encode() for w in made]
    assert got.idx.tolist() == [w[2] or 0 for w in made]
    assert got.null(NO_IDX).tolist() == [w[2] is None for w in made]
    assert got.null(NO_TEXT).tolist() == [w[3] is None for w in made]
    for i, place in enumerate(got.places):
        assert got.null(NO_PLACE << i).tolist() == [w[4 + i] is None for w in made]
        np.testing.assert_array_equal(place, [w[4 + i] or 0.0 for w in made])
    batch = pa.RecordBatch.from_arrays([parts], names=["parts"])
    pieces = [p.num_rows for p in per_chunk(lambda b: b)(iter([batch]))]
    assert sum(pieces) == 5


def test_words_of_one_number_go_by_their_text(spark):
    """Numbers that come twice, on the first page and in a cell, whatever order the words lie in."""
    words = page([*TITLE, ("Game", 21, 30, 50), ("Time", 41, 50, 50), ("late", 30, 40, 60), ("x", 1, 2, 300)])
    words += [("a", 1, i, t, x0, x0 + 5, 60.0) for i, t, x0 in ((5, "Gam", 90.0), (7, "early", 31.0), (7, None, 31.0), (7, "late", 32.0))]
    made = frames(spark, words[::-1], [(1, 80)], ["Game Time"])
    w, ln, c = (df.repartition(3) for df in made)
    # "Gam" (5) comes before "Game" (5), which "Time" follows.
    assert edges_of(spark, words[::-1], ["Game Time"]) == {"Game Time": 20.0}
    (row,) = lay.table_rows(w, ln, c, ["Game Time"]).collect()
    assert (row["row_order"], row["game_time"], row["more"]) == (7, "early late late", {})
    # "Gam" begins a header; the word without text is in no row and in no list of reasons, as it lies in a column.
    assert rows(lay.dropped_words(w, ln, c)) == [("a", "below_last_line", 1), ("a", "header", 3), ("a", "title", 5)]


def test_places_that_are_no_number_or_missing(spark):
    """As Spark compares them: NaN is right of everything, and what is missing lies nowhere."""
    nan = float("nan")
    body = [("Team", 100, 130, 20), ("x", nan, 120, 30), ("y", 110, nan, 30), ("z", 110, 120, nan)]
    words = page(TITLE + body) + [("a", 1, 9, "n", None, 120.0, 30.0), ("a", 1, 10, "o", 110.0, None, 30.0)]
    words, lines, cells = frames(spark, words, [(1, 60)], ["Team"])
    (row,) = lay.table_rows(words, lines, cells, ["Team"]).collect()
    assert (row["row_order"], row["team"]) == (6, "x")
    want = [("a", "below_last_line", 1), ("a", "header", 1), ("a", "outside_columns", 3), ("a", "title", 5)]
    assert rows(lay.dropped_words(words, lines, cells)) == want


def test_headers_longer_than_those_looked_up(spark):
    long = "h" * 100
    words = page([*TITLE, (long, 10, 20, 50), ("b", 30, 40, 50), ("h" * 70, 12, 14, 60), ("w", 12, 14, 60), ("h", 12, 14, 60)])
    words, lines, cells = frames(spark, words, [(1, 80)], [long])
    assert [r["left_edge"] for r in lay.header_edges(words, lay.header_lists(cells)).collect()] == [9.0]
    (row,) = lay.table_rows(words, lines, cells, [long]).collect()
    assert row[long] == "b w"


def test_rows_are_placed_in_batches_and_dealt_by_their_number(spark, monkeypatch):
    """No word comes apart from its page in a plan, and both shuffles of words are as wide as their number asks for."""
    monkeypatch.setattr(lay, "PARTITION_WORDS", 1)
    table = parse_reports(golden(spark), strict=False, n_words=24)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2 and plan.count("MapInArrow") == 3 and "Generate inline" not in plan
    assert table.count() == 2
