"""Injury reports: from decoded page words and lines to one table of rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from rimstone.operators.layout import enforce_layout, faults_of, file_layouts, header_lists, rows_of
from rimstone.session import materialize
from rimstone.sources.datasets import INJURY_COLUMNS

# Columns of the report table.
REPORT_COLUMNS = ["Game Date", "Game Time", "Matchup", "Team", "Player Name", "Current Status", "Reason"]

# Where a row comes from; `row_order` gives the order of a page's rows.
PLACE_COLUMNS = ("file", "page", "line", "row_order")


@dataclass(frozen=True)
class DecodedReports:
    """What a page decoder yields for all files: words, ruled lines, and the cells of the header row."""

    words: DataFrame
    lines: DataFrame
    cells: DataFrame


def parse_reports(
    reports: DecodedReports, *, strict: bool = True, fault_store: str | None = None, n_words: int | None = None
) -> DataFrame:
    """Rows of all reports: the report's columns, all other columns of a file in the map `more`, and the row's place.

    Headers are matched by their snake-case name, so files that spell them differently can be read together. With
    `strict` any file that cannot be laid out stops the job: the error names some of these files, and
    `fault_store` is where all of them are written. The rows are worked out once. `n_words`, if known, sizes the tasks.
    """
    headers = header_lists(reports.cells)
    layouts = file_layouts(reports.words, headers, n_words)
    rows = rows_of(reports.words, reports.lines, layouts, REPORT_COLUMNS, n_words)
    rows = rows.select(*INJURY_COLUMNS, "more", *PLACE_COLUMNS)
    if strict:
        layouts, rows = materialize(layouts, "report-layouts"), materialize(rows, "report-rows")
        files = reports.words.select("file").unionByName(reports.cells.select("file"))
        enforce_layout(faults_of(files, headers, layouts, rows), fault_store)
    return rows
