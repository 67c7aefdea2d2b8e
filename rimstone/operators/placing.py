"""Where the words of report pages belong: headers and column edges of files, cells of rows, and words in no cell.

All functions take Arrow batches of rows with a list of stretches each (`stretches`) and go through their words
together. Texts and doubles compare as Spark compares them: texts by their bytes, NaN above all numbers, null as unknown.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from rimstone.operators.stretches import NO_IDX, NO_PLACE, NO_TEXT, Words, binary, bounds, chunks, read

# Functions of this module travel to executors by value, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words 0-1 of a page are its title, 2-4 its time, data starts at 5; the last column is 500
# points wide; a column starts 1 point left of its header's first word.
STAMP_FROM = 2
DATA_FROM = 5
LAST_COLUMN_WIDTH = 500.0
LEFT_OFFSET = 1.0

# Stands between headers in one text; no word and no header contains it.
SEPARATOR = "\u001f"
MARK = SEPARATOR.encode()

# Beginnings and ends of headers are looked up in one set up to so many bytes, longer texts are compared one by one.
LOOKED_UP = 64

# Places of the words of a first page, and of the words of a body.
FIRST_PLACES = ("x0",)
BODY_PLACES = ("x0", "x1", "bottom")


def string(column: pa.Array) -> pa.Array:
    options = pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True)
    return pc.cast(column, options=options)


def lengths_of(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


def joined_runs(texts: pa.Array, counts: np.ndarray) -> pa.Array:
    """One text for each run of so many texts, with spaces between."""
    runs = pa.ListArray.from_arrays(pa.array(bounds(counts).astype(np.int32)), texts.cast(pa.binary()))
    return pc.binary_join(runs, b" ")


def reading_order(words: Words) -> np.ndarray:
    """The words of each row by number; those of one number by text and then by place."""
    order, no_idx = np.arange(len(words.row)), words.null(NO_IDX)
    back = (words.row[1:] == words.row[:-1]) & (words.idx[1:] <= words.idx[:-1])
    odd = np.union1d(words.row[1:][back], words.row[no_idx])
    no_place, place = words.null(NO_PLACE), words.places[0]
    for r in odd.tolist():
        a, b = words.bounds[r], words.bounds[r + 1]
        texts = words.text.slice(a, b - a).to_pylist()

        def key(i, a=a, texts=texts):
            text = texts[i - a]
            at = (False, False, 0.0) if no_place[i] else (True, place[i] != place[i], 0.0 if place[i] != place[i] else place[i])
            return (not no_idx[i], 0 if no_idx[i] else words.idx[i], text is not None, text or b"", at)

        order[a:b] = sorted(range(a, b), key=key)
    return order


def told(words: Words, lines: pa.Array, test: Callable[[bytes, bytes], bool]) -> np.ndarray:
    """Whether `test` holds for a word's text and the header line of its row; false without either.

    It may hold only for a text that begins or ends a header. Texts are looked up once each among the headers of all
    rows, and only for those that may be part of one is the test made, once for each text and header line.
    """
    texts, values = words.text.dictionary_encode(), binary(lines).dictionary_encode()
    known = values.dictionary.to_pylist()
    names = {name for line in known for name in line.split(MARK)}
    parts = {part for n in names for i in range(min(len(n), LOOKED_UP) + 1) for part in (n[:i], n[len(n) - i :])}
    likely = pc.or_(
        pc.is_in(texts.dictionary, value_set=pa.array(parts, texts.dictionary.type)),
        pc.or_(pc.greater(pc.binary_length(texts.dictionary), LOOKED_UP), pc.match_substring(texts.dictionary, MARK)),
    ).to_numpy(zero_copy_only=False)
    codes = texts.indices.fill_null(len(likely)).to_numpy()
    rows = values.indices.fill_null(-1).to_numpy().astype(np.int64)[words.row]
    asked = np.flatnonzero(np.append(likely, False)[codes] & (rows >= 0))
    pairs, place = np.unique(rows[asked] * len(likely) + codes[asked], return_inverse=True)
    text, line = pairs % max(len(likely), 1), pairs // max(len(likely), 1)
    named = texts.dictionary.take(pa.array(text)).to_pylist()
    answers = np.array([test(t, known[i]) for t, i in zip(named, line.tolist())], dtype=bool)
    found = np.zeros(len(codes), dtype=bool)
    found[asked] = answers[place]
    return found


def opened_headers(names: list[bytes], text: bytes, next_text: bytes) -> list[int]:
    return [i for i, h in enumerate(names) if h == text or (h.startswith(text) and h.endswith(next_text))]


def first_page_layouts(batch: pa.RecordBatch) -> tuple[pa.Array, list]:
    """Report time, and the headers found with their left edges by position, of each row of `parts` and `names`."""
    words, listed = read(batch.column("parts"), len(FIRST_PLACES)), batch.column("names")
    at, flat = bounds(lengths_of(listed)).tolist(), binary(listed.flatten()).to_pylist()
    names = [flat[a:b] for a, b in zip(at, at[1:])]
    lines = [MARK + MARK.join(n) + MARK if n else None for n in names]
    order = reading_order(words)
    no_idx, no_text = words.null(NO_IDX)[order], words.null(NO_TEXT)[order]
    row, idx = words.row, words.idx[order]

    stamp = (idx >= STAMP_FROM) & (idx < DATA_FROM) & ~no_idx & ~no_text
    times = joined_runs(words.text.take(pa.array(order[stamp])), np.bincount(row[stamp], minlength=batch.num_rows))

    # A word that begins no header of its file opens none, and neither does the last word of a page.
    begins = told(words, pa.array(lines, pa.binary()), lambda text, line: MARK + text in line)[order]
    opening = np.flatnonzero(begins[:-1] & (row[1:] == row[:-1]) & ~no_text[1:])
    first, then = order[opening], order[opening + 1]
    texts, next_texts = (words.text.take(pa.array(i)).to_pylist() for i in (first, then))
    known, matches = {}, [[] for _ in range(batch.num_rows)]
    numbers = zip(
        row[opening].tolist(), words.idx[first].tolist(), words.null(NO_IDX)[first].tolist(),
        words.places[0][first].tolist(), words.null(NO_PLACE)[first].tolist(),
    )
    for (r, number, unnumbered, x0, unplaced), text, next_text in zip(numbers, texts, next_texts):
        pair = (lines[r], text, next_text)
        if pair not in known:
            known[pair] = opened_headers(names[r], text, next_text)
        if known[pair]:
            place = (not unplaced, x0 != x0, 0.0 if unplaced or x0 != x0 else x0)
            matches[r].append(((not unnumbered, number), place, known[pair], None if unplaced else x0 - LEFT_OFFSET))

    found = []
    for mine, headers in zip(matches, names):
        placed = {}
        for *_, opened, left_edge in sorted(mine, key=lambda m: m[:3]):
            free = next((pos for pos in opened if pos not in placed), None)
            if free is not None:
                placed[free] = left_edge
        found.append([(pos, headers[pos], placed[pos]) for pos in sorted(placed)])
    return times, found


def layouts(parts: pa.Array, names: pa.Array) -> pa.Array:
    """`reported_at` and `ranges` of files, from the stretches of their first pages and the names of their headers."""
    times, found = [], []
    for chunk in chunks(pa.RecordBatch.from_arrays([parts, names], names=["parts", "names"])):
        some_times, some = first_page_layouts(chunk)
        times.append(some_times)
        found += some
    positions, headers, lefts, rights = [], [], [], []
    for edges in found:
        for i, (pos, name, left) in enumerate(edges):
            after = edges[i + 1][2] if i + 1 < len(edges) else None
            positions.append(pos)
            headers.append(name)
            lefts.append(left)
            rights.append(after if after is not None or left is None else left + LAST_COLUMN_WIDTH)
    fields = [pa.array(positions, pa.int32()), string(pa.array(headers, pa.binary()))]
    fields += [pa.array(values, pa.float64()) for values in (lefts, rights)]
    each = pa.StructArray.from_arrays(fields, names=["pos", "name", "left_edge", "right_edge"])
    ranges = pa.ListArray.from_arrays(pa.array(bounds(np.array([len(f) for f in found], np.int64)).astype(np.int32)), each)
    reported = string(pa.concat_arrays(times)) if times else pa.array([], pa.string())
    return pa.StructArray.from_arrays([reported, ranges], names=["reported_at", "ranges"])


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column, and which of them there are."""
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


class PlacedWords:
    """The body words of pages with what is known of them: which belong to a line, and which are part of a header."""

    def __init__(self, pages: pa.RecordBatch):
        self.words = words = read(pages.column("parts"), len(BODY_PLACES))
        self.pages = pages
        lines = pages.column("stops")
        n_lines = lengths_of(lines)
        self.stops, self.first_stop = lines.flatten().to_numpy(zero_copy_only=False), bounds(n_lines)
        self.line = np.zeros(len(words.row), np.int64)
        bottom = words.places[2]
        for p in range(pages.num_rows):
            mine = slice(words.bounds[p], words.bounds[p + 1])
            self.line[mine] = np.searchsorted(self.stops[self.first_stop[p] : self.first_stop[p + 1]], bottom[mine])
        self.has_line = self.line < n_lines[words.row]
        self.is_header = told(words, pages.column("joined"), lambda text, line: MARK + text in line or text + MARK in line)

    def columns(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of those chosen that lie in a column, once for each, and the slot of the column."""
        ranges = self.pages.column("ranges")
        n_ranges, each = lengths_of(ranges), ranges.flatten()
        (left, has_left), (right, has_right), (slot, _) = (
            numbers(pc.struct_field(each, f)) for f in ("left_edge", "right_edge", "slot")
        )
        words, begin, has_edges = self.words, bounds(n_ranges), has_left & has_right
        (x0, x1, _), rows = words.places, words.row
        chosen = chosen[~words.null(NO_PLACE | NO_PLACE << 1)[chosen]]
        found, slots = [chosen[:0]], [slot[:0]]
        for i in range(n_ranges.max(initial=0)):
            chosen = chosen[n_ranges[rows[chosen]] > i]
            at = begin[rows[chosen]] + i
            first, last = x0[chosen], x1[chosen]
            inside = ((first >= left[at]) | np.isnan(first)) & ((last <= right[at]) | np.isnan(right[at])) & has_edges[at]
            found.append(chosen[inside])
            slots.append(slot[at[inside]])
        return np.concatenate(found), np.concatenate(slots)


def dropped(pages: pa.RecordBatch) -> pa.RecordBatch:
    """Number of words of each page and reason for which they are in no cell."""
    placed = PlacedWords(pages)
    row, is_header, has_line = placed.words.row, placed.is_header, placed.has_line
    in_column = np.zeros(len(row), dtype=bool)
    in_column[placed.columns(np.flatnonzero(has_line & ~is_header))[0]] = True
    reasons = {
        "header": is_header,
        "below_last_line": ~is_header & ~has_line,
        "outside_columns": ~is_header & has_line & ~in_column,
    }
    counts = [np.bincount(row[which], minlength=pages.num_rows) for which in reasons.values()]
    some = [np.flatnonzero(n) for n in counts]
    page = np.concatenate(some)
    names = np.repeat(np.arange(len(reasons)), [len(s) for s in some])
    named = pa.array(list(reasons)).take(pa.array(names))
    amounts = np.concatenate([n[s] for n, s in zip(counts, some)])
    return pa.RecordBatch.from_arrays(
        [pages.column("file").take(pa.array(page)), named, pa.array(amounts, pa.int64())], names=["file", "reason", "n_words"]
    )


def table_parts(names: list[str], idx_type: pa.DataType) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """A function that gives the table rows of pages, with cells for the slots of `names`, the others in a map."""

    def run(pages: pa.RecordBatch) -> pa.RecordBatch:
        placed = PlacedWords(pages)
        words = placed.words
        chosen = np.flatnonzero(placed.has_line & ~placed.is_header & ~words.null(NO_TEXT))
        most = len(placed.stops) + 1
        rows, of_row = np.unique(words.row[chosen] * most + placed.line[chosen], return_inverse=True)
        page, line = rows // most, rows % most
        row_order = np.full(len(rows), np.iinfo(np.int64).max)
        np.minimum.at(row_order, of_row, words.idx[chosen])

        row_of_word = np.zeros(len(words.row), np.int64)
        row_of_word[chosen] = of_row
        found, slots = placed.columns(chosen)
        others = pages.column("others")
        n_others = lengths_of(others)
        n_cells = (len(names) + n_others)[page]
        first_cell = bounds(n_cells)
        cell, number = first_cell[row_of_word[found]] + slots - 1, words.idx[found]
        order = np.lexsort((number, cell))
        if ((np.diff(cell[order]) == 0) & (np.diff(number[order]) == 0)).any():
            # Words of one number go by their text.
            texts = words.text.take(pa.array(found)).dictionary_encode()
            by_text = np.argsort(np.array(texts.dictionary.to_pylist(), dtype=object), kind="stable")
            rank = np.empty(len(by_text), np.int64)
            rank[by_text] = np.arange(len(by_text))
            order = np.lexsort((rank[texts.indices.to_numpy()], number, cell))
        texts = joined_runs(words.text.take(pa.array(found[order])), np.bincount(cell, minlength=first_cell[-1]))
        cells = pc.ascii_trim(string(texts), characters=" ")
        cells = pc.if_else(pc.equal(pc.binary_length(cells), 0), pa.scalar(None, pa.string()), cells)

        of_cell = np.repeat(np.arange(len(rows)), n_cells)
        place = np.arange(len(cells)) - first_cell[of_cell] - len(names)
        further = np.flatnonzero(place >= 0)
        keys = others.flatten().take(pa.array(bounds(n_others)[page[of_cell[further]]] + place[further]))
        offsets = pa.array(bounds(n_others[page]).astype(np.int32))
        more = pa.MapArray.from_arrays(offsets, keys, cells.take(pa.array(further)))
        at_page = pa.array(page)
        made = {
            "file": pages.column("file").take(at_page),
            "page": pages.column("page").take(at_page),
            "line": pa.array(placed.stops[placed.first_stop[page] + line], pa.float64()),
            "row_order": pa.array(row_order).cast(idx_type),
            **{name: cells.take(pa.array(first_cell[:-1] + i)) for i, name in enumerate(names)},
            "more": more,
            "reported_at": pages.column("reported_at").take(at_page),
        }
        return pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return run
