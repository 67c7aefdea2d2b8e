"""Licence scan: templates with optional and replaceable regions, compiled into token automata.

Template markup: plain words are mandatory; `<<optional>> ... <</optional>>` may be absent (and may nest);
`<<var n>>` stands for one to n words of any kind. Words are compared in lower case, so a text is accepted where its
words match all mandatory wording exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from rimstone.llm.common import per_slice

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of a text's UTF-8 bytes with A-Z in lower case
MARK = re.compile(r"<<(/?)(optional|var)\s*(\d*)>>")

# The phrases that every scan counts, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

TEMPLATES = {
    "mit-notice": "<<optional>>this <<var 3>> is<</optional>> <<optional>>released<</optional>> under the "
    "<<optional>>terms of the<</optional>> mit license",
    "apache-2.0-notice": "licensed under the apache license <<optional>>version<</optional>> 2 0",
    "gpl-notice": "this <<var 3>> is licensed under the gnu <<optional>>lesser<</optional>> general public license "
    "<<optional>>version<</optional>> <<var 1>>",
    "cc-by-nc-notice": "licensed under <<optional>>a<</optional>> <<optional>>creative commons<</optional>> cc by nc "
    "<<optional>>4 0<</optional>>",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "<<optional>>and associated documentation files<</optional>> <<optional>>the software<</optional>> to deal in "
    "the software without restriction",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted "
    "<<optional>>provided that the following conditions are met<</optional>>",
}


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


class Automaton:
    """Token automaton of one template: `steps[state]` lists (word or None for any word, next state)."""

    def __init__(self, template: str):
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]
        self.free: list[list[int]] = [[]]
        open_at, at, done = [], 0, 0
        for mark in [*MARK.finditer(template), None]:
            for word in words_of(template[done : mark.start() if mark else len(template)]):
                at = self._step(at, word)
            if mark is None:
                break
            closing, kind, n = mark.groups()
            if kind == "var":
                start = at
                ends = [start := self._step(start, None) for _ in range(int(n or 1))]
                for end in ends[:-1]:
                    self.free[end].append(ends[-1])
                at = ends[-1]
            elif closing:
                self.free[open_at.pop()].append(at)
            else:
                open_at.append(at)
            done = mark.end()
        if open_at:
            raise ValueError(f"optional region is not closed: {template!r}")
        self.final = at
        self.starts = {word for word, _ in self._out({0})}
        if self.final in self._closure({0}) or None in self.starts:
            raise ValueError(f"a template must begin with wording: {template!r}")

    def _step(self, state: int, word: bytes | None) -> int:
        self.edges.append([])
        self.free.append([])
        self.edges[state].append((word, len(self.edges) - 1))
        return len(self.edges) - 1

    def _closure(self, states: set[int]) -> set[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def _out(self, states: set[int]) -> list[tuple[bytes | None, int]]:
        return [edge for s in self._closure(states) for edge in self.edges[s]]

    def longest(self, words: list[bytes], start: int) -> int:
        """Number of words of the longest accepted span that begins at `start`; 0 if there is none."""
        states, best = {0}, 0
        for i in range(start, len(words)):
            states = {to for word, to in self._out(states) if word is None or word == words[i]}
            if not states:
                break
            if self.final in self._closure(states):
                best = i + 1 - start
        return best


def scan_words(words: list[bytes], base: dict[str, Automaton], automata: dict[str, Automaton]) -> list[tuple]:
    """All matches (label, start, n words, is base), by place. Every start of every automaton is tried."""
    starts: dict[bytes, list] = {}
    for kind, machines in ((True, base), (False, automata)):
        for label, machine in machines.items():
            for word in machine.starts:
                starts.setdefault(word, []).append((label, machine, kind))
    found = []
    for word in starts.keys() & set(words):
        at = -1
        for _ in range(words.count(word)):
            at = words.index(word, at + 1)
            for label, machine, kind in starts[word]:
                if n := machine.longest(words, at):
                    found.append((label, at, n, kind))
    return sorted(found, key=lambda m: (m[1], m[0]))


SCAN = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, matches array<struct<label: string, start: long, n_words: long>>"
)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Licence matches of every whole text: one row per row of `docs`, with all spans in `matches`.

    `score` is the share of the text's words that lie in a match. A null or empty text has no words, no matches and
    score 0; overlapping matches all count, words in several once. Other columns are ignored.
    """
    chosen = TEMPLATES if templates is None else templates

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        base = {label: Automaton(phrase) for phrase, label in BASE.items()}
        automata = {label: Automaton(template) for label, template in chosen.items()}
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text or "")
            found = scan_words(words, base, automata)
            places = [m[1] for m in found if m[3]]
            covered = {i for _, start, n, _ in found for i in range(start, start + n)}
            rows.append(
                {
                    "doc_id": doc_id, "n_words": len(words), "n_base": len(places),
                    "first_word": min(places, default=None), "last_word": max(places, default=None),
                    "base_labels": ",".join(sorted({m[0] for m in found if m[3]})),
                    "labels": ",".join(sorted({m[0] for m in found})),
                    "score": len(covered) / len(words) if words else 0.0,
                    "matches": [{"label": m[0], "start": m[1], "n_words": m[2]} for m in found],
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema)

    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("n_words", pa.int64())])
    longs = [(c, pa.int64()) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    texts = [("base_labels", pa.string()), ("labels", pa.string())]
    schema = pa.schema([*longs, *texts, ("score", pa.float64()), ("matches", pa.list_(span))])
    return docs.select("doc_id", "text").mapInArrow(per_slice(scan), SCAN)
