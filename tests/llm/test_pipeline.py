"""The corpus pipeline against a plain version of its last stages, stage by stage."""

from __future__ import annotations

import __spark_entry__ as entry_points
import corpus_pipeline
from conftest import SF_DIR
from test_operators import linked, words

from rimstone.llm.common import materialize, table


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SF_DIR), name)
        seen.append((docs.collect(), after.collect()))
        docs = after
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_classifier" and docs.columns[0] == "doc_id"
    for before, after in seen[:-1]:
        assert list(after[0].asDict()) == columns and {r.doc_id for r in after} <= {r.doc_id for r in before}
    good = {r.doc_id for r in table(spark, SF_DIR, "labels").where("quality = 1").collect()}
    assert not good & ({r.doc_id for r in seen[0][0]} - {r.doc_id for r in seen[0][1]})
    kept = {r.doc_id for r in seen[2][1]}
    assert kept == {c for _, _, c in linked([(r.doc_id, r.text) for r in seen[2][0]])}
    items = [words(r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    windows = {tuple(w[i : i + 10]) for w in items for i in range(max(len(w) - 9, 1)) if w}
    clean = {
        r.doc_id for r in seen[3][0]
        if not any(tuple(words(r.text)[i : i + 10]) in windows for i in range(len(words(r.text))))
    }
    assert {r.doc_id for r in seen[3][1]} == clean == {r.doc_id for r in seen[4][1]}
    assert all(r.n_tokens == len(r.ids) for r in seen[4][1])


def test_registered():
    names = set(entry_points.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names} >= {f"op{i}" for i in range(1, 11)}
