"""Fitting on sparse, repeated, foreign and missing labels, and severity against a plain reading of the model."""

import math
import os
import re

import pyarrow.parquet as pq
import pytest

from panelwatch.llm import toxicity

FOLDER = "/root/testdata/sf0.001"


def plain_severity(model, text):
    """Severity, P(grade > 0) of one text from the model's own numbers."""
    found = set()
    for part in re.findall(r"[^\W_]+", (text or "").lower()):
        found |= {part, *[f"{part[:n]}~" for n in (4, 5, 6) if len(part) > n]}
        if not part.isascii():
            found |= {f"{run[i : i + n]}^" for run in toxicity.UNSPACED.findall(part) for n in (2, 3, 4) for i in range(len(run) - n + 1)}
    score = sum(model.weights.get(f, 0.0) for f in found)
    above = [1 / (1 + math.exp(-min(40, max(-40, score - t)))) for t in model.thresholds]
    return sum(above), above[0]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_severity_of_a_whole_table(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    found = toxicity.toxicity(docs, model).collect()
    texts = dict(zip(*pq.read_table(f"{FOLDER}/documents.parquet").select(["doc_id", "text"]).to_pydict().values()))
    assert sorted(r.doc_id for r in found) == sorted(texts) and model.weights
    for r in found:
        severity, p = plain_severity(model, texts[r.doc_id])
        assert r.severity == pytest.approx(severity, abs=1e-9) and r.p_toxic == pytest.approx(p, abs=1e-9)
        assert r.toxic == (not r.kept) == (r.p_toxic > model.cut) == (r.grade > 0)


def corpus(n=400):
    rows = [(i, f"word{i % 7} plain prose number{i % 5}" + (" vilefool dungheap" if i % 4 == 0 else "")) for i in range(n)]
    return rows, [(i, int(i % 4 == 0)) for i, _ in rows]


def tables(spark, rows, marks):
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_tasks_without_labelled_texts(spark):
    rows, marks = corpus()
    rest = [(10_000 + i, "unlabelled text") for i in range(400)]
    docs, labels = tables(spark, rows + rest, marks)
    spread = docs.repartitionByRange(40, "doc_id")
    assert toxicity.fit(spread, labels).weights == toxicity.fit(docs, labels).weights != {}


def test_repeated_and_contradicting_labels(spark):
    rows, marks = corpus()
    docs, labels = tables(spark, rows, marks)
    again, twice = tables(spark, rows + rows[:3] * 50, marks + marks[:2] * 3)
    assert toxicity.fit(again, twice) == toxicity.fit(docs, labels)
    everywhere = [(i, f"same {text}") for i, text in rows] + [(0, "same " + rows[0][1])]
    assert "same" not in toxicity.fit(*tables(spark, everywhere, marks)).weights  # a feature of every text, one row repeated
    both = toxicity.fit(docs, spark.createDataFrame([*marks, (1, 1), (1, 0)], "doc_id long, toxic int"))
    assert both.weights


def test_foreign_labels_and_one_sided_labels(spark):
    rows, marks = corpus()
    docs, labels = tables(spark, rows, marks + [(50_000 + i, i % 2) for i in range(300)])
    assert toxicity.fit(docs, labels).weights == toxicity.fit(*tables(spark, rows, marks)).weights
    for text_rows, label_rows in ((rows, [(50_000 + i, i % 2) for i in range(30)]), ([], marks), (rows, [m for m in marks if m[1] == 0]), (rows, [(None, 1), (3, None)])):
        model = toxicity.fit(*tables(spark, text_rows, label_rows))
        assert model.weights == {} and model.thresholds == (40.0,)
        assert [r.kept for r in toxicity.toxicity(docs.limit(5), model).collect()] == [True] * 5


def test_columns_that_share_a_name_stay(spark):
    rows, marks = corpus(80)
    docs, labels = tables(spark, rows, marks)
    more = docs.withColumnRenamed("text", "t").selectExpr("doc_id", "t AS text", "'x' AS __civil", "1 AS kept", "2 AS toxic", "3 AS grade")
    kept = toxicity.keep_civil(more, toxicity.fit(more, labels))
    assert kept.columns == more.columns and {r["__civil"] for r in kept.collect()} == {"x"}
