"""The pipeline's stages on planted documents, and every query's result on the smallest tables."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
import edge_tables
from shelfwise.llm import queries


def folder(spark, tmp_path, docs, labels):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def planted():
    rows, labels = [], []
    for i in range(120):
        lines = [edge_tables.words(30 * i + k, 30) for k in range(3)]
        if i < 8:
            lines.append(f"Filed under number {i} in the general register of texts")
        if i >= 90:
            lines[0] += " vileword nastyterm"
        if i == 40:
            lines[1] += f' token = "{"".join(random.Random(1).choices("0123456789abcdef", k=40))}"'
        rows.append((i, "\n".join(lines), "en", f"s{i % 3}", len("\n".join(lines))))
        labels.append((i, 1, int(i >= 90)))
    rows.append((500, rows[50][1], "en", "s0", rows[50][4]))
    words = rows[51][1].split(" ")
    rows.append((501, " ".join(words[:-1] + ["other"]), "en", "s0", 5))
    rows += [(600, None, None, None, None), (None, edge_tables.words(9999, 50), "en", None, 0)]
    return rows, labels


def test_stages_take_effect(spark, tmp_path):
    rows, labels = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long").repartition(3)
    sf_dir = folder(spark, tmp_path, docs, spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        path = f"{tmp_path}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before = {r[0]: r[1] for r in rows}
    clean = {i: t for i, t in before.items() if i is None or not 90 <= i < 120}
    assert {r["doc_id"]: r["text"] for r in seen["toxicity"]} == clean
    lines = {r["doc_id"]: r for r in seen["line_dedup"]}
    assert all(lines[i]["text"] == (t.rsplit("\n", 1)[0] if i is not None and i < 8 else t)
               for i, t in clean.items())
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"] if r["text"])
    kept = {r["doc_id"]: r["text"] for r in seen["simhash_dedup"]}
    assert set(kept) == set(clean) - {500, 501}
    hidden = {r["doc_id"]: r["text"] for r in seen["secrets"]}
    assert "[SECRET]" in hidden[40] and '"' in hidden[40]
    assert {i: t for i, t in hidden.items() if i != 40} == {i: t for i, t in kept.items() if i != 40}
    assert {r["doc_id"] for r in seen["packing"]} == set(kept)


def test_run_on_edge_and_empty_tables(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, docs in (("edge", edge_tables.table(spark)), ("empty", edge_tables.empty(spark))):
        (tmp_path / name).mkdir()
        pieces = corpus_pipeline.run(spark, folder(spark, tmp_path / name, docs, labels))
        assert (pieces.count() > 0) == (name == "edge")


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if not n.startswith("op8")])
def test_one_result_row_per_document(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    result = queries.QUERIES[name](spark, sf_dir)
    documents = {r["doc_id"] for r in queries.table(spark, sf_dir, "documents").collect()}
    ids = [r["doc_id"] for r in result.select("doc_id").collect()]
    if name.startswith(("op3", "op7")):  # findings, not one row each
        assert set(ids) <= documents
    else:
        assert set(ids) == documents
        assert name.startswith("op1") or len(ids) == len(documents)
