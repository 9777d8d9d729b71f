"""The pipeline's stages, each against a plain version of it on its own input."""

import importlib.util
import os
import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tillroll.llm import packing, quality, secrets
from tillroll.llm._stage import staged, table

SMALL = "/root/testdata/sf0.001"


def _plain():
    path = os.path.join(os.path.dirname(__file__), "test_llm_corpus_ops.py")
    spec = importlib.util.spec_from_file_location("plain_corpus_ops", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_stages_one_by_one(spark):
    plain = _plain()
    docs = table(spark, SMALL, "documents")
    names = docs.columns
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = staged(stage(spark, docs, SMALL), f"test-{name}")
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == names and dict(out.dtypes) == dict(docs.dtypes)
            after = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
        if name == "quality_rules":
            verdict = quality.verdicts(docs, quality.train(docs, table(spark, SMALL, "labels")))
            assert sorted(after) == sorted((i, t) for i, t in before if i in {r["doc_id"] for r in verdict.where("kept").collect()})
            assert 0 < len(after) < len(before)
        elif name == "line_dedup":
            assert sorted(after) == sorted((i, t) for i, _, _, t in plain.plain_lines(before))
        elif name == "near_duplicates":
            want = {i for i, n, c in plain.plain_components(before) if i == c or not n}
            assert sorted(after) == sorted((i, t) for i, t in before if i in want)
        elif name == "secret_scan":
            assert sorted(after) == sorted((i, secrets.redacted(t)) for i, t in before)
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        else:
            ids = {i for i, _ in before}
            rows = out.toPandas()
            assert set(rows.doc_id) == ids and rows.groupby("sequence_id").length.sum().max() <= packing.CAPACITY
        seen[name] = out.count()
        docs = out
    assert list(seen) == ["quality_rules", "line_dedup", "near_duplicates", "secret_scan", "best_fit_packing"]
    assert corpus_pipeline.run(spark, SMALL).count() == seen["best_fit_packing"]


WORDS = ("the of and to in that is was for on with as by at from this have not are which one you all had they we been "
         "has their more will would who when there can if no out so what up its about than into them only other new some could").split()
KEY = "AKIA" + "Q7ZP2M4K9R3T6W8X"


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", ","]) for _ in range(n)) + "."


def odd_documents():
    """Nulls, empty and very long texts, repeated rows, copies, shared lines, a secret."""
    shared = "this exact line stands in several documents of the corpus"
    texts = {1: prose(1), 2: None, 3: "", 4: " \n\n ", 5: "short", 6: prose(6) + "\n" + shared, 7: prose(7) + "\n" + shared,
             8: prose(8) + " key " + KEY + " " + prose(88), 9: prose(1), 10: prose(10, 60_000), 11: prose(11), 12: "\n".join(prose(k, 12) for k in range(40))}
    rows = [(i, t, "en", f"s{i % 2}", None if t is None else len(t)) for i, t in texts.items()]
    rows += [rows[10], (None, prose(99), None, None, None), (None, None, None, None, None)]
    return [(*r, 7, 8, "x", 9, "y", 1, True) for r in rows]


ODD = ("doc_id long, text string, lang string, source string, n_chars long, sequence_id long, offset long, _id string, k long, "
       "crc string, kept int, _empty boolean")


@pytest.mark.parametrize("labels", ["some", "none"])
def test_stages_on_odd_tables(spark, tmp_path, labels):
    spark.createDataFrame(odd_documents(), ODD).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    told = [(1, 1, 0), (6, 1, 0), (5, 0, 0), (None, None, None), (1, 1, 0)] if labels == "some" else []
    spark.createDataFrame(told, "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, str(tmp_path), "documents")
    names, rows = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = staged(stage(spark, docs, str(tmp_path)), f"odd-{name}")
        if k < 4:
            assert docs.columns == names
            assert all((r["sequence_id"], r["offset"], r["_id"], r["crc"]) == (7, 8, "x", "y") for r in docs.collect())
        rows[name] = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr) if k < 4 else docs.toPandas()
    ids = {k: [i for i, _ in v] for k, v in rows.items() if k != "best_fit_packing"}
    assert not {2, 3, 4, 5} & set(ids["quality_rules"]) and len(ids["line_dedup"]) == len(ids["quality_rules"])
    text = dict(rows["line_dedup"])
    if {6, 7} <= set(text):
        assert "several documents" in text[6] and "several documents" not in text[7]
    if {1, 9} <= set(text):  # its only line stands in document 1: an empty text is like nothing
        assert text[9] == "" and 9 in ids["near_duplicates"]
    assert len(set(ids["near_duplicates"])) == len(ids["near_duplicates"])
    assert not any(KEY in (t or "") for _, t in rows["secret_scan"]) and ids["secret_scan"] == ids["near_duplicates"]
    packed = rows["best_fit_packing"]
    assert set(packed.doc_id.dropna().astype(int)) == {i for i in ids["secret_scan"] if i is not None}
    assert packed.groupby("sequence_id").length.sum().max() <= packing.CAPACITY
    if 10 in ids["secret_scan"]:
        assert (packed.doc_id == 10).sum() > 20


def test_each_stage_takes_null_and_empty_texts(spark, tmp_path):
    """Every stage on the odd table itself, not on what is left of it."""
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(odd_documents(), ODD).repartition(3)
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path)).collect()
        if name in ("line_dedup", "secret_scan"):
            assert len(out) == n and sum(r["text"] is None for r in out) == 2
        elif name == "near_duplicates":
            kept = [r["doc_id"] for r in out]
            assert {2, 3, 4} <= set(kept) and kept.count(11) == 1 and 9 not in kept
        elif name == "best_fit_packing":
            assert len({r["doc_id"] for r in out}) == 13 and sum(r["length"] for r in out if r["doc_id"] == 3) == 1


def test_stages_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], ODD).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    names = set(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
