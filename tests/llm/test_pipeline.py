"""The pipeline's stages on a driver table: columns, decisions and the last stage's pieces."""

from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F

import brute


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        before, kept = kept, {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(kept) <= set(before)
        if name == "exact_dedup":
            assert len({" ".join(brute.words(t)) for t in kept.values()}) == len(kept)
        if name == "near_dedup":
            components = {c for _, c in brute.near(list(before.items()), 5).values()}
            assert set(kept) == components
        if name == "substring_dedup":
            expected = brute.repeats(list(before.items()))
            assert set(kept) == {d for d, (n, gone, _) in expected.items() if gone < n or not n}
            assert all(len(brute.words(t)) == expected[d][0] - expected[d][1] for d, t in kept.items())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in pieces} == set(kept)


def test_language_stage_keeps_clean_rows(spark, sf_dir):
    """Every clean row of every language stays, also where a language has a few rows only."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, sf_dir)
    named = "lang is not null and length(text) > 2"
    assert kept.where(named).groupBy("lang").count().collect() != []
    assert kept.where(named).count() == docs.where(named).count()


def test_language_decides_sequences(spark, sf_dir):
    """A wrong or missing declaration gives way to the identified language, and no sequence mixes languages."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang is not null and length(text) > 200")
    wrong = [r["doc_id"] for r in table.where("lang = 'en'").orderBy("doc_id").limit(3).collect()]
    at = F.col("doc_id").isin
    lang = F.when(at(wrong[:1]), "de").when(at(wrong[1:2]), None).when(at(wrong[2:]), "en-GB").otherwise(F.col("lang"))
    stages, true = dict(corpus_pipeline.STAGES), {r["doc_id"]: r["lang"] for r in table.collect()}
    docs = stages["language_id"](spark, table.withColumn("lang", lang), sf_dir)
    assert docs.columns == table.columns
    found = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert found == true | {wrong[2]: "en-GB"}
    pieces = stages["packing"](spark, docs, sf_dir).collect()
    sequences = defaultdict(list)
    for r in pieces:
        assert r["part"] == true[r["doc_id"]]
        sequences[r["sequence_id"]].append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        assert len({r["part"] for r in own}) == 1
        ends = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == ends
            ends += r["length"]
        assert ends <= 2048
    assert {r["doc_id"] for r in pieces} == set(true) and docs.count() == table.count()
