"""Columns of the input that have an operator's helper names."""

from __future__ import annotations

from pyspark.sql import functions as F

from alula.llm import exact_dedup, language_id, mixing

NAMES = ["__text", "__score", "__lang_pred", "__rate", "__posterior", "__n_tokens", "__membership", "__k0", "__k1", "__hash", "__copy"]


def test_helper_names_may_be_taken(spark):
    rows = [(i, f"The words of text number {i} are here and there.", "en", i % 2) for i in range(12)] + [(3, "Again.", "en", 1), (3, "Again.", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, q int").select("*", *[F.col("doc_id").alias(n) for n in NAMES])
    labels = docs.select("doc_id", F.when(F.col("q") == 1, "good").otherwise("bad").alias("domain"))
    model = language_id.train_language_id(docs, F.lit(True))
    found = language_id.identify_languages(docs, model, docs.columns)
    assert found.columns == [*docs.columns, "___lang_pred", "___score"] and found.count() == len(rows)
    assert language_id.claimed_rows(docs, model).columns == docs.columns
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 1
    mixed = mixing.mixed_rows(docs, labels, {"good": 0.5, "bad": 0.5})
    assert mixed.columns == docs.columns and all(r["__text"] == r["doc_id"] for r in mixed.collect())
