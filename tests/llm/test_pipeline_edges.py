"""Every pipeline stage on odd tables: empty, clashing columns, repeated rows, nulls, very long texts."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF0001

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
CLASHING = ["row", "id", "key", "kept", "keep_id", "group_size", "size", "fp", "score", "lang_pred", "target", "copies",
            "n", "digit", "salt", "s", "p", "piece", "length", "component_id", "sequence_id", "offset", "taken"]


def _docs(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


def _odd(spark):
    docs = _docs(spark).limit(40)
    some = docs.limit(1).collect()[0].text
    rows = [(9001, None, None, None, None), (9002, "", "en", "a", 0), (9003, " \t\n", "en", None, 3), (None, some + " once more", "en", "a", 5),
            (9004, "word and the word " * 20_000, "en", "a", 360_000), (9005, "x" + " " * 1_000_000 + "y and the rest of it", "en", "b", 1_000_020),
            (9006, "1234 5678", "en", "b", 9)]
    return docs.select(*COLUMNS).unionByName(spark.createDataFrame(rows, docs.select(*COLUMNS).schema)).unionByName(docs.limit(5).select(*COLUMNS))


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stage_on_empty_and_clashing_tables(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    docs = _docs(spark).limit(60)
    assert stage(spark, docs.limit(0), SF0001).count() == 0
    more = docs
    for c in CLASHING:
        more = more.withColumn(c, F.lit("x"))
    plain = stage(spark, docs, SF0001)
    own = sorted(map(str, plain.collect()))              # a later stage deletes what this one reads
    clash = stage(spark, more, SF0001)
    assert sorted(map(str, clash.select(*plain.columns).collect())) == own and own
    if k < len(corpus_pipeline.STAGES) - 1:
        assert plain.columns == docs.columns and clash.columns == more.columns


def test_stages_one_after_another_on_odd_rows(spark, tmp_path):
    docs, seen = _odd(spark), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF0001)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs)
    language, exact, near, mixed, packed = seen
    kept = [r.doc_id for r in language.collect()]
    assert not {9001, 9002, 9003, 9006} & set(kept) and {9004, 9005, None} <= set(kept)
    ids = [r.doc_id for r in exact.collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= set(kept)                     # repeated rows are one
    assert {r.doc_id for r in near.collect()} <= set(ids)
    pieces = packed.collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in mixed.collect()}
    assert all(1 <= r.length <= 2048 and r.offset + r.length <= 2048 for r in pieces)
