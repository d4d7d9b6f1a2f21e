"""The pipeline's stages on the smallest tables, against plain versions of what they decide."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessella.llm import queries

sys.path.insert(0, str(Path(__file__).parent))
from test_operators_on_rows import plain_components  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_score", F.lit(1)).withColumn("kept", F.lit(1))
    seen = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], SF).cache())
    return seen


def ids(df):
    return {r[0] for r in df.select("doc_id").distinct().collect()}


def test_stages_keep_the_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:4])
    assert ids(stages[1]) < ids(stages[0]) and ids(stages[2]) <= ids(stages[1]) and ids(stages[3]) <= ids(stages[2])


def test_one_of_each_group_stays(stages):
    rows = [tuple(r) for r in stages[2].select("doc_id", "text").collect()]
    assert ids(stages[3]) == {top for _, top in plain_components(rows, 5, 80).values()}
    assert stages[3].count() == len(ids(stages[3]))


def test_every_document_left_is_packed_whole(stages):
    packed = stages[4].toPandas()
    assert set(packed.doc_id) == ids(stages[3])
    own = packed.groupby("doc_id")
    assert (own["length"].sum() == own["doc_tokens"].first()).all()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048


def test_clean_documents_stay_and_junk_goes(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, after = (s.join(labels, "doc_id").groupBy("quality").count().toPandas().set_index("quality")["count"]
                     for s in (stages[0], stages[2]))
    assert after.get(0, 0) <= 0.2 * before[0] and after[1] >= 0.9 * before[1]


def test_pipeline_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b c " * 30, "en", "s", 9)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, SF)
            assert out.count() >= 0


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, text), (1, other), (2, text + " x"), (3, other), (3, other), (None, text), (None, "u " * 30), (None, "u " * 30),
            (5, ""), (5, None), (4, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 7) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, _row int")
    got = corpus_pipeline.deduplicated(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got.collect()))) == sorted(map(str, [
        (1, text), (1, other), (None, "u " * 30), (5, ""), (5, None), (4, "alone")]))


def test_one_query_per_operator():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)
