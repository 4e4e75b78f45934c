"""The pipeline's stages on rows with equal ids, clashing columns, nulls and empty tables."""

import pytest

from parlance.llm import stages

SF = "/root/testdata/sf0.001"
W = {c: " ".join(f"{c}{i}" for i in range(30)) for c in "XYZ"}


def test_jaccard_stage_removes_rows_not_ids(spark):
    rows = [(3, W["X"]), (5, W["X"]), (5, W["Y"]), (7, W["Z"]), (5, W["Z"] + " more"), (None, W["Y"]), (9, None), (9, ""), (3, W["X"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, stages.jaccard_stage(spark, df, SF).collect()), key=str)
    assert got == sorted([(3, W["X"]), (3, W["X"]), (5, W["Y"]), (5, W["Z"] + " more"), (9, None), (9, "")], key=str)


FILTERS = {n: f for n, f in stages.STAGES[:-1]}


@pytest.mark.parametrize("name", FILTERS)
def test_stages_keep_the_columns(spark, name):
    schema = "doc_id long, text string, lang string, id int, t string, x long, row_key string, class_key int, n_shingles int, c0 int, f long"
    rows = [(1, W["X"], "en", 1, "t", 2, "k", 3, 4, 5, 6), (None, W["Y"]) + (None,) * 9, (2, None) + (None,) * 9, (3, "") + (None,) * 9]
    df = spark.createDataFrame(rows, schema)
    out = FILTERS[name](spark, df, SF)
    assert out.dtypes == df.dtypes
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows, key=str)
    assert FILTERS[name](spark, df.limit(0), SF).collect() == []
