"""What a query writes and how it joins, on tables made here: the steps whose cost outgrew the input must not come back."""

import os
from datetime import datetime

import pytest

from sorrel.plans import roles as R
from sorrel.plans.queries import QUERIES
from sorrel.session import shared_dir, unsorted_writes
from sorrel.sources import delimited as D

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    tags = R.TAGS
    tables = {
        "customer": ([(u, ["MACHINERY", "BUILDING", "FURNITURE"][u % 3], u * 1234.5 % 9000, u % 25) for u in range(20)], "c_custkey long, c_mktsegment string, c_acctbal double, c_nationkey int"),
        "part": ([(i, f"{tags[i % 16]} {tags[i * 7 % 16]}", i % 50 + 1) for i in range(30)], "p_partkey long, p_name string, p_size int"),
        "orders": ([(o, o % 18) for o in range(60)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(k // 4, k % 4, k * 11 % 27, float(k * 13 % 50 + 1), datetime(1998, 1, 1 + k % 28)) for k in range(240)], "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{out}/{name}.parquet")
    return out


def made_by(spark, query, folder):
    """(rows, kinds of folders that the query wrote)."""
    before = set(os.listdir(shared_dir(spark)))
    got = QUERIES[query](spark, folder)
    rows = got.collect()
    return got, rows, [n.rsplit("-", 1)[0] for n in os.listdir(shared_dir(spark)) if n not in before]


def plan(df):
    return df._jdf.queryExecution().toString()


def test_recommendations_write_ratings_once_and_no_matrix(spark, folder):
    got, rows, made = made_by(spark, "recommend", folder)
    assert len(rows) == 20 * 10 and made.count("ratings") == 1 and "matrix" not in made
    # users are dealt to the blocks and never copied to them
    assert "ShuffledHashJoin" in plan(got)


def test_exclusions_are_taken_out_inside_the_row(spark, folder):
    got, rows, made = made_by(spark, "recommend_unseen", folder)
    seen = {(r.user_id, r.item_id) for r in R.interactions(spark, folder).collect()}
    assert rows and not seen & {(r.user_id, r.item_id) for r in rows}
    assert made.count("ratings") == 1 and "matrix" not in made and "LeftAnti" not in plan(got)


def test_the_matrix_sorts_no_ratings(spark, folder):
    # one look-up per entity
    assert plan(R.matrix(spark, folder)).count("ShuffledHashJoin") >= 2
    before = spark.conf.get(OPEN_FILES)
    with pytest.raises(ValueError), unsorted_writes(spark):
        assert int(spark.conf.get(OPEN_FILES)) > 1
        raise ValueError
    assert spark.conf.get(OPEN_FILES) == before


def test_reference_scores_keep_features_of_training_rows_and_scores(spark, folder):
    _, rows, made = made_by(spark, "reference_scores", folder)
    assert rows[0].n and {"train", "scores"} <= set(made) and "matrix" not in made


def test_lines_are_parsed_once_a_side(spark, tmp_path):
    path = tmp_path / "r.dat"
    path.write_text("1::2::3::4\n1::2::x::4\n\n5::6::7::8\n")
    good, bad = D.read_checked(spark, str(path), D.RATINGS)
    assert good.count() == 2 and bad.count() == 2
    for side in (good, bad):
        assert side._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
