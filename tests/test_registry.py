"""The registered queries against their SQL on the smallest tables."""

import os
import sys

import pytest

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")

import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, key, ok_type, same  # noqa: E402

from sorrel.plans.oracles import ORACLES  # noqa: E402
from sorrel.plans.queries import QUERIES  # noqa: E402

QUICK = [
    "one_hot_tags", "quality_checks", "validate_users", "feature_matrix", "point_in_time", "user_stats", "coverage",
    "roc_auc", "exact_split", "top_k", "nb_params", "nb_scores", "recommend_unseen", "materialize_incremental",
    "feature_drift", "score_batches", "request_metrics", "error_rate", "stream_requests",
    "stream_latency_breach", "rejected_lines", "stream_corrections", "psi",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_lazy_and_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    types = {c[0]: str(c[1]) for c in cur.description}
    assert all(ok_type(f.dataType.simpleString(), types[f.name]) for f in df.schema.fields)
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()), key=key)
    assert len(got) == len(want) and all(same(x, y) for a, b in zip(got, want) for x, y in zip(a, b))
