"""Named queries against their SQL, where there is some."""

import glob
import os

import duckdb
import pytest

from fleetmeter.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def same(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    out = QUERIES[name](spark, SF_DIR)
    columns = sorted(out.columns)
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    assert same(tuple(r) for r in out.select(*columns).collect()) == same(want.select(*columns).fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_names(name):
    assert name.startswith("op")


def test_near_vectors_reach_the_recall(spark):
    """At least nine in ten of the true neighbours of every 20th row of the table; ranks without gaps."""
    got = QUERIES["op13_near_vectors"](spark, SF_DIR).collect()
    con = duckdb.connect()
    want = con.sql(f"""
      WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM '{SF_DIR}/embeddings.parquet')
      SELECT q.vec_id, c.vec_id FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
      QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.x, c.x) DESC, c.vec_id) <= 20""").fetchall()
    have = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(have) == len(got) == len(want)
    assert sum(w in have for w in want) >= 0.9 * len(want)
    assert {r["rank"] for r in got} == set(range(1, 21))
