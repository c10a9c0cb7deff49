"""The registered queries against their DuckDB SQL on the sf0.001 documents and embeddings."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from ledgerlens.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    cols = sorted(c[0] for c in cur.description)
    at = [[c[0] for c in cur.description].index(c) for c in cols]
    expected = sorted(tuple(r[i] for i in at) for r in cur.fetchall())
    out = QUERIES[name](spark, SF_SMALL)
    assert sorted(out.columns) == cols
    assert sorted(tuple(r) for r in out.select(*cols).collect()) == expected


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE_SQL) <= set(E.oracle_sql()) and "pipeline" not in E.oracle_sql()
    assert E.queries()["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "suffix_array_dedup", "source_mix", "byte_level_bpe"]
