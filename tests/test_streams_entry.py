"""Streams equal their batch results; the driver contract runs; oracle names line up."""

import os

import duckdb

import __spark_entry__ as E
from tests.conftest import SF_SMALL

CHEAP = ["select_recombined", "where_tree", "doc_eq", "upd_push_slice", "pipe_chain", "sel_simple", "rule_record",
         "template_fill", "postings", "crawl_reach", "stream_dedup", "stream_upsert", "dedup_hash"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["doc_id", "lang", "source", "n_chars", "text", "text_pieces"]


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


def _norm(rows):
    def n(v):
        return round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


def test_queries_match_oracle_small(spark):
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    q, o = E.queries(), E.oracle_sql()
    for name in CHEAP:
        sdf = q[name](spark, SF_SMALL)
        cols = sorted(sdf.columns)
        got = _norm(sdf.select(*cols).collect())
        res = con.execute(o[name])
        dcols = [d[0] for d in res.description]
        assert sorted(dcols) == cols, name
        idx = [dcols.index(c) for c in cols]
        want = _norm([tuple(r[i] for i in idx) for r in res.fetchall()])
        assert got == want, name
