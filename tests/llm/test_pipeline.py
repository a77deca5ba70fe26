"""The corpus pipeline against brute force, stage by stage, and on rows with nulls."""

import tempfile
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import quality, tokens
from tests.conftest import SF_SMALL
from tests.llm.test_llm import LOW, components_by_force, hits_by_force


def lines_by_force(rows):
    space = " \t\n\x0b\x0c\r"
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(space).translate(LOW)
            if len(key) >= 10:
                holders.setdefault(key, set()).add(i)
    return [(i, "\n".join(x for x in (t or "").split("\n")
                          if len(holders.get(k := x.strip(space).translate(LOW), ())) < 2 or min(holders[k]) == i)) for i, t in rows]


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rows = [(r[0], r[1]) for r in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()]
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality.ORACLE}) WHERE kept").fetchall()}
    want = [(i, t) for i, t in rows if i in kept]
    stages = iter(corpus_pipeline.STAGES)

    def run(frame):
        out = next(stages)[1](spark, frame, SF_SMALL)
        path = tempfile.mkdtemp(prefix="llm-stage-") + "/out"
        out.write.parquet(path)
        back = spark.read.parquet(path)
        return back, sorted((r.doc_id, r.text) for r in back.select("doc_id", "text").collect()) if "text" in back.columns else None

    frame, got = run(docs)
    assert got == want and frame.columns == docs.columns and 0 < len(got) < len(rows)
    frame, got = run(frame)
    want = lines_by_force(want)
    assert got == want and frame.columns == docs.columns
    assert frame.where("n_chars <> char_length(text)").count() == 0
    frame, got = run(frame)
    first = {i for i, _, c in components_by_force(want, 5, 80) if i == c}
    want = [(i, t) for i, t in want if i in first]
    assert got == want and frame.columns == docs.columns
    frame, got = run(frame)
    want = [(i, t) for i, t in want if not (h := hits_by_force(t, items))[1] or 20 * h[1] < h[0]]
    assert got == want and frame.columns == docs.columns
    frame, _ = run(frame)
    code = tokens.Coder(tokens.tokenizer_path(corpus_pipeline.TOKENIZER), "bare", 2).library
    pieces = {}
    for r in frame.orderBy("doc_id", "start").collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert sorted(pieces) == [i for i, _ in want]
    for i, t in want:
        ids, at = np.array(code.encode(t, add_special_tokens=False).ids + [2], "<u4"), 0
        for r in pieces[i]:
            assert r.start == at and zlib.crc32(ids[at:at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    total = corpus_pipeline.run(spark, SF_SMALL).agg(F.sum("length")).first()[0]
    assert total == sum(r.length for p in pieces.values() for r in p)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, None, "en", "a", None), (2, "", None, "a", 0), (2, "x " * 40 + "end", None, None, 5),
                                       (2, "x " * 40 + "end", None, None, 5), (None, " ".join(f"w{i}" for i in range(30)), "en", "a", 9)]])
def test_pipeline_takes_nulls_repeats_and_empty_tables(spark, rows):
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"rep": F.lit(1), "n": F.lit(2)})
    frame = given
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF_SMALL)
        if name != "packing":
            assert frame.columns == given.columns
    assert frame.count() == (0 if not rows else frame.select("sequence_id", "offset").distinct().count())
