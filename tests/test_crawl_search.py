"""Crawl reach / walk against brute force on a small fixture; dedup; search and facets."""

import random
from collections import deque

from pyspark.sql import functions as F

from tessera.operators import crawl, search as se


def _edges(seed=5, n_nodes=30, n_edges=120):
    rnd = random.Random(seed)
    return [(rnd.randrange(n_nodes), i, rnd.randrange(n_nodes)) for i in range(n_edges)]


def brute_walk(edges, start, steps):
    out = [(start, 0, start)]
    seen, cur = [start], start
    for s in range(1, steps + 1):
        links = sorted((o, d) for src, o, d in edges if src == cur)
        nxt = next((d for o, d in links if d not in seen), None)
        if nxt is None:
            break
        seen.append(nxt)
        cur = nxt
        out.append((start, s, nxt))
    return out


def brute_reach(edges, start, max_hops):
    dist = {start: 0}
    q = deque([start])
    while q:
        u = q.popleft()
        if dist[u] == max_hops:
            continue
        for src, _, d in edges:
            if src == u and d not in dist:
                dist[d] = dist[u] + 1
                q.append(d)
    return dist


def test_walk_matches_brute_force(spark):
    edges = _edges()
    e = spark.createDataFrame(edges, "src long, ord long, dst long")
    starts = e.select(F.col("src").alias("node")).distinct()
    got = sorted(tuple(r) for r in crawl.walk(e, starts, 4).collect())
    want = sorted(x for s in {src for src, _, _ in edges} for x in brute_walk(edges, s, 4))
    assert got == want


def test_a_visited_start_moves_to_its_next_unvisited_link(spark):
    edges = _edges(seed=8)
    e = spark.createDataFrame(edges, "src long, ord long, dst long")
    gone = set(range(0, 30, 3))
    starts = sorted({src for src, _, _ in edges})
    got = sorted(tuple(r) for r in crawl.walk(e, spark.createDataFrame([(s,) for s in starts], "node long"), 4,
                                              spark.createDataFrame([(g,) for g in gone], "node long")).collect())
    free = [x for x in edges if x[2] not in gone]
    want = []
    for s in starts:
        first = s if s not in gone else next((d for o, d in sorted((o, d) for src, o, d in free if src == s)), None)
        if first is not None:
            want += [(s, step, node) for _, step, node in brute_walk(free, first, 4)]
    assert got == sorted(want) and any(s in gone for s, _, _ in got)


def test_reach_matches_brute_force(spark):
    edges = _edges(seed=9)
    e = spark.createDataFrame(edges, "src long, ord long, dst long")
    start = edges[0][0]
    got = {r.node: r.hops for r in crawl.reach(e, spark.createDataFrame([(start,)], "node long"), 3).collect()}
    assert got == brute_reach(edges, start, 3)


def test_dedup_keeps_first_and_skips_seen(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "id long, t string")
    seen = crawl.seen_hashes(spark.createDataFrame([("c",)], "t string"), F.col("t"))
    got = sorted((r.id, r.copies) for r in crawl.dedup_by_hash(df, F.col("t"), "id", seen=seen).collect())
    assert got == [(1, 2), (2, 1)]


def test_tokens_postings_search(spark):
    docs = spark.createDataFrame([(1, "The Koala, the koala!"), (2, "Mit avec con; ÉTÉ été")], "id long, text string")
    toks = [r.t for r in docs.select(se.tokens(F.col("text")).alias("t")).orderBy("id").collect()]
    assert toks == [["koala", "koala"], ["mit", "avec", "con", "été", "été"]]
    post = se.postings(docs, "id", ["text"])
    k = post.filter("term = 'koala'").collect()[0]
    assert (k.doc_id, k.tf, k.first_pos) == (1, 2, 0)
    assert [r.id for r in se.term_search(post, docs, "id", "text", "KOALA", fl=["id"]).collect()] == [1]
    assert se.expand_synonyms(["avec"], {"mit": ["avec", "con"]}) == ["avec", "con", "mit"]
    assert se.synonym_search(post, "text", ["con"], {"mit": ["avec", "con"]}).collect()[0].hits == 3
    facets = {r.term: r.n for r in se.facet_terms(post, "text", contains="t").collect()}
    assert facets == {"mit": 1, "été": 2}


def test_scan_forms_equal_index_forms(spark):
    docs = spark.createDataFrame([(1, "Mit avec, AVEC und"), (2, "con con"), (3, "nothing here")],
                                 "id long, text string")
    post = se.postings(docs, "id", ["text"])
    syn = {"mit": ["avec", "con"]}
    a = sorted(tuple(r) for r in se.synonym_search(post, "text", ["avec"], syn).collect())
    b = sorted(tuple(r) for r in se.synonym_search_scan(docs, "id", "text", ["avec"], syn).collect())
    assert a == b == [(1, 3), (2, 2)]
    assert [r.id for r in se.term_search_scan(docs, "text", "UND", fl=["id"]).collect()] == [1]
    f1 = sorted(tuple(r) for r in se.facet_terms(post, "text").collect())
    f2 = sorted(tuple(r) for r in se.facet_counts(docs, "text").collect())
    assert f1 == f2


def test_positions_phrases_and_distances_match_brute_force(spark):
    import random
    import re

    rnd = random.Random(4)
    words = ["red", "Blue", "the", "green", "of", "tea"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 40, 400]))) for _ in range(60)] + [None, "", "tea " * 3000 + "red"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("term", F.lit("x"))
    index = se.positional_postings(docs, "doc_id", ["text"])
    split = {i: [w.lower() for w in re.findall(r"\w+", t or "")] for i, t in enumerate(texts)}
    got = {(r.doc_id, r.term): (r.tf, r.at) for r in index.select("doc_id", "term", "tf", se.positions().alias("at")).collect()}
    want = {}
    for i, w in split.items():
        for p, t in enumerate(w):
            if t not in se.STOP_WORDS:
                want.setdefault((i, t), []).append(p)
    assert got == {k: (len(v), v) for k, v in want.items()}
    assert index.where(F.exists("blocks", lambda b: F.size(b["gaps"]) >= se.BLOCK)).count() == 0
    for phrase in ("red blue", "tea the red", "tea tea tea", "green of the blue", "red missing", "the"):
        q = phrase.split()
        hits = {}
        for i, w in split.items():
            n = sum(all(t in se.STOP_WORDS or w[p + k] == t for k, t in enumerate(q)) for p in range(len(w) - len(q) + 1))
            if n and phrase != "the":
                hits[i] = n
        # a stop word stands for any word, also beyond the end of the text
        assert {r.doc_id: r.hits for r in se.phrase_search(index, "text", phrase).collect()} == hits
    for terms, slop in ((["red", "blue"], 1), (["red", "green", "tea"], 4), (["tea"], 2), (["red", "missing"], 9)):
        hits = {}
        for i, w in split.items():
            n = sum(t == terms[0] and all(o in w[max(0, p - slop):p + slop + 1] for o in terms[1:]) for p, t in enumerate(w))
            if n:
                hits[i] = n
        assert {r.doc_id: r.hits for r in se.near_search(index, "text", terms, slop).collect()} == hits


def test_a_stored_index_is_read_by_term(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"w{i % 7} common w{i % 3}") for i in range(200)], "doc_id long, text string")
    se.stored_order(se.positional_postings(docs, "doc_id", ["text"])).write.parquet(f"{tmp_dir}/index")
    index = spark.read.parquet(f"{tmp_dir}/index")
    plan = se.phrase_search(index, "text", "common w2")._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [common,w2])" in plan and "EqualTo(field,text)" in plan


def test_longest_pattern_by_anchors_matches_brute_force(spark):
    import random

    from tessera.operators import pages as pg

    rnd = random.Random(9)
    word = lambda n: "".join(rnd.choice("abcé") for _ in range(n))
    pats = list({word(rnd.choice([1, 2, 3, 4, 5, 6, 9])) for _ in range(60)}) + ["", "zzzz", "zz", None]
    values = [word(rnd.choice([0, 1, 3, 4, 8, 30])) for _ in range(150)] + [None, "", "zz", "ZZ", pats[0] * 40]
    df = spark.createDataFrame(list(enumerate(values)), "k long, v string").withColumn("anchor", F.lit("x"))
    table = spark.createDataFrame([(p, 1) for p in pats + pats[:5]], "p string, gram int")
    got = {r.k: r.best for r in pg.best_match_table(df, "k", "v", table, "p").collect()}
    for k, v in enumerate(values):
        found = sorted((p for p in pats if p and v is not None and p in v), key=lambda p: (-len(p), p))
        assert got[k] == (found[0] if found else "not found")
    empty = pg.best_match_table(df, "k", "v", table.limit(0), "p")
    assert {r.best for r in empty.collect()} == {"not found"}


def test_an_index_is_built_in_sorted_runs_without_a_shuffle(spark, monkeypatch, tmp_dir):
    monkeypatch.setattr(se, "RUN_TOKENS", 5)                  # runs of few documents; a long one is a run of its own
    texts = ["b e b the e", None, "c " * 9, "", "e", "the of"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_dir}/docs")
    docs = spark.read.parquet(f"{tmp_dir}/docs")
    rows = [tuple(r) for r in se.positional_postings(docs, "doc_id", ["text"]).select("term", "doc_id", "tf").collect()]
    assert sorted(rows) == [("b", 0, 2), ("c", 2, 9), ("e", 0, 2), ("e", 4, 1)]
    for index in (se.postings(docs, "doc_id", ["text"]), se.positional_postings(docs, "doc_id", ["text"])):
        plan = index._jdf.queryExecution().executedPlan().toString()
        assert "Exchange rangepartitioning" not in plan and "Sort" not in plan
    two = list(se._runs(iter([_tokens_batch([["b", "a", "b"], ["a"], ["z"] * 9, []])]), []))
    assert [(r[0].to_pylist(), r[1].to_pylist(), r[2].tolist()) for r in two] == [([0, 1, 0], ["a", "a", "b"], [1, 1, 2]), ([2], ["z"], [9])]


def _tokens_batch(tokens):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(range(len(tokens)), pa.int64()), pa.array(tokens, pa.list_(pa.string()))], names=["doc_id", "t"])


def test_longest_pattern_broadcasts_no_table(spark):
    from tessera.operators import pages as pg

    df = spark.createDataFrame([(i, f"value {i % 3}") for i in range(30)], "k long, v string")
    pats = spark.createDataFrame([("value",), ("value 1",), ("e",)], "p string")
    out = pg.best_match_table(df, "k", "v", pats, "p")
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert {(r.k % 3, r.best) for r in out.collect()} == {(0, "value"), (1, "value 1"), (2, "value")}
