"""Text analysis, postings, term / synonym search and facet counts.

Tokens are maximal runs of letters and digits (``[^\\p{L}\\p{N}]+`` splits), lower-cased; stop words
are compared case-insensitively. Postings are long rows ``(field, term, doc_id, tf, first_pos)``, or with
all positions as delta-coded blocks for phrase and proximity searches; no per-term list is ever collected, so a very common term is just many rows spread over the
shuffle, and facet counts use partial (map-side) aggregation.
"""

from __future__ import annotations

import re
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ship_package, spread

SPLIT = r"[^\p{L}\p{N}]+"

# Default English stop words (the classic analyzer list); callers may pass their own.
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
              "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
              "they", "this", "to", "was", "will", "with"]


def tokens(text: Column, stop_words: Iterable[str] | None = None) -> Column:
    """array<string>: lower-cased tokens with stop words removed (empty tokens dropped)."""
    toks = F.filter(F.split(F.lower(text), SPLIT), lambda t: F.length(t) > 0)
    stops = [w.lower() for w in (STOP_WORDS if stop_words is None else stop_words)]
    if stops:
        # a literal IN list above the conversion threshold becomes a hash-set lookup (InSet)
        toks = F.filter(toks, lambda t: ~t.isin(stops))
    return toks


#: Tokens that a task sorts at a time; each run of so many is one sorted part of the index.
RUN_TOKENS = 1_000_000

#: Positions in one block of a posting; a block holds its first position and the gaps to the others.
BLOCK = 32


def _runs(batches, stops):
    """For runs of documents (id, tokens) of about ``RUN_TOKENS``: ids, terms, tf, starts and positions of the postings, in
    the order of (term, document)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo, done = 0, 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, done + RUN_TOKENS, "right")))
            size = np.diff(ends[lo:hi], prepend=done)
            coded = batch.column(1).slice(lo, hi - lo).flatten().dictionary_encode()
            by_name = pc.sort_indices(coded.dictionary)
            rank = np.empty(len(by_name), np.int64)
            rank[by_name.to_numpy()] = np.arange(len(by_name))
            terms = coded.dictionary.take(by_name)
            doc = np.repeat(np.arange(hi - lo), size)
            pos = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
            key = rank[coded.indices.to_numpy()] * (hi - lo) + doc
            if stops:
                kept = ~pc.is_in(terms, pa.array(stops, terms.type)).to_numpy(zero_copy_only=False).astype(bool)[key // (hi - lo)]
                key, pos = key[kept], pos[kept]
            order = np.argsort(key, kind="stable")
            key, pos = key[order], pos[order].astype(np.int32)
            start = np.flatnonzero(np.diff(key, prepend=-1))
            if len(start):
                yield batch.column(0).slice(lo, hi - lo).take(pa.array(key[start] % (hi - lo))), terms.take(pa.array(key[start] // (hi - lo))), np.diff(start, append=len(key)), start, pos
            lo, done = hi, int(ends[hi - 1])


def _blocks(tf, start, pos):
    """Arrow lists of the blocks of postings that begin at ``start`` in ``pos``."""
    import numpy as np
    import pyarrow as pa

    n = -(-tf // BLOCK)
    first = np.cumsum(n) - n
    at = np.repeat(start, n) + BLOCK * (np.arange(n.sum()) - np.repeat(first, n))
    opens = np.zeros(len(pos), bool)
    opens[at] = True
    gaps = np.diff(pos, prepend=pos[:1])[~opens]
    offsets = np.append(at - np.arange(len(at)), len(gaps)).astype(np.int32)
    blocks = pa.StructArray.from_arrays([pa.array(pos[at]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(gaps.astype(np.int32)))], ["first", "gaps"])
    return pa.ListArray.from_arrays(pa.array(np.append(first, n.sum()).astype(np.int32)), blocks)


def _indexed(docs: DataFrame, key: str, fields: Sequence[str], analysed, stops: list[str], column: str, kind: str, cut) -> DataFrame:
    """(field, term, doc_id, tf, ``column``) of every field. Spark breaks the texts up; their tokens are counted and
    put in order a run of documents at a time, so no row is shuffled and each run is sorted by (term, document)."""
    docs = spread(docs, key)
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("field", T.StringType()), T.StructField("term", T.StringType()), T.StructField("doc_id", docs.schema[key].dataType),
                           T.StructField("tf", T.LongType()), T.StructField(column, T._parse_datatype_string(kind))])

    def count(field):
        def rows(batches):
            import numpy as np
            import pyarrow as pa

            for ids, terms, tf, start, pos in _runs(batches, stops):
                names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(tf), np.int32)), pa.array([field])).dictionary_decode()
                yield pa.RecordBatch.from_arrays([names, terms, ids, pa.array(tf.astype(np.int64)), cut(tf, start, pos)], names=schema.names)
        return rows

    out = None
    for f in fields:
        part = docs.select(F.col(key).alias("doc_id"), analysed(F.col(f)).alias("t")).mapInArrow(count(f), schema)
        out = part if out is None else out.unionByName(part)
    return out


def postings(docs: DataFrame, key: str, fields: Sequence[str], stop_words: Iterable[str] | None = None) -> DataFrame:
    """(field, term, doc_id, tf, first_pos) for every field/term/document; no shuffle is needed."""
    def first(tf, start, pos):
        import pyarrow as pa
        return pa.array(pos[start])

    return _indexed(docs, key, fields, lambda text: tokens(text, stop_words), [], "first_pos", "int", first)


def positional_postings(docs: DataFrame, key: str, fields: Sequence[str], stop_words: Iterable[str] | None = None) -> DataFrame:
    """(field, term, doc_id, tf, blocks): postings with all positions, delta-coded in blocks of ``BLOCK``.

    A position counts all tokens of the field before it, stop words too, so words keep their distances.
    No shuffle is needed; a document's positions are spread over its terms, and a very long run is
    many small blocks. A null field has no tokens.
    """
    stops = [w.lower() for w in (STOP_WORDS if stop_words is None else stop_words)]
    return _indexed(docs, key, fields, lambda text: tokens(text, []), stops, "blocks", "array<struct<first:int,gaps:array<int>>>", _blocks)


def positions(blocks: str = "blocks") -> Column:
    """array<int>: the positions that a posting's blocks hold, rising. Gaps are summed inside a block only."""
    return F.expr(f"flatten(transform({blocks}, b -> concat(array(b.first), transform(b.gaps, (g, i) -> "
                  "b.first + aggregate(slice(b.gaps, 1, i + 1), 0, (a, x) -> a + x)))))")


def _query_terms(text: str, stop_words: Iterable[str] | None) -> list[tuple[str, int]]:
    """(term, place) of the words of a query, analysed as documents are; stop words leave a gap."""
    stops = {w.lower() for w in (STOP_WORDS if stop_words is None else stop_words)}
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return [(w, i) for i, w in enumerate(words) if w not in stops]


def _places(index: DataFrame, field: str, terms: Sequence[str]) -> DataFrame:
    """(doc_id, at map<term, positions>) of the documents that hold all of ``terms``. The filter on field and term
    goes into the scan of a stored index; of each document only these terms' postings are shuffled."""
    hits = index.where((F.col("field") == field) & F.col("term").isin(*terms)).select("doc_id", "term", positions().alias("at"))
    found = hits.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "at"))).alias("at"))
    return found.where(F.size("at") == len(terms))


def _back(n: int):
    return lambda p: p - n


def phrase_search(index: DataFrame, field: str, phrase: str, stop_words: Iterable[str] | None = None) -> DataFrame:
    """(doc_id, hits): documents holding the words of ``phrase`` one after another, and how often.

    Each word's positions are shifted back by its place in the phrase; what all words then share are the
    places where the phrase begins. A stop word in the phrase stands for any one word.
    """
    words = _query_terms(phrase, stop_words)
    if not words:
        return index.select("doc_id", F.lit(0).cast("bigint").alias("hits")).limit(0)
    at = _places(index, field, sorted({w for w, _ in words}))
    starts = None
    for w, i in words:
        shifted = F.transform(F.col("at")[w], _back(i))
        starts = shifted if starts is None else F.array_intersect(starts, shifted)
    return at.select("doc_id", F.size(starts).cast("bigint").alias("hits")).where("hits > 0")


def near_search(index: DataFrame, field: str, terms: Sequence[str], slop: int) -> DataFrame:
    """(doc_id, hits): documents in which some place of the first term has all other terms at most ``slop``
    positions away, before or after; ``hits`` counts these places."""
    terms = list(dict.fromkeys(t.lower() for t in terms))
    at = _places(index, field, terms)
    found = F.col("at")[terms[0]]
    for t in terms[1:]:
        around = F.flatten(F.transform(F.col("at")[t], lambda p: F.sequence(p - slop, p + slop)))
        found = F.array_intersect(found, around)
    return at.select("doc_id", F.size(found).cast("bigint").alias("hits")).where("hits > 0")


def stored_order(post: DataFrame) -> DataFrame:
    """Postings in the order an index is stored in: by ranges of (field, term, document), sorted, so a
    term's rows lie in few files (a very common term in several) and statistics skip the others."""
    return post.repartitionByRange("field", "term", "doc_id").sortWithinPartitions("field", "term", "doc_id")


def delete_docs(post: DataFrame, doomed: DataFrame, key: str) -> DataFrame:
    """Postings without those of the documents in ``doomed`` (column ``key``)."""
    return post.join(doomed.select(F.col(key).alias("doc_id")).distinct(), "doc_id", "left_anti")


def term_search(post: DataFrame, docs: DataFrame, key: str, field: str, value: str | None,
                fl: Sequence[str] | None = None) -> DataFrame:
    """``field:value`` (``value=None`` is ``*:*``) -> matching documents with the ``fl`` columns."""
    out = docs
    if value is not None:
        hits = post.filter((F.col("field") == field) & (F.col("term") == value.lower())).select(F.col("doc_id").alias(key))
        out = docs.join(hits, key, "left_semi")
    return out.select(*(fl or docs.columns))


def expand_synonyms(terms: Sequence[str], synonyms: Mapping[str, Sequence[str]]) -> list[str]:
    """Query-time expansion (expand=true): every term of a synonym group stands for the whole group."""
    groups = [set([k.lower(), *[v.lower() for v in vs]]) for k, vs in synonyms.items()]
    out: list[str] = []
    for t in terms:
        t = t.lower()
        grp = next((g for g in groups if t in g), {t})
        out.extend(sorted(grp - set(out)))
    return out


def synonym_search(post: DataFrame, field: str, terms: Sequence[str], synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """(doc_id, hits): documents holding any expanded query term, with the total term frequency."""
    expanded = expand_synonyms(terms, synonyms)
    hits = post.filter((F.col("field") == field) & F.col("term").isin(expanded))
    return hits.groupBy("doc_id").agg(F.sum("tf").cast("bigint").alias("hits"))


def facet_terms(post: DataFrame, field: str, contains: str | None = None) -> DataFrame:
    """(term, n): occurrences of each term of ``field``; ``contains`` keeps terms holding it."""
    p = post.filter(F.col("field") == field)
    if contains:
        p = p.filter(F.col("term").contains(contains.lower()))
    return p.groupBy("term").agg(F.sum("tf").cast("bigint").alias("n"))


# --- scan-time forms (no stored index): one pass over the documents, no shuffle for searches ------
# On a large input the filters below run inside the (many) scan tasks; with a stored index prefer
# the postings forms above, whose term filter is pushed into the postings scan.

def match_terms(docs: DataFrame, field: str, terms: Sequence[str], stop_words: Iterable[str] | None = None) -> DataFrame:
    """Documents whose ``field`` holds any of ``terms``, with ``hits`` = their total frequency.
    A per-row filter: no postings, no shuffle."""
    wanted = [t.lower() for t in terms]
    # filter first with exists(): a filter on a computed column would be pushed below the
    # projection with the tokenizer inlined, tokenising every document twice
    present = F.exists(tokens(F.col(field), stop_words), lambda t: t.isin(wanted))
    hits = F.size(F.filter(tokens(F.col(field), stop_words), lambda t: t.isin(wanted)))
    return docs.filter(present).withColumn("hits", hits.cast("bigint"))


def term_search_scan(docs: DataFrame, field: str, value: str | None, fl: Sequence[str] | None = None) -> DataFrame:
    """``field:value`` over the documents themselves (``None`` is ``*:*``)."""
    out = docs if value is None else docs.filter(F.exists(tokens(F.col(field)), lambda t: t == value.lower()))
    return out.select(*(fl or docs.columns))


def synonym_search_scan(docs: DataFrame, key: str, field: str, terms: Sequence[str],
                        synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """(key, hits) for documents holding any expanded query term."""
    return match_terms(docs, field, expand_synonyms(terms, synonyms)).select(key, "hits")


def facet_counts(docs: DataFrame, field: str, contains: str | None = None,
                 stop_words: Iterable[str] | None = None) -> DataFrame:
    """(term, n) straight from the token stream: one shuffle, partially aggregated map-side."""
    t = docs.select(F.explode(tokens(F.col(field), stop_words)).alias("term"))
    if contains:
        t = t.filter(F.col("term").contains(contains.lower()))
    return t.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
