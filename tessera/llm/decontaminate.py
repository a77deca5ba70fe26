"""Benchmark decontamination: windows of normalised benchmark words, looked up in every training window.

Words are runs of ASCII letters and digits and of any character beyond ASCII, with A-Z lower-cased.
An item gives every run of ``WINDOW`` consecutive words, or its whole word sequence where it is
shorter. A window's hash is looked up in the benchmark's hash set; a hit is verified word by word.

Cases: null or empty texts have no words and no hits; repeated rows are judged each by itself; a
benchmark row without an id still marks words but is not listed among the items; a window that an item
repeats counts once, so long runs of one word cost no more than others; very long texts are scanned whole;
empty tables give empty results, or documents without hits. Columns named ``__hit_*`` are reserved.
"""

from __future__ import annotations

import pickle
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import words as W
from tessera.llm.common import open_fs, python_ready, query, read_table, shared_path

WINDOW = 13
#: Benchmark text in one hash set (bytes). A larger benchmark is split into several sets, each
#: held against all documents in turn, so a worker never holds more than one set of this size.
BLOCK_BYTES = 16 << 20


class WindowIndex:
    """The windows of some benchmark items by length, each once an item, with a bit table in front of the sorted
    hashes. An item's words are kept as one byte string and the places where they begin."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        by_length: dict[int, list] = {}
        self.items, self.texts, self.begins = [], [], []
        for name, text in items:
            data = np.frombuffer(text, np.uint8)
            _, h, s, e = W.word_hashes(data, np.array([0, len(data)]), W.ALPHANUMERIC, positions=True)
            if not len(h):
                continue
            n = min(window, len(h))
            wh = W.window_hashes(h, n)
            self.items.append(name)
            lower = text.lower()
            self.texts.append(b"\0".join([*(lower[a:b] for a, b in zip(s.tolist(), e.tolist())), b""]))
            self.begins.append(np.concatenate([[0], np.cumsum(e - s + 1)]).astype(np.int64))
            at = self._distinct(wh, n)
            by_length.setdefault(n, []).append((wh[at], np.full(len(at), len(self.items) - 1), at))
        self.lengths = {}
        for n, parts in by_length.items():
            h, item, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            size = max(16, int(len(h) * 64).bit_length())
            table = np.zeros(1 << (size - 3), np.uint8)
            mask = np.uint64((1 << size) - 1)
            bit = h & mask
            np.bitwise_or.at(table, bit >> np.uint64(3), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
            self.lengths[n] = (h[order], item[order], at[order], table, mask)

    def _window(self, item: int, start: int, n: int) -> bytes:
        begins = self.begins[item]
        return self.texts[item][begins[start]:begins[start + n]]

    def _distinct(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """First places of the different windows of the last item (told apart by their words, not by the hash alone)."""
        order = np.argsort(hashes, kind="stable")
        again = np.flatnonzero(np.diff(hashes[order]) == 0) + 1
        keep = np.ones(len(hashes), bool)
        item = len(self.items) - 1
        first, seen = None, set()
        for j in again.tolist():
            if hashes[order[j]] != first:                    # a new run of equal hashes
                first, seen = hashes[order[j]], {self._window(item, int(order[j - 1]), n)}
            here = self._window(item, int(order[j]), n)
            keep[order[j]] = here not in seen
            seen.add(here)
        return np.flatnonzero(keep)

    def hits(self, hashes: np.ndarray, doc: np.ndarray, word) -> Iterator[tuple[int, int, int]]:
        """(first word, length, item) of every verified window; ``word(i)`` gives a word's bytes."""
        for n, (known, item, at, table, mask) in self.lengths.items():
            wh = W.window_hashes(hashes, n)
            if not len(wh):
                continue
            bit = wh & mask
            maybe = np.flatnonzero(table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
            maybe = maybe[doc[maybe] == doc[maybe + n - 1]]
            lo = np.searchsorted(known, wh[maybe], "left")
            hi = np.searchsorted(known, wh[maybe], "right")
            for i, a, b in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                here = b"\0".join([*(word(j) for j in range(i, i + n)), b""])
                for k in range(a, b):
                    if self._window(int(item[k]), int(at[k]), n) == here:
                        yield i, n, int(item[k])


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int):
    """One broadcast hash set, or the files of several where the benchmark is beyond the bound."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).cast("binary").alias("t")).where("t is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    build = lambda part: WindowIndex([(r.i, bytes(r.t)) for r in part.collect()], window)
    if n == 1:
        return spark.sparkContext.broadcast(build(rows)), []
    folder = shared_path(spark, "benchmark")
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)
    files = []
    for b in range(n):
        with fs.open_output_stream(f"{path}/{b:05d}") as f:
            f.write(pickle.dumps(build(rows.where(F.pmod(F.xxhash64("t"), F.lit(n)) == b))))
        files.append(f"{folder}/{b:05d}")
    return None, files


def find_hits(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
              item_text: str = "text", window: int = WINDOW, carry: list[str] | None = None,
              cut_spans: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (its ``carry`` columns, or all) with the benchmark windows found in each text.

    Adds ``__hit_words`` (words of the text), ``__hit_count`` (words inside any hit) and
    ``__hit_items`` (sorted ids of the items found). With ``cut_spans`` the text comes back without
    the hit spans (from the first to the last byte of each run of hit words).
    """
    spark = docs.sparkSession
    python_ready(spark)
    shared, files = _blocks(benchmark, item, item_text, window, block_bytes)
    carry = docs.columns if carry is None else carry
    given = docs.select(F.col(f"`{text}`").cast("string").alias("__hit_text"),
                        *[F.col(f"`{c}`") for c in carry if not (cut_spans and c == text)])
    schema = given.drop("__hit_text").schema
    schema = schema.add("__hit_words", T.LongType()).add("__hit_count", T.LongType())
    schema = schema.add("__hit_items", T.ArrayType(T.StringType()))
    if cut_spans:
        schema = schema.add("__hit_text", T.StringType())

    def indexes() -> Iterator[WindowIndex]:
        if shared is not None:
            yield shared.value
        for uri in files:
            fs, path = open_fs(uri)
            with fs.open_input_stream(path) as f:
                yield pickle.loads(f.read())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffers(batch.column("__hit_text"))
            slices = list(W.slices(offsets))
            scans = [_Scan(hi - lo) for lo, hi in slices]
            for index in indexes():                          # a block is loaded once for a whole batch
                for (lo, hi), scan in zip(slices, scans):
                    scan.mark(data, offsets[lo:hi + 1], index)
            for (lo, hi), scan in zip(slices, scans):
                part = batch.slice(lo, hi - lo)
                counts, hit, found, spans = scan.result(data, offsets[lo:hi + 1], cut_spans)
                columns = [part.column(i) for i, f in enumerate(batch.schema.names) if f != "__hit_text"]
                names = [f for f in batch.schema.names if f != "__hit_text"]
                columns += [pa.array(counts), pa.array(hit),
                            pa.array([sorted(found[i]) if i in found else [] for i in range(hi - lo)], pa.list_(pa.string()))]
                names += ["__hit_words", "__hit_count", "__hit_items"]
                if cut_spans:
                    columns.append(_without(part.column("__hit_text"), spans))
                    names.append("__hit_text")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return given.mapInArrow(scan, schema)


class _Scan:
    """What the blocks of a benchmark mark in a slice of texts."""

    def __init__(self, texts: int):
        self.texts = texts
        self.begun: list[tuple[int, int]] = []               # (first word, words) of the hits
        self.found: dict[int, set] = {}
        self.counts = None

    def mark(self, data, offsets, index: WindowIndex) -> None:
        self.counts, h, s, e = W.word_hashes(data, offsets, W.ALPHANUMERIC, positions=True)
        doc = np.repeat(np.arange(self.texts), self.counts)
        word = lambda j: data[s[j]:e[j]].tobytes().lower()
        last = None
        for i, length, k in index.hits(h, doc, word):
            if (i, length) != last:                          # one mark, however many items hold the window
                last = (i, length)
                self.begun.append(last)
            ids = self.found.setdefault(int(doc[i]), set())
            if index.items[k] is not None:
                ids.add(index.items[k])

    def result(self, data, offsets, want_spans: bool):
        counts, n = self.counts, self.texts
        doc = np.repeat(np.arange(n), counts)
        cover = np.zeros(len(doc) + 1, np.int64)
        if self.begun:
            first, size = np.array(self.begun, np.int64).T
            np.add.at(cover, first, 1)
            np.add.at(cover, first + size, -1)
        inside = np.cumsum(cover[:-1]) > 0
        hit = np.bincount(doc[inside], minlength=n).astype(np.int64)
        spans: dict[int, list[tuple[int, int]]] = {}
        if want_spans and inside.any():
            _, _, s, e = W.word_hashes(data, offsets, W.ALPHANUMERIC, positions=True)
            edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
            edge_doc = np.flatnonzero(inside[1:] & inside[:-1] & (doc[1:] != doc[:-1])) + 1
            begins = np.union1d(np.flatnonzero(edge == 1), edge_doc)
            stops = np.union1d(np.flatnonzero(edge == -1), edge_doc)
            for a, b in zip(begins.tolist(), stops.tolist()):
                d = int(doc[a])
                spans.setdefault(d, []).append((int(s[a] - offsets[d]), int(e[b - 1] - offsets[d])))
        return counts, hit, self.found, spans


def _without(column: pa.Array, spans: dict[int, list[tuple[int, int]]]) -> pa.Array:
    if not spans:
        return column
    texts = column.to_pylist()
    for i, cuts in spans.items():
        raw, at, kept = texts[i].encode(), 0, []
        for a, b in cuts:
            kept.append(raw[at:a])
            at = b
        texts[i] = b"".join([*kept, raw[at:]]).decode()
    return pa.array(texts, column.type)


def contaminated():
    """The rule over the columns of ``find_hits``: hit words are at least a twentieth of the words."""
    return (F.col("__hit_count") > 0) & (20 * F.col("__hit_count") >= F.col("__hit_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **options) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with the hit spans cut out."""
    if remove == "spans":
        text = options.get("text", "text")
        found = find_hits(docs, benchmark, cut_spans=True, **options)
        return found.select(*[F.col("__hit_text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
    found = find_hits(docs, benchmark, **options)
    return found.where(~contaminated()).select(*[F.col(f"`{c}`") for c in docs.columns])


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LEADS = ", ".join(f"lead(x, {i}) OVER o" for i in range(1, WINDOW))
ORACLE = rf"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) l, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) i FROM b WHERE len(w) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  FROM documents),
u AS (SELECT doc_id, unnest(w) x, generate_subscripts(w, 1) i FROM d),
v AS (SELECT doc_id, i, [x, {_LEADS}] s FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
dw AS (SELECT doc_id, i, l, array_to_string(s[1:l], ' ') g FROM v, (SELECT DISTINCT l FROM bw) WHERE s[l] IS NOT NULL),
hit AS (SELECT doc_id, item, i, dw.l FROM dw JOIN bw ON dw.l = bw.l AND dw.g = bw.g),
cover AS (SELECT doc_id, count(*) n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + l)) p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) n, sha256(string_agg(item, ',' ORDER BY item)) s FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) n_words, coalesce(cover.n, 0) n_hit, coalesce(items.n, 0) n_items,
       coalesce(items.s, sha256('')) items_sha256, coalesce(cover.n, 0) > 0 AND 20 * coalesce(cover.n, 0) >= len(w) contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op3_decontaminate", ORACLE)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document held against every benchmark item."""
    found = find_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select(
        "doc_id", F.col("__hit_words").alias("n_words"), F.col("__hit_count").alias("n_hit"),
        F.size("__hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("__hit_items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))
