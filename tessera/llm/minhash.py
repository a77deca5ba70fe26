"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find.

A document's set holds the hashes of its distinct runs of ``shingle`` words (the whole sequence
where it has fewer words; none without words). SuperMinHash gives every element one random
permutation of the registers and rank ``j + r`` at its j-th place, so the registers of one element
are correlated; a document is done at the first level at which all its registers hold a rank.

Documents with equal sets form one class, and only the class representative (smallest id) goes on.
Representatives sharing a band of registers are candidates:

* buckets of at most ``SMALL_BUCKET`` give their pairs, and a pair that shares ``min_shared`` bands
  is verified on the full sets of its two texts;
* larger buckets give no pair rows. They are joined into groups, a group is cut into blocks of
  about ``BLOCK`` documents, and every two blocks meet in one task, which compares all their
  documents exactly (as a product of 0/1 matrices) and returns a spanning forest of the links. Work
  still grows with the square of a group: n distinct texts move n * n / ``BLOCK`` texts.

No bucket or partner is capped. Cases: texts without words are linked with nothing and stay; rows
without an id get no component and stay; rows with one id are one document; empty tables give empty
results; other columns are ignored. Columns named ``__mh_*`` are reserved.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.common import python_ready, query, read_table, written
from tessera.llm.components import connected_components

REGISTERS, ROWS = 128, 4
BANDS = REGISTERS // ROWS
SMALL_BUCKET = 16
BLOCK = 256
_SLICE = 1 << 19                                            # bytes of text sketched at once
_EMPTY = np.uint32(0xFFFFFFFF)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    counts, h = W.word_hashes(data, offsets, W.SPACE_SEPARATED)
    windows = W.window_hashes(h, k)
    at = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for i, n in enumerate(counts.tolist()):
        a = int(at[i])
        if n >= k:
            out.append(np.unique(windows[a:a + n - k + 1]))
        else:
            out.append(W.window_hashes(h[a:a + n], n) if n else np.empty(0, np.uint64))
    return out


def super_minhash(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """SuperMinHash registers (texts x m) as j * 2**24 + r, for all sets at once, level by level."""
    registers = np.full(len(sets) * m, _EMPTY, np.uint32)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    chosen: list[np.ndarray] = []                            # k of the earlier levels, for each element
    for j in range(m):
        if not len(element):
            break
        rnd = W.mix(element + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        r = (rnd >> np.uint64(40)).astype(np.uint32)
        k = j + (((rnd & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        place = k.copy()                                     # what Fisher-Yates holds at position k now
        for i in range(j - 1, -1, -1):
            place[chosen[i] == place] = i
        np.minimum.at(registers, doc * m + place, np.uint32(j << 24) | r)
        chosen.append(k)
        open_docs = (registers.reshape(-1, m) == _EMPTY).any(axis=1)
        still = open_docs[doc]
        if not still.all():
            doc, element = doc[still], element[still]
            chosen = [c[still] for c in chosen]
    return registers.reshape(-1, m)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """64-bit key of each band (texts x bands); keys of different bands differ."""
    pairs = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for i in range(ROWS):
        key = W.mix(key * np.uint64(0x9E3779B97F4A7C15) + pairs[:, :, i])
    return key.view(np.int64)


def _sketches(k: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffers(batch.column("__mh_text"))
            for lo, hi in W.slices(offsets, _SLICE):
                sets = shingle_sets(data, offsets[lo:hi + 1], k)
                sizes = np.array([len(s) for s in sets], np.int64)
                digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), "<i8").reshape(-1, 2)
                full = np.flatnonzero(sizes)
                keys = band_keys(super_minhash([sets[i] for i in full])) if len(full) else np.empty((0, BANDS), np.int64)
                ends = np.cumsum(np.where(sizes > 0, BANDS, 0))
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__mh_id").slice(lo, hi - lo), pa.array(sizes), pa.array(digests[:, 0]), pa.array(digests[:, 1]), bands],
                    names=["id", "n", "k1", "k2", "bands"])
    return sketch


def _linked(inter, a, b, percent: int):
    return 100 * inter >= percent * (a + b - inter)


def _verify_pairs(k: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = W.text_buffers(batch.column("ta"))
            right = W.text_buffers(batch.column("tb"))
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            keep = []
            for i in range(len(a)):
                x = shingle_sets(left[0], left[1][i:i + 2], k)[0]
                y = shingle_sets(right[0], right[1][i:i + 2], k)[0]
                both = np.intersect1d(x, y, assume_unique=True)
                keep.append(bool(len(both)) and bool(_linked(len(both), len(x), len(y), percent)))
            keep = np.array(keep, bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])
    return verify


def block_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix of the links among ``sets``, by exact intersection sizes."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(np.concatenate(sets) if n else np.empty(0, np.uint64), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)                       # an element of one set meets nothing
    number = np.full(len(count), -1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    inter = np.zeros((n, n), np.float32)
    step = 4096
    for lo in range(0, len(shared), step):
        a, b = np.searchsorted(column, [lo, lo + step])
        part = np.zeros((n, min(step, len(shared) - lo)), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        inter += part @ part.T
    inter = inter.astype(np.int64)
    return (inter > 0) & _linked(inter, sizes[:, None], sizes[None, :], percent)


def _verify_blocks(k: int, percent: int):
    def verify(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        data, offsets = W.text_buffers(table.column("text"))
        sets = []
        for lo, hi in W.slices(offsets, _SLICE):
            sets += shingle_sets(data, offsets[lo:hi + 1], k)
        order = np.argsort(ids, kind="stable")
        ids, sets = ids[order], [sets[i] for i in order]
        links = block_links(sets, percent)
        label = np.arange(len(ids))                          # union-find over the matrix: smallest index reached
        while True:
            near = np.where(links, label[None, :], len(ids)).min(axis=1, initial=len(ids))
            new = np.minimum(label, near)
            new = np.minimum(new, new[new])
            if (new == label).all():
                break
            label = new
        away = label != np.arange(len(ids))
        return pa.table({"a": ids[label[away]], "b": ids[away]})
    return verify


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, id: str = "doc_id",  # noqa: A002
                    text: str = "text", min_shared: int = 2) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``."""
    spark = docs.sparkSession
    python_ready(spark)
    rows = docs.select(F.col(f"`{id}`").cast("bigint").alias("__mh_id"), F.col(f"`{text}`").cast("string").alias("__mh_text"))
    sketches = written(rows.mapInArrow(_sketches(shingle), "id bigint, n bigint, k1 bigint, k2 bigint, bands array<bigint>"), "sketches")
    classes = (sketches.where("n > 0 and id is not null").groupBy("k1", "k2")
               .agg(F.min(F.struct("id", "bands")).alias("first")).select("k1", "k2", F.col("first.id").alias("rep"), "first.bands"))
    classes = written(classes, "classes")

    entries = classes.select("rep", F.explode("bands").alias("bucket"))
    sizes = written(entries.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("hub")).where("size > 1"), "buckets")
    members = written(entries.join(sizes, "bucket"), "members")

    small = (members.where(F.col("size") <= SMALL_BUCKET).groupBy("bucket").agg(F.sort_array(F.collect_set("rep")).alias("r"))
             .select(F.explode(F.expr("flatten(transform(r, (x, i) -> transform(slice(r, i + 2, size(r)), y -> struct(x as a, y as b))))")).alias("p")))
    pairs = written(small.groupBy("p.a", "p.b").agg(F.count("*").alias("shared")).where(F.col("shared") >= min_shared).select("a", "b"), "pairs")

    large = members.where(F.col("size") > SMALL_BUCKET)
    groups = written(connected_components(large.select("rep", "hub").distinct()), "groups")
    group_sizes = written(groups.groupBy("component").agg(F.count("*").alias("members")), "group_sizes")

    active = (pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id")))
              .unionAll(groups.select(F.col("node").alias("id"))).distinct())
    # planned as a shuffle at every size, as the active documents grow with the input
    texts = written(rows.where("__mh_id is not null and __mh_text is not null").join(active.hint("merge"), rows["__mh_id"] == active["id"], "left_semi")
                    .select(F.col("__mh_id").alias("id"), F.col("__mh_text").alias("text")), "texts")

    first = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    small_links = pairs.join(first, "a").join(second, "b").select("a", "b", "ta", "tb").mapInArrow(_verify_pairs(shingle, percent), "a bigint, b bigint")

    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    placed = (groups.join(group_sizes, "component").withColumn("blocks", blocks)
              .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
              .select("component", F.col("node").alias("id"), "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")))
    meets = placed.join(texts, "id").select("component", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "id", "text")
    large_links = meets.groupBy("component", "x", "y").applyInArrow(_verify_blocks(shingle, percent), "a bigint, b bigint")

    links = written(small_links.unionAll(large_links), "links")
    parts = connected_components(links).withColumnRenamed("node", "rep")
    named = written(classes.select("k1", "k2", "rep").join(parts, "rep", "left")
                    .select("k1", "k2", F.coalesce("component", "rep").alias("component")), "class_components")
    out = sketches.select("id", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document (the smallest id) of each group of near-duplicates."""
    key = options.get("id", "doc_id")
    found = near_duplicates(docs, **options)
    gone = written(found.where(~F.col("kept")).select(F.col(key).alias("__mh_gone")).distinct(), "duplicates")
    return docs.join(gone.hint("merge"), docs[key].cast("bigint") == gone["__mh_gone"], "left_anti")


@query("op6_superminhash")
def op6_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under three-word shingles and a similarity of 0.85 or more."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, percent=85)
