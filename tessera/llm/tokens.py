"""Token-ID files: flat unsigned integers and 64-bit document offsets, written by shard and memory-mapped.

Layout of a token folder (one shard for each range of document ids)::

    ids-<shard>-<attempt>.bin      token ids, little-endian u16 (vocabularies up to 65,536) or u32
    offsets-<shard>-<attempt>.bin  u64: first id of each document in the shard, then the id count
    docs-<shard>-<attempt>.bin     i64: doc_id of each document, preceded by a presence byte each
    manifest.json                  the shards in order: files, documents, ids, base (ids before it)

A task writes files that only its own attempt names, so a retried or doubled task never touches the
files of another. The manifest, written last, lists the attempts that count; the base of each shard
is the prefix sum of the id counts before it.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from itertools import repeat
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (open_fs, python_ready, query, range_shards, read_table, shared_path,
                                shuffle_partitions)

# White space as the tokenizers' regular expressions know it (fixed values).
_WS = "\t-\r \x85\xa0  -     　"
#: Pieces of a text that the pre-tokenizer never joins: a run without white space, with the one
#: space before it where that belongs to it ("lead"), or the run alone ("bare").
PIECES = {
    "lead": re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"),
    "bare": re.compile(f"[^{_WS}]+"),
}
CACHE_ENTRIES = 300_000                                     # distinct pieces that a worker remembers
TEXT_BYTES = 2 << 20                                        # of texts that are encoded in one go
_BLOCK = 1 << 18                                            # pieces whose values are gathered in one go

_coders: dict = {}


class _Values:
    """Growing flat arrays: the values of entry i lie at ``flat[start[i]:start[i] + size[i]]``."""

    def __init__(self, dtype):
        self.start, self.size, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, dtype)
        self.n = self.used = 0

    def add(self, sizes: np.ndarray, flat: np.ndarray) -> None:
        n, used = self.n + len(sizes), self.used + len(flat)
        for name, need in (("start", n), ("size", n), ("flat", used)):
            old = getattr(self, name)
            if need > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(max(need - len(old), len(old)), old.dtype)]))
        self.size[self.n:n] = sizes
        self.start[self.n:n] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used:used] = flat
        self.n, self.used = n, used

    def take(self, numbers: np.ndarray) -> np.ndarray:
        parts = []
        for lo in range(0, len(numbers), _BLOCK):
            k = numbers[lo:lo + _BLOCK]
            size = self.size[k]
            at = np.repeat(self.start[k] - np.cumsum(size) + size, size)
            at += np.arange(len(at))
            parts.append(self.flat[at])
        return parts[0] if len(parts) == 1 else np.concatenate([self.flat[:0], *parts])


class PieceTable:
    """Distinct pieces of text with the values that ``learn`` gives for them, each learned once.

    ``learn`` takes a list of pieces and returns (sizes, values) for each of ``dtypes``. Beyond ``limit``
    pieces only those met in several calls are kept.
    """

    def __init__(self, learn, dtypes, limit: int = CACHE_ENTRIES):
        self.learn, self.dtypes, self.limit = learn, dtypes, limit
        self.known: dict[str, int] = {}
        self.hits = np.zeros(0, np.int32)
        self.columns = [_Values(d) for d in dtypes]

    def _turn(self) -> None:
        keep = np.flatnonzero(self.hits > 1)
        if len(keep) > self.limit // 2:
            keep = keep[:0]
        names = list(self.known)
        old, self.columns = self.columns, [_Values(d) for d in self.dtypes]
        for was, now in zip(old, self.columns):
            now.add(was.size[keep], was.take(keep))
        self.known = {names[i]: j for j, i in enumerate(keep.tolist())}
        self.hits = np.ones(len(keep), np.int32)

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """Number of each piece; holds until the next call."""
        if len(self.known) > self.limit:
            self._turn()
        coded = pieces.dictionary_encode()
        names = coded.dictionary.to_pylist()
        found = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(found < 0)
        self.hits[found[found >= 0]] += 1
        if len(new):
            first = len(self.known)
            fresh = [names[i] for i in new.tolist()]
            for column, (sizes, flat) in zip(self.columns, self.learn(fresh)):
                column.add(sizes, flat)
            found[new] = np.arange(first, first + len(fresh))
            self.known.update(zip(fresh, range(first, first + len(fresh))))
            self.hits = np.concatenate([self.hits, np.ones(len(fresh), np.int32)])
        return found[coded.indices.to_numpy(zero_copy_only=False)]


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``TEXT_BYTES`` of text, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + TEXT_BYTES, "right")))
        yield lo, hi
        lo = hi


class Coder:
    """Whole texts to ids with a ``tokenizers`` file.

    A text's ids are the ids of its pieces one after another, as the pre-tokenizer cuts between
    them anyway; each distinct piece goes through the library once while it stays in a
    ``PieceTable``. Texts whose white space is spaces and line feeds, never three of them together
    or two at the end, are cut by plain splitting, others by ``PIECES``. A text holding a special
    token's string is encoded in one call.
    """

    def __init__(self, path: str, pieces: str, add: int | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.lead = pieces == "lead"
        self.find = PIECES[pieces].findall
        size = max(self.library.get_vocab_size(with_added_tokens=True), (add or 0) + 1)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.end = np.array([] if add is None else [add], self.dtype)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # several fresh pieces go through the library as one text, between strings of one known id
        self.between = "\n" if self.lead else next(iter(self.special), None)
        self.between_id = self._ids(self.between)[0] if self.between else None
        # a library that lower-cases gives a text's ids from the text in lower case too
        self.lower = not self.lead and self.library.encode("Ab", add_special_tokens=False).ids == self.library.encode("ab", add_special_tokens=False).ids
        self.odd = "|".join([f"[\x00\t\x0b\x0c\r\x1c-\x1f{_WS[4:]}]", *(f"(?i:{re.escape(t)})" for t in self.special)] + [r"[ \n]{3}", r"[ \n]{2}\z"] * self.lead)
        self.table = PieceTable(lambda names: [self._learn(names)], [self.dtype])

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype)

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(e.ids, self.dtype) for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array([len(x) for x in ids], np.int64), np.concatenate([self.end[:0], *ids])

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of all pieces) of each piece."""
        if self.between is None:
            return self._each(pieces)
        sizes, flat = [], []
        for lo in range(0, len(pieces), 4096):
            some = pieces[lo:lo + 4096]
            joined = [self.between.join([*some[i:i + 256], ""]) for i in range(0, len(some), 256)]
            ids = np.concatenate([np.array(e.ids, self.dtype) for e in self.library.encode_batch_fast(joined, add_special_tokens=False)])
            at = np.flatnonzero(ids == self.between_id)
            n = np.diff(at, prepend=-1) - 1
            ids = np.delete(ids, at)
            # a piece that holds the string itself, or is empty, does not come out alone
            if len(at) != len(some) or any(not x or self.between in x for x in some):
                n, ids = self._each(some)
            sizes.append(n)
            flat.append(ids)
        return np.concatenate(sizes), np.concatenate(flat)

    def cut(self, texts: pa.Array, marks: bool = True) -> tuple[np.ndarray, pa.Array, dict[int, list[str] | None]]:
        """Pieces of each text: how many, all of them in order, and the texts cut by ``PIECES``
        (None: to be encoded whole), which count as having none here. With ``marks`` words are cut from the
        punctuation behind them too."""
        odd = pc.match_substring_regex(texts, self.odd)
        slow: dict = {}
        if pc.any(odd).as_py():
            for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
                text = texts[i].as_py()
                slow[i] = None if any(s in text for s in self.special) else self.find(text)
            texts = pc.if_else(odd, "", texts)
        if self.lower:
            texts = pc.ascii_lower(texts)
        # no token goes on from a letter into such a mark, and words come back with other marks behind them
        if marks:
            texts = pc.replace_substring_regex(texts, "([A-Za-z])([.,;:!?])", "\\1\0\\2" if self.lead else "\\1 \\2")
        if self.lead:
            texts = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
            split = pc.split_pattern(texts, "\0")
        else:
            split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        return pc.list_value_length(split).to_numpy().astype(np.int64), split.flatten(), slow

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with its end id (a null text has that alone), and
        n + 1 offsets into them."""
        ids, sizes = [self.end[:0]], [np.zeros(0, np.int64)]
        for lo, hi in text_slices(texts):
            n, x = self._encode(pc.fill_null(texts.slice(lo, hi - lo), ""))
            sizes.append(n)
            ids.append(x)
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        counts, pieces, slow = self.cut(texts)
        more = [x for p in slow.values() if p for x in p]
        numbers = self.table.numbers(pa.concat_arrays([pieces, pa.array(more, pieces.type)]) if more else pieces)
        values = self.table.columns[0]
        fast, rest = numbers[:len(pieces)], numbers[len(pieces):]
        edges = np.concatenate([[0], np.cumsum(counts)])
        cum = np.concatenate([[0], np.cumsum(values.size[fast])])
        offsets = cum[edges]
        sizes, ids = np.diff(offsets), values.take(fast)
        if slow:                                             # their ids come between those of their neighbours
            parts, at = [], 0
            for i, p in slow.items():
                own = self._ids(texts[i].as_py()) if p is None else values.take(rest[:len(p)])
                rest = rest[len(p or ()):]
                parts += [ids[at:offsets[i]], own]
                at, sizes[i] = offsets[i], len(own)
            ids = np.concatenate([*parts, ids[at:]])
        if len(self.end):
            ids = np.insert(ids, np.cumsum(sizes), self.end[0])
            sizes = sizes + 1
        return sizes, ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Id bytes of each text with the end id behind it (a null text has the end id only)."""
        ids, offsets = self.encode_array(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]


def coder(path: str, pieces: str, add: int | None) -> Coder:
    """The coder of this Python worker (kept between its tasks)."""
    key = (path, pieces, add)
    if key not in _coders:
        _coders[key] = Coder(path, pieces, add)
    return _coders[key]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_STATS = "shard int, attempt string, docs bigint, ids bigint"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, *, pieces: str = "lead", end_id: int = 0,
                 key: str = "doc_id", text: str = "text", shards: int | None = None) -> list[dict]:
    """Encode ``docs`` into a token folder in ascending ``key`` order; returns the manifest.

    ``tokenizer`` is the path of a tokenizers file that every worker can open. Null keys come first;
    rows with equal keys follow each other by text; a null or empty text has the end id alone; an
    empty table gives a manifest without shards. Other columns are ignored.
    """
    spark = docs.sparkSession
    python_ready(spark)
    narrow = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).cast("string").alias("t"))
    dealt = range_shards(narrow, "k", shards or shuffle_partitions(spark))
    dealt = dealt.sortWithinPartitions("_shard", F.asc_nulls_first("k"), "t")
    fs, path = open_fs(folder)
    fs.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer, pieces, end_id)
        fs, path = open_fs(folder)
        files, shard, attempt, n_docs, n_ids = (), None, "", 0, 0
        done = []
        for batch in batches:
            numbers = batch.column("_shard").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if numbers[lo] != shard:
                    if files:
                        done.append(_finish(files, shard, attempt, n_docs, n_ids))
                    shard, attempt, n_docs, n_ids = int(numbers[lo]), uuid.uuid4().hex, 0, 0
                    files = [fs.open_output_stream(f"{path}/{kind}-{shard:06d}-{attempt}.bin")
                             for kind in ("ids", "offsets", "docs")]
                keys = batch.column("k").slice(lo, hi - lo)
                texts = batch.column("t").slice(lo, hi - lo)
                for at, to in text_slices(texts):
                    ids, offsets = code.encode_array(texts.slice(at, to - at))
                    files[0].write(ids.tobytes())
                    files[1].write((offsets[:-1] + n_ids).astype("<u8").tobytes())
                    part = keys.slice(at, to - at)
                    rows = np.zeros(len(part), np.dtype([("there", "u1"), ("key", "<i8")]))
                    rows["there"] = part.is_valid().to_numpy(zero_copy_only=False)
                    rows["key"] = part.fill_null(0).to_numpy()
                    files[2].write(rows.tobytes())
                    n_docs += to - at
                    n_ids += len(ids)
        if files:
            done.append(_finish(files, shard, attempt, n_docs, n_ids))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema(
                [("shard", pa.int32()), ("attempt", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    # one row for each shard comes back, never documents or ids
    parts = sorted((r.asDict() for r in dealt.mapInArrow(write, _STATS).collect()), key=lambda r: r["shard"])
    base = 0
    width = coder(tokenizer, pieces, end_id).dtype.itemsize
    for p in parts:
        p["base"], p["width"] = base, width
        base += p["ids"]
    with fs.open_output_stream(f"{path}/manifest.json.part") as f:
        f.write(json.dumps(parts).encode())
    fs.move(f"{path}/manifest.json.part", f"{path}/manifest.json")
    return parts


def _finish(files, shard: int, attempt: str, docs: int, ids: int) -> dict:
    files[1].write(np.array([ids], "<u8").tobytes())
    for f in files:
        f.close()
    return {"shard": shard, "attempt": attempt, "docs": docs, "ids": ids}


class TokenShard:
    """One shard of a token folder, memory-mapped where the folder is on a mounted file system."""

    def __init__(self, folder: str, part: dict):
        fs, path = open_fs(folder)
        read = lambda kind: fs.open_input_file(f"{path}/{kind}-{part['shard']:06d}-{part['attempt']}.bin").read_buffer()
        self.ids = np.frombuffer(read("ids"), f"<u{part['width']}")
        self.offsets = np.frombuffer(read("offsets"), "<u8")
        self.docs = np.frombuffer(read("docs"), np.dtype([("there", "u1"), ("key", "<i8")]))
        self.base = part["base"]

    def document(self, i: int) -> np.ndarray:
        return self.ids[int(self.offsets[i]):int(self.offsets[i + 1])]


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a token folder: doc_id, start, n_tokens, ids_crc32 (of little-endian u32 ids)."""
    python_ready(spark)
    fs, path = open_fs(folder)
    with fs.open_input_stream(f"{path}/manifest.json") as f:
        parts = json.loads(f.read())
    schema = "shard int, attempt string, docs bigint, ids bigint, base bigint, width int"
    rows = spark.createDataFrame([tuple(p[c] for c in ("shard", "attempt", "docs", "ids", "base", "width"))
                                  for p in parts], schema)
    tasks = min(max(1, len(parts)), 4 * spark.sparkContext.defaultParallelism)
    spread = rows.repartitionById(tasks, F.col("shard"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                shard = TokenShard(folder, part)
                starts = shard.offsets.astype(np.int64)
                for lo in range(0, len(shard.docs), 4096):
                    hi = min(lo + 4096, len(shard.docs))
                    crc = [zlib.crc32(shard.document(i).astype("<u4")) for i in range(lo, hi)]
                    docs = shard.docs[lo:hi]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs["key"].astype(np.int64), mask=docs["there"] == 0),
                         pa.array(starts[lo:hi] + shard.base), pa.array(np.diff(starts[lo:hi + 1])),
                         pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


@query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the byte-level vocabulary into a token folder, read back from its files."""
    folder = shared_path(spark, "tokens")
    write_tokens(read_table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"))
    return read_tokens(spark, folder)
