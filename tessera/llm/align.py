"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

Both tokenisations of a text are lists of byte offsets at which tokens end. Galloping intersection
finds the offsets common to both: each offset of the shorter list is sought in the longer one from
where it should lie by proportion, by steps that double until they pass it and then by halving the last
step. Common offsets cut both lists into groups that cover the same bytes. The ranks found on the way give
the overlaps too: a token of the shorter list overlaps as many tokens of the longer as the ranks of its
two ends differ by, so links are written out as ranges, without comparing tokens.

All texts of a batch are searched at once, as one list of offsets that goes on rising from text to text.
Links (occurrences of an id pair on overlapping tokens) are counted over the whole corpus, partially in
each task; the counts are stored in files by ranges of pairs, and looked up by one pass over the stored links
for each ``SLICE`` pairs, so no task holds more of them at once.

Cases: texts that are null or empty, or whose tokens do not give back space + text byte by byte, have no
tokens and count for nothing; long texts are aligned whole; repeated rows count each by itself; a null id
stays null; of pairs with equal counts all are the best; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import open_fs, python_ready, query, read_table, shared_path, written
from tessera.llm.tokens import Coder, PieceTable, tokenizer_path

SLICE = 4 << 20                                             # pairs in one file of counts
TEXT_BYTES = 1 << 20                                        # of texts that are aligned at once
LINKS = 1 << 20                                             # links that are looked up at once
PIECES = 250_000                                            # distinct pieces that a worker remembers
_HELD = 2 << 20                                             # pairs that a task counts before it passes them on


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each element of ``short`` the number of elements of ``long`` below it (both rising), sought
    from index ``start`` by doubling steps, then by halving."""
    n = len(long)
    lo, hi = np.minimum(start, n), np.minimum(start, n)     # all before lo are below, none from hi on
    todo, step = np.flatnonzero(lo > 0), 1
    while len(todo := todo[long[lo[todo] - 1] >= short[todo]]):
        hi[todo] = lo[todo] - 1
        lo[todo] = np.maximum(lo[todo] - 1 - step, 0)
        todo, step = todo[lo[todo] > 0], 2 * step
    todo, step = np.flatnonzero((hi < n) & (lo == hi)), 1
    while len(todo := todo[long[hi[todo]] < short[todo]]):
        lo[todo] = hi[todo] + 1
        hi[todo] = np.minimum(hi[todo] + 1 + step, n)
        todo, step = todo[hi[todo] < n], 2 * step
    todo = np.flatnonzero(lo < hi)
    while len(todo):
        mid = (lo[todo] + hi[todo]) >> 1
        below = long[mid] < short[todo]
        lo[todo[below]] = mid[below] + 1
        hi[todo[~below]] = mid[~below]
        todo = todo[lo[todo] < hi[todo]]
    return lo


def overlaps(short: np.ndarray, long: np.ndarray, first: np.ndarray, sizes_s: np.ndarray, sizes_l: np.ndarray):
    """Common ends (masks over ``short`` and ``long``) and links (index pairs) of texts whose ends follow each
    other in both lists; ``sizes_*`` are the tokens of each text, ``first`` the texts' first in ``long``."""
    text = np.repeat(np.arange(len(sizes_s)), sizes_s)
    begin = np.cumsum(sizes_s) - sizes_s
    place = np.arange(len(short)) - begin[text]
    rank = gallop(short, long, first[text] + place * sizes_l[text] // np.maximum(sizes_s[text], 1))
    common = long[np.minimum(rank, len(long) - 1)] == short if len(long) else np.zeros(len(short), bool)
    common_long = np.zeros(len(long), bool)
    common_long[rank[common]] = True
    at_or_below = np.concatenate([[0], (rank + common)[:-1]]) if len(short) else rank
    at_or_below[place == 0] = first[text[place == 0]]       # a text begins where the one before has ended
    count = rank - at_or_below + 1
    link_short = np.repeat(np.arange(len(short)), count)
    link_long = np.arange(len(link_short)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(at_or_below, count)
    return common, common_long, link_short, link_long


def _byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: printable Latin-1 stands for itself, the
    others are numbered from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Texts to ids of vocabulary A (byte-level, a ``tokenizers`` file; of space + text) and B
    (``sentencepiece``, which adds the space itself), and their alignment."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = Coder(path_a, "lead", None)
        self.a.library.encode_special_tokens = True          # their strings are plain text
        self.a.special = []
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_alphabet()
        vocabulary = self.a.library.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in alphabet for c in token)
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = [np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b)]
        self.shift = 16 if max(len(pieces), len(self.bytes_a)) <= 1 << 16 else 32
        self.pair = np.dtype("<u4" if self.shift == 16 else "<u8")
        kind = np.dtype("<u2" if self.shift == 16 else "<u4")
        # cutting at spaces and line feeds is right for B if none of its pieces goes on over one
        self.cuttable = not any("\n" in p or "▁" in p.strip("▁") or (p.endswith("▁") and p.strip("▁")) for p in pieces)
        self.odd = self.a.odd + "|  "
        self.table = PieceTable(self._learn, [kind, kind], PIECES)
        # decimal digits of an id as the bytes of a word, and how far behind them the next byte lies
        digits = [str(i).encode() for i in range(max(map(len, self.sizes)))]
        self.digits = np.frombuffer(b"".join(d.ljust(8, b"\0") for d in digits), "<u8")
        self.behind = np.array([8 * len(d) for d in digits], np.uint64)

    def _b_ids(self, pieces: list[str]) -> list[list[int]]:
        """B's ids of pieces of a text. Before a piece without its space goes a line feed, which B keeps apart."""
        alone = self.b.encode("\n")                          # space, line feed
        given = [p[1:] if p[0] == " " and len(p) > 1 else "\n" + p for p in pieces]
        return [alone[:-1] if p == " " else ids if p[0] == " " else ids[len(alone):]
                for p, ids in zip(pieces, self.b.encode(given, num_threads=1))]

    def _learn(self, pieces: list[str]):
        empty = [i for i, p in enumerate(pieces) if not p]
        sizes_a, flat_a = self.a._learn([p or " " for p in pieces])
        ids_b = self._b_ids([p or " " for p in pieces])
        ok = np.array([b"".join([self.bytes_b[i] for i in ids]) == p.encode() for p, ids in zip(pieces, ids_b)])
        ok[empty] = False
        # a piece that does not come back byte by byte has no ids, so its text's tokens are too short
        flat_a = flat_a[np.repeat(ok, sizes_a)]
        ids_b = [ids if good else [] for ids, good in zip(ids_b, ok.tolist())]
        sizes_b = np.array([len(x) for x in ids_b], np.int64)
        flat_b = np.fromiter((i for ids in ids_b for i in ids), self.table.dtypes[1], int(sizes_b.sum()))
        return [(np.where(ok, sizes_a, 0), flat_a), (sizes_b, flat_b)]

    def _whole(self, text: str):
        """Both ids of a text from the libraries, or none if they do not give back its bytes."""
        out = self.a.library.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        want = b" " + text.encode()
        if all(b"".join([v[i] for i in ids]) == want for ids, v in zip(out, (self.bytes_a, self.bytes_b))):
            return out
        return [], []

    def ids(self, texts: pa.Array):
        """(ids, tokens of each text) by A and by B."""
        texts = pc.fill_null(texts, "")
        given = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise("", texts, " "))
        odd = pc.match_substring_regex(given, self.odd) if self.cuttable else pc.not_equal(texts, "")
        slow = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        if slow:
            given = pc.if_else(odd, "", given)
        counts, pieces, _ = self.a.cut(given, marks=False)
        numbers = self.table.numbers(pieces)
        edges = np.concatenate([[0], np.cumsum(counts)])
        out = []
        for column, sizes in zip(self.table.columns, self.sizes):
            cum = np.concatenate([[0], np.cumsum(column.size[numbers])])
            out.append([column.take(numbers), np.diff(cum[edges])])
        bytes_ = np.diff(_buffers(given)[0])
        wrong = np.flatnonzero(np.any([bytes_ != _per_text(v[ids], n) for v, (ids, n) in zip(self.sizes, out)], axis=0))
        if len(wrong) or slow:
            own = {i: ([], []) for i in wrong.tolist()} | {i: self._whole(texts[i].as_py()) for i in slow}
            for side in (0, 1):
                ids, n = out[side]
                parts, at, ends = [], 0, np.cumsum(n)
                for i in sorted(own):
                    parts += [ids[at:ends[i] - n[i]], np.array(own[i][side], ids.dtype)]
                    at = ends[i]
                for i in own:
                    n[i] = len(own[i][side])
                out[side] = [np.concatenate([*parts, ids[at:]]), n]
        return out

    def align(self, texts: pa.Array) -> dict[str, pa.Array]:
        (ids_a, n_a), (ids_b, n_b) = self.ids(texts)
        ends = [np.cumsum(v[ids]) for v, ids in zip(self.sizes, (ids_a, ids_b))]
        first = [np.cumsum(n) - n for n in (n_a, n_b)]
        common = [np.zeros(len(x), bool) for x in (ids_a, ids_b)]
        links = []
        for turned in (False, True):                         # texts with the shorter list on side A, then on side B
            some = (n_a > n_b) == turned
            s, l = (1, 0) if turned else (0, 1)
            sizes = [np.where(some, n, 0) for n in (n_a, n_b)]
            at = [np.flatnonzero(np.repeat(some, n)) for n in (n_a, n_b)]
            begin = np.cumsum(sizes[l]) - sizes[l]
            cs, cl, ls, ll = overlaps(ends[s][at[s]], ends[l][at[l]], begin, sizes[s], sizes[l])
            common[s][at[s][cs]] = True
            common[l][at[l][cl]] = True
            ls, ll = at[s][ls], at[l][ll]
            links.append((ll, ls) if turned else (ls, ll))
        link_a, link_b = (np.concatenate(x) for x in zip(*links))
        pair = ids_a[link_a].astype(self.pair) << self.shift | ids_b[link_b].astype(self.pair)
        text = np.repeat(np.arange(len(n_a)), n_a)[link_a]
        pair = pair[np.argsort(text, kind="stable")]         # by text again
        n_links = np.bincount(text, minlength=len(n_a))
        words, sizes = self._groups(ids_a, ids_b, *common, first, (n_a, n_b))
        return {"n_a": pa.array(n_a, pa.int64()), "n_b": pa.array(n_b, pa.int64()),
                "n_groups": pa.array(_per_text(common[0], n_a), pa.int64()), "n_links": pa.array(n_links, pa.int64()),
                "groups": _blobs(words, sizes).cast(pa.string()),
                "links": _blobs(pair.view(np.uint8), n_links * self.pair.itemsize)}

    def _groups(self, ids_a, ids_b, common_a, common_b, first, n):
        """Text of all groups (``a1,a2|b1;a3|b2,b3``) as bytes, and the bytes of each text."""
        last_a, last_b = np.flatnonzero(common_a), np.flatnonzero(common_b)
        group_a = np.cumsum(common_a) - common_a             # groups before each token
        group_b = np.cumsum(common_b) - common_b
        start_b = np.concatenate([[0], last_b + 1])
        at_a = np.arange(len(ids_a)) + start_b[group_a]      # behind the B tokens of all earlier groups
        at_b = np.arange(len(ids_b)) + last_a[group_b] + 1   # behind the A tokens up to the own group
        word = np.zeros(len(ids_a) + len(ids_b), "<u8")
        for ids, at, common, mark in ((ids_a, at_a, common_a, "|"), (ids_b, at_b, common_b, ";")):
            behind = np.where(common, ord(mark), ord(",")).astype("<u8")
            if mark == ";":
                behind[(first[1] + n[1] - 1)[n[1] > 0]] = 0  # nothing behind the last token of a text
            word[at] = self.digits[ids] | behind << self.behind[ids]
        raw = word.view(np.uint8)
        there = raw != 0
        sizes = _per_text(there.reshape(-1, 8).sum(axis=1), n[0] + n[1])
        return raw[there], sizes


def _per_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    cum = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return cum[ends] - cum[ends - sizes]


def _blobs(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary array without nulls."""
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int32)[array.offset:array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int32)
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


_aligners: dict = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this Python worker (kept between its tasks)."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: A002
    """Per row of ``docs``: row (a number), doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``:
    ids of A and B covering the same bytes), links (the id pairs of overlapping tokens, in text order, as
    little-endian integers ``a << 16 | b``; 64 bits and 32 for vocabularies over 65,536)."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for batch in batches:
            texts = batch.column("text")
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            lo = 0
            while lo < len(ends):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TEXT_BYTES, "right")))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_pydict({"row": part.column("row"), "doc_id": part.column("doc_id"), **both.align(part.column("text"))})
                lo = hi

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, links binary")


def pair_counts(aligned: DataFrame, wide: bool = False) -> DataFrame:
    """(pair, n, best) over all links: how many there are, and whether no pair with its B id has more."""
    kind = np.dtype("<u8" if wide else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, kind), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_pydict({"pair": pa.array(keys.astype(np.int64)), "n": pa.array(counts)})

        for batch in batches:
            offsets, data = _buffers(batch.column(0))
            links = data[offsets[0]:offsets[-1]].view(kind)
            for lo in range(0, len(links), _HELD):
                more, n = np.unique(links[lo:lo + _HELD], return_counts=True)
                both, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
                sums = np.zeros(len(both), np.int64)
                sums[at[:len(keys)]] += counts
                sums[at[len(keys):]] += n
                keys, counts = both, sums
                if len(keys) > _HELD:
                    yield out()
                    keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield out()

    counted = written(aligned.select("links").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND((1 << (32 if wide else 16)) - 1).alias("b")
    top = counted.groupBy(b).agg(F.max("n").alias("top"))
    return counted.withColumn("b", b).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


_slice: dict = {}


def _load(folder: str, files: tuple[str, ...], kind):
    """The counts of some files by rising pair, kept by this Python worker until it reads others."""
    import pyarrow.parquet as pq

    if (folder, files) not in _slice:
        _slice.clear()
        fs, path = open_fs(folder)
        table = pa.concat_tables([pq.read_table(f"{path}/{f}", filesystem=fs) for f in files])
        pairs, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
        order = np.argsort(pairs, kind="stable")
        _slice[folder, files] = (pairs[order].astype(kind), n[order], best[order])
    return _slice[folder, files]


def _slices(folder: str, limit: int) -> list[tuple[str, ...]]:
    """The Parquet files of a folder in groups of at most ``limit`` rows (or one larger file)."""
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs

    fs, path = open_fs(folder)
    groups, held = [], 0
    for f in sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(path)) if f.base_name.endswith(".parquet")):
        rows = pq.read_metadata(f"{path}/{f}", filesystem=fs).num_rows
        if not groups or held + rows > limit:
            groups.append([])
            held = 0
        groups[-1].append(f)
        held += rows
    return [tuple(g) for g in groups]


def link_scores(aligned: DataFrame, counts: DataFrame, wide: bool = False, slice_: int = SLICE) -> DataFrame:
    """Per row of the stored ``aligned``: row, n_best (links whose pair is the best of its B id), count_sum
    (counts of all its links)."""
    spark = aligned.sparkSession
    kind = np.dtype("<u8" if wide else "<u4")
    stored = written(counts, "counts")
    folder = shared_path(spark, "slices")
    slices = max(1, -(-stored.count() // slice_))
    stored.repartitionByRange(slices, "pair").sortWithinPartitions("pair").write.parquet(folder)

    def lookup(files: tuple[str, ...]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs, n, best = _load(folder, files, kind)
            for batch in batches:
                offsets, data = _buffers(batch.column("links"))
                links = data[offsets[0]:offsets[-1]].view(kind)
                ends = (offsets.astype(np.int64) - offsets[0]) // kind.itemsize
                out = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
                lo = 0
                while lo < batch.num_rows and len(pairs):
                    hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + LINKS, "right")) - 1)
                    some = links[ends[lo]:ends[hi]]
                    at = np.minimum(np.searchsorted(pairs, some), len(pairs) - 1)
                    at = np.where(pairs[at] == some, at, -1)
                    for sums, values in zip(out, (best, n)):
                        cum = np.concatenate([[0], np.cumsum(np.where(at < 0, 0, values[at]), dtype=np.int64)])
                        sums[lo:hi] = np.diff(cum[ends[lo:hi + 1] - ends[lo]])
                    lo = hi
                yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, out)], names=["row", "n_best", "count_sum"])
        return run

    schema = "row bigint, n_best bigint, count_sum bigint"
    passes = [aligned.select("row", "links").mapInArrow(lookup(g), schema) for g in _slices(folder, slice_)]
    if not passes:
        return aligned.select("row", F.lit(0).cast("bigint").alias("n_best"), F.lit(0).cast("bigint").alias("count_sum"))
    out = passes[0]
    for p in passes[1:]:
        out = out.unionByName(p)
    return out if len(passes) == 1 else out.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the byte-level and the sentence-piece vocabulary."""
    found = align(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups"), 256)).otherwise("")
    stored = written(found.withColumn("groups_sha256", digest).drop("groups"), "aligned", compression="zstd")
    scores = link_scores(stored, pair_counts(stored))
    return stored.drop("links").join(scores, "row").drop("row")
