"""Best-fit packing with swap-based local search: few fixed-length sequences, documents cut only where they must be.

A document of at most ``window`` tokens is one piece; a longer one is cut into full windows behind a
shorter first piece. Full pieces are sequences of their own. The others are put in order of length and
dealt out like cards into lanes of about ``LANE`` pieces, so that every lane has the same mix of
lengths. A lane is packed in one task: largest first, each piece into the sequence with the least
room that takes it. Local search then takes the emptiest sequence and trades with others that have
room: it moves a piece, or exchanges one for one, two for one or one for two, whatever raises the sum
of squared fills most, until the sequence is empty or no trade helps. The lane is done when it needs no
more sequences than its tokens fill, or when no sequence can be emptied any further.

The emptiest sixteenth of a lane's sequences is taken apart again and packed once more in the next
round, in lanes of such leftovers, until one lane holds them. Each round is a sixteenth of the one before.
Only a piece's number, length and checksum move; token ids stay where they were encoded.

Cases: a null or empty text has the end id alone; a null id stays null; repeated rows, and rows with one id,
are packed each by itself; an empty table gives no pieces; very long texts are many full pieces;
other columns are ignored. Sequence numbers are arbitrary.
"""

from __future__ import annotations

import heapq
import zlib
from itertools import combinations
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import python_ready, query, ranked, read_table, written
from tessera.llm.tokens import coder, text_slices, tokenizer_path

WINDOW = 1024
LANE = 16_384
AGAIN = 16                                                  # one in so many sequences is packed once more


def best_fit(sizes: list[int], window: int) -> list[list[int]]:
    """Items (by index) in bins of ``window``: largest first, each where the least room is left over."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(window + 1)]
    rooms = 0                                               # bit r: some bin has r places left
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = rooms >> sizes[i]
        if fits:
            room = sizes[i] + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(bins), window
            bins.append([])
        bins[b].append(i)
        room -= sizes[i]
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins


class _Trades:
    """Bins with room, found by what they could give away: nothing, one item or two.

    ``given[kind][size]`` maps a bin's room to the bins that have a gift of that kind and size;
    ``rooms[kind][size]`` is the same as bits, so the fullest bin with enough room is one shift away.
    """

    def __init__(self, bins: list[list[int]], sizes: list[int], window: int):
        self.bins, self.sizes, self.window = bins, sizes, window
        self.room = [window - sum(sizes[i] for i in b) for b in bins]
        self.given: list[dict] = [{}, {}, {}]
        self.rooms: list[dict] = [{}, {}, {}]
        for b in range(len(bins)):
            self.enter(b)

    def gifts(self, b: int, kinds=(0, 1, 2)) -> Iterator[tuple[int, int, tuple]]:
        """(kind, size, items) for each size that the bin can give; equal sizes once."""
        one = {self.sizes[i]: i for i in self.bins[b]}
        if 0 in kinds:
            yield 0, 0, ()
        for size, i in one.items():
            yield 1, size, (i,)
        if 2 in kinds:
            seen = {}
            for i, j in combinations(one.values(), 2):
                seen.setdefault(self.sizes[i] + self.sizes[j], (i, j))
            count: dict = {}
            for i in self.bins[b]:
                count.setdefault(self.sizes[i], []).append(i)
            for size, same in count.items():
                if len(same) > 1:
                    seen.setdefault(2 * size, (same[0], same[1]))
            for size, pair in seen.items():
                yield 2, size, pair

    def enter(self, b: int) -> None:
        room = self.room[b]
        if room and self.bins[b]:
            for kind, size, items in self.gifts(b):
                self.given[kind].setdefault(size, {}).setdefault(room, {})[b] = items
                self.rooms[kind][size] = self.rooms[kind].get(size, 0) | 1 << room

    def leave(self, b: int) -> None:
        room = self.room[b]
        if room and self.bins[b]:
            for kind, size, _ in self.gifts(b):
                some = self.given[kind][size]
                del some[room][b]
                if not some[room]:
                    del some[room]
                    self.rooms[kind][size] ^= 1 << room
                    if not some:
                        del self.given[kind][size], self.rooms[kind][size]

    def best(self, b: int) -> tuple | None:
        """The trade of bin ``b`` (not entered) with another that raises the sum of squares most:
        (other bin, items given, items taken)."""
        top, found = 0, None
        fill = self.window - self.room[b]
        most = max((m.bit_length() - 1 for m in self.rooms[0].values()), default=0)
        for kind, size, items in self.gifts(b, kinds=(1, 2)):
            for back in ((0, 1, 2) if kind == 1 else (1,)):
                rooms = self.rooms[back]
                # gain = 2 d (other's fill + d - own fill), which grows with d: the largest d first
                for d in range(min(size, most), 0, -1):
                    fits = rooms.get(size - d, 0) >> d
                    if fits:
                        room = d + (fits & -fits).bit_length() - 1
                        gain = d * (self.window - room + d - fill)
                        if gain > top:
                            other, taken = next(iter(self.given[back][size - d][room].items()))
                            top, found = gain, (other, items, taken)
                        break
        return found

    def trade(self, b: int, other: int, given: tuple, taken: tuple) -> None:
        """``b`` is out of the index and stays out."""
        self.leave(other)
        for x, y, items in ((b, other, given), (other, b, taken)):
            for i in items:
                self.bins[x].remove(i)
                self.bins[y].append(i)
                self.room[x] += self.sizes[i]
                self.room[y] -= self.sizes[i]
        self.enter(other)


def local_search(bins: list[list[int]], sizes: list[int], window: int) -> list[list[int]]:
    """The bins after trades, without those that became empty."""
    spare = sum(window - sum(sizes[i] for i in b) for b in bins) // window
    if spare == 0:
        return bins                                          # fewer bins could not hold the items
    trades = _Trades(bins, sizes, window)
    queue = [(-r, b) for b, r in enumerate(trades.room) if r]
    heapq.heapify(queue)
    stuck: set[int] = set()
    while queue and spare:
        r, b = heapq.heappop(queue)
        if b in stuck or -r != trades.room[b] or not bins[b]:
            continue
        trades.leave(b)
        moved = False
        while bins[b] and (t := trades.best(b)):
            trades.trade(b, *t)
            moved = True
            if trades.room[t[0]]:
                stuck.discard(t[0])
                heapq.heappush(queue, (-trades.room[t[0]], t[0]))
        if not bins[b]:
            spare -= 1
            continue
        trades.enter(b)
        stuck.add(b)
        if moved:
            heapq.heappush(queue, (-trades.room[b], b))
    return [b for b in bins if b]


def _cut(tokenizer: str, end_id: int, window: int, with_ids: bool):
    """Rows of (row, doc, text) to their pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer, "lead", end_id)
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in text_slices(texts):
                ids, offsets = code.encode_array(texts.slice(lo, hi - lo))
                n = np.diff(offsets)
                count = -(-n // window)
                first = n - (count - 1) * window
                doc = np.repeat(np.arange(hi - lo), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = np.where(piece > 0, first[doc] + (piece - 1) * window, 0)
                length = np.where(piece > 0, window, first[doc])
                wide = ids.astype("<u4")
                at = offsets[doc] + start
                raw = [wide[a:b] for a, b in zip(at.tolist(), (at + length).tolist())]
                out = {"row": batch.column("row").slice(lo, hi - lo).take(pa.array(doc)),
                       "doc_id": batch.column("doc").slice(lo, hi - lo).take(pa.array(doc)),
                       "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                       "length": pa.array(length, pa.int64()), "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64())}
                if with_ids:
                    out["ids"] = pa.array([x.tobytes() for x in raw], pa.binary())
                yield pa.RecordBatch.from_pydict(out)
    return run


_PIECE = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _pack_lane(window: int, round_: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        lane = table.column("lane")[0].as_py()
        # pieces of equal length are told apart by what they are, not by how they came here
        table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32", "row")])
        sizes = table.column("length").to_pylist()
        bins = local_search(best_fit(sizes, window), sizes, window)
        bins.sort(key=lambda b: sum(sizes[i] for i in b))
        again = 0 if last else len(bins) // AGAIN
        take, sequence, offset = [], [], []
        for number, b in enumerate(bins):
            at = 0
            for i in sorted(b):
                take.append(i)
                sequence.append(None if number < again else round_ << 56 | lane << 24 | number)
                offset.append(at)
                at += sizes[i]
        table = table.take(pa.array(take, pa.int64())).drop_columns(["lane"])
        return (table.append_column("sequence_id", pa.array(sequence, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))
    return run


def pack_best_fit(docs: DataFrame, tokenizer: str, *, window: int = WINDOW, end_id: int = 2, lane: int = LANE,
                  id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:  # noqa: A002
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and the ids
    as little-endian u32 bytes with ``with_ids``)."""
    spark = docs.sparkSession
    python_ready(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").cast("bigint").alias("doc"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    cut = written(rows.mapInArrow(_cut(tokenizer, end_id, window, with_ids), _PIECE + ", ids binary" * with_ids), "pieces")
    placed = ranked(cut.drop("ids"), ["length", "doc_id", "piece", "ids_crc32"])
    placed = written(placed, "placed")
    schema = _PIECE + ", sequence_id bigint, offset bigint"
    names = [c.split()[0] for c in schema.split(", ")]
    full = F.col("length") == window
    done = [placed.where(full).withColumns({"sequence_id": F.col("rank"), "offset": F.lit(0).cast("bigint")}).select(names)]
    open_, round_ = placed.where(~full).select("rank", *names[:6]), 0
    left = open_.count()
    while left:
        round_ += 1
        lanes = -(-left // lane)
        dealt = open_.withColumn("lane", F.pmod("rank", F.lit(lanes))).drop("rank", "of")
        packed = written(dealt.groupBy("lane").applyInArrow(_pack_lane(window, round_, lanes == 1), schema), "packed")
        done.append(packed.where("sequence_id IS NOT NULL"))
        open_ = packed.where("sequence_id IS NULL").select(names[:6])
        left = 0 if lanes == 1 else open_.count()
        if left:
            open_ = ranked(open_, ["length", "doc_id", "piece", "ids_crc32"])
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    if with_ids:
        out = out.join(cut.select("row", "piece", "ids"), ["row", "piece"])
    return out.select(*names[1:], *["ids"] * with_ids)


@query("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack_best_fit(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
