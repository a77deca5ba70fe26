"""Mixture-controlled packing: deficit round-robin over source queues.

Documents wait in one queue for each source. For every sequence (window) of ``window`` tokens each
queue's deficit grows by its target share of the window. The queues take turns, and each serves its front
documents as long as its deficit covers them; what is then still open goes to the most overdue queue's
front document, whose deficit may so become negative. Documents are served whole: only the end of
a window cuts one, and its rest opens the next window. Deficits go on from window to window.

Across partitions the work is cut into lanes of about ``LANE`` windows. In virtual time every source
is served at its own steady rate; a document (or a stretch of ``WINDOW`` tokens of a longer one) goes
to the lane in which its middle would be served. Positions inside a queue come from prefix sums over
partition totals, and a source's queue starts at a phase of its own, so that many small sources do
not meet in one lane. Deficits are carried from lane to lane: a queue enters a lane with the tokens that the
target had served by then, less the tokens that stand before its first document there, which is what the
earlier lanes have served of it, and its share of a window is the target's at that time, not the
lane's own mix. A lane is packed in one task and its size does not depend on the data, so a source with
a third of all tokens is spread over all lanes. Only the last window of a lane may be short.

Without ``weights`` a source's target is its share of all tokens, so all queues end together and
every lane mirrors the corpus. With ``weights`` the named sources get those relative rates, the
others share the weight None (default 1) by size; a queue that has run dry leaves its share to the
rest, so every document is still packed.

Cases: a null or empty text has the end id alone; a null source is a source; repeated rows are
packed each by itself; queues are in the order in which the table is read, and of equally overdue queues the
first by name is served; very long texts are cut into windows; an empty table gives no pieces; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import deque
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import python_ready, query, read_table, written
from tessera.llm.tokens import coder, text_slices, tokenizer_path

WINDOW = 4096
LANE = 256


def _tokenise(tokenizer: str, pieces: str, end_id: int):
    """Rows to (doc, source, n, start in the partition's part of the queue, id bytes), in row order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer, pieces, end_id)
        ahead: dict = {}
        for batch in batches:
            for lo, hi in text_slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                ids, offsets = code.encode_array(part.column("text"))
                n = np.diff(offsets)
                before = []
                for source, size in zip(part.column("source").to_pylist(), n.tolist()):
                    before.append(ahead.get(source, 0))
                    ahead[source] = before[-1] + size
                blobs = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((offsets * ids.itemsize).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("part"), part.column("doc"), part.column("source"), pa.array(n, pa.int64()),
                     pa.array(before, pa.int64()), blobs],
                    names=["part", "doc", "source", "n", "before", "ids"])
    return run


class _Schedule:
    """Target rates as a piecewise linear map from virtual time to tokens served.

    The breakpoints are the moments at which a named source (or the rest) runs dry, so there are at
    most as many as there are ``weights``; nothing here grows with the data.
    """

    def __init__(self, totals: DataFrame, weights: dict | None, lane_tokens: int):
        weights = dict(weights or {})
        self.known = [g for g in weights if g is not None]
        group = F.when(F.col("source").isin(self.known), F.col("source")) if self.known else F.lit(None).cast("string")
        size = {r[0]: int(r[1]) for r in totals.groupBy(group.alias("g")).agg(F.sum("total")).collect()}
        self.total = sum(size.values())
        self.lanes = max(1, round(self.total / lane_tokens))
        rate = {g: max(float(weights.get(g, 1.0 if g is None else 0.0)), 1e-9) for g in size}
        dry = sorted((size[g] / rate[g], str(g), g) for g in size)
        self.points, served, flow, last = [(0.0, 0.0)], 0.0, sum(rate.values()), 0.0
        for t, _, g in dry:
            served += (t - last) * flow
            self.points.append((t, served))
            flow, last = flow - rate[g], t
        self.life = {g: size[g] / rate[g] for g in size}     # virtual time at which a source runs dry

    def _life(self):
        """Virtual time at which a row's source runs dry."""
        life = F.lit(self.life.get(None, 1.0))
        for g in self.known:
            life = F.when(F.col("source") == F.lit(g), F.lit(self.life.get(g, 1.0))).otherwise(life)
        return life

    @staticmethod
    def _along(points, x):
        out = F.lit(points[-1][1])
        for (x0, y0), (x1, y1) in reversed(list(zip(points, points[1:]))):
            slope = (y1 - y0) / (x1 - x0) if x1 > x0 else 0.0
            out = F.when(x < F.lit(x1), F.lit(y0) + (x - F.lit(x0)) * F.lit(slope)).otherwise(out)
        return out

    def lane(self, share):
        """Lane in which a source is when ``share`` (0 to 1) of its queue has been served."""
        served = self._along(self.points, share * self._life())
        return F.least(F.floor(served * F.lit(self.lanes / max(self.total, 1))), F.lit(self.lanes - 1))

    def target(self, lane):
        """Share of a source's queue that the target has served when ``lane`` begins."""
        t = self._along([(x, t) for t, x in self.points], lane * F.lit(self.total / self.lanes))
        return F.least(t / self._life(), F.lit(1.0))


def _serve_lane(window: int, sources: list, lengths: list[int], deficit: dict, quantum: dict) -> list[list[int]]:
    """Pieces [row, from, tokens, window, offset] of a lane's rows, which are in the order of their queues.
    ``deficit`` is what each source enters the lane with, ``quantum`` its share of a window."""
    queues: dict = {}
    for i, s in enumerate(sources):
        queues.setdefault(s, deque()).append(i)
    names = list(queues)
    pieces, number, offset, turn, cut = [], 0, window, -1, None

    def serve(s, i: int, done: int) -> None:
        nonlocal offset, cut
        n = min(lengths[i] - done, window - offset)
        pieces.append([i, done, n, number, offset])
        deficit[s] -= n
        offset += n
        cut = (s, i, done + n) if done + n < lengths[i] else None

    while cut or names:
        if offset == window:                                 # the next window
            number, offset, turn = number + (turn >= 0), 0, turn + 1
            names = [s for s in names if queues[s]]
            for s in names:
                deficit[s] += quantum[s]
            if cut:
                serve(*cut)
        at = turn % len(names) if names else 0
        for s in names[at:] + names[:at]:
            queue = queues[s]
            while queue and offset < window and deficit[s] >= lengths[queue[0]]:
                serve(s, queue.popleft(), 0)
        overdue = [(-deficit[s], k) for k, s in enumerate(names) if queues[s]]
        heapq.heapify(overdue)
        while overdue and offset < window:
            _, k = heapq.heappop(overdue)
            s = names[k]
            serve(s, queues[s].popleft(), 0)
            if queues[s]:
                heapq.heappush(overdue, (-deficit[s], k))
        if offset < window:
            break
        names = [s for s in names if queues[s]]
    return pieces


def _pack_lane(window: int, width: int, with_ids: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("source", "ascending"), ("position", "ascending"), ("doc", "ascending"), ("start", "ascending")])
        rows = {c: table.column(c).to_pylist() for c in ("source", "position", "entry", "quantum", "doc", "start", "length", "doc_tokens", "ids")}
        deficit, quantum = {}, {}
        for s, position, entry, q in zip(*(rows[c] for c in ("source", "position", "entry", "quantum"))):
            if s not in deficit:                             # the queue's first document in this lane
                deficit[s], quantum[s] = entry - position, q
        pieces = _serve_lane(window, rows["source"], rows["length"], deficit, quantum)
        first = table.column("lane")[0].as_py() << 20        # more windows than a lane can hold
        for p in pieces:
            p[3] += first

        kind = np.dtype(f"<u{width}")
        ids = [np.frombuffer(x, kind) for x in rows["ids"]]
        raw = [ids[i][a:a + n].astype("<u4").tobytes() for i, a, n, _, _ in pieces]
        out = {
            "doc_id": pa.array([rows["doc"][p[0]] for p in pieces], pa.int64()),
            "start": pa.array([rows["start"][p[0]] + p[1] for p in pieces], pa.int64()),
            "length": pa.array([p[2] for p in pieces], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64()),
            "doc_tokens": pa.array([rows["doc_tokens"][p[0]] for p in pieces], pa.int64()),
            "sequence_id": pa.array([p[3] for p in pieces], pa.int64()),
            "offset": pa.array([p[4] for p in pieces], pa.int64()),
            "source": pa.array([rows["source"][p[0]] for p in pieces], pa.string()),
        }
        if with_ids:
            out["ids"] = pa.array(raw, pa.binary())
        return pa.table(out)
    return run


def pack(docs: DataFrame, tokenizer: str, *, pieces: str = "bare", end_id: int = 2, lane: int = LANE,
         weights: dict | None = None, id: str = "doc_id", text: str = "text", source: str = "source",  # noqa: A002
         with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source
    (and the ids as little-endian u32 bytes with ``with_ids``). A sequence's pieces, by offset, fill
    its ``WINDOW`` places without gaps; the last sequence of a lane may be shorter."""
    spark = docs.sparkSession
    python_ready(spark)
    width = coder(tokenizer, pieces, end_id).dtype.itemsize
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(f"`{id}`").cast("bigint").alias("doc"),
                       F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{text}`").cast("string").alias("text"))
    coded = written(rows.mapInArrow(_tokenise(tokenizer, pieces, end_id),
                                    "part int, doc bigint, source string, n bigint, before bigint, ids binary"), "coded")
    sums = written(coded.groupBy("part", "source").agg(F.sum("n").alias("tokens")), "sums")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = written(sums.groupBy("source").agg(F.sum("tokens").alias("total")), "totals")
    plan = _Schedule(totals, weights, lane * WINDOW)
    bases = (sums.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).alias("s")
             .join(totals.alias("t"), F.expr("s.source <=> t.source"))
             .select(F.col("s.part").alias("p"), F.col("s.source").alias("q"), "base", "total"))
    bases = written(bases, "bases")
    queue = coded.join(bases, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("q")))
    queue = queue.withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(WINDOW).cast("bigint"))))
    queue = queue.withColumns({"length": F.least(F.col("n") - F.col("start"), F.lit(WINDOW)), "lo": F.col("base") + F.col("before") + F.col("start")})
    phase = F.pmod(F.xxhash64("source"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    middle = F.col("lo") + F.col("length") / 2
    turned = queue.withColumn("share", F.pmod(middle / F.col("total") + phase, F.lit(1.0)))
    turned = turned.withColumn("lane", plan.lane(F.col("share")))
    entry, after = plan.target(F.col("lane")) * F.col("total"), plan.target(F.col("lane") + 1) * F.col("total")
    chunks = turned.select(
        "lane", "source", "doc", (F.col("share") * F.col("total") - F.col("length") / 2).alias("position"), entry.alias("entry"),
        ((after - entry) * F.lit(WINDOW * plan.lanes / max(plan.total, 1))).alias("quantum"), "start", "length",
        F.col("n").alias("doc_tokens"),
        F.substring(F.col("ids"), (F.col("start") * width + 1).cast("int"), (F.col("length") * width).cast("int")).alias("ids"))
    schema = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
              "offset bigint, source string" + ", ids binary" * with_ids)
    return chunks.groupBy("lane").applyInArrow(_pack_lane(WINDOW, width, with_ids), schema)


@query("op8_mixture_packing")
def op8_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed at the corpus' own source mixture."""
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
