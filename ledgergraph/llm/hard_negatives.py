"""Hard-negative mining by an inverted multi-index over two half-space codebooks.

A component x becomes the integer floor(scale * x) and a score is an integer inner product. Vectors are
cut into two halves; each half has a codebook, fitted by k-means on a bounded sample (``sample`` rows,
chosen by a hash of the id), and a vector's cell is its pair of nearest entries. All rows are indexed.
The radius of an entry is the largest distance of a half to it over all rows, so that the half score of
an anchor a with any row of entry c is at most a.c + |a| radius; the sum of two such bounds is a bound
for a cell.

Every anchor visits cells from the highest bound on, by a heap over its two sorted lists of half-score
bounds (the multi-sequence algorithm), some thousand rows in the first round and four times as many in
each further one. First it looks for its positives, then, when these are final, for the negatives of
each positive's window. After a round the scores found so far say which bound a cell needs to change
anything; an anchor whose next cell is below it is certified and leaves. Nothing is approximate: the
recall is 1 and only the work depends on the codebooks.

On Spark the rows of a cell are blocks of about ``block`` vectors; the visits of a round are grouped into
blocks of anchors per cell and joined with the row blocks, and numpy scores block against block. Each
keeps the few best per anchor, so no pair table is ever made, and a window with a group limit merges them.

Defined results: rows with a null id or label, a null vector or a null or non-finite component take no
part; of rows with the same id the one with the least (label, vector) counts; shorter vectors are
followed by zeros; anchors without another row of their label give no rows; a positive below zero has
an empty window; components whose inner products doubles can't hold exactly (beyond 2^23 with 64
components) saturate; an empty table gives no rows; extra columns never clash.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgergraph.llm.common import finite, integers, pick, read
from ledgergraph.session import scoped_conf, staged

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
SAMPLE, BLOCK, MOST_ENTRIES = 20_000, 512, 512
FIRST_ROWS = 4096
NOTHING = -(1 << 62)


# ---- the index ------------------------------------------------------------------------------------

def fit(halves: np.ndarray, entries: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of one half of the sample."""
    centres = halves[:: max(1, len(halves) // entries)][:entries].astype(np.float64)
    for _ in range(rounds):
        near = nearest(halves, centres)[0]
        n = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, halves)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, distance) of the nearest centre."""
    d = (centres * centres).sum(1)[None, :] - 2.0 * (points @ centres.T)
    at = d.argmin(axis=1)
    off = points - centres[at]
    return at, np.sqrt((off * off).sum(axis=1))


def in_order(one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, i, j) over all pairs from the largest sum on: the multi-sequence heap."""
    a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    heap, pushed = [(-(one[a[0]] + two[b[0]]), 0, 0)], {(0, 0)}
    while heap:
        least, i, j = heapq.heappop(heap)
        yield -least, int(a[i]), int(b[j])
        for at in ((i + 1, j), (i, j + 1)):
            if at[0] < len(a) and at[1] < len(b) and at not in pushed:
                pushed.add(at)
                heapq.heappush(heap, (-(one[a[at[0]]] + two[b[at[1]]]), *at))


class Index:
    """What planning a visit needs: codebooks, radii (below zero: no rows) and rows per cell."""

    def __init__(self, books, radii, occupied: dict[int, int] | np.ndarray):
        self.books, self.radii = books, radii
        if isinstance(occupied, dict):
            found, occupied = occupied, np.zeros(len(books[0]) * len(books[1]), np.int64)
            occupied[list(found)] = list(found.values())
        self.occupied = occupied

    def cell(self, one, two):
        return one * len(self.books[1]) + two

    def visits(self, anchor: np.ndarray, done: int, need: int, budget: int) -> tuple[list[int], int]:
        """The cells to visit next, of those from place ``done`` on whose bound reaches ``need``, with
        ``budget`` rows or a few more, and the place to go on from."""
        half = anchor.shape[0] // 2
        bounds = []
        for part, book, radius in zip((anchor[:half], anchor[half:]), self.books, self.radii):
            norm = math.sqrt(float((part * part).sum()))
            # a margin for rounding: a bound may only be too large
            b = book @ part + norm * radius
            bounds.append(np.where(radius < 0, -np.inf, b + 1e-9 * (1 + np.abs(b))))
        cells, rows = [], 0
        for place, (bound, i, j) in enumerate(in_order(*bounds)):
            if bound < need or rows >= budget:
                return cells, place if place > done else done
            if place >= done and (n := int(self.occupied[self.cell(i, j)])):
                cells.append(self.cell(i, j))
                rows += n
        return cells, len(self.books[0]) * len(self.books[1])


def codebooks(some: DataFrame, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """The codebooks of both halves, fitted in one task on the vectors ``q`` of a bounded sample: the driver only gets
    the centres."""
    def learn(batches):
        parts = [b.column("q").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64) for b in batches if b.num_rows]
        if parts:
            fitted = np.concatenate(parts)
            half = fitted.shape[1] // 2
            books = [fit(fitted[:, :half], entries), fit(fitted[:, half:], entries)]
            yield pa.RecordBatch.from_pydict({"width": pa.array([b.shape[1] for b in books], pa.int32()),
                                              "centres": pa.array([np.ascontiguousarray(b).tobytes() for b in books], pa.binary())})
    # an ordered sample: one partition, and both rows in order
    got = some.select("q").mapInArrow(learn, "width int, centres binary").collect()
    return tuple(np.frombuffer(r["centres"], np.float64).reshape(-1, r["width"]) for r in got) or (np.zeros((1, 1)), np.zeros((1, 1)))


def index_rows(rows: DataFrame, sample: int = SAMPLE, block: int = BLOCK) -> tuple[DataFrame, Index]:
    """Blocks (cell, ids, labels, vectors) of all ``rows`` (id, label, q), and the index."""
    n = rows.count()
    entries = min(MOST_ENTRIES, max(1, math.ceil(math.sqrt(n / block))))
    some = rows.filter(F.pmod(F.xxhash64("id"), F.lit(max(1, n // sample))) == 0).orderBy(F.xxhash64("id"), "id").limit(sample)
    books = codebooks(some, entries)
    half = books[0].shape[1]

    def place(batches):
        for batch in batches:
            q = batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            one, d1 = nearest(q[:, :half], books[0])
            two, d2 = nearest(q[:, half:], books[1])
            whole = [x.tobytes() for x in np.ascontiguousarray(q, "<i4")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(one.astype(np.int32)), pa.array(two.astype(np.int32)),
                 pa.array(d1), pa.array(d2), pa.array(whole, pa.binary())], names=["id", "label", "one", "two", "d1", "d2", "v"])
    placed = staged(rows.select("id", "label", "q").mapInArrow(
        place, "id long, label long, one int, two int, d1 double, d2 double, v binary"), "multi-index")
    radii = []
    for entry, d, book in (("one", "d1", books[0]), ("two", "d2", books[1])):
        radius = np.full(len(book), -1.0)
        for r in placed.groupBy(entry).agg(F.max(d).alias("d")).collect():       # one row per entry
            radius[r[0]] = r[1] * (1 + 1e-9) + 1e-9
        radii.append(radius)
    cell = (F.col("one") * len(books[1]) + F.col("two")).cast("int")
    sizes = staged(placed.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")), "multi-cells")
    # at most MOST_ENTRIES squared cells, as two columns of numbers
    found = sizes.toArrow()
    occupied = np.zeros(len(books[0]) * len(books[1]), np.int64)
    occupied[found["cell"].to_numpy()] = found["n"].to_numpy()
    sub = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / block))
    blocks = (placed.select(cell.alias("cell"), "id", "label", "v").join(sizes, "cell")
              .groupBy("cell", sub.alias("sub")).agg(F.collect_list(F.struct("id", "label", "v")).alias("rows")))
    return staged(blocks.select("cell", "sub", F.col("rows.id").alias("ids"), F.col("rows.label").alias("labels"),
                                F.col("rows.v").alias("vs")), "multi-blocks"), Index(books, radii, occupied)


# ---- visiting -------------------------------------------------------------------------------------

def _best(score: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the ``k`` best scores per anchor where ``ok``, ties by smaller id."""
    held = np.where(ok, score, -np.inf)
    if held.shape[1] > k:
        least = -np.partition(-held, k - 1, axis=1)[:, k - 1]
        ok = ok & (held >= least[:, None])
    a, r = np.nonzero(ok)
    order = np.lexsort((ids[r], -held[a, r], a))
    a, r = a[order], r[order]
    first = np.searchsorted(a, a)                    # where the anchor's run starts
    keep = np.arange(len(a)) - first < k
    return a[keep], r[keep]


def _found(windows: bool, k: int):
    """(anchor block, row block) -> (anchor, slot, id, score): per anchor the best rows of its label, or
    per slot the best of other labels inside of the slot's window."""
    def run(batches):
        for pdf in batches:
            out = []
            for anchors, ids, labels, vs in zip(pdf["anchors"], pdf["ids"], pdf["labels"], pdf["vs"]):
                rows = np.frombuffer(b"".join(vs), "<i4").reshape(len(ids), -1).astype(np.float64)
                ids, labels = np.asarray(ids, np.int64), np.asarray(labels, np.int64)
                mine = np.frombuffer(b"".join(a["v"] for a in anchors), "<i4").reshape(len(anchors), -1).astype(np.float64)
                who = np.array([a["anchor"] for a in anchors], np.int64)
                what = np.array([a["label"] for a in anchors], np.int64)
                need = np.array([a["need"] for a in anchors], np.int64)
                score = mine @ rows.T
                same = what[:, None] == labels[None, :]
                ok = score >= need[:, None]
                if not windows:
                    slots = [(0, ok & same & (who[:, None] != ids[None, :]))]
                else:
                    slots = []
                    for s in range(max((len(a["tops"]) for a in anchors), default=0)):
                        top = np.array([a["tops"][s] if s < len(a["tops"]) else NOTHING for a in anchors], np.float64)[:, None]
                        slots.append((s, ok & ~same & (score <= top) & (100 * score >= 80 * top)))
                for s, inside in slots:
                    a, r = _best(score, inside, ids, k)
                    out.append(pd.DataFrame({"anchor": who[a], "slot": s, "id": ids[r], "score": score[a, r].astype(np.int64)}))
            if out:
                yield pd.concat(out)
    return run


def _search(anchors: DataFrame, blocks: DataFrame, index: Index, k: int, windows: bool, n_anchors: int) -> DataFrame:
    """(anchor, slot, id, score): the ``k`` best rows of every anchor, certified. ``anchors``: (anchor,
    label, v, tops), tops being the upper ends of its windows."""
    # what an anchor still needs: no cell below can change its lists
    state = staged(anchors.withColumn("done", F.lit(0)).withColumn(
        "need", F.expr("(80 * array_min(tops) + 99) div 100") if windows else F.lit(NOTHING).cast("long")),
        "multi-state")
    found = staged(anchors.sparkSession.createDataFrame([], "anchor long, slot int, id long, score long"), "multi-found")
    budget = FIRST_ROWS
    groups = max(1, -(-n_anchors // 256))
    while True:
        def plan(batches, budget=budget):
            for pdf in batches:
                went = [index.visits(np.frombuffer(v, "<i4").astype(np.float64), int(d), int(need), budget)
                        for v, d, need in zip(pdf["v"], pdf["done"], pdf["need"])]
                yield pd.DataFrame({"anchor": pdf["anchor"], "label": pdf["label"], "v": pdf["v"], "tops": pdf["tops"],
                                    "done": [w[1] for w in went], "need": pdf["need"], "cells": [w[0] for w in went]})
        spread = max(1, -(-n_anchors // 64))
        planned = staged(state.repartition(min(spread, _tasks(state)), "anchor").mapInPandas(
            plan, "anchor long, label long, v binary, tops array<long>, done int, need long, cells array<int>")
            .filter(F.size("cells") > 0), "multi-plan")
        if planned.isEmpty():
            return found
        visits = (planned.select(F.explode("cells").alias("cell"), F.struct("anchor", "label", "v", "tops", "need").alias("a"))
                  .groupBy("cell", F.pmod(F.xxhash64("a.anchor"), F.lit(groups)).alias("g"))
                  .agg(F.collect_list("a").alias("anchors")))
        # never broadcast: Spark takes the visits to be as large as ``planned``, and they are as many times larger as an
        # anchor has cells to visit
        jobs = visits.hint("merge").join(blocks, "cell").select("anchors", "ids", "labels", "vs")
        with scoped_conf(anchors.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "32"}):
            more = staged(jobs.repartition(_tasks(state)).mapInPandas(
                _found(windows, k), "anchor long, slot int, id long, score long"), "multi-candidates")
        best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc("id"))
        found = staged(found.unionByName(more).withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k).drop("nth"),
                       "multi-found")
        # the last of a full list bounds what can still enter it; a window that isn't full needs its lower end
        last = found.groupBy("anchor", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
        lists = (planned.select("anchor", F.posexplode("tops").alias("slot", "top")) if windows
                 else planned.select("anchor", F.lit(0).alias("slot"), F.lit(NOTHING).cast("long").alias("top")))
        floor = F.expr("(80 * top + 99) div 100") if windows else F.col("top")
        need = (lists.join(last, ["anchor", "slot"], "left")
                .groupBy("anchor").agg(F.min(F.when(F.col("n") >= k, F.col("low")).otherwise(floor)).alias("need")))
        state = staged(planned.drop("need", "cells").join(need, "anchor"), "multi-state")
        budget *= 4


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE,
         sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, the
    rows whose id is divisible by ``anchor_every``."""
    spark = vectors.sparkSession
    raw = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
           .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v"))))
    size, n, ids = raw.agg(F.max(F.size("v")), F.count(F.lit(1)), F.countDistinct("id")).first()
    width = max(2, -(-(size or 0) // 2) * 2)
    rows = raw.select("id", "label", integers(F.col("v"), scale, width, int((2 ** 52 / width) ** 0.5)).alias("q"))
    if ids < n:
        rows = rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q")
    blocks, index = index_rows(rows, sample, block)
    anchors = blocks.select(F.explode(F.arrays_zip("ids", "labels", "vs")).alias("r")).filter(F.col("r.ids") % anchor_every == 0).select(
        F.col("r.ids").alias("anchor"), F.col("r.labels").alias("label"), F.col("r.vs").alias("v"))
    anchors = staged(anchors, "anchors")
    n_anchors = anchors.count()
    none = F.array().cast("array<long>")
    best = _search(anchors.withColumn("tops", none), blocks, index, positives, False, n_anchors)
    nth = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc("id"))
    slots = staged(best.filter("score >= 0").select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                                                   (F.row_number().over(nth) - 1).alias("slot")), "positives")
    # an anchor's positives are at most ``positives`` rows
    tops = slots.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))).alias("t")).select(
        "anchor", F.col("t.positive_score").alias("tops"))
    hard = _search(anchors.join(tops, "anchor"), blocks, index, negatives, True, n_anchors)
    rank = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc("id"))
    return (hard.withColumn("rank", F.row_number().over(rank)).join(slots, ["anchor", "slot"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def query(spark, sf_dir):
    """op11: hard negatives of every anchor, where every seventh row has the next label."""
    rows = pick(read(spark, sf_dir, "embeddings"), ["vec_id", "embedding", "label"])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved))


ORACLE = f"""
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM kept a JOIN kept r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}),
found AS (
  SELECT p.anchor_id, p.positive_id, s.id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= {NEGATIVES}"""
