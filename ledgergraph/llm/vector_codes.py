"""Vector code compression: product quantisation by Lloyd rounds over partition-local cover trees.

A component x becomes the integer floor(scale * x); a vector is cut into ``parts`` equal consecutive
parts, each with a codebook of its own. Rows are cut into chunks inside their partitions, and every
chunk keeps, per part, a cover tree of its distinct points: the centres of a level are a net of the
chunk (no two within the level's scale, every point within it of one), scales halve from level to
level, and a centre stays one below. Points are stored in depth-first order with a centre first, so
a node is a slice of them, and cumulative sums give the sum and number of rows of any slice.

A round walks each tree from the root. With d1 and d2 the distances of a node's centre to its nearest
and second nearest entry and r the largest distance of a point below to that centre, the triangle
inequality gives all of the slice to the nearest entry if d2 - d1 > 2 r; only the other nodes descend,
down to single points, which are compared exactly. Spark adds the chunks' sums per part and entry;
the driver sees the codebooks alone (``parts`` times ``entries`` rows).

Trees are built once, as a scratch table of one row per chunk, and read by every round. Distances are
computed in doubles that hold them exactly: integers beyond the magnitude where that ends (2^23 with
16 components a part) saturate there.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped; the
first entries are the kept rows with the smallest ids (null ids last, ties by vector), repeated rows
counted each; with fewer rows than ``entries`` the codebook is that much smaller; shorter vectors
are followed by zeros; null ids and labels are kept, null labels being equal; an empty table gives
no rows; extra columns never clash.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.llm.common import finite, integers, pick, read
from ledgergraph.session import staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
CHUNK = 1024


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, exact while they are below 2^52."""
    p, c = points.astype(np.float64), centres.astype(np.float64)
    return (p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)[None, :]


class CoverTree:
    """Distinct ``points`` in depth-first order, the rows' ``place`` in it, cumulative sums and the levels:
    per level the starts, ends and radii of its nodes, whose centre is the point at their start."""

    def __init__(self, rows: np.ndarray):
        points, place, weight = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        place = place.ravel()
        far = np.sqrt(np.maximum(squared(points, points), 0))
        owners, centres = self._nets(far)
        above = [np.arange(len(points))]             # the points' centres, from the lowest level up
        for owner in reversed(owners):
            above.append(owner[above[-1]])
        above.reverse()
        keys = [above[0]]
        for up, down in zip(above, above[1:]):       # below a centre, the centre itself comes first
            keys += [up != down, down]
        order = np.lexsort(keys[::-1])
        self.points = points[order]
        self.place = np.argsort(order)[place].astype(np.int32)
        weight = weight[order]
        self.weight = np.concatenate(([0], np.cumsum(weight)))
        sums = np.cumsum(self.points * weight[:, None], axis=0)
        self.sums = np.concatenate((np.zeros((1, rows.shape[1]), np.int64), sums))
        self.levels = []
        for centre in above:
            own = centre[order]
            starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            ends = np.concatenate((starts[1:], [len(own)]))
            self.levels.append((starts, ends, np.maximum.reduceat(far[own, order], starts)))

    @staticmethod
    def _nets(far: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """For each level but the last, the centre that every point goes to; the last level's centres are
        all points."""
        n = len(far)
        centres, scale, owners = np.array([0]), float(far[0].max()), []
        while len(centres) < n:
            owners.append(centres[far[:, centres].argmin(axis=1)])
            before = len(centres)
            while len(centres) == before:            # levels that add nothing are left out
                scale /= 2
                open_ = ~(far[:, centres] <= scale).any(axis=1)
                new = []
                while open_.any():
                    p = int(open_.argmax())
                    new.append(p)
                    open_ &= far[p] > scale
                centres = np.concatenate((centres, np.array(new, np.int64)))
        return owners, centres

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry per point, rows per entry, component sums per entry): nearest entry, ties to the lower."""
        label = np.zeros(len(self.points), np.int64)
        count, total = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
        open_ = np.ones(len(self.points), bool)
        for starts, ends, radius in self.levels:
            here = open_[starts]                     # a slice is open as a whole
            s, e, r = starts[here], ends[here], radius[here]
            if not len(s):
                break
            d = squared(self.points[s], book)
            best = d.argmin(axis=1)
            rows = np.arange(len(s))
            first = np.sqrt(np.maximum(d[rows, best], 0))
            d[rows, best] = np.inf
            second = np.sqrt(np.maximum(d.min(axis=1), 0))
            sure = (e - s == 1) | (second - first > 2 * r + 1e-6 * (1 + second))
            s, e, best = s[sure], e[sure], best[sure]
            np.add.at(count, best, self.weight[e] - self.weight[s])
            np.add.at(total, best, self.sums[e] - self.sums[s])
            inside = np.repeat(best, e - s)
            at = np.repeat(s - np.concatenate(([0], np.cumsum(e - s)[:-1])), e - s) + np.arange(len(inside))
            label[at] = inside
            open_[at] = False
        return label, count, total


def cover_trees(rows: DataFrame, parts: int, width: int, chunk: int = CHUNK) -> DataFrame:
    """``rows`` (id, label, q) as chunks: (ids, labels, trees), trees being one per part."""
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def build(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                q = part.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                q = q.reshape(part.num_rows, parts, width // parts)
                trees = [pickle.dumps(CoverTree(q[:, k])) for k in range(parts)]
                whole = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(whole, part.column("id")),
                     pa.ListArray.from_arrays(whole, part.column("label")), pa.array([trees], pa.list_(pa.binary()))],
                    names=["ids", "labels", "trees"])
    return rows.mapInArrow(build, f"ids array<{fields['id']}>, labels array<{fields['label']}>, trees array<binary>")


def _sums(books: list[np.ndarray]):
    """Chunks -> rows and component sums per part and entry, added up within a task."""
    def run(batches):
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            for trees in batch.column("trees"):
                for k, tree in enumerate(trees):
                    _, n, s = pickle.loads(tree.as_py()).assign(books[k])
                    count[k] += n
                    total[k] += s
        for k in range(len(books)):
            used = np.flatnonzero(count[k])
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(count[k][used]),
                     pa.array(total[k][used].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])
    return run


def _codes(books: list[np.ndarray]):
    """Chunks -> (id, label, code, error)."""
    def run(batches):
        for batch in batches:
            for ids, labels, trees in zip(batch.column("ids"), batch.column("labels"), batch.column("trees")):
                code, error = [], 0
                for tree, book in zip(trees, books):
                    tree = pickle.loads(tree.as_py())
                    label, _, _ = tree.assign(book)
                    off = ((tree.points - book[label]) ** 2).sum(axis=1)
                    code.append(label[tree.place])
                    error = error + off[tree.place]
                text = ["".join(f"{e:02x}" for e in row) for row in np.stack(code, axis=1).tolist()]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(text), pa.array(error)],
                                                 names=["id", "label", "code", "error"])
    return run


def learn(trees: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after ``rounds`` Lloyd rounds; an entry becomes the floor of its rows' mean."""
    width = books[0].shape[1]
    for _ in range(rounds):
        sums = (trees.mapInArrow(_sums(books), "part int, entry int, n long, sums array<bigint>")
                .groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]))
        books = [b.copy() for b in books]
        for r in sums.collect():                     # one row per part and entry at most
            books[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             chunk: int = CHUNK) -> DataFrame:
    """One row per kept vector: id, ``code``, ``error``, ``label_error``, ``codebooks_sha256``."""
    whole = {n: "bigint" if (t := vectors.schema[n].dataType.simpleString()) == "void" else t for n in (id_col, label_col)}
    kept = vectors.select(F.col(id_col).cast(whole[id_col]).alias("id"), F.col(label_col).cast(whole[label_col]).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v")).filter(finite(F.col("v")))
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    width = max(1, -(-(longest or 0) // parts)) * parts
    most = int((2 ** 52 / (width // parts)) ** 0.5 / 2)
    rows = kept.select("id", "label", integers(F.col("v"), scale, width, most).alias("q"))
    start = rows.orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).collect()
    if not start:
        out = rows.select(F.col("id").alias(id_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                          F.lit(0).cast("long").alias("label_error"))
        return out.withColumn("codebooks_sha256", F.lit(digest([]))).limit(0)
    first = np.array([r["q"] for r in start], np.int64).reshape(len(start), parts, width // parts)
    trees = staged(cover_trees(rows, parts, width, chunk), "cover-trees")
    books = learn(trees, [first[:, k] for k in range(parts)], rounds)
    schema = f"id {whole[id_col]}, label {whole[label_col]}, code string, error long"
    coded = staged(trees.mapInArrow(_codes(books), schema), "codes")
    total = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return (coded.join(total, F.col("label").eqNullSafe(F.col("of")))
            .select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))


def query(spark, sf_dir):
    """op13: code and error of every vector."""
    return compress(pick(read(spark, sf_dir, "embeddings"), ["vec_id", "embedding", "label"]))


def _oracle() -> str:
    """The same rounds in SQL: every part against every entry."""
    def nearest(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (
  SELECT p.vec_id, p.part, min(CAST(p.vv - 2 * list_inner_product(p.v, c.v) + c.vv AS HUGEINT) * {ENTRIES} + c.entry) AS m
  FROM p JOIN c{k} c ON c.part = p.part GROUP BY p.vec_id, p.part)"""

    def books(k: int) -> str:
        return f"""
m{k} AS (
  SELECT part, entry, list(x ORDER BY i) AS v FROM (
    SELECT a.part, CAST(a.m % {ENTRIES} AS BIGINT) AS entry, t.i, floor(sum(p.v[t.i]) / count(*)) AS x
    FROM a{k - 1} a JOIN p ON p.vec_id = a.vec_id AND p.part = a.part, width, range(1, width.d + 1) t(i) GROUP BY 1, 2, 3) GROUP BY 1, 2),
c{k} AS MATERIALIZED (
  SELECT part, entry, v, list_inner_product(v, v) AS vv FROM (
    SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{k - 1} c LEFT JOIN m{k} m ON m.part = c.part AND m.entry = c.entry))"""
    steps = ",".join(f"{nearest(k)},{books(k + 1)}" for k in range(ROUNDS)) + "," + nearest(ROUNDS)
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {SCALE})) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
width AS (SELECT CAST(max(len(q)) / {PARTS} AS BIGINT) AS d FROM kept),
p AS MATERIALIZED (
  SELECT vec_id, part, v, list_inner_product(v, v) AS vv FROM (
    SELECT vec_id, t.part, q[t.part * width.d + 1:(t.part + 1) * width.d] AS v FROM kept, width, range({PARTS}) t(part))),
c0 AS MATERIALIZED (
  SELECT part, entry, v, vv FROM (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v, vv FROM p)
  WHERE entry < {ENTRIES}),{steps},
code AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(m % {ENTRIES} AS BIGINT)), '' ORDER BY part) AS code,
         CAST(sum(m // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id),
label_error AS (SELECT k.label, CAST(sum(c.error) AS BIGINT) AS label_error FROM code c JOIN kept k ON k.vec_id = c.vec_id GROUP BY k.label),
book AS (
  SELECT sha256(string_agg(CAST(CAST(c.v[t.i] AS BIGINT) AS VARCHAR), ',' ORDER BY c.part, c.entry, t.i)) AS codebooks_sha256
  FROM c{ROUNDS} c, width, range(1, width.d + 1) t(i))
SELECT c.vec_id, c.code, c.error, l.label_error, b.codebooks_sha256
FROM code c JOIN kept k ON k.vec_id = c.vec_id JOIN label_error l ON l.label IS NOT DISTINCT FROM k.label, book b"""


ORACLE = _oracle()
