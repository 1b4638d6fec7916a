"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the mix by weight, clamped at ``max_epochs`` times its own size; what
the clamped ones leave is shared out again by weight until no source is above its clamp. A source
then takes its whole repetitions of every document and, for the fraction left over, the documents
that come first in a seeded order, up to the one that brings it closest to its target.

Only one row per source (its total) comes to the driver. The seeded order is cut without sorting
a source in one place: sizes are summed per (source, 4,096 slices of the order), the slice that
holds the cut is found on those sums, and only its documents are ordered. The cut is one key per
source, so the decision itself is a scan of the documents, without a shuffle.

Defined results: a null or blank text has size 0 (it follows the repetitions of its source and
takes no words); a null source is a source of its own, last in order; a null id is ordered by its
text instead; rows repeated with one id fall on one side of the cut together; an empty table
gives no rows; extra columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgergraph.llm.common import WORD, pick, read, text_or_empty
from ledgergraph.session import staged

MAX_SOURCES = 100_000     # rows that may come to the driver; more is an error, never a cut


def water_fill(sizes: list[int], weights: list[int], total: float, max_epochs: float) -> list[float]:
    """Targets by weight, none above ``max_epochs`` times its size."""
    targets: list[float | None] = [None] * len(sizes)
    while True:
        free = [i for i, t in enumerate(targets) if t is None]
        left = total - sum(t for t in targets if t is not None)
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > max_epochs * sizes[i]]
        if not over:
            for i in free:
                targets[i] = left * weights[i] / weight
            return targets
        for i in over:
            targets[i] = float(max_epochs * sizes[i])


def order_key(seed: int, doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(text))).cast("binary"))


def mix_plan(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_epochs: float = 2.0,
             seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
             text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(sizes per document, one row per source: source_size, target, whole, cut key).

    Sources by code point, null last, take ``weights`` in turn, repeating."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    rows = staged(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        order_key(seed, F.col(id_col), text).alias("key")), "mix-sizes")
    slices = staged(rows.groupBy("source", F.substring("key", 1, 3).alias("slice"))
                    .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "mix-slices")
    totals = slices.groupBy("source").agg(F.sum("words").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    totals = sorted(totals, key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [r[1] for r in totals]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(totals))],
                         share * sum(sizes), max_epochs) if sum(sizes) else [0.0] * len(sizes)
    plan = []
    for r, target in zip(totals, targets):
        whole = int(target // r[1]) if r[1] else 0
        plan.append((r[0], r[1], target, whole, target - whole * r[1]))
    plan = spark.createDataFrame(plan, "source string, source_size long, target double, whole int, rest double")
    # the slice in which the running sum passes what is left over, then the key in that slice
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    at = (slices.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
          .join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
          .filter("before < rest").groupBy("source")
          .agg(F.max_by(F.struct("slice", "before", "rest"), "slice").alias("at"))
          .select(F.col("source").alias("s"), "at.*"))
    inside = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (rows.withColumn("slice", F.substring("key", 1, 3))
           .join(at.withColumnRenamed("slice", "cut_slice"), F.col("source").eqNullSafe(F.col("s"))
                 & (F.col("slice") == F.col("cut_slice")))
           .groupBy("source", "key", "before", "rest").agg(F.sum("size").alias("size"))
           .withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
           .withColumn("taken", F.col("start") + F.col("size") / 2 < F.col("rest"))
           .groupBy("source").agg(F.max(F.when(F.col("taken"), F.col("key"))).alias("inner"),
                                  F.min("key").alias("first"))
           # nothing of the slice taken: the cut lies before its first key
           .select(F.col("source").alias("s"), F.coalesce("inner", F.substring("first", 1, 3)).alias("cut")))
    plan = staged(plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").coalesce(1), "mix-plan")
    return rows, plan


def _copies() -> Column:
    return F.col("whole") + F.coalesce(F.col("key") <= F.col("cut"), F.lit(False)).cast("int")


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per document: id, size, source_size, target, copies and the words the mix takes."""
    rows, plan = mix_plan(docs, **options)
    plan = plan.withColumnRenamed("source", "s")
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("s")))
            .select(F.col("id").alias(options.get("id_col", "doc_id")), "size", "source_size", "target",
                    _copies().alias("copies"), (F.col("size") * _copies()).cast("long").alias("taken")))


def mixed_rows(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_epochs: float = 2.0,
               seed: int = 17) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it."""
    _, plan = mix_plan(docs, weights, share, max_epochs, seed)
    plan = plan.withColumnRenamed("source", "s")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (docs.select(row.alias("row"))
            .withColumn("key", order_key(seed, F.col("row.doc_id"), F.coalesce(F.col("row.text").cast("string"), F.lit(""))))
            .join(plan, F.col("row.source").cast("string").eqNullSafe(F.col("s")))
            .withColumn("n", F.explode(F.array_repeat(F.lit(1), _copies())))
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS pos,
             CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS w
      FROM d GROUP BY source),
fill AS (
  SELECT 0 AS step, pos, w, source_size, CAST(NULL AS DOUBLE) AS target,
         1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS room, CAST(sum(w) OVER () AS DOUBLE) AS free_w FROM s
  UNION ALL
  SELECT step + 1, pos, w, source_size, target,
         1.5 * sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(target) OVER (), 0),
         sum(CASE WHEN target IS NULL THEN CAST(w AS DOUBLE) END) OVER ()
  FROM (SELECT step, pos, w, source_size, room, free_w,
               CASE WHEN target IS NOT NULL THEN target
                    WHEN room * w / free_w > 2.0 * source_size THEN 2.0 * source_size END AS target FROM fill)
  WHERE step < 64),
t AS (SELECT s.source, s.source_size, coalesce(f.target, f.room * f.w / f.free_w) AS target
      FROM s JOIN fill f USING (pos) WHERE f.step = 64),
r AS (SELECT d.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) - d.size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN start + size / 2.0 < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""


def query(spark, sf_dir):
    """op9: what the mix takes of every document."""
    return mix(pick(read(spark, sf_dir, "documents"), ["doc_id", "text", "source"])).drop("copies")
