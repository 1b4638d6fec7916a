"""SimHash near-dedup: 64-bit fingerprints, compared exactly in tiles with numpy.

A fingerprint bit is set if it is set in over half of the document's shingle hashes (XXH64, seed
42, of each run of ``shingle`` words; fewer words: the whole sequence; none: fingerprint zero).
Equal fingerprints are collapsed before anything is compared.

Comparison is exact: distinct fingerprints are cut into tiles of at most ``tile`` values, and
tiles are compared by exclusive-or and bit counts. A pair of tiles is skipped when its
population counts differ by more than the radius, which no link can. To keep the tile pairs few
at scale, tiles are cut within blocks: with radius r, fingerprints are split into r + 1 bit
fields, and two of them within r bits agree in at least one field, so each is compared inside the
r + 1 blocks it agrees in. Blocks lose no link and need no cap: one with many values gets many
tiles, whose pairs are rows of their own and spread over all tasks.

A tile pair returns a spanning forest of its links, at most one link per value, never all pairs.
Components join the forests.

Defined results: null text: no words; null ids take part with their text and can't be a
component's name unless it has no other; repeated rows share a component; an empty table gives no
rows; extra columns never clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgergraph.llm.common import pick, read
from ledgergraph.llm.components import components
from ledgergraph.session import staged

SEED = 42
BITS = 64


def simhash_of(text: str | None, shingle: int = 4) -> int:
    """Fingerprint of one text as an unsigned 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # ASCII case and white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    hashes = np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[k - 1:].tolist())),
                         np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 16):       # bounded memory for very long texts
        part = hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): fp holds the unsigned fingerprint's bits as a long. One row per document."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash_of(t, shingle) for t in texts], np.uint64).view(np.int64))
    return docs.select(F.col(id_col).alias("id"), fp(F.col(text_col).cast("string")).alias("fp"))


def _forest(x: np.ndarray, y: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the values within ``radius`` bits, of one tile or of two."""
    values = x if y is None else np.concatenate([x, y])
    ia, ib = [], []
    for at in range(0, len(x), 256):      # a band of the tile pair at a time
        near = np.bitwise_count(x[at:at + 256, None] ^ (x if y is None else y)[None, :]) <= radius
        i, j = np.nonzero(near)
        i = i + at
        if y is None:
            i, j = i[i < j], j[i < j]
        else:
            j = j + len(x)
        ia.append(i)
        ib.append(j)
    ia, ib = np.concatenate(ia), np.concatenate(ib)
    if not len(ia):
        return []
    root = np.arange(len(values))
    while True:                            # least label over links, with pointer jumping
        low = np.minimum(root[ia], root[ib])
        new = root.copy()
        np.minimum.at(new, root[ia], low)
        np.minimum.at(new, root[ib], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    linked = np.nonzero(root != np.arange(len(values)))[0]
    return [(int(values[i].view(np.int64)), int(values[root[i]].view(np.int64))) for i in linked]


def links(fps: DataFrame, radius: int = 4, tile: int = 2048) -> DataFrame:
    """(a, b): links between the distinct longs in ``fp``, enough to connect all within ``radius``.

    Per block, values are ordered by population count and cut into tiles; a tile is one row with
    its values as bytes."""
    fields = radius + 1
    cuts = [round(i * BITS / fields) for i in range(fields + 1)]
    field = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) if hi - lo < BITS else F.col("fp")
             for lo, hi in zip(cuts, cuts[1:])]
    entries = fps.select("fp", F.bit_count("fp").alias("pop"), F.posexplode(F.array(*field)).alias("field", "value"))
    # a value's place in its block, by population count: the values of lower counts, plus a hashed
    # place among those of its own count; so no block is ever ordered in one task
    lower = Window.partitionBy("field", "value").orderBy("pop").rowsBetween(Window.unboundedPreceding, -1)
    places = (entries.groupBy("field", "value", "pop").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(lower), F.lit(0))))
    place = F.col("before") + F.pmod(F.xxhash64("fp"), F.col("n"))
    tiles = staged(entries.join(places, ["field", "value", "pop"])
                   .groupBy("field", "value", F.floor(place / tile).alias("tile"))
                   .agg(F.collect_list("fp").alias("fps"), F.min("pop").alias("low"), F.max("pop").alias("high"))
                   .withColumn("n", F.size("fps")), "tiles")
    several = tiles.groupBy("field", "value").count().filter("count > 1").select("field", "value")
    heads = tiles.select("field", "value", "tile", "low", "high").join(several, ["field", "value"])
    other = heads.select("field", "value", *[F.col(c).alias(f"{c}2") for c in ("tile", "low", "high")])
    pairs = (heads.join(other, ["field", "value"])
             .filter((F.col("tile") < F.col("tile2")) & (F.col("low2") - F.col("high") <= radius)
                     & (F.col("low") - F.col("high2") <= radius))
             .select("field", "value", "tile", "tile2"))
    second = tiles.select("field", "value", F.col("tile").alias("tile2"), F.col("fps").alias("fps2"))
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    jobs = (pairs.join(tiles.select("field", "value", "tile", "fps"), ["field", "value", "tile"])
            .join(second, ["field", "value", "tile2"]).select("fps", "fps2")
            .unionByName(tiles.filter("n > 1").select("fps", F.lit(None).cast("array<bigint>").alias("fps2"))))

    def compare(batches):
        for pdf in batches:
            found = []
            for x, y in zip(pdf["fps"], pdf["fps2"]):
                x = np.asarray(x, np.int64).view(np.uint64)
                found += _forest(x, None if y is None else np.asarray(y, np.int64).view(np.uint64), radius)
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return jobs.repartition(spread).mapInPandas(compare, "a long, b long").distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
               radius: int = 4, tile: int = 2048) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = staged(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), radius, tile))
    # fingerprints in no link are components of their own; a component is named by its least id
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    name = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(name, "root").select("fp", "component_id")
    return (fps.join(named, "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the one with the least id (null ids
    last, ties by the text's SHA-256; of repeated rows one)."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                   F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("sha")).alias("key")
    found = near_dedup(docs.select(key, "text"), id_col="key", shingle=shingle, radius=radius)
    stay = found.filter("key = component_id").select("key").distinct()
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key).join(stay, "key")
    repeated = stay.join(docs.select(key), "key").groupBy("key").count().filter("count > 1")
    if not repeated.isEmpty():
        kept = (kept.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row"))))
                .filter("nth = 1"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def query(spark, sf_dir):
    """op2: fingerprint and component of every document."""
    return near_dedup(pick(read(spark, sf_dir, "documents"), ["doc_id", "text"]))
