"""Document fingerprints: threshold-scaled sketches, with DataFrame functions only.

The sketch of a text is the sorted set of those hashes of its word shingles that lie in the lowest
``1 / scale`` of the hash range. Whether a hash is kept depends on the hash alone, so the sketch of
a union is the union of sketches, and the share of one sketch found in another estimates
containment however unequal the documents are; intersection over union estimates resemblance.
With ``least``, a sketch that would have fewer than ``least`` hashes is the text's ``least`` smallest
hashes instead (all hashes of a text that has fewer), so that only texts without words have an empty
sketch and texts of few words are compared whole. Such sketches unite as well: of the hashes of both
those below the bound are kept, or the ``least`` smallest. Resemblance is read off the sketch of the
union, containment off those hashes up to which the other sketch is whole.

Shingles are runs of ``shingle`` words (fewer words: the whole sequence; none: no shingle). Words are
runs of characters other than ASCII white space, in lower case (ASCII letters), and a shingle's hash
is XXH64 over the XXH64 hashes of its words.

``neighbours`` gives each row the row that follows it by descending id. Ids are cut into ranges at
approximate quantiles, so no task orders more than a range; the first row of each range is also
sent to the range before it, which makes the order whole across ranges with one shuffle. Ranges
and their first ids, at most ``MAX_RANGES`` numbers, come to the driver.

Defined results: a null text is empty and has the empty fingerprint; null ids follow all others;
rows of one id are ordered by SHA-256 of their text; a single row follows itself; two empty
fingerprints are alike (1.0), an empty and another are not (0.0); a text none of whose kept hashes
is where the other's sketch is whole counts as not contained (0.0); an empty table gives no rows;
extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgergraph.llm.common import SPACE, pick, read, text_or_empty

SHINGLE = 5
SCALE = 8
LEAST = 16
MAX_RANGES = 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body).getItem(0)


def bound(scale: int) -> int:
    """The largest hash that is kept whatever else the text has."""
    return -(1 << 63) + (1 << 64) // scale - 1


def kept(hashes: Column, scale: int, least: int) -> Column:
    """Of sorted distinct hashes those up to the bound, or the ``least`` smallest if that is more."""
    return let(F.filter(hashes, lambda x: x <= F.lit(bound(scale))),
               lambda low: F.when(F.size(low) >= least, low).otherwise(F.slice(hashes, 1, least)))


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE, least: int = 0) -> Column:
    """The kept shingle hashes of ``text``, sorted."""
    blank = "\t\n\x0b\x0c\r "
    words = F.split(F.btrim(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                            F.lit(blank)), SPACE)

    def hashes(h: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(h) - shingle),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(shingle)]))
        return F.when(F.size(h) >= shingle, runs).otherwise(F.array(F.xxhash64(h)))

    def sketched(h: Column) -> Column:
        # only texts with few hashes below the bound have all their hashes sorted
        low = F.array_sort(F.array_distinct(F.filter(h, lambda x: x <= F.lit(bound(scale)))))
        if not least:
            return low
        return let(low, lambda x: F.when(F.size(x) >= least, x)
                   .otherwise(F.slice(F.array_sort(F.array_distinct(h)), 1, least)))

    return F.when(F.btrim(text, F.lit(blank)) == "", F.array().cast("array<bigint>")) \
        .otherwise(let(let(F.transform(words, lambda w: F.xxhash64(w)), hashes), sketched))


def fingerprint(sketched: Column) -> Column:
    """A sketch as text: 16 lowercase hex digits a hash."""
    return F.lower(F.array_join(F.transform(sketched, lambda h: F.hex(h)), ""))


def likeness(a: Column, b: Column, scale: int = SCALE, least: int = 0) -> Column:
    """Resemblance that two sketches show: shared hashes over all hashes of the union's sketch."""
    def share(union: Column) -> Column:
        shared = F.size(F.array_intersect(F.array_intersect(a, b), union))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))
    return let(kept(F.array_sort(F.array_union(a, b)), scale, least) if least else F.array_union(a, b), share)


def containment(a: Column, b: Column, scale: int = SCALE, least: int = 0) -> Column:
    """Share of a's hashes that b has: how much of a's text stands in b."""
    # b's sketch is whole if it has fewer than ``least`` hashes, else up to the bound or its last hash
    whole = F.when(F.size(b) < least, F.lit((1 << 63) - 1)).otherwise(F.greatest(F.lit(bound(scale)), F.get(b, F.size(b) - 1)))
    seen = let(whole, lambda w: F.filter(a, lambda x: x <= w)) if least else a
    return F.when(F.size(a) == 0, F.when(F.size(b) == 0, F.lit(1.0)).otherwise(F.lit(0.0))) \
        .otherwise(let(seen, lambda x: F.when(F.size(x) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, b)) / F.size(x))))


def merged(sketches: DataFrame, by: list[str], column: str = "sketch", scale: int = SCALE, least: int = 0) -> DataFrame:
    """The sketch of each group's texts together: hashes are united before any shuffle."""
    hashes = F.array_sort(F.collect_list("h"))
    return (sketches.select(*by, F.explode(column).alias("h")).distinct()
            .groupBy(*by).agg((kept(hashes, scale, least) if least else hashes).alias(column)))


def neighbours(rows: DataFrame, id_col: str, tie: Column, carried: list[str], rows_per_range: int = 2000) -> DataFrame:
    """``rows`` with the struct ``next``: ``carried`` of the row that follows by descending id; the last
    row is followed by the first."""
    spark = rows.sparkSession
    n = rows.filter(F.col(id_col).isNotNull()).count()
    wanted = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_per_range))
    wanted = min(MAX_RANGES, wanted, max(1, n // 8))
    ids = rows.select(id_col)
    at = [i / wanted for i in range(1, wanted)]
    cuts = ids.agg(F.percentile_approx(id_col, at, 10 * MAX_RANGES)).first()[0] if at else []
    cuts = sorted(set(cuts or []))
    # range 0 holds the null ids, then 1, 2, ... by ascending id
    rank = F.when(F.col(id_col).isNull(), 0)
    rank = rank.otherwise(1 + F.size(F.filter(F.lit(cuts), lambda c: c < F.col(id_col)))) if cuts else rank.otherwise(1)
    heads = sorted((r[0], r[1]) for r in ids.groupBy(rank.alias("r")).agg(F.max(id_col)).collect())
    order = [r for r, _ in heads]
    # the range that a range's first row is sent to: the one above, from the highest to the lowest
    above = dict(zip(order, order[1:] + order[:1]))
    head = F.create_map(*[F.lit(x) for r, i in heads for x in (r, i)]) if heads else None
    to = F.create_map(*[F.lit(x) for pair in above.items() for x in pair]) if heads else None
    if head is None:
        return rows.withColumn("next", F.struct(*carried))
    # the rows travel as structs, so that no column of theirs clashes with those added here
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    ranged = rows.select(row.alias("row"), rank.alias("range"), F.col(f"`{id_col}`").alias("id"), tie.alias("tie"))
    first = F.col("id").eqNullSafe(F.element_at(head, F.col("range")))
    home = F.struct(F.col("range").alias("r"), F.lit(False).alias("guest"))
    away = F.struct(F.element_at(to, F.col("range")).alias("r"), F.lit(True).alias("guest"))
    sent = (ranged.withColumn("place", F.explode(F.when(first, F.array(home, away)).otherwise(F.array(home))))
            .select("row", "id", "tie", "place.r", "place.guest"))
    follow = Window.partitionBy("r").orderBy("guest", F.col("id").desc_nulls_last(), "tie")
    after = F.struct(*[F.col(f"row.`{c}`").alias(c) for c in carried])
    return (sent.withColumn("next", F.lead(after).over(follow)).filter(~F.col("guest"))
            .select(*[F.col(f"row.`{c}`").alias(c) for c in rows.columns], "next"))


def query(spark, sf_dir):
    """op4: fingerprints of every document, of its edited text, and how alike they are."""
    docs = pick(read(spark, sf_dir, "documents"), ["doc_id", "text"]).withColumn("text", text_or_empty())
    rows = neighbours(docs.withColumn("sketch", sketch(F.col("text"), least=LEAST)), "doc_id", F.sha2(F.col("text"), 256),
                      ["text", "sketch"])
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next.text"), F.lit(1), cut))
    # the edited text is computed once for its digest and its sketch, the sketch once for all its uses
    done = rows.select("doc_id", n.cast("long").alias("n_chars"), "sketch", F.col("next.sketch").alias("next_sketch"),
                       let(edited, lambda t: F.struct(F.sha2(t, 256).alias("sha"), sketch(t, least=LEAST).alias("sketch"))).alias("edited"))

    def result(e: Column) -> Column:
        s, other = e["sketch"], e["next"]
        own = F.col("sketch")
        return F.struct(e["sha"].alias("edited_sha256"), fingerprint(own).alias("fingerprint"),
                        fingerprint(s).alias("edited_fingerprint"), likeness(own, s, least=LEAST).alias("near_edited"),
                        likeness(own, other, least=LEAST).alias("near_next"), containment(own, s, least=LEAST).alias("contained_edited"),
                        containment(own, other, least=LEAST).alias("contained_next"))

    given = F.struct(F.col("edited.sha").alias("sha"), F.col("edited.sketch").alias("sketch"), F.col("next_sketch").alias("next"))
    return done.select("doc_id", "n_chars", let(given, result).alias("r")).select("doc_id", "n_chars", "r.*")
