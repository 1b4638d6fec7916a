"""Exact dedup by distributed most-significant-digit radix partitioning.

Every round takes the next bytes of each live document as its digit and splits each group by
them. A group of one row is decided; so is a group whose digit came out shorter than asked for,
because its texts have ended and are equal. The others go on with a digit ``grow`` times longer,
so a text of n bytes needs about log(n) rounds. Texts are compared by their own bytes; no digest
decides equality (the SHA-256 is only reported).

Skew: a digit's rows are salted by id, counted per (group, digit, salt) before any shuffle, and
joined back on the salted key, so a group of copies holding a third of all rows is spread over
``spark.sql.shuffle.partitions`` tasks. Rounds are written to scratch tables.

Defined results: null text equals the empty text; null ids rank after all others (a group of
null ids keeps one of its rows and has a null ``keep_id``); of repeated rows with the same id and
text exactly one is kept; an empty table gives no rows; extra columns never clash, the source row
travels as one struct.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgergraph.llm.common import pick, read
from ledgergraph.session import staged


# a run of white space that is not a single space already: only these are replaced
LONG_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; as UTF-8 bytes."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), LONG_SPACE, " ").cast("binary")


def digit_of(text: Column, offset: int, size: int) -> Column:
    """Bytes ``offset`` to ``offset + size`` of the normalised text; fewer where it ends. The first digit
    comes from the text's beginning alone, where that gives enough: what white space collapses to
    there does not depend on the rest."""
    whole = F.substring(normalised(text), offset + 1, size)
    if offset:
        return whole
    head = normalised(F.substring(F.coalesce(text.cast("string"), F.lit("")), 1, 4 * size))
    return F.when(F.length(head) >= size, F.substring(head, 1, size)).otherwise(whole)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                first_bytes: int = 64, grow: int = 4, carry: bool = False) -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    With ``carry`` the whole source row comes along as the struct ``row``."""
    spark = docs.sparkSession
    salts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.struct(id_col, text_col)
    live = docs.select(row.alias("row"), F.lit("").alias("group"))
    doc_id, text = F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`")
    offset, size, decided = 0, first_bytes, []
    while True:
        sha = F.col("sha") if decided else F.sha2(normalised(text), 256)
        keyed = (live.select("row", "group", doc_id.alias("id"), digit_of(text, offset, size).alias("digit"), sha.alias("sha"))
                 .withColumn("salt", F.pmod(F.xxhash64("id", "digit"), F.lit(salts))))
        key = ["group", "digit", "salt"]
        across = Window.partitionBy("group", "digit")
        counts = (keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
                  .select(*key, F.sum("n").over(across).alias("group_size"),
                          F.min("least").over(across).alias("keep_id")))
        # a group's name: its least id, which is in no other group; ids that are null or stand more than
        # once are told apart by where their group came from
        origin = F.sha2(F.concat(F.col("group").cast("binary"), F.lit(":").cast("binary"), "digit"), 256)
        counts = counts.withColumn("name", F.concat_ws(":", F.coalesce(F.col("keep_id").cast("string"), F.lit("-")), origin))
        done = (F.col("group_size") == 1) | (F.length("digit") < size)
        keep_row = F.col("row") if carry else F.when(~done, F.col("row"))
        out = staged(keyed.join(counts, key).select(
            keep_row.alias("row"), "id", "sha", F.col("name").alias("group"), "keep_id", "group_size",
            done.alias("done")), "radix")
        decided.append(out.filter("done"))
        live = out.filter(~F.col("done")).select("row", "group", "sha")
        if live.isEmpty():
            break
        offset, size = offset + size, size * grow
    result = (reduce(DataFrame.unionByName, decided)
              .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id"))))
    repeated = result.filter("kept").groupBy("id", "group").count().filter("count > 1")
    if not repeated.isEmpty():       # the same id and text more than once: one row of them stays
        nth = F.row_number().over(Window.partitionBy("id", "group", "kept").orderBy("sha"))
        result = result.withColumn("kept", F.col("kept") & (nth == 1))
    cols = [F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")]
    return result.select(*cols, *(["row"] if carry else []))


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    return (exact_dedup(docs, id_col, text_col, carry=True).filter("kept")
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def query(spark, sf_dir):
    """op6: every document with the row that stays for its text."""
    return exact_dedup(pick(read(spark, sf_dir, "documents"), ["doc_id", "text"]))
