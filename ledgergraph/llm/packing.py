"""Best-fit packing through a configuration linear program over the length histogram.

Texts are tokenised, closed with the token 0, and cut into pieces of at most ``capacity`` tokens
(only longer documents are cut; the first piece takes the remainder). The number of pieces per
length, at most ``capacity`` numbers, is all that packing needs to know. A configuration is a
multiset of lengths that fits into one sequence. The covering program (fewest sequences so that
every length's count is covered) is solved by multiplicative weights: lengths carry prices,
knapsack dynamic programming finds the most valuable configuration, and the prices of the
lengths it covers fall. The fractional solution is rounded down; what is left of the histogram is rounded
up, configuration by configuration, each priced by a knapsack on what is left and taken as often as that
allows, so the driver's work and memory depend on the lengths and not on the pieces. No length in the
result is dropped or capped.

The packing is a table of slot ranges: for a length, ranks r0 to r1 go to sequences s0, s0 + 1, ...
at a fixed offset. Pieces are ranked within their length by counts per (length, slice of a hash),
so a length that holds a third of all pieces is never ordered in one task, and find their slot by
binary search in that table (at most configurations times items, a few thousand rows).

The tokenizer is the byte-level BPE vocabulary file of ``tokenizers``; its ids are computed by
``tiktoken`` from the same file, over four times faster, and are equal (tested), however long a text or
a run of one character in it is.

Defined results: a null text is empty and packs as the single token 0; null ids pack like others;
repeated rows each get a place of their own; an empty table gives no rows; extra columns never
clash.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgergraph.llm.common import pick, read, text_or_empty
from ledgergraph.session import staged

CAPACITY = 2048
END = 0
#: at least so many slices of a length, and about so many pieces in one
SLICES, SLICE_ROWS = 256, 1 << 16
#: runs of white space (as Unicode defines it) that the tokenizer's pattern would have to go back over
#: character by character: they are one token piece, and are cut out before the pattern sees them
LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{2000,}")


@lru_cache(maxsize=4)
def encoder(path: str | None = None):
    """Text -> ids of the byte-level BPE file at ``path`` (default: the public 50k vocabulary)."""
    import public_tokenizers
    import tiktoken
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = json.load(f)
    special = {t["content"]: t["id"] for t in vocabulary.get("added_tokens", [])}
    # byte-level files spell bytes as printable characters: those that are printable as themselves,
    # the others from U+0100 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
    ranks = {bytes(spelled[c] for c in token): i for token, i in vocabulary["model"]["vocab"].items()
             if token not in special}
    encoding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    marks = re.compile("|".join(map(re.escape, special))) if special else None

    def encode(text: str) -> list[int]:
        out, at = [], 0
        for run in LONG_SPACE.finditer(text):
            stop = run.end()
            # the last character of a run goes with what follows, unless that is nothing or a special token
            if stop < len(text) and not (marks and marks.match(text, stop)):
                stop -= 1
            out += encoding.encode(text[at:run.start()], allowed_special="all")
            out += encoding._encode_single_piece(text[run.start():stop].encode("utf-8"))
            at = stop
        return out + encoding.encode(text[at:], allowed_special="all")
    return encode


def piece_rows(text: str, encode, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, list[int]]]:
    """(piece, start, length, ids_crc32, ids) of one document."""
    ids = np.array(encode(text) + [END], "<u4")
    pieces = -(-len(ids) // capacity)
    first = len(ids) - (pieces - 1) * capacity
    out = []
    for k in range(pieces):
        start, stop = (0, first) if k == 0 else (first + (k - 1) * capacity, first + k * capacity)
        part = ids[start:stop]
        out.append((k, start, stop - start, zlib.crc32(part.tobytes()), part))
    return out


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
        tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and ids)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    id_type = "bigint" if id_type == "void" else id_type

    def pieces(batches):
        encode = encoder(tokenizer)
        for pdf in batches:
            for at in range(0, len(pdf), 64):
                rows = [(i, *p) for i, text in zip(pdf["id"][at:at + 64], pdf["text"][at:at + 64])
                        for p in piece_rows(text, encode, capacity)]
                out = pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32", "ids"])
                yield out if with_ids else out.drop(columns="ids")

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<bigint>" * with_ids
    rows = docs.select(F.col(id_col).cast(id_type).alias("id"), text_or_empty(text_col).alias("text"))
    # ids may be null: pandas would turn such a column into floats, so they travel as text
    return (rows.withColumn("id", F.col("id").cast("string"))
            .mapInPandas(pieces, schema.replace(f"id {id_type}", "id string", 1))
            .withColumn("id", F.col("id").cast(id_type)))


def price(values: np.ndarray, capacity: int) -> list[int]:
    """The most valuable multiset of lengths (values[i] is length i + 1's) that fits: unbounded
    knapsack by dynamic programming over capacities."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        # best[c - l] + value(l) for l = 1..c
        options = best[c - 1::-1][:c] + values[:c]
        i = int(options.argmax())
        best[c], last[c] = options[i], i + 1
    out, c = [], capacity
    while c > 0:
        if values[last[c] - 1] > 0:      # a length without value is unused room
            out.append(int(last[c]))
        c -= int(last[c])
    return out


def configurations(counts: np.ndarray, capacity: int, rounds: int = 800, rate: float = 0.06,
                   steep: float = 1.0) -> dict[tuple[int, ...], float]:
    """A fractional cover of ``counts`` (per length 1..capacity) by configurations, by multiplicative
    weights: a configuration is taken as often as its scarcest length allows in one step. ``steep`` above 1
    lets long pieces start at more than the price of their space."""
    need = counts.astype(np.float64)
    have = need > 0
    log_price = np.where(have, steep * np.log(np.arange(1, capacity + 1) / capacity), -np.inf)
    covered, cover = np.zeros(capacity), {}
    for _ in range(rounds):
        left = have & (covered < need)
        if not left.any():
            break
        prices = np.where(left, np.exp(log_price - log_price[left].max()) , 0.0)
        items = price(prices, capacity)
        lengths, times = np.unique(items, return_counts=True)
        at = lengths - 1
        # a share of the scarcest length's need, at least one sequence
        step = max(1.0, min(float((np.maximum(need[at] * rate, 1.0) / times).min()),
                            float(((need[at] - covered[at]) / times).max())))
        key = tuple(items)
        cover[key] = cover.get(key, 0.0) + step
        covered[at] += step * times
        log_price[at] -= step * times / need[at]
    return cover


def completed(left: np.ndarray, items: list[int], capacity: int) -> list[int]:
    """The fullest configuration that holds ``items`` and takes no length more often than it is left: a knapsack
    with lengths as prices (those that prove the volume bound), by dynamic programming over sums kept as
    bits of one integer."""
    room = capacity - sum(items)
    have = left.copy()
    np.subtract.at(have, np.array(items) - 1, 1)
    sums, whole, steps = 1, (1 << (room + 1)) - 1, []
    for length in (np.flatnonzero(have[:room] > 0) + 1).tolist():
        times, some = min(int(have[length - 1]), room // length), 1
        while times:                     # 1, 2, 4, ... pieces, so that every number is a sum
            some = min(some, times)
            steps.append((length, some, sums))
            sums |= (sums << (length * some)) & whole
            times -= some
            some *= 2
    at, out = sums.bit_length() - 1, list(items)
    for length, some, before in reversed(steps):        # longer pieces first
        if length * some <= at and before >> (at - length * some) & 1:
            out += [length] * some
            at -= length * some
    return out


#: starting prices of the program that are tried: which solution rounds best depends on the histogram
STEEP = (1.3, 1.0, 2.0)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Slot ranges (length, first rank, ranks, first sequence, offset) that place every piece of the histogram
    once, and the number of sequences: the best of the program's solutions, or the first that meets the
    volume bound."""
    least = -(-int((counts * np.arange(1, capacity + 1)).sum()) // capacity)
    best = None
    for steep in STEEP:
        found = rounded(counts, capacity, configurations(counts, capacity, steep=steep))
        best = found if best is None or found[1] < best[1] else best
        if best[1] == least:
            break
    return best


def rounded(counts: np.ndarray, capacity: int, cover: dict[tuple[int, ...], float]) -> tuple[np.ndarray, int]:
    """A fractional ``cover`` as whole sequences. Of it the configurations that fill a sequence are kept, rounded
    down. What is left is rounded up: the configuration of the longest remaining piece is priced on what is
    left, and taken as often as its scarcest length allows."""
    left = counts.astype(np.int64).copy()
    used = np.zeros(capacity, np.int64)     # ranks given away per length
    slots, sequences = [], 0

    def place(items: list[int], most: float) -> None:
        nonlocal sequences
        lengths, per = np.unique(items, return_counts=True)
        times = int(min(most, (left[lengths - 1] // per).min()))
        offset = 0
        for length in items if times else []:
            slots.append((length, int(used[length - 1]), times, sequences, offset))
            used[length - 1] += times
            left[length - 1] -= times
            offset += length
        sequences += times

    for items, times in sorted(cover.items(), key=lambda x: (-x[1], x[0])):
        if sum(items) == capacity:
            place(list(items), int(times))
    while left.any():
        place(completed(left, [int(np.flatnonzero(left)[-1]) + 1], capacity), np.inf)
    return np.array(sorted(slots), np.int64).reshape(-1, 5), sequences


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (id, piece, length, ...) with ``sequence_id`` and ``offset``.

    ``pieces`` is read twice: hand in a staged table."""
    spark = pieces.sparkSession
    slices = max(SLICES, -(-pieces.count() // SLICE_ROWS))
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(slices)))
    tally = sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    below = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    tally = staged(tally.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0))), "pack-tally")
    counts = np.zeros(capacity, np.int64)
    for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect():      # at most ``capacity`` rows
        counts[r["length"] - 1] = r["n"]
    slots = plan(counts, capacity)[0]
    shared = spark.sparkContext.broadcast(slots)

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = shared.value
        width = int(table[:, 1].max()) + int(table[:, 2].max()) + 1
        starts = table[:, 0] * width + table[:, 1]
        at = np.searchsorted(starts, length.to_numpy() * width + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": table[at, 3] + rank.to_numpy() - table[at, 1], "offset": table[at, 4]})

    order = Window.partitionBy("length", "slice").orderBy("id", "piece", "ids_crc32")
    ranked = (sliced.withColumn("nth", F.row_number().over(order))
              .join(tally.select("length", "slice", "before"), ["length", "slice"]))
    return (ranked.withColumn("place", slot("length", F.col("before") + F.col("nth") - 1))
            .select(*[F.col(c) for c in pieces.columns], "place.*"))


def packed(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of ``docs`` with its place."""
    pieces = staged(cut(docs, id_col, text_col, capacity, tokenizer, with_ids), "pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_col)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences of a packing made with ``with_ids``. A sequence has at
    most ``capacity`` tokens, so its pieces are gathered in one row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (placed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids")))


def query(spark, sf_dir):
    """op7: every piece of the documents with its place in a sequence of 2,048 tokens."""
    return packed(pick(read(spark, sf_dir, "documents"), ["doc_id", "text"])).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
