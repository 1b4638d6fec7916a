"""Incremental conversion: block files in a folder are parsed as they appear and as they grow, and
appended to the flat ledger tables by a Structured Streaming query over the ``blockfiles`` stream source
(``sources.blockranges``), whose offsets say how far every file consists of whole blocks.

A node appends to its last block file, so a file that was seen once is not finished: a cut-off last block
or zero padding is no progress, and reading goes on there when the bytes have come. Spark keeps the
offsets in the query's checkpoint; the sink writes every table of a micro-batch into
``batch=<epoch id>`` with ``overwrite``, so a replayed epoch rewrites the same partitions and nothing
comes twice. Readers see one table per name with ``batch`` as a prunable partition column. Damage (see
``sources.blockfile``) fails the query unless ``on_damage="keep"``; it is then listed in ``rejects``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ledgergraph.sources import blockranges
from ledgergraph.sources.blockfile import MAINNET_MAGIC, DamagedBlockFile, blocks_of, damage_of, flatten
from ledgergraph.sources.io import LEDGER_TABLES


def append_batch(scan: DataFrame, output_dir: str, epoch_id: int, compression: str = "gzip", on_damage: str = "fail") -> None:
    """The rows of one micro-batch as ``batch=epoch_id`` of every table."""
    scan = scan.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        damaged = damage_of(scan)
        if on_damage != "keep" and (first := damaged.first()):
            raise DamagedBlockFile(f"{first.file}: {first.reason}, {first.length} bytes at {first.offset}")
        for name, df in zip((*LEDGER_TABLES, "rejects"), (*flatten(blocks_of(scan)), damaged)):
            df.write.mode("overwrite").option("compression", compression).parquet(f"{output_dir}/{name}/batch={epoch_id}")
    finally:
        scan.unpersist()


def start_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_location: str,
                 glob: str = "blk*.dat", magic: bytes = MAINNET_MAGIC, compression: str = "gzip",
                 available_now: bool = True, interval: str = "30 seconds", on_damage: str = "fail"):
    """Start the conversion stream; ``available_now`` processes what is there, then stops."""
    blockranges.register(spark)
    scan = (spark.readStream.format("blockfiles").option("path", input_dir).option("glob", glob)
            .option("magic", magic.hex()).option("scripts", "outputs").load())
    writer = scan.writeStream.foreachBatch(
        lambda df, epoch: append_batch(df, output_dir, epoch, compression, on_damage)).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
