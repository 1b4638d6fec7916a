"""Range-partitioned row numbers equal the window definition, also with a hot group."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgergraph.operators.ids import dense_ids, with_row_number


def _data(spark):
    # group 0 holds a third of all rows and spans several range partitions; ties in `v`
    rows = [(0 if i % 3 == 0 else i % 17, (i * 7919) % 1000, i) for i in range(3000)]
    return spark.createDataFrame(rows, "g long, v long, k long")


def test_within_group_matches_window(spark):
    df = _data(spark)
    ours, total = with_row_number(df, ["v", "k"], partition_by=["g"], id_col="rn", num_partitions=7)
    assert total == 3000
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "k")) - 1)
    assert sorted(ours.collect()) == sorted(ref.collect())


def test_global_dense_ids_with_offset(spark):
    df = _data(spark).select("k")
    ids, n = dense_ids(df, "k", offset=100)
    got = sorted((r.k, r.id) for r in ids.collect())
    assert n == 3000
    assert got == [(k, 100 + k) for k in range(3000)]


def test_string_keys_and_empty_partitions(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("a", 3), ("c", 0)], "s string, x long")
    ours, _ = with_row_number(df, ["x"], partition_by=["s"], num_partitions=16)
    assert sorted((r.s, r.x, r.rn) for r in ours.collect()) == [("a", 1, 0), ("a", 3, 1), ("b", 2, 0), ("c", 0, 0)]


def test_order_chain_with_hot_customer(spark):
    """One customer holds a third of all orders: the chain (next order per customer) equals
    the window definition, although that customer's orders span many partitions."""
    import datetime as dt

    from pyspark.sql import Window

    from ledgergraph.sources.star import _order_chain
    base = dt.datetime(1995, 1, 1)
    rows = [(k, 7 if k % 3 == 0 else k % 50, base + dt.timedelta(days=(k * 37) % 400))
            for k in range(3000)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {(r.o_orderkey, r.next_orderkey, r.seq) for r in _order_chain(orders).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    ref = orders.select("o_orderkey", F.lead("o_orderkey").over(w).alias("next_orderkey"),
                        (F.row_number().over(w) - 1).alias("seq"))
    assert got == {(r.o_orderkey, r.next_orderkey, r.seq) for r in ref.collect()}


def test_blocks_independent_of_time_zone_and_timestamp_type(spark):
    import datetime as dt

    from ledgergraph.sources.star import derive_blocks
    rows = [(1, dt.datetime(1995, 1, 1)), (2, dt.datetime(1995, 1, 2)), (3, dt.datetime(1995, 1, 1))]
    ntz = spark.createDataFrame(rows, "o_orderkey long, o_orderdate timestamp_ntz")
    # the same instants as a zone-aware TIMESTAMP column (cast while the session is UTC)
    ltz = ntz.select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate")).cache()
    ltz.count()
    want = sorted(tuple(r) for r in derive_blocks(ntz).collect())
    assert sorted(r[2] for r in want) == [788918400, 789004800]
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert sorted(tuple(r) for r in derive_blocks(ntz).collect()) == want
        assert sorted(tuple(r) for r in derive_blocks(ltz).collect()) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_row_number_property(spark):
    """Random skewed groups, random partition counts: equal to the window definition."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "hot", "hot", "hot"]),
                              st.integers(0, 50)), min_size=1, max_size=300),
           st.integers(1, 12))
    def check(rows, parts):
        data = [(g, v, i) for i, (g, v) in enumerate(rows)]     # i makes the order key unique
        df = spark.createDataFrame(data, "g string, v long, i long")
        ours, total = with_row_number(df, ["v", "i"], partition_by=["g"], num_partitions=parts)
        ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "i")) - 1)
        assert total == len(data)
        assert sorted(ours.collect()) == sorted(ref.collect())

    check()
