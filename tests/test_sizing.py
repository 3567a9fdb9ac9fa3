"""Measured broadcast decisions."""

from unnestor.plans.sizing import broadcast_limit, fits_broadcast, measure


def test_broadcast_limit_parsing(spark):
    try:
        for value, want in [("10485760b", 10485760), ("10MB", 10 << 20), ("-1", -1), ("2g", 2 << 30)]:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
            assert broadcast_limit(spark) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measure_and_fit(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "k string, v int")
    rows, nbytes = measure(df, ["k"])
    assert rows == 2 and nbytes == 3 + 8 + 0 + 8
    assert fits_broadcast(spark, rows, nbytes)
    assert not fits_broadcast(spark, rows, nbytes, max_rows=1)
    assert not fits_broadcast(spark, rows, 1 << 40)
