import datetime as dt

from pyspark.sql import functions as F

from quakeframe.functions.columns import epoch_seconds, ntz_millis_sql


def test_ntz_epoch_is_zone_free(spark):
    """Whole seconds and milliseconds of TIMESTAMP_NTZ values are their UTC
    wall-clock epoch values in any session zone, across daylight saving."""
    vals = [
        dt.datetime(2024, 7, 1, 12, 0, 0, 999000),  # summer
        dt.datetime(2024, 1, 1, 0, 0, 0),
        dt.datetime(2024, 3, 10, 2, 30, 0),  # inside a spring-forward gap in US zones
        dt.datetime(1969, 12, 31, 23, 59, 59, 500000),  # before the epoch: floor
    ]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    epoch = dt.datetime(1970, 1, 1)
    want = [((v - epoch) // dt.timedelta(seconds=1), (v - epoch) // dt.timedelta(milliseconds=1)) for v in vals]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Australia/Sydney"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [(r.s, r.ms) for r in df.select(epoch_seconds(df, "t").alias("s"),
                                                  F.expr(ntz_millis_sql("t")).alias("ms")).collect()]
            assert got == want, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
