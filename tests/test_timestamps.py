from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from loquela.operators import timestamps as ts


def us(*parts):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp()) * 1_000_000


def instants(spark, rows, tz="Europe/Rome"):
    df = spark.createDataFrame([(i, v, s, tz) for i, (v, s) in enumerate(rows)], "k long, v string, s string, tz string")
    return {r["k"]: r for r in ts.normalise(df.withColumn("_v", F.lit(1)).withColumn("utc_us", F.lit(2)), ["k"], "v", "tz", "s").collect()}


CASES = [
    ("2025-02-10T07:19:26", us(2025, 2, 10, 6, 19, 26)),
    ("  2025-07-10 07:19:26,500 ", us(2025, 7, 10, 5, 19, 26) + 500_000),
    ("2025-02-28T09:11:22Z", us(2025, 2, 28, 9, 11, 22)),
    ("2025-03-17T11:24:24.000-04:00", us(2025, 3, 17, 15, 24, 24)),
    ("2025-03-03 13:50+0100", us(2025, 3, 3, 12, 50)),
    ("2025-02-20 13:54:49 GMT+1", us(2025, 2, 20, 12, 54, 49)),
    ("2025-10-03 08:37:52 CEST", us(2025, 10, 3, 6, 37, 52)),
    ("2026-02-22T23:08:17[America/New_York]", us(2026, 2, 23, 4, 8, 17)),
    ("1742247955", 1742247955 * 1_000_000),
    ("1739864152541", 1739864152541 * 1000),
    ("20250214_092743", us(2025, 2, 14, 8, 27, 43)),
    ("22 febbraio 2025, ore 1:56", us(2025, 2, 22, 0, 56)),
    ("24 feb 2025 21:55:46", us(2025, 2, 24, 20, 55, 46)),
    ("Thu, 20 Mar 2025 10:29:35 -0400", us(2025, 3, 20, 14, 29, 35)),
    ("2025-03-10 24:10", us(2025, 3, 10, 23, 10)),
    ("2025-03-30T02:30:00", None),
    ("2025-10-26T02:30:00", None),
    ("2025-10-26T02:30:00+02:00", us(2025, 10, 26, 0, 30)),
    ("2025-13-04 09:00:00", None),
    ("2026-02-30T10:15:00", None),
    ("0000-00-00 00:00:00", None),
    ("01:20", None),
    ("ieri sera", None),
    ("x" * 5000, None),
    ("", None),
    (None, None),
]


def test_notations(spark):
    got = instants(spark, [(v, "a") for v, _ in CASES])
    assert len(got) == len(CASES)
    for i, (value, want) in enumerate(CASES):
        assert got[i]["utc_us"] == want, value


def test_order_is_learnt_per_source(spark):
    rows = [("25/03/2025 10:00:00", "day"), ("04/05/2025 10:00:00", "day"), ("03/25/2025 10:00:00 AM", "month"), ("04/05/2025 10:00:00 PM", "month"), ("04-05-2025_10-00-00", "none"), ("05/05/2025 10:00", "none"), ("25/03/2025 10:00:00", "month")]
    rows += [("03/26/2025 10:00", "month")] * 100
    got = instants(spark, rows)
    assert got[1]["utc_us"] == us(2025, 5, 4, 8)
    assert got[3]["utc_us"] == us(2025, 4, 5, 20)
    assert got[4]["utc_us"] is None and got[4]["status"] == "ambiguous_order"
    assert got[5]["utc_us"] == us(2025, 5, 5, 8)
    assert got[6]["utc_us"] is None


@pytest.mark.parametrize("tz", [None, "Nowhere/Land"])
def test_unknown_zone(spark, tz):
    got = instants(spark, [("2025-02-10T07:19:26", "a"), ("2025-02-10T07:19:26Z", "a")], tz)
    assert got[0]["utc_us"] is None and got[0]["status"] == "unknown_zone" and got[1]["utc_us"] is not None


def test_empty(spark):
    assert instants(spark, []) == {}
