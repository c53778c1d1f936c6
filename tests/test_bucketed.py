"""Daily volumes stored in buckets: the same rows, and no move of the daily rows."""

from __future__ import annotations

import uuid

import pytest

from build import executed_nodes, factor_table, pressure_table, pvt_table, volume_table
from voidage.plans.vrr import VRR_COLUMNS, splits, vrr_view
from voidage.sources.schemas import MONTH_PLACE
from voidage.sources.tables import read_daily_volumes, store_daily_volumes


@pytest.fixture
def name(spark):
    name = f"volumes_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture(scope="module")
def small(spark):
    factors = factor_table(spark, [("P1", "C1", "2015-01-01", 0.75), ("P2", "C1", "2016-02-01", 0.25), ("P1", "C2", "2015-01-01", 1.0)])
    pressures = pressure_table(spark, [("P1", "2015-01-01", 110.0), ("P1", "2016-03-01", 120.0), ("P2", "2015-01-01", 130.0)])
    pvt = pvt_table(spark, [(c, "2014-01-01", p, v) for c in ("C1", "C2") for p, v in ((100.0, 2.0), (140.0, 3.0))])
    return factors, pressures, pvt


def days(completion, years):
    return [
        {"ID_PATTERN": "P1", "COMPLETION_ID": completion, "PROD_DATE": f"{y}-{m:02}-{d:02}", "AMOUNT_TYPE": "Production",
         "THEOR_OIL_VOL_STB": 1.0 + d, "THEOR_GAS_VOL_KSCF": 2.0}
        for y in years for m in range(1, 13) for d in (1, 15)
    ]


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("factor", ["pair", "pattern", "completion", "latest"])
@pytest.mark.parametrize("pressure_key", ["factor", "volume"])
def test_same_rows(spark, name, small, factor, pressure_key):
    # One completion has most of the rows and more years than the cycle of months is long.
    volumes = volume_table(spark, days("C1", range(2014, 2023)) + days("C2", [2016]))
    store_daily_volumes(volumes, name, buckets=4)
    options = {"factor": factor, "pressure_key": pressure_key}
    got = vrr_view(read_daily_volumes(spark, name), *small, **options)
    assert got.columns == list(VRR_COLUMNS)
    assert rows(got) == rows(vrr_view(volumes, *small, **options))


def test_daily_rows_are_joined_where_they_lie(spark, name, small):
    store_daily_volumes(volume_table(spark, days("C1", range(2014, 2017))), name, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = executed_nodes(splits(read_daily_volumes(spark, name), *small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = [n.toString() for n in nodes if n.getClass().getSimpleName().startswith(("ShuffleExchange", "BroadcastExchange"))]
    assert text and not any(name in t for t in text)
    (scan,) = [n.toString() for n in nodes if name in n.toString() and n.getClass().getSimpleName() == "FileSourceScanExec"]
    assert "Bucketed: true" in scan


def test_rows_without_date_or_completion_and_no_rows(spark, name, small):
    odd = spark.createDataFrame(
        [(None, None)], "PROD_DATE date, COMPLETION_ID string"
    )
    volumes = volume_table(spark, days("C1", [2016])).unionByName(odd, allowMissingColumns=True)
    store_daily_volumes(volumes, name, buckets=2)
    assert read_daily_volumes(spark, name).filter(f"{MONTH_PLACE} IS NULL").count() == 1
    assert rows(vrr_view(read_daily_volumes(spark, name), *small)) == rows(vrr_view(volumes, *small))
    store_daily_volumes(volumes.limit(0), name, buckets=2)
    assert vrr_view(read_daily_volumes(spark, name), *small).count() == 0
