"""Base tables: counts of the derived ones, reading, writing, SQL surface."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from build import factor_table, pressure_table, pvt_table, volume_table
from conftest import MEDIUM, SMALL
from voidage.plans import sqlapi
from voidage.plans.pvt import pvt_lookup, requests_by_factor
from voidage.plans.vrr import vrr_view, with_factor
from voidage.sources import schemas
from voidage.sources.derived import Field
from voidage.sources.tables import known_points, read_path, read_table, write_daily_volumes

# Row counts of the derived tables and of the lookup branches.
COUNTS = {
    SMALL: {"pvt": 200, "pressures": 587, "factors": 40, "volumes": 5_644, "requests": 527},
    MEDIUM: {"pvt": 2_000, "pressures": 675, "factors": 400, "volumes": 56_487, "requests": 6_247},
}
BRANCHES = {
    (SMALL, "all_to_date"): {"exact": 58, "interp": 174, "extrap_low": 29, "extrap_high": 33, "single": 46, "none": 187},
    (SMALL, "active"): {"exact": 19, "interp": 190, "extrap_low": 35, "extrap_high": 50, "single": 46, "none": 187},
    (MEDIUM, "all_to_date"): {"exact": 748, "interp": 1909, "extrap_low": 442, "extrap_high": 542, "single": 422, "none": 2184},
    (MEDIUM, "active"): {"exact": 306, "interp": 2120, "extrap_low": 573, "extrap_high": 642, "single": 422, "none": 2184},
}
MATCHES = {
    SMALL: {"pair": 7_788, "pattern": 6_635, "completion": 6_126, "latest": 2_138},
    MEDIUM: {"pair": 81_602, "pattern": 58_001, "completion": 65_861, "latest": 23_914},
}


@pytest.mark.parametrize("sf_dir", COUNTS)
def test_derived_tables(spark, sf_dir):
    field = Field(spark, sf_dir)
    found = {name: getattr(field, name).count() for name in ("pvt", "pressures", "factors", "volumes")}
    found["requests"] = requests_by_factor(field.factors, field.pressures).count()
    assert found == COUNTS[sf_dir]
    keys = ["ID_COMPLETION", "TEST_DATE", "PRESSURE"]
    assert field.pvt.dropDuplicates(keys).count() == found["pvt"]


@pytest.mark.parametrize("sf_dir,scope", BRANCHES)
def test_branch_counts(spark, sf_dir, scope):
    field = Field(spark, sf_dir)
    found = pvt_lookup(requests_by_factor(field.factors, field.pressures), field.pvt, scope)
    assert {r.BRANCH: r["count"] for r in found.groupBy("BRANCH").count().collect()} == BRANCHES[sf_dir, scope]


@pytest.mark.parametrize("sf_dir", MATCHES)
def test_factor_matches(spark, sf_dir):
    field = Field(spark, sf_dir)
    found = {rule: with_factor(field.volumes, field.factors, rule, "inner").count() for rule in MATCHES[sf_dir]}
    assert found == MATCHES[sf_dir]


def test_written_volumes_are_pruned_by_year(spark, tmp_path):
    rows = [{"ID_PATTERN": "P", "COMPLETION_ID": f"C{i}", "PROD_DATE": f"{2000 + i % 3}-05-01"} for i in range(30)]
    path = str(tmp_path / "volumes")
    write_daily_volumes(volume_table(spark, rows), path)
    assert sorted(p.name for p in (tmp_path / "volumes").glob("PROD_YEAR=*")) == [f"PROD_YEAR={y}" for y in (2000, 2001, 2002)]
    assert read_path(spark, path, "production_volumes_daily_oilfield").count() == 30
    one_year = spark.read.parquet(path).filter("PROD_YEAR = 2001")
    assert "PartitionFilters: [isnotnull(PROD_YEAR" in one_year._jdf.queryExecution().executedPlan().toString()


def test_stored_types_are_conformed(spark, tmp_path):
    stored = spark.range(1).select(
        F.lit("P").alias("id_pattern"),
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("DATE"),
        F.lit("12.5").cast("decimal(10,2)").alias("PRESSURE"),
        F.lit(1).alias("UNUSED"),
    )
    stored.write.parquet(str(tmp_path / "p"))
    table = read_path(spark, str(tmp_path / "p"), "pattern_pressure")
    assert table.schema == schemas.PATTERN_PRESSURE
    table.createOrReplaceTempView("stored_pressures")
    assert read_table(spark, "stored_pressures", "pattern_pressure").first() == ("P", dt.date(2020, 1, 1), 12.5)


def test_known_points(spark):
    pvt = pvt_table(spark, [("C1", "2020-01-01", 1.0, 1.0), ("C1", "2021-01-01", 2.0, 1.0), ("C2", "2020-01-01", 3.0, 1.0)])
    by = dt.date(2020, 12, 31)
    assert [r.PRESSURE for r in known_points(spark, pvt, by, "C1").collect()] == [1.0]
    asked = spark.createDataFrame([("C2",)], "ID_COMPLETION string")
    assert [r.PRESSURE for r in known_points(spark, pvt, by, asked=asked).collect()] == [3.0]
    assert known_points(spark, pvt, by).count() == 2


def test_sql_functions(spark):
    sqlapi.register_line_functions(spark)
    sql = "SELECT interpolate(0, 10, 1, 2, 5), extrapolate(0, 10, 1, 2, 20), extrapolate(3, 3, 7, 9, 1), interpolate_guarded(0, 10, 1, 2, 20), interpolate_guarded(0D, NULL, 1D, 2D, 5D)"
    assert tuple(spark.sql(sql).first()) == (1.5, 3.0, 7.0, None, None)


def test_sql_views(spark):
    pvt = pvt_table(spark, [("C1", "2019-01-01", 100.0, 2.0)])
    factors = factor_table(spark, [("P1", "C1", "2020-01-01", 0.5)])
    pressures = pressure_table(spark, [("P1", "2020-01-01", 110.0)])
    volumes = volume_table(spark, [{"ID_PATTERN": "P1", "COMPLETION_ID": "C1", "PROD_DATE": "2020-01-02",
                                    "AMOUNT_TYPE": "Production", "THEOR_OIL_VOL_STB": 4.0}])
    assert sqlapi.register_views(spark, volumes, factors, pressures, pvt, views=["completion_pvt_interpolated"], prefix="a_") == [
        "a_completion_pvt_interpolated"]
    names = {t.name for t in spark.catalog.listTables()}
    assert not names & {*sqlapi.TABLES, *sqlapi.VIEWS, "a_pattern_vrr_view"}
    sqlapi.register_views(spark, volumes, factors, pressures, pvt, prefix="b_", tables=True)
    row = spark.sql("SELECT v.ID_PATTERN_VRR, p.BRANCH FROM b_pattern_vrr_view v, b_completion_pvt_interpolated p").first()
    assert tuple(row) == ("P102-01-2020", "single")
    sqlapi.register_lookup_function(spark, pvt)
    (answer,) = spark.sql("SELECT * FROM pvt_at(110D, 'C1', DATE '2020-01-01')").collect()
    assert (answer.BRANCH, answer.VISCOSITY_GAS) == ("single", 2.0)
    (unknown,) = spark.sql("SELECT * FROM pvt_at(111D, 'C9', DATE '2020-01-01')").collect()
    assert (unknown.BRANCH, unknown.VISCOSITY_GAS) == ("none", None)


def test_view_follows_its_tables(spark, tmp_path):
    """Rows that are stored after a view was defined are in it, earlier ones too."""
    pvt = pvt_table(spark, [("C1", "2000-01-01", 100.0, 2.0)])
    put = lambda name, df: df.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    put("factors", factor_table(spark, [("P1", "C1", "2020-01-01", 0.5)]))
    put("pressures", pressure_table(spark, [("P1", "2010-01-01", 110.0)]))
    days = ["2015-06-01", "2020-06-01"]
    volumes = volume_table(spark, [{"ID_PATTERN": "P1", "COMPLETION_ID": "C1", "PROD_DATE": d,
                                    "AMOUNT_TYPE": "Production", "THEOR_OIL_VOL_STB": 4.0} for d in days])
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW f_stored USING parquet OPTIONS (path '{tmp_path}/factors')")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW p_stored USING parquet OPTIONS (path '{tmp_path}/pressures')")
    factors = read_table(spark, "f_stored", "pattern_contribution_factor")
    pressures = read_table(spark, "p_stored", "pattern_pressure")
    view = vrr_view(volumes, factors, pressures, pvt)
    assert sorted(str(r.DATE) for r in view.collect()) == days[1:]
    put("factors", factor_table(spark, [("P1", "C1", "2014-01-01", 0.25)]))
    spark.catalog.refreshTable("f_stored")
    later = vrr_view(volumes, read_table(spark, "f_stored", "pattern_contribution_factor"), pressures, pvt)
    assert sorted(str(r.DATE) for r in later.collect()) == days
    # No date of the data is written into the plan.
    assert "2014-01-01" not in later._jdf.queryExecution().optimizedPlan().toString()


def test_three_part_names(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS field_db")
    try:
        volume_table(spark, [{"ID_PATTERN": "P", "COMPLETION_ID": "C", "PROD_DATE": "2020-01-01"}]).write.mode("overwrite").option(
            "path", str(tmp_path / "daily")).saveAsTable("spark_catalog.field_db.daily")
        assert read_table(spark, "spark_catalog.field_db.daily", "production_volumes_daily_oilfield").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS spark_catalog.field_db.daily")
        spark.sql("DROP DATABASE IF EXISTS field_db")


def test_view_reads_only_the_columns_and_rows_it_needs(spark, tmp_path):
    rows = [{"ID_PATTERN": "P1", "COMPLETION_ID": "C1", "PROD_DATE": "2020-01-02", "AMOUNT_TYPE": "Production"}]
    path = str(tmp_path / "volumes")
    volume_table(spark, rows).write.parquet(path)
    view = vrr_view(
        read_path(spark, path, "production_volumes_daily_oilfield"),
        factor_table(spark, [("P1", "C1", "2020-01-01", 0.5)]),
        pressure_table(spark, [("P1", "2019-01-01", 110.0)]),
        pvt_table(spark, [("C1", "2019-01-01", 100.0, 2.0)]),
        require_gas=True,
    )
    jvm = spark.sparkContext._jvm
    plan = view._jdf.queryExecution().explainString(
        jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "IsNotNull(THEOR_GAS_VOL_KSCF)" in plan
    reads = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert reads and all("CUMULATIVE" not in line and "FREE_GAS" not in line for line in reads)
