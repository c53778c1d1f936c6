"""The rollup and the ratio views on hand-made fields."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from build import executed_nodes, factor_table, pressure_table, pvt_table, volume_table
from voidage.plans.relations import relationship_counts
from voidage.plans.vrr import VRR_COLUMNS, splits, vrr_report, vrr_view


def production(date, completion="C1", pattern="P1", **volumes):
    return {"ID_PATTERN": pattern, "COMPLETION_ID": completion, "PROD_DATE": date, "AMOUNT_TYPE": "Production", **volumes}


def injection(date, completion="C1", pattern="P1", **volumes):
    return {**production(date, completion, pattern, **volumes), "AMOUNT_TYPE": "Injection"}


@pytest.fixture(scope="module")
def pvt(spark):
    # Every property is 2 at any pressure of C1 and C2.
    return pvt_table(spark, [("C1", "2019-01-01", 100.0, 2.0), ("C2", "2019-01-01", 100.0, 2.0)])


@pytest.fixture(scope="module")
def pressures(spark):
    return pressure_table(
        spark,
        [("P1", "2020-01-01", 110.0), ("P1", "2020-03-01", 120.0), ("P2", "2020-01-01", 130.0)],
    )


@pytest.fixture(scope="module")
def factors(spark):
    return factor_table(spark, [("P1", "C1", "2020-01-01", 0.75), ("P2", "C1", "2020-02-01", 0.25)])


def view(spark, rows, factors, pressures, pvt, **options):
    found = vrr_view(volume_table(spark, rows), factors, pressures, pvt, **options)
    assert tuple(found.columns) == VRR_COLUMNS
    return sorted(found.collect(), key=lambda r: (r.DATE, r.PRESSURE))


def test_one_day(spark, factors, pressures, pvt):
    rows = [
        production("2020-01-10", THEOR_OIL_VOL_STB=8.0, THEOR_WATER_VOL_STB=4.0, THEOR_GAS_VOL_KSCF=0.032),
        injection("2020-01-10", THEOR_WATER_INJ_VOL_STB=6.0, THEOR_GAS_INJ_VOL_KSCF=0.002),
    ]
    (row,) = view(spark, rows, factors, pressures, pvt)
    assert row.ID_PATTERN_VRR == "P110-01-2020"
    assert (row.ID_PATTERN, row.PRESSURE) == ("P1", 110.0)
    assert (row.OIL_VOLUME_STB, row.WATER_VOLUME_STB, row.GAS_VOLUME_SCF) == (6.0, 3.0, pytest.approx(24.0))
    assert (row.OIL_VOLUME_RES_BBL, row.WATER_VOLUME_RES_BBL) == (12.0, 6.0)
    # (32 / 8 - 2) * 8 * 0.75 * 2
    assert row.FREE_GAS == pytest.approx(24.0)
    assert row.PRODUCTION_VOLUME_RES_BBL == pytest.approx(42.0)
    assert (row.WATER_INJ_VOLUME_RES_BBL, row.GAS_INJ_VOLUME_RES_BBL) == (9.0, pytest.approx(3.0))
    assert row.INJECTION_VOLUME_RES_BBL == pytest.approx(12.0)
    assert row.VRR == pytest.approx(12 / 42)
    # Running production leaves free gas out.
    assert row.CUMULATIVE_PRODUCTION_VOLUME_RES_BBL == 18.0
    assert row.CUMULATIVE_VRR == pytest.approx(12 / 18)


def test_cumulative_can_include_free_gas(spark, factors, pressures, pvt):
    rows = [production("2020-01-10", THEOR_OIL_VOL_STB=8.0, THEOR_WATER_VOL_STB=4.0, THEOR_GAS_VOL_KSCF=0.032)]
    (row,) = view(spark, rows, factors, pressures, pvt, cumulative_includes_free_gas=True)
    assert row.CUMULATIVE_PRODUCTION_VOLUME_RES_BBL == pytest.approx(42.0)


def test_a_day_fans_out_to_the_patterns_of_the_completion(spark, factors, pressures, pvt):
    rows = [production("2020-02-10", THEOR_OIL_VOL_STB=8.0, THEOR_WATER_VOL_STB=0.0)]
    first, second = view(spark, rows, factors, pressures, pvt)
    assert [(r.ID_PATTERN, r.PRESSURE, r.OIL_VOLUME_STB) for r in (first, second)] == [
        ("P1", 110.0, 6.0),
        ("P1", 130.0, 2.0),
    ]
    # Rows of one date share the running total.
    assert first.CUMULATIVE_PRODUCTION_VOLUME_RES_BBL == second.CUMULATIVE_PRODUCTION_VOLUME_RES_BBL == 16.0


def test_running_totals_over_days_and_pressure_change(spark, factors, pressures, pvt):
    rows = [production(d, THEOR_OIL_VOL_STB=4.0) for d in ("2020-01-10", "2020-01-11")]
    rows += [production("2020-03-01", completion="C2", THEOR_OIL_VOL_STB=4.0)]
    more = factors.unionByName(factor_table(spark, [("P1", "C2", "2020-01-01", 1.0)]))
    found = view(spark, rows, more, pressures, pvt)
    assert [r.PRESSURE for r in found] == [110.0, 110.0, 120.0]
    assert [r.CUMULATIVE_OIL_PRODUCTION_VOLUME_RES_BBL for r in found] == [6.0, 12.0, 20.0]
    total = sum(r.OIL_VOLUME_RES_BBL for r in found)
    assert found[-1].CUMULATIVE_OIL_PRODUCTION_VOLUME_RES_BBL == total


def test_oil_zero_null_factor_and_null_volume(spark, pressures, pvt):
    factors = factor_table(spark, [("P1", "C1", "2020-01-01", None)])
    rows = [production("2020-01-10", THEOR_OIL_VOL_STB=0.0, THEOR_WATER_VOL_STB=10.0, THEOR_GAS_VOL_KSCF=10.0)]
    (row,) = view(spark, rows, factors, pressures, pvt)
    assert row.FREE_GAS == 0.0
    assert row.WATER_VOLUME_STB == 10.0
    assert row.GAS_INJ_VOLUME_SCF == 0.0


def test_no_production_gives_ratio_zero(spark, factors, pressures, pvt):
    rows = [production("2020-01-09", THEOR_OIL_VOL_STB=4.0), injection("2020-01-10", THEOR_WATER_INJ_VOL_STB=5.0)]
    found = view(spark, rows, factors, pressures, pvt)
    assert [r.VRR for r in found] == [0.0, 0.0]
    assert found[1].INJECTION_VOLUME_RES_BBL == 7.5


def test_days_before_production_and_unknown_properties_are_left_out(spark, factors, pressures, pvt):
    early = [injection("2020-01-09", THEOR_WATER_INJ_VOL_STB=5.0)]
    assert view(spark, early, factors, pressures, pvt) == []
    unknown = pvt.filter("ID_COMPLETION = 'C9'")
    assert view(spark, [production("2020-01-10", THEOR_OIL_VOL_STB=4.0)], factors, pressures, unknown) == []


def test_require_gas(spark, factors, pressures, pvt):
    rows = [production("2020-01-10", THEOR_OIL_VOL_STB=4.0), production("2020-01-11", THEOR_OIL_VOL_STB=4.0, THEOR_GAS_VOL_KSCF=0.0)]
    assert len(view(spark, rows, factors, pressures, pvt)) == 2
    (row,) = view(spark, rows, factors, pressures, pvt, require_gas=True)
    assert row.DATE.isoformat() == "2020-01-11"


def test_free_gas_rules(spark, factors, pressures, pvt):
    rows = [production("2020-01-10", THEOR_OIL_VOL_STB=8.0, THEOR_GAS_VOL_KSCF=0.032, FREE_GAS=5.0),
            injection("2020-01-10", THEOR_OIL_VOL_STB=8.0, THEOR_GAS_VOL_KSCF=0.032, FREE_GAS=5.0)]

    def gas(rule, **options):
        shares = splits(volume_table(spark, rows), factors, pressures, pvt, gas_rule=rule, **options)
        return sorted(r.FREE_GAS for r in shares.collect())

    assert gas("gor") == [0.0, pytest.approx(24.0)]
    assert gas("stored") == [0.0, 7.5]
    assert gas("untyped") == [pytest.approx(24.0)] * 2
    # Without a factor the stored gas stays whole.
    none = factors.filter("ID_COMPLETION = 'C9'")
    whole = splits(volume_table(spark, rows), none, pressures, pvt, "latest", "volume", "stored")
    assert sorted(r.FREE_GAS for r in whole.collect()) == [0.0, 5.0]


@pytest.mark.parametrize("bad", [{"pressure_key": "x"}, {"gas_rule": "x"}, {"factor": "x"}])
def test_unknown_options(spark, factors, pressures, pvt, bad):
    with pytest.raises((ValueError, KeyError)):
        splits(volume_table(spark, [production("2020-01-10")]), factors, pressures, pvt, **bad)


def test_own_pattern_pressure_keeps_rows_without_a_factor(spark, factors, pressures, pvt):
    rows = [production("2020-01-10", completion="C2", THEOR_OIL_VOL_STB=4.0)]
    assert view(spark, rows, factors, pressures, pvt, factor="latest", free_gas="stored") == []
    (row,) = view(spark, rows, factors, pressures, pvt, factor="latest", free_gas="stored", pressure_key="volume")
    assert (row.OIL_VOLUME_STB, row.OIL_VOLUME_RES_BBL) == (4.0, 8.0)


@pytest.mark.parametrize("policy", ["full", "low_only", "low_only_null", "nearest"])
def test_split_volumes_add_up_under_any_policy(spark, factors, pressures, pvt, policy):
    rows = [production("2020-02-10", THEOR_OIL_VOL_STB=8.0), production("2020-03-10", THEOR_OIL_VOL_STB=16.0)]
    shares = splits(volume_table(spark, rows), factors, pressures, pvt, policy=policy)
    assert shares.agg(F.sum("OIL_VOLUME")).first()[0] == 24.0


def test_report(spark, factors, pressures):
    stored = {"CUMULATIVE_INJECTION_VOLUME_RES_BBL": 3.0, "CUMULATIVE_PRODUCTION_VOLUME_RES_BBL": 6.0}
    rows = [
        production("2020-01-01", THEOR_OIL_VOL_STB=8.0, THEOR_GAS_VOL_KSCF=0.5, **stored),
        production("2020-01-01", THEOR_OIL_VOL_STB=8.0, THEOR_GAS_VOL_KSCF=0.5, **stored),
        production("2020-01-02", **stored),  # no factor of P1 is effective later
        production("2019-12-31", **stored),  # no factor in force
        production("2020-01-01", **{**stored, "CUMULATIVE_PRODUCTION_VOLUME_RES_BBL": 0.0}),
    ]
    (row,) = vrr_report(volume_table(spark, rows), factors, pressures).collect()
    assert row.ID_PATTERN == "P101-Jan-2020"
    assert row.VRR_INJECTION_VOLUME_PRODUCTION_VOLUME == 0.5
    assert (row.THEOR_OIL_VOL_STB, row.THEOR_WATER_VOL_STB, row.THEOR_GAS_VOL_KSCF) == (8.0, 0.0, 500.0)
    assert (row.PRESSURE, row.FACTORS) == (110.0, 0.75)


def test_report_splits_the_days_of_a_hot_pattern_only(spark):
    days = 20_000
    stored = {"CUMULATIVE_INJECTION_VOLUME_RES_BBL": 3.0, "CUMULATIVE_PRODUCTION_VOLUME_RES_BBL": 6.0}
    hot = [f"{1960 + d // 336}-{d // 28 % 12 + 1:02d}-{d % 28 + 1:02d}" for d in range(days)]
    rows = [production(d, **stored) for d in hot]
    for k in range(2, 12):
        rows += [production(d, completion=f"C{k}", pattern=f"P{k}", **stored) for d in hot[:20]]
    names = [(f"P{k}", f"C{k}") for k in range(1, 12)]
    factors = factor_table(spark, [(p, c, d, f) for p, c in names for d, f in (("1960-01-01", 0.5), ("2100-01-01", 0.25))])
    pressures = pressure_table(spark, [(p, "1960-01-01", 100.0) for p, _ in names])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        report = vrr_report(volume_table(spark, rows), factors, pressures)
        joins = [n for n in executed_nodes(report) if "Join" in n.getClass().getSimpleName()]
        last = [n for n in joins if "FACTORS" in n.output().mkString()]
        assert len(last) == 1 and last[0].isSkewJoin()
        found = report.groupBy("FACTORS").count().collect()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    assert {r["FACTORS"]: r["count"] for r in found} == {f: days + 10 * 20 for f in (0.5, 0.25)}


def test_row_order_does_not_matter(spark, factors, pressures, pvt):
    rows = [production(f"2020-01-{d:02d}", THEOR_OIL_VOL_STB=float(d)) for d in range(1, 29)]
    assert view(spark, rows, factors, pressures, pvt) == view(spark, rows[::-1], factors, pressures, pvt)


def test_relationship_counts(spark, factors, pressures, pvt):
    volumes = volume_table(spark, [production("2020-01-10"), production("2020-01-11"), injection("2020-01-11")])
    found = {r.RELATIONSHIP: tuple(r)[1:] for r in relationship_counts(volumes, factors, pressures, pvt).collect()}
    assert found["pattern to production day"] == (1, 2, 2, 2)
    assert found["pattern to completion"] == (2, 2, 1, 1)
    assert found["completion to pattern"] == (1, 2, 2, 2)
    assert found["pattern to pressure record"] == (2, 3, 1, 2)


@pytest.mark.parametrize("scope", ["active", "all_to_date"])
def test_factor_stored_twice_counts_twice(spark, factors, pressures, pvt, scope):
    rows = volume_table(spark, [production("2020-01-10", THEOR_OIL_VOL_STB=8.0)])
    twice = factors.union(factors)
    assert splits(rows, twice, pressures, pvt, scope=scope).count() == 2
    assert splits(rows, twice, pressures, pvt, scope=scope, policy="low_only").count() == 2


def test_without_pressures(spark, factors, pressures, pvt):
    rows = volume_table(spark, [production("2020-01-10", THEOR_OIL_VOL_STB=8.0)])
    assert vrr_view(rows, factors, pressures.filter("false"), pvt).count() == 0
    assert vrr_view(rows, factors.filter("false"), pressures, pvt, pressure_key="volume").count() == 1
