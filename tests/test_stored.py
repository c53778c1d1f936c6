"""The stored rollup: what a refresh reads, and that it equals a full one."""

from __future__ import annotations

import datetime as dt
import random

from build import executed_nodes, factor_table, pressure_table, pvt_table, volume_table
from voidage.plans.stored import _by_month, _runs, refresh_rollup, store_rollup, stored_view
from voidage.plans.vrr import vrr_view
from voidage.sources.tables import read_path, write_daily_volumes


def tables(spark):
    factors = factor_table(spark, [("P1", "C1", "2020-01-01", 0.5), ("P1", "C1", "2020-03-15", 0.25), ("P2", "C2", "2020-01-01", 1.0)])
    pressures = pressure_table(spark, [("P1", "2020-01-01", 110.0), ("P1", "2020-02-10", 140.0), ("P2", "2019-01-01", 100.0)])
    pvt = pvt_table(spark, [("C1", "2019-01-01", 100.0, 2.0), ("C1", "2019-01-01", 150.0, 4.0), ("C2", "2019-01-01", 100.0, 1.0)])
    return factors, pressures, pvt


def days(start, count, seed):
    rng = random.Random(seed)
    for k in range(count):
        date = (dt.date.fromisoformat(start) + dt.timedelta(days=k)).isoformat()
        for pattern, completion in (("P1", "C1"), ("P2", "C2")):
            yield {"ID_PATTERN": pattern, "COMPLETION_ID": completion, "PROD_DATE": date, "AMOUNT_TYPE": "Production",
                   "THEOR_OIL_VOL_STB": float(rng.randrange(8)), "THEOR_WATER_VOL_STB": 1.0, "THEOR_GAS_VOL_KSCF": 2.0,
                   "THEOR_WATER_INJ_VOL_STB": 4.0, "THEOR_GAS_INJ_VOL_KSCF": 0.0}


def same(spark, path, volumes, rest):
    key = lambda df: sorted(str(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in df.collect())
    assert key(stored_view(spark, path)) == key(vrr_view(volumes, *rest))


def test_refresh_equals_a_full_rollup(spark, tmp_path):
    rest, path, stored = tables(spark), str(tmp_path / "rollup"), str(tmp_path / "volumes")
    first, more, late = (list(days(*d)) for d in (("2020-01-20", 30, 1), ("2020-02-19", 25, 2), ("2020-01-25", 1, 3)))
    write_daily_volumes(volume_table(spark, first), stored)
    volumes = lambda: read_path(spark, stored, "production_volumes_daily_oilfield")
    store_rollup(volumes(), *rest, path)
    same(spark, path, volumes(), rest)
    for part, months in ((more, [(2020, 2), (2020, 3)]), (late, [(2020, 1)])):
        added = volume_table(spark, part)
        write_daily_volumes(volumes().union(added), str(tmp_path / f"v{len(part)}"))
        stored = str(tmp_path / f"v{len(part)}")
        kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "rollup").glob("MONTH=*/*.parquet")}
        found = refresh_rollup(added, volumes(), *rest, path)
        assert [(m.year, m.month) for m in found] == months
        same(spark, path, volumes(), rest)
        touched = {f"MONTH={y}-{m:02}" for y, m in months}
        assert all(p.exists() != (p.parent.name in touched) for p in kept)
        refresh_rollup(added, volumes(), *rest, path)
        same(spark, path, volumes(), rest)
    assert refresh_rollup(volume_table(spark, []), volumes(), *rest, path) == []


def test_one_month_is_read(spark, tmp_path):
    """The range of the months reaches the scan of the volumes."""
    stored = str(tmp_path / "volumes")
    write_daily_volumes(volume_table(spark, [*days("2018-05-01", 5, 1), *days("2020-02-01", 40, 2)]), stored)
    volumes = read_path(spark, stored, "production_volumes_daily_oilfield")
    (start, end), = _runs([dt.date(2020, 2, 1)])
    nodes = executed_nodes(_by_month(volumes.filter(f"PROD_DATE >= '{start}' AND PROD_DATE < '{end}'"), *tables(spark)))
    (scan,) = [n.toString() for n in nodes if n.getClass().getSimpleName() == "FileSourceScanExec" and "THEOR_OIL" in n.toString()]
    assert "GreaterThanOrEqual(PROD_DATE,2020-02-01)" in scan and "LessThan(PROD_DATE,2020-03-01)" in scan


def test_runs_of_months():
    months = [dt.date(2019, 12, 1), dt.date(2020, 1, 1), dt.date(2020, 3, 1)]
    assert _runs(months) == [(dt.date(2019, 12, 1), dt.date(2020, 2, 1)), (dt.date(2020, 3, 1), dt.date(2020, 4, 1))]
