from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from voidage.llm import near


def brute(rows, percent):
    """Pairs of different families and parts whose sets reach ``percent``."""
    found = set()
    for a, part_a, family_a, x in rows:
        for b, part_b, family_b, y in rows:
            common = len(set(x) & set(y))
            if a < b and part_a != part_b and family_a != family_b and 100 * common >= percent * (len(x) + len(y) - common):
                found.add((a, b))
    return found


def counted(all_):
    each = all_.select("family", F.explode("shingles").alias("shingle"))
    return each.groupBy("family", "shingle").agg(F.count(F.lit(1)).alias("f"))


@pytest.fixture
def joins(monkeypatch, spark):
    """The joined tables of a run."""
    made, kind = [], type(spark.range(1))
    join = kind.join

    def noted(self, other, *args, **kwargs):
        made.append(join(self, other, *args, **kwargs))
        return made[-1]

    monkeypatch.setattr(kind, "join", noted)
    return made


def test_what_a_family_shares_is_looked_up_once(spark, joins):
    """300 near copies share 40 of their 100 shingles with two other families."""
    base = list(range(100))
    rows = [(k, k % 7, 0, [*base[:k % 100], 1000 + k, *base[k % 100 + 1 :]]) for k in range(300)]
    rows += [(1000 + k, 10 + k, 10 + k, [*base[:40], *range(10_000 * (k + 1), 10_000 * (k + 1) + 60)]) for k in range(2)]
    all_ = spark.createDataFrame(rows, "node long, part long, family long, shingles array<long>")
    assert near._across(all_, counted(all_), 80).count() == 0
    by_shingle = [df.count() for df in joins if "shingle" in df.columns]
    assert by_shingle and max(by_shingle) < 1_000


@pytest.mark.parametrize("percent", [50, 80])
def test_no_pair_of_families_is_lost(spark, percent):
    rows = []
    for family in range(6):
        for k in range(1 + 4 * (family % 3)):
            shared = [s for s in range(40) if (s * (family + 3) + k) % 11 > family // 2]
            rows.append((len(rows), k % 3 + 10 * (family % 4), family, shared + [100 * family + 1000 + k % 2]))
    all_ = spark.createDataFrame(rows, "node long, part long, family long, shingles array<long>")
    pairs = {(min(r.x, r.y), max(r.x, r.y)) for r in near._across(all_, counted(all_), percent).collect()}
    expected = brute(rows, percent)
    assert expected and expected <= pairs
