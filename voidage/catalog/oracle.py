"""SQL building blocks of the oracles: plain correlated and ranked SQL.

The oracles restate each query without the operators it is built from, so the
two sides share nothing but the input files.
"""

from __future__ import annotations

from voidage.sources.schemas import PROPERTIES

_TABLES = {
    "ns": "SELECT count(*) AS n FROM supplier",
    "pvt": """
        SELECT CASE WHEN s % 10 = 9 OR (s % 10 = 8 AND k <> 0) THEN 'T' ELSE 'C' END || s AS ID_COMPLETION,
               DATE '1995-01-15' + CAST(500 * (k % 4) AS INTEGER) AS TEST_DATE,
               CAST(1000 + 500 * (k // 4) + 50 * (z % 10) AS DOUBLE) AS PRESSURE,
               1 + z / 64 AS OIL_FORMATION_VOLUME_FACTOR,
               z / 1024 AS GAS_FORMATION_VOLUME_FACTOR,
               1 + z / 512 AS WATER_FORMATION_VOLUME_FACTOR,
               100 + 10 * z AS SOLUTION_GAS_OIL_RATIO,
               z / 4096 AS VOLATIZED_OIL_GAS_RATIO,
               1 + z / 16 AS VISCOSITY_OIL,
               CAST(0.5 AS DOUBLE) + z / 128 AS VISCOSITY_WATER,
               CASE WHEN z <> 13 THEN z / 2048 END AS VISCOSITY_GAS,
               z / 2048 AS INJECTED_GAS_FORMATION_VOLUME_FACTOR,
               1 + z / 256 AS INJECTED_WATER_FORMATION_VOLUME_FACTOR
        FROM (SELECT p_partkey % n AS s, p_partkey // n AS k, CAST(p_size AS DOUBLE) AS z FROM part, ns)""",
    "pattern_pressure": """
        SELECT 'P' || c_nationkey AS ID_PATTERN,
               CAST(date_trunc('quarter', o_orderdate) AS DATE) AS DATE,
               CAST(800 + 50 * (CAST(sum(o_orderkey) AS BIGINT) % 60) AS DOUBLE) AS PRESSURE
        FROM orders JOIN customer ON o_custkey = c_custkey
        GROUP BY ALL""",
    "contribution_factor": """
        SELECT 'P' || (s_nationkey + x) % 25 AS ID_PATTERN,
               CASE WHEN s_suppkey % 7 = 0 OR (v = 1 AND s_suppkey % 5 = 0) THEN 'N' ELSE 'C' END
                   || s_suppkey AS ID_COMPLETION,
               CASE WHEN v = 0 THEN DATE '1996-01-01' WHEN x = 0 THEN DATE '1999-01-01'
                    ELSE DATE '1999-07-01' END AS EFFECT_DATE,
               CAST(CASE WHEN x = 0 THEN 0.625 + 0.125 * v ELSE 0.375 - 0.125 * v END AS DOUBLE) AS FACTOR
        FROM supplier, (VALUES (0), (1)) AS a(x), (VALUES (0), (1)) AS b(v)""",
    "daily": """
        SELECT 'P' || s_nationkey AS ID_PATTERN, 'C' || l_suppkey AS COMPLETION_ID,
               CAST(l_shipdate AS DATE) AS PROD_DATE, l_linestatus = 'F' AS prod,
               CAST(sum(l_quantity) AS BIGINT) AS q, CAST(sum(l_linenumber) AS BIGINT) AS n
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        GROUP BY ALL""",
    "daily_volume": """
        SELECT ID_PATTERN, COMPLETION_ID, PROD_DATE,
               CASE WHEN prod THEN 'Production' ELSE 'Injection' END AS AMOUNT_TYPE,
               CAST(CASE WHEN prod AND q % 13 <> 0 THEN q ELSE 0 END AS DOUBLE) AS THEOR_OIL_VOL_STB,
               CAST(CASE WHEN prod THEN 0.5 * q END AS DOUBLE) AS THEOR_WATER_VOL_STB,
               CAST(CASE WHEN q % 11 = 0 THEN NULL WHEN prod THEN 0.25 * q + n ELSE 0 END AS DOUBLE) AS THEOR_GAS_VOL_KSCF,
               CAST(CASE WHEN NOT prod THEN 2 * q END AS DOUBLE) AS THEOR_WATER_INJ_VOL_STB,
               CAST(CASE WHEN prod THEN 0.125 * q END AS DOUBLE) AS ALLOC_GAS_VOL_KSCF,
               CAST(CASE WHEN NOT prod THEN 0.5 * n END AS DOUBLE) AS THEOR_GAS_INJ_VOL_KSCF,
               CAST(CASE WHEN q % 17 <> 0 THEN 8 * n END AS DOUBLE) AS FREE_GAS,
               CAST(sum(CASE WHEN NOT prod THEN q END)
                    OVER (PARTITION BY COMPLETION_ID ORDER BY PROD_DATE) AS DOUBLE) AS CUMULATIVE_INJECTION_VOLUME_RES_BBL,
               CAST(sum(CASE WHEN prod THEN q END)
                    OVER (PARTITION BY COMPLETION_ID ORDER BY PROD_DATE) AS DOUBLE) AS CUMULATIVE_PRODUCTION_VOLUME_RES_BBL
        FROM daily""",
    "requests": """
        SELECT DISTINCT ID_COMPLETION, p.DATE AS VRR_DATE, PRESSURE
        FROM contribution_factor JOIN pattern_pressure p USING (ID_PATTERN)""",
    "pvt_ended": """
        SELECT *, coalesce((SELECT min(later.TEST_DATE) FROM pvt later
                            WHERE later.ID_COMPLETION = pvt.ID_COMPLETION
                              AND later.TEST_DATE > pvt.TEST_DATE), DATE '9999-12-31') AS END_DATE
        FROM pvt""",
    "pressure_ended": """
        SELECT *, coalesce((SELECT min(later.DATE) FROM pattern_pressure later
                            WHERE later.ID_PATTERN = pattern_pressure.ID_PATTERN
                              AND later.DATE > pattern_pressure.DATE), DATE '9999-12-31') AS END_DATE
        FROM pattern_pressure""",
}

_NEEDS = {
    "pvt": ("ns",),
    "daily_volume": ("daily",),
    "requests": ("contribution_factor", "pattern_pressure"),
    "pvt_ended": ("pvt",),
    "pressure_ended": ("pattern_pressure",),
}


def with_tables(body: str, *tables: str, ctes: dict[str, str] | None = None) -> str:
    """``body`` under the WITH clause of the tables (and their needs) and extra CTEs."""
    order: list[str] = []

    def need(table: str) -> None:
        for other in _NEEDS.get(table, ()):
            need(other)
        if table not in order:
            order.append(table)

    for table in tables:
        need(table)
    clauses = [f"{name} AS ({_TABLES[name]})" for name in order]
    clauses += [f"{name} AS ({sql})" for name, sql in (ctes or {}).items()]
    return "WITH " + ",\n".join(clauses) + "\n" + body


def settled(x: str, places: int) -> str:
    scale = 10**places
    return f"floor(({x}) * {scale} + 0.5001) / {scale}"


def known(scope: str) -> str:
    """Every request with every point it may use; X is the request's pressure."""
    active = "AND v.END_DATE > last_day(r.VRR_DATE)" if scope == "active" else ""
    return f"""
        SELECT r.VRR_DATE, r.PRESSURE AS X, v.* FROM requests r JOIN pvt_ended v
          ON v.ID_COMPLETION = r.ID_COMPLETION AND v.TEST_DATE <= last_day(r.VRR_DATE) {active}"""


_FIRST = "QUALIFY row_number() OVER (PARTITION BY k.ID_COMPLETION, k.VRR_DATE, k.X ORDER BY {order}) = 1"


def _beyond(side: str, sign: str, order: str) -> str:
    return (
        f"SELECT k.* FROM known k JOIN {side} s ON s.ID_COMPLETION = k.ID_COMPLETION"
        f" AND s.VRR_DATE = k.VRR_DATE AND s.X = k.X AND k.PRESSURE {sign} s.PRESSURE "
        + _FIRST.format(order=order)
    )


def neighbours(scope: str, tolerance: str | None = None) -> dict[str, str]:
    """CTEs for the points at, below and above each request."""
    down, rise = "k.PRESSURE DESC, k.TEST_DATE DESC", "k.PRESSURE, k.TEST_DATE DESC"
    at = f"abs(k.PRESSURE - k.X) < {tolerance}" if tolerance else "k.PRESSURE = k.X"
    nearest = "k.TEST_DATE DESC, abs(k.PRESSURE - k.X)" if tolerance else "k.TEST_DATE DESC"
    return {
        "known": known(scope),
        "hit": f"SELECT * FROM known k WHERE {at} " + _FIRST.format(order=nearest),
        "low": "SELECT * FROM known k WHERE k.PRESSURE < k.X " + _FIRST.format(order=down),
        "up": "SELECT * FROM known k WHERE k.PRESSURE > k.X " + _FIRST.format(order=rise),
        "low2": _beyond("low", "<", down),
        "up2": _beyond("up", ">", rise),
    }


def same_request(alias: str) -> str:
    return f"{alias}.ID_COMPLETION = r.ID_COMPLETION AND {alias}.VRR_DATE = r.VRR_DATE AND {alias}.X = r.PRESSURE"


def has(alias: str) -> str:
    return f"EXISTS (SELECT 1 FROM {alias} WHERE {same_request(alias)})"


def lacks(alias: str) -> str:
    return "NOT " + has(alias)


def line(a: str, b: str, name: str) -> str:
    return (
        f"{a}.{name} + (r.PRESSURE - {a}.PRESSURE) * ({b}.{name} - {a}.{name})"
        f" / ({b}.PRESSURE - {a}.PRESSURE)"
    )


def _branch(name: str, conditions: list[str], a: str | None, b: str | None = None, rounding: str = "sql") -> str:
    if a is None:
        values = ["CAST(NULL AS DOUBLE)"] * len(PROPERTIES)
        point = "CAST(NULL AS DOUBLE)"
    else:
        values = [line(a, b, p) if b else f"{a}.{p}" for p in PROPERTIES]
        point = f"{a}.PRESSURE"
    rounded = ", ".join(f"{ROUNDED[rounding](v)} AS {p}" for v, p in zip(values, PROPERTIES))
    joins = " ".join(f"JOIN {t} ON {same_request(t)}" for t in (a, b) if t)
    where = f"WHERE {' AND '.join(conditions)}" if conditions else ""
    return (
        f"SELECT r.ID_COMPLETION, r.VRR_DATE, r.PRESSURE, '{name}' AS BRANCH, {point} AS POINT_PRESSURE, {rounded}"
        f" FROM requests r {joins} {where}"
    )


# round() of a double goes by its binary value here, which puts 1.103125 below
# its half; as a decimal a half is a half.
ROUNDED = {
    "sql": lambda x: f"CAST(round(CAST({x} AS DECIMAL(38, 12)), 5) AS DOUBLE)",
    "half_up": lambda x: f"floor(({x}) * 100000 + 0.5) / 100000",
    # Printing rounds the exact binary value, halves to even.
    "half_even": lambda x: f"CAST(printf('%.5f', {x}) AS DOUBLE)",
}


def branches(policy: str, rounding: str = "sql") -> dict[str, str]:
    """One SELECT per branch of a policy, each with its own conditions."""
    no_hit, no_low, no_up = lacks("hit"), lacks("low"), lacks("up")

    def b(name, conditions, a, second=None):
        return _branch(name, conditions, a, second, rounding)

    exact = {"exact": b("exact", [], "hit")}
    interp = {"interp": b("interp", [no_hit], "low", "up")}
    below = {"extrap_low": b("extrap_low", [no_hit, no_low], "up", "up2")}
    nothing = {"none": b("none", [no_hit, no_low, no_up], None)}
    if policy == "full":
        return {
            **exact,
            **interp,
            **below,
            "extrap_high": b("extrap_high", [no_hit, no_up], "low", "low2"),
            "single_low": b("single", [no_hit, no_up, lacks("low2")], "low"),
            "single_up": b("single", [no_hit, no_low, lacks("up2")], "up"),
            **nothing,
        }
    if policy == "low_only":
        return {**exact, **interp, **below, **nothing}
    if policy == "low_only_null":
        bracketed = f"({has('low')} AND {has('up')})"
        extended = f"({no_hit} AND {no_low} AND {has('up2')})"
        return {
            "interp": b("interp", [], "low", "up"),
            **below,
            "none": b("none", [f"NOT {bracketed}", f"NOT {extended}"], None),
        }
    if policy == "nearest":
        return {
            **exact,
            **interp,
            "nearest_low": b("nearest_low", [no_hit, no_up], "low"),
            "nearest_high": b("nearest_high", [no_hit, no_low], "up"),
            **nothing,
        }
    raise ValueError(policy)


def lookup(
    scope: str = "all_to_date",
    policy: str = "full",
    only: tuple[str, ...] = (),
    tolerance: str | None = None,
    rounding: str = "sql",
    requests: str | None = None,
) -> str:
    """A whole lookup, or ``only`` some of its branches; ``requests`` replaces the usual ones."""
    chosen = {n: q for n, q in branches(policy, rounding).items() if not only or n in only}
    tables = ("contribution_factor", "pattern_pressure") if requests else ("requests",)
    asked = {"requests": requests} if requests else {}
    return with_tables(
        "\nUNION ALL ".join(chosen.values()), *tables, "pvt_ended", ctes={**asked, **neighbours(scope, tolerance)}
    )
