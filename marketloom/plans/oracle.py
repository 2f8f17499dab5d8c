"""SQL text for the panels of `marketloom.plans.panels`, used to check queries."""

from __future__ import annotations

from marketloom.schema import CALENDAR, PRICE, WEATHER

_TABLES = {
    "prices": """
        SELECT cast(l_shipdate AS date) AS obs_date, n_name AS region, s_nationkey AS region_id,
          p_type AS commodity,
          cast(floor(sum(cast(l_extendedprice AS decimal(14,2)))
            / sum(cast(l_quantity AS decimal(14,2)))) AS double) AS price,
          cast(floor(sum(cast(l_quantity AS decimal(14,2))) / count(*)) AS double) AS temp_avg_c,
          cast(floor(sum(cast(l_discount AS decimal(14,2))) * 100) AS double) AS rain_mm,
          cast(floor(sum(cast(l_tax AS decimal(14,2))) * 100) AS double) AS humidity_avg_pct
        FROM lineitem JOIN part ON l_partkey = p_partkey
          JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        GROUP BY 1, 2, 3, 4""",
    "event_prices": """
        SELECT cast(ts AS date) AS obs_date, event_type AS commodity,
          cast(user_id % 15 AS int) AS region_id,
          cast(floor(sum(cast(value AS decimal(14,2))) / count(*)) AS double) AS price
        FROM events GROUP BY 1, 2, 3""",
}


def _calendar(days: str) -> str:
    def feast(shift):
        year = f"(year(obs_date) + {shift})"
        return f"make_date({year}, cast({year} % 12 AS int) + 1, 15)"

    def christmas(shift):
        return f"make_date(year(obs_date) + {shift}, 12, 25)"

    def nearest(day):
        return "least(" + ", ".join(f"abs(obs_date - {day(s)})" for s in (-1, 0, 1)) + ")"

    return f"""
        SELECT obs_date, cast(isodow(obs_date) - 1 AS int) AS weekday_idx,
          cast(month(obs_date) AS int) AS month,
          cast(isodow(obs_date) >= 6 AS int) AS is_weekend,
          cast(obs_date = {feast(0)} OR obs_date = {christmas(0)}
            OR obs_date = make_date(year(obs_date), 1, 1) AS int) AS is_holiday,
          cast({nearest(feast)} AS int) AS days_to_eid,
          cast({nearest(christmas)} AS int) AS days_to_christmas
        FROM (SELECT DISTINCT obs_date FROM {days})"""


def _daily(panel: str) -> str:
    means = ", ".join(f"avg({c}) AS {c}" for c in (PRICE, *WEATHER))
    fixed = ", ".join(f"min({c}) AS {c}" for c in CALENDAR)
    return f"SELECT commodity, obs_date, {means}, {fixed} FROM {panel} GROUP BY 1, 2"


def _anomaly(panel: str) -> str:
    return f"""
        SELECT *,
          coalesce((price - province_mean) / nullif(province_mean, 0) * 100, 0) AS deviation_pct,
          coalesce((price - previous_price) / nullif(previous_price, 0) * 100, 0) AS delta_pct
        FROM (SELECT *, avg(price) OVER (PARTITION BY commodity, obs_date) AS province_mean,
            lag(price) OVER (PARTITION BY region, commodity ORDER BY obs_date) AS previous_price
          FROM {panel})"""


_TABLES |= {
    "calendar": _calendar("prices"),
    "event_calendar": _calendar("event_prices"),
    "panel": f"""
        SELECT obs_date, region, region_id, commodity, price, {", ".join(WEATHER)},
          {", ".join(CALENDAR)} FROM prices JOIN calendar USING (obs_date)""",
    "short": f"""
        SELECT obs_date, 'R' || region_id AS region, region_id, commodity, price,
          {", ".join(f"cast(NULL AS double) AS {c}" for c in WEATHER)}, {", ".join(CALENDAR)}
        FROM event_prices JOIN event_calendar USING (obs_date)""",
    "daily": _daily("panel"),
    "short_daily": _daily("short"),
    "anomaly": _anomaly("panel"),
    "short_anomaly": _anomaly("short"),
    # A score that SQL can compute too, in place of the forest's.
    "scored": """
        SELECT *, -abs(deviation_pct) - abs(delta_pct) AS score FROM anomaly""",
    "flagged": """
        SELECT *, cast(score < (SELECT quantile_cont(score, 0.03) FROM scored) AS int) AS is_anom
        FROM scored""",
    "backtest": """
        SELECT commodity, obs_date, price AS actual, previous AS prediction
        FROM (SELECT commodity, obs_date, price,
            lag(price) OVER (PARTITION BY commodity ORDER BY obs_date) AS previous,
            row_number() OVER (PARTITION BY commodity ORDER BY obs_date) AS n,
            row_number() OVER (PARTITION BY commodity ORDER BY obs_date DESC) AS back
          FROM short_daily)
        WHERE back <= 20 AND n > 1""",
    "errors": """
        SELECT commodity, count(*) AS n_samples,
          coalesce(round_even(avg(abs(a - p)), 0), 0) AS mae,
          coalesce(round_even(sqrt(avg((a - p) * (a - p))), 0), 0) AS rmse,
          coalesce(round_even(avg(abs((a - p) / a) * 100), 2), 0) AS mape
        FROM (SELECT commodity, CASE WHEN actual <> 0 THEN actual END AS a, prediction AS p
          FROM backtest) GROUP BY 1""",
    "baseline": """
        SELECT commodity, cast(step AS int) AS step,
          cast(last_date + cast(step AS int) AS date) AS target_date,
          price, mae, rmse, mape, n_days, n_samples,
          'moving average of the last days' AS model
        FROM (SELECT commodity, max(obs_date) AS last_date, count(*) AS n_days,
            cast(round_even(avg(price) FILTER (back <= 7), 0) AS bigint) AS price
          FROM (SELECT *, row_number() OVER (PARTITION BY commodity ORDER BY obs_date DESC) AS back
            FROM short_daily) GROUP BY 1)
        JOIN errors USING (commodity) CROSS JOIN range(1, 8) AS steps(step)""",
}

# Tables each of them reads.
_NEEDS = {
    "calendar": ["prices"],
    "event_calendar": ["event_prices"],
    "panel": ["prices", "calendar"],
    "short": ["event_prices", "event_calendar"],
    "daily": ["panel"],
    "short_daily": ["short"],
    "anomaly": ["panel"],
    "short_anomaly": ["short"],
    "scored": ["anomaly"],
    "flagged": ["scored"],
    "backtest": ["short_daily"],
    "errors": ["backtest"],
    "baseline": ["short_daily", "errors"],
}


def over(tables: str, query: str) -> str:
    """`query` with the named panel tables (and what they read) put before it."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in tables.split():
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({_TABLES[n]})" for n in order) + query
