"""DuckDB statements that recompute the registered queries independently.

They are written against the driver's raw tables through the adapter views
in :mod:`stratus.sources.adapters`.  Doubles are rounded through
DECIMAL(38,10) exactly as the Spark side does, so tie-breaking is identical.
"""

from __future__ import annotations

from ..sources.adapters import sql_half_even as E
from ..sources.adapters import sql_half_up as R
from ..sources.adapters import with_views

# Fixed values, stated here and not imported, so that the statements check the plans' own constants.
MONTH_ARRAY = "['Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec']"
LAGS = (1, 3, 6, 12, 24, 48)
ROLLING_WINDOWS = (3, 6, 12, 24)

# Column types of the adapter views (what the generated SQL must round).
HOURLY_TYPES = {"tempC": "double", "precipMM": "double", "humidity": "double", "pressure": "bigint",
                "windspeedKmph": "double", "cloudcover": "double", "FeelsLikeC": "double"}
ROWS_TYPES = {"tempC": "double", "precipMM": "double", "humidity": "double"}


def calendar_sql(ts: str = "date_time") -> list[str]:
    return [f"CAST(hour({ts}) AS INTEGER) AS hour", f"CAST(day({ts}) AS INTEGER) AS day",
            f"CAST(month({ts}) AS INTEGER) AS month", f"CAST(isodow({ts}) - 1 AS INTEGER) AS weekday",
            f"CAST(quarter({ts}) AS INTEGER) AS quarter", f"CAST(year({ts}) AS INTEGER) AS year"]


def cyclical_sql() -> list[str]:
    out = []
    for name, period in (("hour", 24), ("day", 31), ("month", 12)):
        angle = f"(2 * pi() * {name} / {float(period)})"
        out += [f"sin{angle} AS {name}_sin", f"cos{angle} AS {name}_cos"]
    return out


def feature_sql(view: str, types: dict, key: str | None = None, tiebreak=(), dropna: bool = True,
                round_digits: int = 6) -> tuple[str, list[str]]:
    """SQL computing the engineered table of ``view`` and its column list."""
    present = set(types)
    order = ", ".join(["date_time", *tiebreak])
    part = f"PARTITION BY {key} " if key else ""
    w = f"({part}ORDER BY {order}"
    lagged = [(p, c) for p, c in (("temp", "tempC"), ("humidity", "humidity"), ("precip", "precipMM"))
              if c in present]
    win_cols, out_types = [], {}
    for k in LAGS:
        for p, c in lagged:
            win_cols.append(f"CAST(lag({c}, {k}) OVER {w}) AS DOUBLE) AS {p}_lag_{k}")
            out_types[f"{p}_lag_{k}"] = "double"
    for n in ROLLING_WINDOWS:
        frame = f"{w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for name, fn, c in ((f"temp_roll_mean_{n}", "avg", "tempC"), (f"temp_roll_std_{n}", "stddev_samp", "tempC"),
                            (f"humidity_roll_mean_{n}", "avg", "humidity"),
                            (f"precip_roll_sum_{n}", "sum", "precipMM")):
            if c in present:
                win_cols.append(f"CASE WHEN count({c}) OVER {frame} = {n} THEN {fn}({c}) OVER {frame} END AS {name}")
                out_types[name] = "double"
    inter = []
    for name, a, b in (("temp_humidity", "tempC", "humidity"), ("temp_pressure", "tempC", "pressure"),
                       ("wind_temp", "windspeedKmph", "tempC"), ("humidity_pressure", "humidity", "pressure")):
        if a in present and b in present:
            inter.append(f"{a} * {b} AS {name}")
            out_types[name] = "bigint" if types[a] == types[b] == "bigint" else "double"
    key_part = f"PARTITION BY {key}, month" if key else "PARTITION BY month"
    anomalies = [f"tempC - avg(tempC) OVER ({key_part}) AS temp_anomaly",
                 f"precipMM - avg(precipMM) OVER ({key_part}) AS rain_anomaly"]
    seasons = ["CAST(month IN (3, 4, 5) AS INTEGER) AS is_summer", "CAST(month IN (6, 7, 8, 9) AS INTEGER) AS is_monsoon",
               "CAST(month IN (11, 12, 1, 2) AS INTEGER) AS is_winter"]
    glob = ", ".join(([key] if key else []) + ["date_time", *tiebreak])
    base_cols = list(types)
    sql = f"""
    base AS (SELECT *, {', '.join(calendar_sql())} FROM {view}),
    cyc AS (SELECT *, {', '.join(cyclical_sql())} FROM base),
    feat AS (
      SELECT *, {', '.join(win_cols)}, {', '.join(inter)}, {', '.join(seasons)}, {', '.join(anomalies)},
             CAST(coalesce(precipMM > 0.1, false) AS INTEGER) AS will_rain,
             row_number() OVER (ORDER BY {glob}) - 1 AS row_idx
      FROM cyc)"""
    cal = ["hour", "day", "month", "weekday", "quarter", "year",
           "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos"]
    derived = [c.split(" AS ")[-1] for c in win_cols] + [c.split(" AS ")[-1] for c in inter]
    derived += ["is_summer", "is_monsoon", "is_winter", "temp_anomaly", "rain_anomaly", "will_rain"]
    lead = ([key] if key else []) + ["date_time"] + list(tiebreak) + base_cols
    seen, columns = set(), []
    for c in lead + cal + derived + ["row_idx"]:
        if c not in seen:
            seen.add(c)
            columns.append(c)
    double_cols = {c for c, t in types.items() if t == "double"} | {c for c, t in out_types.items() if t == "double"}
    double_cols |= {"hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos",
                    "temp_anomaly", "rain_anomaly"}
    if round_digits is not None:
        sel = [R(c, round_digits) + f" AS {c}" if c in double_cols else c for c in columns]
    else:
        sel = columns
    where = f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in columns)}" if dropna else ""
    final = f"SELECT {', '.join(sel)} FROM feat {where}"
    return sql, final, columns


def features_query(view: str, types: dict, key=None, tiebreak=(), dropna=True, round_digits=6) -> str:
    ctes, final, _ = feature_sql(view, types, key, tiebreak, dropna, round_digits)
    return with_views(f", {ctes.strip()}\n{final}", view)
