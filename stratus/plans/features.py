"""Feature-table plan (P1): raw observations -> engineered table.

Physical shape of the plan (see ``explain``):

* one range exchange assigns the global row index (``with_row_index``) and
  the sorted rows are written once to the checkpoint folder;
* the calendar-month means for the anomalies are a partial aggregate over
  that table, broadcast back (bounded by the number of months, or joined
  under AQE when a station key is present);
* one hash exchange on (key, chunk) feeds every lag and rolling column, which
  are computed over Arrow batches of the sorted rows;
* projections (calendar, cyclical, interactions, seasons, target) fuse into
  the surrounding whole-stage-codegen stages.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import cyclical, season_flags, time_parts
from ..functions.rules import EXCLUDED_FROM_FEATURES, interactions, rain_label
from ..operators.index import _as_list, with_row_index
from ..operators.windows import DEFAULT_CHUNK_ROWS, WindowSpec, add_series_windows, anomaly
from ..session import compile_wide

# Fixed values that must equal the reference's results.
LAGS = (1, 3, 6, 12, 24, 48)
ROLLING_WINDOWS = (3, 6, 12, 24)
# Model feature order: 16 raw pass-through columns, then the derived ones.
REFERENCE_RAW_FEATURES = (
    "maxtempC", "mintempC", "totalSnow_cm", "sunHour", "uvIndex", "moon_illumination",
    "DewPointC", "HeatIndexC", "WindChillC", "WindGustKmph", "cloudcover", "humidity",
    "pressure", "visibility", "winddirDegree", "windspeedKmph",
)
INDEX_COLUMNS = ("row_idx", "series_idx")


@dataclass(frozen=True)
class SeriesColumns:
    """Names of the measured columns the features are built from."""
    ts: str = "date_time"
    temp: str = "tempC"
    humidity: str = "humidity"
    precip: str = "precipMM"
    pressure: str = "pressure"
    wind: str = "windspeedKmph"
    key: tuple = ()
    tiebreak: tuple = ()
    extra_excluded: tuple = field(default_factory=tuple)


def window_specs(cols: SeriesColumns, present: set) -> list[WindowSpec]:
    """The 34 reference window columns, in the reference's column order."""
    lagged = {p: c for p, c in (("temp", cols.temp), ("humidity", cols.humidity), ("precip", cols.precip))
              if c in present}
    specs = [WindowSpec(f"{p}_lag_{k}", "lag", c, k) for k in LAGS for p, c in lagged.items()]
    for w in ROLLING_WINDOWS:
        for name, kind, c in ((f"temp_roll_mean_{w}", "mean", cols.temp),
                              (f"temp_roll_std_{w}", "std", cols.temp),
                              (f"humidity_roll_mean_{w}", "mean", cols.humidity),
                              (f"precip_roll_sum_{w}", "sum", cols.precip)):
            if c in present:
                specs.append(WindowSpec(name, kind, c, w))
    return specs


def engineer(raw: DataFrame, cols: SeriesColumns = SeriesColumns(), drop_incomplete: bool = True,
             chunk_rows: int = DEFAULT_CHUNK_ROWS, num_partitions: int | None = None) -> DataFrame:
    """Engineered table: raw columns + 56 derived columns (+ ``row_idx``).

    ``row_idx`` is the row's position in the full, sorted input (before the
    complete-case filter), so windows and splits stay reproducible.
    NaN inputs are treated as missing, like pandas.
    """
    keys = _as_list(cols.key)
    present = set(raw.columns)
    # pandas treats NaN as missing: normalise doubles so avg/count skip them.
    nan_safe = {f.name: F.nanvl(F.col(f.name), F.lit(None).cast("double"))
                for f in raw.schema.fields if f.dataType.typeName() in ("double", "float")}
    base = raw.withColumns(nan_safe) if nan_safe else raw
    indexed = with_row_index(base, cols.ts, keys or None, list(cols.tiebreak) or None,
                             num_partitions=num_partitions)
    # Monthly means over *all* rows (before the complete-case filter), taken
    # from the materialised index table so the range sampling and the write
    # above scan only the raw columns.
    anomalies = {n: c for n, c in (("temp_anomaly", cols.temp), ("rain_anomaly", cols.precip)) if c in present}
    indexed = anomaly(indexed.withColumn("_month", F.month(cols.ts)), anomalies, "_month", keys or None).drop("_month")
    windowed = add_series_windows(indexed, window_specs(cols, present), keys or None, "row_idx", chunk_rows)
    # Calendar parts are cheap projections: computed after the materialised
    # index so they are never written to storage.
    windowed = cyclical(time_parts(windowed, cols.ts))
    pairs = (("temp_humidity", cols.temp, cols.humidity), ("temp_pressure", cols.temp, cols.pressure),
             ("wind_temp", cols.wind, cols.temp), ("humidity_pressure", cols.humidity, cols.pressure))
    out = season_flags(interactions(windowed, pairs))
    out = out.withColumn("will_rain", rain_label(cols.precip)) if cols.precip in present else out
    derived = ["hour", "day", "month", "weekday", "quarter", "year",
               "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos"]
    derived += [s.name for s in window_specs(cols, present)]
    derived += [p[0] for p in pairs if p[0] in out.columns]
    derived += ["is_summer", "is_monsoon", "is_winter", *anomalies, *(["will_rain"] if "will_rain" in out.columns else [])]
    out = out.select(*raw.columns, *derived, "row_idx")
    if drop_incomplete:
        # pandas dropna(): any NULL/NaN in any column removes the row.  Calendar columns are NULL only where the time
        # is, flags and the index never: testing the others alone keeps sines and cosines out of the filter.
        calendar = {*derived[:12], "is_summer", "is_monsoon", "is_winter", "will_rain", "row_idx"} - set(raw.columns)
        out = out.na.drop("any", subset=[c for c in out.columns if c not in calendar])
    return compile_wide(out)


def model_features(engineered: DataFrame, cols: SeriesColumns = SeriesColumns()) -> list[str]:
    """Model inputs: every column except the exclusion list, keys and indices."""
    drop = set(EXCLUDED_FROM_FEATURES) | set(INDEX_COLUMNS) | {cols.ts, cols.temp, cols.precip}
    drop |= set(_as_list(cols.key)) | set(cols.tiebreak) | set(cols.extra_excluded)
    return [c for c in engineered.columns if c not in drop]
