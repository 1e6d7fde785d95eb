"""Column contract of a readings table and the physical layout parameters."""

from __future__ import annotations

from dataclasses import dataclass

# Column names, label texts and formats of the readings contract.
TIMESTAMP = "Timestamp"
TARGET = "Electricity_Consumed"
TEMPERATURE = "Temperature"
HUMIDITY = "Humidity"
WIND = "Wind_Speed"
PAST = "Avg_Past_Consumption"
LABEL = "Anomaly_Label"
NUMERIC_COLUMNS = (TARGET, TEMPERATURE, HUMIDITY, WIND, PAST)
WEATHER_COLUMNS = (TEMPERATURE, HUMIDITY, WIND)
READING_COLUMNS = (TIMESTAMP, *NUMERIC_COLUMNS, LABEL)
LABEL_CODES = {"Normal": 0, "Abnormal": 1}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Derived columns.
CALENDAR_COLUMNS = ("hour", "day_of_week", "month", "is_weekend")
ROLLING_WINDOWS = {"3h": 6, "24h": 48}
CYCLICAL_COLUMNS = ("hour_sin", "hour_cos", "dow_sin", "dow_cos")
DERIVATIVE_COLUMNS = ("consumption_diff", "consumption_residual_24h")
LAGS = (1, 2, 48)
SEASON = 48
SEQUENCE_LENGTH = 24
SEQUENCE_FEATURES = (TARGET, TEMPERATURE, HUMIDITY, *CALENDAR_COLUMNS)
FORECAST_SPLIT = (0.7, 0.15)
TUNING_SPLIT = (0.6, 0.2)

ROW = "row_idx"
ROWS = "series_rows"

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def step_seconds(step: str) -> int:
    """Seconds in a cadence text such as ``30 minutes``."""
    count, unit = step.split()
    return int(count) * _UNIT_SECONDS[unit.rstrip("s")]


@dataclass(frozen=True)
class SeriesSpec:
    """How rows of a table form time series.

    ``series`` names the key columns of a series; the empty tuple means the whole
    table is one series. ``one_per_slot`` states that a series holds at most one row
    per ``step`` (true for the output of ``to_interval_grid``), which bounds the rows
    of a time bucket without looking at the data.
    """

    ts: str = TIMESTAMP
    target: str = TARGET
    series: tuple[str, ...] = ()
    tiebreak: tuple[str, ...] = ()
    step: str = "30 minutes"
    one_per_slot: bool = False

    @property
    def seconds(self) -> int:
        return step_seconds(self.step)


@dataclass(frozen=True)
class Layout:
    """Sizes that bound the rows a single task or group may hold.

    ``bucket_slots``  grid slots of one time bucket while rows are being numbered.
    ``bucket_limit``  most rows a bucket may hold before numbering switches to a range
                      partitioned sort.
    ``chunk_rows``    least rows of a chunk; long series use ``sqrt(rows)`` instead so that
                      neither a chunk nor the list of chunks of a series gets large.
    ``exact_limit``   most values of a group for which the built-in exact percentile is used.
    ``block_rows``    rows per side of a distance block.
    """

    bucket_slots: int = 4096
    bucket_limit: int = 1_000_000
    chunk_rows: int = 4096
    exact_limit: int = 1_000_000
    block_rows: int = 1024


DEFAULT_LAYOUT = Layout()
