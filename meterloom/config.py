"""Column roles, chronological splits and the fixed values of the forecasting job."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: results only agree when these do -------------------------
HORIZON = 24
QUANTILES = (0.05, 0.95)
MAX_GAP = 30
CLIP_PERCENTILES = (0.01, 0.99)
TARGET_LAGS = (1, 2, 3, 24, 25, 48, 168, 169)
EXOG_LAGS = (1, 2, 24)
SHORT_WINDOW = 24
LONG_WINDOW = 168
EWMA_SPANS = (12, 24)
MIN_HISTORY = 168
DEEPEST_LAG = 169
ZERO_DENOMINATOR = 1e-5
HISTOGRAM_BINS = 60
TOP_FEATURES = 20
CV_FOLDS = 3
TUNING_HORIZON = 12
TUNING_TRIALS = 10
TUNING_TREES = 300
TUNING_PATIENCE = 30
SEARCH = {
    "learning_rate": (0.02, 0.1),
    "max_depth": (4, 8),
    "feature_fraction": (0.6, 0.9),
    "row_fraction": (0.6, 0.9),
}
DATE_TIME_PATTERN = "d/M/yyyy H:mm:ss"
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Roles:
    """Which measurement is forecast, which are inputs, and how each becomes hourly."""

    target: str
    exog: tuple[str, ...]
    sum_cols: tuple[str, ...]
    mean_cols: tuple[str, ...]

    @property
    def all_cols(self) -> tuple[str, ...]:
        return (self.target, *self.exog)

    def __post_init__(self) -> None:
        if set(self.sum_cols) | set(self.mean_cols) != set(self.all_cols):
            raise ValueError("every column needs exactly one of SUM or MEAN")
        if set(self.sum_cols) & set(self.mean_cols):
            raise ValueError("a column cannot be both SUM and MEAN")


@dataclass(frozen=True)
class Splits:
    """Rows before ``val_start`` train, rows from ``test_start`` on test."""

    val_start: str
    test_start: str


# The public household power-consumption layout.
HOUSEHOLD = Roles(
    target="Global_active_power",
    exog=(
        "Global_reactive_power",
        "Voltage",
        "Global_intensity",
        "Sub_metering_1",
        "Sub_metering_2",
        "Sub_metering_3",
    ),
    sum_cols=("Global_active_power", "Sub_metering_1", "Sub_metering_2", "Sub_metering_3"),
    mean_cols=("Global_reactive_power", "Voltage", "Global_intensity"),
)
HOUSEHOLD_SPLITS = Splits("2009-07-01 00:00:00", "2010-01-01 00:00:00")


def short_flag(col: str) -> str:
    return f"{col}_is_short_imputed"


def profile_flag(col: str) -> str:
    return f"{col}_is_profile_imputed"


def feature_columns(roles: Roles) -> list[str]:
    """The feature matrix's column order (61 names for a 7-column meter)."""
    exog = roles.exog
    return (
        ["load_cleaned"]
        + [f"{c}_cleaned" for c in exog]
        + [f"load_lag_{k}" for k in TARGET_LAGS]
        + [f"{c}_lag_{k}" for c in exog for k in EXOG_LAGS]
        + [f"rolling_{s}_{SHORT_WINDOW}" for s in ("mean", "std", "min", "max")]
        + [f"rolling_{s}_{LONG_WINDOW}" for s in ("mean", "std")]
        + [f"ewm_mean_{s}" for s in EWMA_SPANS]
        + [f"{c}_rolling_mean_{SHORT_WINDOW}" for c in exog]
        + [f(c) for c in roles.all_cols for f in (short_flag, profile_flag)]
    )


def target_columns(horizon: int = HORIZON) -> list[str]:
    return [f"target_h{h}" for h in range(1, horizon + 1)]
