"""Parameters and fixed values.

Every operator takes its parameters from a ``FleetSpec``; nothing reads a
global. The block marked FIXED VALUES holds the numbers and texts that must
equal the original application's for the same results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original application; stated as plain text)
# ---------------------------------------------------------------------------

# Raw turbofan telemetry: 26 whitespace-separated columns in this order.
RAW_COLUMNS = [
    "engine_id", "cycle", "setting_1", "setting_2", "setting_3",
    "sensor_1", "sensor_2", "sensor_3", "sensor_4", "sensor_5", "sensor_6",
    "sensor_7", "sensor_8", "sensor_9", "sensor_10", "sensor_11", "sensor_12",
    "sensor_13", "sensor_14", "sensor_15", "sensor_16", "sensor_17",
    "sensor_18", "sensor_19", "sensor_20", "sensor_21",
]

# Seven uninformative columns dropped before modelling.
DROP_COLUMNS = [
    "sensor_1", "sensor_5", "sensor_6", "sensor_10", "sensor_16",
    "sensor_18", "sensor_19",
]

# The 17 model features, in model order (order is semantic: ties break by it).
TELEMETRY_FEATURES = [
    "setting_1", "setting_2", "setting_3",
    "sensor_2", "sensor_3", "sensor_4", "sensor_7", "sensor_8", "sensor_9",
    "sensor_11", "sensor_12", "sensor_13", "sensor_14", "sensor_15",
    "sensor_17", "sensor_20", "sensor_21",
]

# Plain-English display names of the 17 features.
TELEMETRY_DISPLAY_NAMES = {
    "setting_1": "Altitude Setting",
    "setting_2": "Mach Setting",
    "setting_3": "Throttle Setting",
    "sensor_2": "LPC Outlet Temp",
    "sensor_3": "HPC Outlet Temp",
    "sensor_4": "LPT Outlet Temp",
    "sensor_7": "HPC Outlet Pressure",
    "sensor_8": "Fan Speed",
    "sensor_9": "Core Speed",
    "sensor_11": "HPC Static Pressure",
    "sensor_12": "Fuel-to-Pressure Ratio",
    "sensor_13": "Corrected Fan Speed",
    "sensor_14": "Corrected Core Speed",
    "sensor_15": "Bypass Ratio",
    "sensor_17": "Bleed Enthalpy",
    "sensor_20": "HPT Coolant Bleed",
    "sensor_21": "LPT Coolant Bleed",
}

# Health bands (cycles): >= 80 healthy, >= 40 warning, else critical.
HEALTHY_MIN = 80.0
WARNING_MIN = 40.0

# Action wording of the scoring service, keyed by status.
SERVICE_ACTIONS = {
    "Healthy": "No action needed — continue normal operation.",
    "Warning": "Monitor closely — plan maintenance within the next window.",
    "Critical": "Schedule maintenance immediately — failure is imminent.",
}

# Action wording of the dashboards, keyed by upper-case status.
DASHBOARD_ACTIONS = {
    "HEALTHY": "Status is nominal — continue normal operation.",
    "WARNING": "Plan maintenance within the next service window.",
    "CRITICAL": "Schedule maintenance immediately — failure is imminent.",
}

# Maintenance sentence pieces.
SUMMARY_PREFIX = "Engine "
SUMMARY_MIDDLE = " is predicted to fail in approximately "
SUMMARY_STATUS = " cycles. Status: "
SUMMARY_SIGNAL = " Top warning signal: "

RUL_CAP = 125.0            # piecewise-linear remaining-life cap
WINDOW = 30                # sliding-window length (cycles)
LATE_DIVISOR = 10.0        # asymmetric score: exp(e/10) - 1 when late (e > 0)
EARLY_DIVISOR = 13.0       # asymmetric score: exp(-e/13) - 1 when early
RMSE_GATE = 30.0           # quality gate: rmse <= 30
MIN_SCORED_ENGINES = 95    # quality gate: at least 95 engines scored
PSI_BINS = 10              # decile bins
PSI_EPS = 1e-6             # proportion floor and edge widening
PSI_ALARM = 0.2            # alarm strictly above 0.2
PSI_MODERATE = 0.1         # severity: < 0.1 stable, 0.1..0.2 moderate
SCALE_STD_FLOOR = 1e-6     # std at or below this counts as 1 in warning scores
NEAR_CONSTANT_STD = 1e-6   # uninformative: sample std below this ...
NEAR_CONSTANT_DISTINCT = 2  # ... or at most 2 distinct values
ATTRIBUTION_FLOOR = 1e-9   # normalisation denominator floor
BACKGROUND_SAMPLES = 100   # attribution background windows
DRIFT_RECENT = 500         # rolling drift window (readings)
SEED = 42

# ---------------------------------------------------------------------------
# Run parameters
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FleetSpec:
    """Everything an operator needs to know about one fleet."""

    name: str
    features: tuple[str, ...]
    window: int = WINDOW
    cap: float = RUL_CAP
    display: dict = field(default_factory=dict)
    # Given linear forecaster: rul = bias + sum_f weight_f * mean over the window of z_f
    bias: float = 60.0
    weights: dict = field(default_factory=dict)
    train_fraction: float = 0.8
    seed: int = SEED
    # cycle block used to split one engine's ordered history over many tasks
    block: int = 4096

    def weight(self, f: str) -> float:
        return float(self.weights.get(f, 0.0))

    def position(self, f: str) -> int:
        return self.features.index(f) + 1


# Fleet over lineitem: one engine per supplier, one cycle per shipped line.
LINEITEM_FLEET = FleetSpec(
    name="lineitem",
    features=("quantity", "extendedprice", "discount", "tax", "linestatus", "setting"),
    display={
        "quantity": "Quantity",
        "extendedprice": "Extended Price",
        "discount": "Discount",
        "tax": "Tax",
    },
    bias=60.0,
    weights={
        "quantity": -6.0,
        "extendedprice": -4.0,
        "discount": 3.0,
        "tax": 2.0,
        "linestatus": -10.0,
        "setting": 0.0,
    },
)

# Fleet over events: one engine per user, one cycle per event; short lives.
EVENTS_FLEET = FleetSpec(
    name="events",
    features=("value", "k", "hour", "is_error"),
    cap=30.0,
    display={"value": "Reading", "k": "Key", "hour": "Hour of Day"},
    bias=15.0,
    weights={"value": -2.0, "k": 1.5, "hour": 0.5, "is_error": -3.0},
)

# Fleet over orders: one engine per customer; very short histories.
ORDERS_FLEET = FleetSpec(
    name="orders",
    features=("totalprice",),
    window=10,
    cap=20.0,
    display={"totalprice": "Order Total"},
    bias=10.0,
    weights={"totalprice": -1.0},
)

# Fleet over raw turbofan telemetry files (reference layout).
TELEMETRY_FLEET = FleetSpec(
    name="telemetry",
    features=tuple(TELEMETRY_FEATURES),
    display=dict(TELEMETRY_DISPLAY_NAMES),
)

# Synthetic test truth over a fleet: engine e loses its last c(e) cycles,
# c(e) = (TRUTH_MULT * e) mod TRUTH_MOD; engines with e mod TRUTH_SKIP = 0
# have no truth row (exercises the missing-label path).
TRUTH_MULT = 7
TRUTH_MOD = 120
TRUTH_SKIP = 10

# Arithmetic sampling hash shared by Spark and SQL: (id*H1 + cycle*H2 + seed) % HM
HASH_ID = 7919
HASH_CYCLE = 104729
HASH_MOD = 1000003

# Why a window gets no forecast.
BAD_READING = "reading missing or not finite"
