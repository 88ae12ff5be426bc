"""Reference configuration: warehouses, carriers, SLA tiers, known anomaly windows, rule constants.

Config is a handful of rows, so it lives in plain records. The rules that walk it (weights, windows,
keywords) become column expressions; what is joined (routing, dimensions) becomes a DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from parcelflow.sources import schemas


@dataclass(frozen=True)
class Warehouse:
    warehouse_id: str
    warehouse_name: str
    assigned_states: str  # ';'-separated
    region_rule_notes: str | None = None


@dataclass(frozen=True)
class Carrier:
    carrier_id: str
    carrier_name: str
    reliability_tier: str
    performance_notes: str | None = None
    warehouse_exception: str | None = None
    weight: float = 0.12


@dataclass(frozen=True)
class SlaTarget:
    sla_tier: str
    target_days: int
    description: str | None = None


@dataclass(frozen=True)
class AnomalyWindow:
    anomaly_id: str
    anomaly_type: str
    affected_carrier_id: str | None  # None: any carrier
    affected_warehouse_id: str
    issue_type: str
    start_date: date
    end_date: date
    notes: str | None = None


# --- Fixed values: they must equal the reference's for equal results -------------------------------

WAREHOUSES = (
    Warehouse("WH_NORTH", "North FC", "AM;PA;RR;AP;RO;AC;TO"),
    Warehouse("WH_SOUTHEAST", "Southeast FC", "SP;RJ;MG;ES"),
    Warehouse("WH_SOUTH", "South FC", "PR;SC;RS"),
    Warehouse("WH_CENTRAL_WEST", "Central-West FC", "DF;GO;MT;MS"),
)
OVERRIDE_STATES = ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE")
OVERRIDE_WAREHOUSE = "WH_SOUTHEAST"
DEFAULT_WAREHOUSE = "WH_CENTRAL_WEST"

CARRIERS = (
    Carrier("CAR_A", "Carrier A", "solid", None, None, 0.33),
    Carrier("CAR_B", "Carrier B", "solid", None, None, 0.33),
    Carrier("CAR_C", "Carrier C", "mediocre", None, None, 0.22),
    Carrier("CAR_D", "Carrier D", "warehouse_specific_poor", None, "WH_CENTRAL_WEST", 0.12),
)
EXCEPTION_WEIGHT = 0.23

SLA_TARGETS = (
    SlaTarget("fast", 3),
    SlaTarget("standard", 5),
    SlaTarget("bulky", 8),
)
BULKY_KEYWORDS = ("moveis", "cama_mesa_banho", "construcao", "ferramentas", "eletrodomesticos", "climatizacao")
FAST_KEYWORDS = ("beleza", "fashion", "eletron", "informatica", "telefonia", "relogios", "perfumaria", "papelaria")
UNKNOWN_CATEGORY = "unknown"

ANOMALY_WINDOWS = (
    AnomalyWindow("ANOM_SPIKE_001", "sharp_spike", "CAR_B", "WH_SOUTHEAST", "damaged", date(2018, 4, 1), date(2018, 4, 14)),
    AnomalyWindow("ANOM_DRIFT_001", "gradual_drift", None, "WH_CENTRAL_WEST", "sla_breach", date(2018, 7, 1), date(2018, 7, 28)),
)
SPIKE_TYPE = "sharp_spike"
DRIFT_TYPE = "gradual_drift"
VALIDATION_METRICS = {"ANOM_SPIKE_001": "damaged_issue_rate", "ANOM_DRIFT_001": "sla_breach_rate"}

QUALITY_ISSUE_TYPES = ("missing", "damaged", "wrong", "failed", "cancelled", "refund")
ISSUE_TYPES = ("none",) + QUALITY_ISSUE_TYPES
BASE_ISSUES = ("missing", "damaged", "wrong", "failed", "refund")
SPIKE_ISSUES = (("damaged", 0.7), ("missing", 0.2), ("wrong", 0.1))
DRIFT_ISSUES = (("failed", 0.6), ("refund", 0.25), ("missing", 0.15))

BASE_RISK = 0.03
LATE_RISK = 0.12
LOW_REVIEW_RISK = 0.15
LOW_REVIEW_SCORE = 2
WEAK_CARRIER = "CAR_C"
WEAK_CARRIER_RISK = 0.05
EXCEPTION_RISK = 0.12
SPIKE_RISK = 0.35
DRIFT_RISK = 0.05
DRIFT_SLOPE = 0.18
CANCELED_RISK = 0.95
MAX_RISK = 0.95
BASELINE_SOURCE = "synthetic_baseline"

Z_SCORE_THRESHOLD = 2.0
MIN_SHIPMENTS = 20
MIN_PRIOR_WEEKS = 4

COMPLETE_MONTH_DAY = 28
WINDOW_MONTHS = 6

# Expected config sizes, used by the config checks.
CONFIG_ROWS = {"warehouses": 4, "carriers": 4, "sla_targets": 3, "anomaly_windows": 2}

# ---------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """Everything the enrichment needs besides the order tables."""

    carriers: tuple[Carrier, ...] = CARRIERS
    sla_targets: tuple[SlaTarget, ...] = SLA_TARGETS
    windows: tuple[AnomalyWindow, ...] = ANOMALY_WINDOWS
    bulky_keywords: tuple[str, ...] = BULKY_KEYWORDS
    fast_keywords: tuple[str, ...] = FAST_KEYWORDS
    default_warehouse: tuple[str, str] = (DEFAULT_WAREHOUSE, "Central-West FC")
    validation_metrics: dict[str, str] = field(default_factory=lambda: dict(VALIDATION_METRICS))

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(w.anomaly_id for w in self.windows)


def local_table(spark: SparkSession, rows, schema: StructType | str) -> DataFrame:
    """A small in-memory table. By way of Arrow it becomes a local relation of known size, which Spark
    broadcasts by its own check; rows given directly would be an RDD of unknown size."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}
    return spark.createDataFrame(pa.Table.from_pydict(columns, schema=to_arrow_schema(schema)), schema)


def _frame(spark: SparkSession, records, schema: StructType) -> DataFrame:
    return local_table(spark, [tuple(getattr(r, c) for c in schema.names) for r in records], schema)


def warehouses_df(spark: SparkSession, warehouses=WAREHOUSES) -> DataFrame:
    return _frame(spark, warehouses, schemas.WAREHOUSES)


def carriers_df(spark: SparkSession, carriers=CARRIERS) -> DataFrame:
    return _frame(spark, carriers, schemas.CARRIERS)


def sla_targets_df(spark: SparkSession, targets=SLA_TARGETS) -> DataFrame:
    return _frame(spark, targets, schemas.SLA_TARGET_CONFIG)


def windows_df(spark: SparkSession, windows=ANOMALY_WINDOWS) -> DataFrame:
    return _frame(spark, windows, schemas.ANOMALY_WINDOWS)


def ordered_windows_df(spark: SparkSession, windows=ANOMALY_WINDOWS) -> DataFrame:
    """The windows with their `position` in config order."""
    schema = StructType().add("position", "integer")
    for column in schemas.ANOMALY_WINDOWS:
        schema.add(column)
    rows = [(i, *(getattr(w, c) for c in schemas.ANOMALY_WINDOWS.names)) for i, w in enumerate(windows)]
    return local_table(spark, rows, schema)


def label_metrics_df(spark: SparkSession, metrics=None) -> DataFrame:
    rows = list((VALIDATION_METRICS if metrics is None else metrics).items())
    return local_table(spark, rows, "anomaly_id string, validation_metric string")


def warehouse_names(spark: SparkSession, warehouses=WAREHOUSES) -> DataFrame:
    """`warehouse_id, warehouse_name` of the configured warehouses: an in-memory dimension."""
    rows = [(w.warehouse_id, w.warehouse_name) for w in warehouses]
    return local_table(spark, rows, "warehouse_id string, warehouse_name string")


def carrier_names(spark: SparkSession, carriers=CARRIERS) -> DataFrame:
    """`carrier_id, carrier_name` of the configured carriers: an in-memory dimension."""
    rows = [(c.carrier_id, c.carrier_name) for c in carriers]
    return local_table(spark, rows, "carrier_id string, carrier_name string")


def _records(df: DataFrame, cls):
    """Config rows as records."""
    return tuple(cls(**{name: row[name] for name in cls.__dataclass_fields__ if name in row}) for row in df.collect())


def carriers_from(df: DataFrame, weights=None) -> tuple[Carrier, ...]:
    """Carriers read from a config table; `weights` maps carrier_id to its share."""
    known = {c.carrier_id: c.weight for c in CARRIERS} if weights is None else weights
    carriers = _records(df, Carrier)
    return tuple(
        Carrier(c.carrier_id, c.carrier_name, c.reliability_tier, c.performance_notes,
                c.warehouse_exception, known.get(c.carrier_id, 0.12))
        for c in carriers
    )


def sla_targets_from(df: DataFrame) -> tuple[SlaTarget, ...]:
    return _records(df, SlaTarget)


def windows_from(df: DataFrame) -> tuple[AnomalyWindow, ...]:
    return _records(df, AnomalyWindow)


def rules_from(frames: dict[str, DataFrame]) -> Rules:
    """Rules from the four config tables; spikes are judged by damages, other windows by breaches."""
    windows = windows_from(frames["anomaly_windows"])
    metrics = {w.anomaly_id: "damaged_issue_rate" if w.anomaly_type == SPIKE_TYPE else "sla_breach_rate" for w in windows}
    default = frames["warehouses"].where(f"warehouse_id = '{DEFAULT_WAREHOUSE}'").first()
    return Rules(
        carriers=carriers_from(frames["carriers"]),
        sla_targets=sla_targets_from(frames["sla_targets"]),
        windows=windows,
        default_warehouse=(DEFAULT_WAREHOUSE, default.warehouse_name if default else None),
        validation_metrics=metrics,
    )


def overrides_df(spark: SparkSession) -> DataFrame:
    return local_table(spark, [(state, OVERRIDE_WAREHOUSE) for state in OVERRIDE_STATES], "customer_state string, warehouse_id string")
