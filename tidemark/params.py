"""Parameters of the engine. The defaults are fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# The ordered feature contract between training and scoring.
FEATURES = (
    "total_sales_revenue",
    "total_items_purchased",
    "total_sale_txs",
    "avg_sale_days",
    "recency",
    "total_return_amount",
    "total_items_returned",
    "total_return_txs",
    "avg_return_days",
    "tenure_days",
    "recent_revenue",
    "revenue_momentum",
    "recent_tx_count",
    "tx_count_momentum",
)
# Features that move with the calendar, so their drift is expected.
TEMPORAL_FEATURES = ("tenure_days",)
LABEL = "inactive_90d"

# Right-closed probability bands and their names.
RISK_EDGES = (0.0, 0.3, 0.6, 1.0)
RISK_LABELS = ("low", "medium", "high")

# The threshold sweep 0.05, 0.10, ... 0.95 as i-th multiples of a double step.
SWEEP_THRESHOLDS = tuple(0.05 + i * 0.05 for i in range(19))
SWEEP_METRICS = ("f1", "precision", "recall", "youden_j")

# Quantile points of ten PSI bins (the i-th multiple of 0.1, the last exactly 1).
PSI_POINTS = tuple(i * 0.1 for i in range(10)) + (1.0,)
# Percentiles of the purchase-interval report.
INTERVAL_POINTS = (0.10, 0.25, 0.50, 0.75, 0.90)

SEED = 42


@dataclass(frozen=True)
class SnapshotPlan:
    """Window sizes of a snapshot sequence. ``unit`` is ``month`` or ``day``.

    Windows start at midnight, are half-open, and snapshot 1 starts at ``start``.
    """

    start: date = date(2009, 12, 1)
    feature: int = 5
    outcome: int = 3
    step: int = 3
    unit: str = "month"

    def __post_init__(self) -> None:
        if self.unit not in ("month", "day"):
            raise ValueError(f"unit must be 'month' or 'day', got {self.unit!r}")
        if min(self.feature, self.outcome, self.step) < 1:
            raise ValueError("feature, outcome and step must be positive")


@dataclass(frozen=True)
class SplitPlan:
    """Snapshots per split, oldest first."""

    train: int = 2
    val: int = 1
    test: int = 1

    @property
    def total(self) -> int:
        return self.train + self.val + self.test


@dataclass(frozen=True)
class QualityPolicy:
    max_null_customer: float = 0.95
    max_duplicate_rate: float = 0.20
    trailing_months: int = 12
    soft_z: float = 3.0
    hard_z: float = 5.0


@dataclass(frozen=True)
class DriftPolicy:
    warning: float = 0.10
    critical: float = 0.25
    #: Rows of the stored drift baseline; None keeps the whole cohort.
    baseline_rows: int | None = None


@dataclass(frozen=True)
class GuardrailPolicy:
    metric: str = "roc_auc"
    max_metric_regression: float = 0.005
    max_recall_regression: float = 0.05
    max_brier_regression: float = 0.02


@dataclass(frozen=True)
class AlertPolicy:
    prediction_psi_warning: float = 0.10
    prediction_psi_critical: float = 0.25
    feature_psi_warning: float = 0.10
    feature_psi_critical: float = 0.25
    max_roc_auc_drop: float = 0.005
    max_recall_drop: float = 0.05
    max_brier_worsening: float = 0.02
    critical_multiplier: float = 2.0
