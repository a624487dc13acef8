"""Point-in-time customer analytics on Spark DataFrames."""

from tidemark.params import (
    AlertPolicy,
    DriftPolicy,
    GuardrailPolicy,
    QualityPolicy,
    SnapshotPlan,
    SplitPlan,
)

__all__ = [
    "AlertPolicy",
    "DriftPolicy",
    "GuardrailPolicy",
    "QualityPolicy",
    "SnapshotPlan",
    "SplitPlan",
]
