"""Column expressions (JVM-side, codegen friendly)."""

from riskfold.functions.missing import any_feature_present, is_missing, present_value
from riskfold.functions.scoring import risk_level, threshold_label

__all__ = [
    "any_feature_present", "is_missing", "present_value", "risk_level", "threshold_label",
]
