"""Column-level helpers; every function returns a built-in Spark ``Column``."""

from .arith import safe_div
from .calendar import cutoff_month, date_parts, fiscal_shift, month_key
from .labels import (account_kind, area_rename, interaction_discount, percent_guard,
                     queue_weight, recontact_ratio, recontact_weight, refund_kind,
                     shift_class)
from .scoring import Bands, band_score, imputed_band_score, step_penalty

__all__ = [
    "safe_div", "cutoff_month", "date_parts", "fiscal_shift", "month_key",
    "account_kind", "area_rename", "interaction_discount", "percent_guard",
    "queue_weight", "recontact_ratio", "recontact_weight", "refund_kind", "shift_class",
    "Bands", "band_score", "imputed_band_score", "step_penalty",
]
