"""Column builders (no Python UDFs): classifiers, calendar parts, keys, numerics, labels."""

from .classify import (alert_type, beaufort, c_to_f, precipitation_class, severity,
                       uv_risk_level, wmo_label)
from .dates import (daylight_hours, date_parts, days_between, dow0, hours_between, is_weekend,
                    month_name_pt, month_abbr_pt, season_south, weekday_name_pt, weekday_abbr_pt,
                    year_month)
from .keys import instant_text, surrogate_key
from .labels import label, label_pt
from .numeric import clean_floor, mean, round_half_even, round_half_up, to_double

__all__ = [
    "alert_type", "beaufort", "c_to_f", "precipitation_class", "severity", "uv_risk_level",
    "wmo_label", "daylight_hours", "date_parts", "days_between", "dow0", "hours_between",
    "is_weekend", "month_name_pt", "month_abbr_pt", "season_south", "weekday_name_pt",
    "weekday_abbr_pt", "year_month", "surrogate_key", "instant_text", "label", "label_pt", "clean_floor",
    "mean", "round_half_even", "round_half_up", "to_double",
]
