from churnlab.functions.columns import (  # noqa: F401
    clip, confusion_label, cut, date_to_yyyymmdd, desc_text_key, label_at, parse_yyyymmdd,
    risk_band, row_sum, safe_ratio, tenure_years, yyyymmdd_add_days,
)
