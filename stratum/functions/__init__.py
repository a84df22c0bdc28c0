"""Column expressions (built-in Spark functions only, no Python UDFs)."""

from stratum.functions.text import clean_trim, clean_lower, clean_upper, proper_case, concat_null, full_name
from stratum.functions.validity import (valid_email, valid_required, valid_required_nonblank,
                                        valid_event_time, valid_date_range, valid_metrics,
                                        active_valid, null_default_differs, any_tracked_differs)
from stratum.functions.numeric import rate_pct, safe_ratio, exact_ratio, ad_metrics, flag_to_int, count_true
from stratum.functions.temporal import (try_parse_ts, ts_text, date_parts, days_between,
                                        add_days, add_hours, add_minutes, ts_literal)
from stratum.functions.hashing import hash_key, row_hash, row_hash32

__all__ = [
    "clean_trim", "clean_lower", "clean_upper", "proper_case", "concat_null", "full_name",
    "valid_email", "valid_required", "valid_required_nonblank", "valid_event_time",
    "valid_date_range", "valid_metrics", "active_valid", "null_default_differs", "any_tracked_differs",
    "rate_pct", "safe_ratio", "exact_ratio", "ad_metrics", "flag_to_int", "count_true",
    "try_parse_ts", "ts_text", "date_parts", "days_between", "add_days", "add_hours", "add_minutes",
    "ts_literal", "hash_key", "row_hash", "row_hash32",
]
