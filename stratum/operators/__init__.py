"""Relational operators: pure functions from DataFrames to a DataFrame."""

from stratum.operators.dedup import dedup_latest
from stratum.operators.merge import scd1_merge, fact_merge, split_null_keys
from stratum.operators.surrogate import assign_surrogate_keys, max_key
from stratum.operators.scd2 import scd2_apply, Scd2Spec
from stratum.operators.flatten import flatten_json_array, list_membership
from stratum.operators.change_feed import change_feed, change_feed_by_digest, inserts_only
from stratum.operators.increments import distinct_bitmaps, merged_distinct, merged_sums, signed_sums
from stratum.operators.skew import heavy_keys, hot_key_join
from stratum.operators.calendar import date_dimension
from stratum.operators import history

__all__ = ["dedup_latest", "scd1_merge", "fact_merge", "split_null_keys", "assign_surrogate_keys",
           "max_key", "scd2_apply", "Scd2Spec", "flatten_json_array", "list_membership",
           "change_feed", "change_feed_by_digest", "inserts_only", "distinct_bitmaps", "merged_distinct", "merged_sums", "signed_sums",
           "heavy_keys", "hot_key_join", "date_dimension", "history"]
