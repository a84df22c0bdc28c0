"""F14/J12 lateral JSON flatten and M9 list-membership rebuild."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratum.functions.validity import active_valid


def flatten_json_array(df: DataFrame, json_col: str, value_col: str = "value",
                       value_type: str = "int", keep: list[str] | None = None) -> DataFrame:
    """``LATERAL FLATTEN(TRY_PARSE_JSON(c))``: one row per array element (or object field).

    Malformed, empty, NULL and scalar inputs produce no rows. Elements are converted with
    ``try_variant_get``: an element that is not a ``value_type`` becomes NULL instead of failing
    the batch. Runs as a Generate node next to the scan: no shuffle.
    """
    keep = keep if keep is not None else [c for c in df.columns]
    spark = df.sparkSession
    exploded = df.select(*keep, F.col(json_col).alias("__json")).lateralJoin(
        spark.tvf.variant_explode(F.try_parse_json(F.col("__json").outer())))
    return exploded.select(*keep, F.col("pos").alias("element_pos"),
                           F.try_variant_get(F.col("value"), "$", value_type).alias(value_col))


def list_membership(contacts: DataFrame, key: str = "contact_id", email_col: str = "email",
                    subscribed_col: str = "list_ids_raw",
                    unsubscribed_col: str | None = "list_unsubscribed_raw") -> DataFrame:
    """M9: contact x list bridge from the subscribed and unsubscribed JSON arrays.

    Only valid, undeleted contacts contribute. Rebuilt as a whole each time (it is a pure function
    of the Silver snapshot), so it can be written as a fresh snapshot.
    """
    live = contacts.filter(active_valid("is_valid_record", "is_deleted"))
    parts = [flatten_json_array(live, subscribed_col, "list_id", "int", [key, email_col])
             .withColumn("is_unsubscribed", F.lit(False))]
    if unsubscribed_col and unsubscribed_col in contacts.columns:
        parts.append(flatten_json_array(live, unsubscribed_col, "list_id", "int", [key, email_col])
                     .withColumn("is_unsubscribed", F.lit(True)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(key, "list_id", email_col, "is_unsubscribed")
