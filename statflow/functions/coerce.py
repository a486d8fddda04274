"""Lenient JSON coercion in the manner of Jackson's ``asLong``/``asDouble``/
``asText`` (§2.11), on Variant values (``try_parse_json``).

* number → itself (decimals truncated for ``as_long``);
* text → parsed when numeric, else 0 (``as_text``: the text);
* boolean → 1/0 (``as_text``: ``true``/``false``);
* JSON null → 0 (``as_text``: ``null``); object/array → 0 (``as_text``: ``''``);
* a *missing* field is null: the caller quarantines it (Jackson throws).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMERIC = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def field(v: Column, path: str) -> Column:
    """Sub-variant at ``path`` (null when missing)."""
    return F.try_variant_get(v, path, "variant")


def _kind(x: Column) -> Column:
    t = F.schema_of_variant(x)
    return F.when(F.is_variant_null(x), F.lit("NULL")).otherwise(
        F.when(t.startswith("DECIMAL"), F.lit("DECIMAL")).otherwise(t)
    )


def as_long(x: Column) -> Column:
    k = _kind(x)
    s = F.try_variant_get(x, "$", "string")
    # "12" → 12 exactly (no detour through double), "1.9" → 1, "zz" → 0.
    text_long = F.coalesce(s.try_cast("bigint"), s.try_cast("double").try_cast("bigint"))
    return (
        F.when(x.isNull(), F.lit(None).cast("long"))
        .when(k == "BOOLEAN", F.when(s == "true", F.lit(1)).otherwise(F.lit(0)).cast("long"))
        .when(k.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.try_variant_get(x, "$", "bigint"))
        .when(k.isin("DOUBLE", "FLOAT", "DECIMAL"), F.try_variant_get(x, "$", "double").try_cast("bigint"))
        .when(k == "STRING", F.coalesce(text_long, F.lit(0).cast("long")))
        .otherwise(F.lit(0).cast("long"))
    )


def out_of_range(x: Column) -> Column:
    """Whether a number, or a numeric text, lies beyond bigint (``as_long`` has no value for it)."""
    k = _kind(x)
    d = F.when(k.isin("DOUBLE", "FLOAT", "DECIMAL", "STRING"), F.try_variant_get(x, "$", "string").try_cast("double"))
    # 2^63 as a double is the first value that no bigint holds; NaN counts as beyond.
    return F.coalesce((d >= F.lit(2.0**63)) | (d < F.lit(-(2.0**63))) | F.isnan(d), F.lit(False))


def as_double(x: Column) -> Column:
    k = _kind(x)
    s = F.try_variant_get(x, "$", "string")
    return (
        F.when(x.isNull(), F.lit(None).cast("double"))
        .when(k == "BOOLEAN", F.when(s == "true", F.lit(1.0)).otherwise(F.lit(0.0)))
        .when(k.isin(*_NUMERIC, "DECIMAL"), F.try_variant_get(x, "$", "double"))
        .when(k == "STRING", F.coalesce(s.try_cast("double"), F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )


def as_text(x: Column) -> Column:
    k = _kind(x)
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(k == "NULL", F.lit("null"))
        .when(k.startswith("OBJECT") | k.startswith("ARRAY"), F.lit(""))
        .otherwise(F.try_variant_get(x, "$", "string"))
    )
