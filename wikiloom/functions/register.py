"""SQL names for the scalar functions."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> list[str]:
    """Registers SQL functions (JVM expressions, no Python UDF) in the session; returns their names."""
    made = {
        "wl_ucfirst": "(s STRING) RETURNS STRING RETURN concat(upper(left(s, 1)), substring(s, 2))",
        "wl_xml_escape": "(s STRING) RETURNS STRING RETURN replace(replace(replace(replace(replace(s, '&', '&amp;'), '\"', '&quot;'), '\\'', '&apos;'), '<', '&lt;'), '>', '&gt;')",
        "wl_is_stub": "(s STRING) RETURNS BOOLEAN RETURN contains(lower(s), 'stub}}')",
        "wl_strip_comments": "(s STRING) RETURNS STRING RETURN regexp_replace(s, '(?s)<!--.*?-->', '')",
    }
    for name, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {body}")
    return sorted(made)

