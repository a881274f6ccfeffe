"""Canonical result form for comparing query results with an external oracle.

Doubles are compared as 32-bit floats (engines sum in different orders, so
the last bits of a double differ); magnitudes below 1e-9 (rounding noise of
an exact zero, e.g. the skewness of symmetric data) and -0.0 become 0.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def canon(df: DataFrame) -> DataFrame:
    out = []  # as text: one call to the JVM, where thousands of Column calls took longer than the query
    for f in df.schema.fields:
        c = "`" + f.name.replace("`", "``") + "`"
        if f.dataType.typeName() in ("double", "float", "decimal"):
            out.append(f"CAST(CASE WHEN abs({c}) < 1e-9D THEN 0.0D ELSE {c} END AS FLOAT) AS {c}")
        else:
            out.append(f"{c} AS {c}")
    return df.selectExpr(*out)
