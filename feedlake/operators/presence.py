"""Missing key vs JSON null vs value, per optional field.

``.get`` access in the client treats a missing key and a JSON null alike; the
landing keeps the difference, and this operator counts it. One pass, one
partial aggregate per task (map-side combine), then a small shuffle keyed by
(group, field).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.operators.flatten import REC


def field_presence(records: DataFrame, paths: dict[str, str], by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., field, n_missing, n_null, n_value) over exploded ``_rec`` rows."""
    cols = []
    for name, path in paths.items():
        v = F.variant_get(F.col(REC), "$." + path, "variant")
        state = F.when(v.isNull(), F.lit("missing")).when(F.is_variant_null(v), F.lit("null")).otherwise(F.lit("value"))
        cols.append(F.struct(F.lit(name).alias("field"), state.alias("state")))
    long = records.select(*by, F.inline(F.array(*cols)))
    return long.groupBy(*by, "field").agg(
        F.count(F.when(F.col("state") == "missing", 1)).alias("n_missing"),
        F.count(F.when(F.col("state") == "null", 1)).alias("n_null"),
        F.count(F.when(F.col("state") == "value", 1)).alias("n_value"),
    )
