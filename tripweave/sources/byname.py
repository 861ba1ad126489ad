"""Load by column name, case-insensitively, onto a target schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def load_by_name(df: DataFrame, target: StructType) -> DataFrame:
    """Project ``df`` onto ``target``: each target field takes the source
    column of the same name in any letter case, cast tolerantly to the target
    type; a field with no source column is NULL.  Source columns that the
    target lacks are dropped."""
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for field in target.fields:
        src = by_lower.get(field.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif df.schema[src].dataType == field.dataType:
            cols.append(F.col(f"`{src}`").alias(field.name))
        else:
            cols.append(F.col(f"`{src}`").try_cast(field.dataType).alias(field.name))
    return df.select(*cols)
