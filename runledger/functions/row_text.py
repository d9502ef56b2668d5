"""Result rows as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_text(df: DataFrame) -> DataFrame:
    """One readable ``value`` string per row: ``[1,abc,null]``.

    Commas inside values are not escaped; ``row_json`` is the lossless form.
    """
    # Positional names: a result may repeat a column name or use dots in it.
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in plain.columns]
    return plain.select(
        F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]")).alias("value")
    )


def row_json(df: DataFrame) -> DataFrame:
    """One JSON object per row in a ``value`` column, nulls kept."""
    return df.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )
