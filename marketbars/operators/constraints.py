"""Checks of the table constraints: required columns, number range, unique key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.schemas import Cadence


def constraint_violations(rows: DataFrame, cadence: Cadence) -> DataFrame:
    """Counts per violated constraint, as rows of ``check`` and ``violations``.

    Both parts aggregate map-side: one row per task for the required columns, and one
    partial count per key for the uniqueness check, so copies of one key never meet in one
    task as rows. Prices given as text must also fit the price type.
    """
    required = cadence.staging_schema.fieldNames()
    fitting = {f.name: F.col(f.name).try_cast(f.dataType) for f in cadence.staging_schema}
    nulls = rows.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in required],
        *[
            F.count_if(F.col(c).isNotNull() & fit.isNull()).alias(f"range:{c}")
            for c, fit in fitting.items()
        ],
    )
    listed = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("violations"))
                for c in nulls.columns
            ]
        )
    )
    copies = (
        rows.dropna(subset=cadence.keys)
        .groupBy(*cadence.keys)
        .count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))
        .select(F.lit("unique:key").alias("check"), "violations")
    )
    return nulls.select(listed.alias("v")).select("v.*").unionByName(copies)
