"""Role policies as ordinary projections and filters.

A policy looks at the current role only, never at roles it inherits, so an
administrator sees what an unknown role sees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.labels import flag
from seriesmill.functions.text import has

ENGINEER, ANALYST, REPORTER = "ENGINEER_ROLE", "ANALYST_ROLE", "REPORTER_ROLE"
FULL_ACCESS = (ENGINEER, ANALYST)
MASKED_VALUE = -1.0

# Layers that each role may read.
READABLE_LAYERS = {
    ENGINEER: ("raw", "staging", "intermediate", "mart"),
    ANALYST: ("staging", "intermediate", "mart"),
    REPORTER: ("mart",),
}


def masked(value: Column, role: str, allowed: Sequence[str] = FULL_ACCESS) -> Column:
    """The value itself for an allowed role, -1 (for NULL too) for all others."""
    return value if role in allowed else F.lit(MASKED_VALUE)


def mask(
    df: DataFrame, column: str, role: str, allowed: Sequence[str] = FULL_ACCESS
) -> DataFrame:
    """R1 on one column of a table."""
    return df.withColumn(column, masked(F.col(column), role, allowed))


def is_national(region: Column) -> Column:
    return flag(has(region, "New Zealand")) | flag(has(region, "Total")) | region.isNull()


def may_see(region: Column, role: str, allowed: Sequence[str] = FULL_ACCESS) -> Column:
    """R2 as a condition: everything, national rows for reporters, nothing for other roles."""
    if role in allowed:
        return F.lit(True)
    return is_national(region) if role == REPORTER else F.lit(False)


def rows_for(
    df: DataFrame,
    role: str,
    column: str = "series_title_3",
    allowed: Sequence[str] = FULL_ACCESS,
) -> DataFrame:
    """R2 on a table."""
    return df.filter(may_see(F.col(column), role, allowed))


def layers_for(role: str) -> tuple[str, ...]:
    """R3."""
    return READABLE_LAYERS.get(role, ())


# Layer of a stored table by the start of its name, and the policies attached to tables.
LAYER_OF = {"raw": "raw", "stg": "staging", "int": "intermediate", "mart": "mart"}
MASKED_COLUMNS = {"raw_wages": "data_value"}
REGION_COLUMNS = {"raw_household": "series_title_3"}


def as_role(df: DataFrame, table: str, role: str) -> DataFrame:
    """What a role gets of a stored table."""
    seen = published(df, LAYER_OF.get(table.partition("_")[0], "raw"), role)
    if table in REGION_COLUMNS:
        seen = rows_for(seen, role, REGION_COLUMNS[table])
    return mask(seen, MASKED_COLUMNS[table], role) if table in MASKED_COLUMNS else seen


def published(df: DataFrame, layer: str, role: str) -> DataFrame:
    """Hand out a table of a layer, or refuse."""
    if layer not in layers_for(role):
        raise PermissionError(f"{role} may not read the {layer} layer")
    return df
