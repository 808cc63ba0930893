"""Build all models from the stored raw tables and run the declared checks.

Staging models stay views. Intermediate models and marts are tables by year, and the next
layer reads the stored table: a mart is computed from the small table below it, never
again from the raw rows. Checks of a stored model are counted while it is written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill import schema
from seriesmill.plans import checks, marts, staging
from seriesmill.sources.tables import TableStore, utc_now


def build_models(
    store: TableStore,
    start_year: int = schema.DEFAULT_START_YEAR,
    at: dt.datetime | None = None,
    years: Sequence[int] | None = None,
) -> dict[str, DataFrame]:
    """All tables by name. Each raw table is scanned once for the models.

    The wages are reduced to their cells first, which both wage models read. With
    `years`, only these years of the stored models are written anew; their growth
    and ranks still look at all years.
    """
    return _build(store, start_year, at, years, {})[0]


def build_and_check(
    store: TableStore,
    start_year: int = schema.DEFAULT_START_YEAR,
    at: dt.datetime | None = None,
    years: Sequence[int] | None = None,
    first_year: int = 2000,
    last_year: int = 2030,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All models, and the verdicts of all checks on them.

    Stored models are checked by the writes themselves and never read again. The staging
    views are not written, so their checks are one aggregate over each.
    """
    declared = checks.all_checks(first_year, last_year)
    tables, verdicts = _build(store, start_year, at, years, declared)
    views = {name: tables[name] for name in tables if name.startswith("stg_")}
    return tables, reduce(DataFrame.unionByName, [checks.check_tables(views, declared), *verdicts])


def _build(store, start_year, at, years, declared) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    at = at or utc_now()
    refreshed = F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    raw = {name: store.read(name) for name in schema.RAW_TABLES}
    verdicts: list[DataFrame] = []

    def kept(name: str, df: DataFrame) -> DataFrame:
        found = store.write_model(df, name, declared.get(name, ()), years)
        if found is not None:
            verdicts.append(found)
        return store.read(name)

    staged = {
        "stg_household": staging.stage_household(raw["raw_household"], start_year),
        "stg_wages": staging.stage_wages(raw["raw_wages"], start_year),
        "stg_monthly": staging.stage_monthly(raw["raw_monthly"], start_year),
    }
    for name, view in staged.items():
        view.createOrReplaceTempView(name)

    def regional() -> dict[str, DataFrame]:
        model = marts.regional_employment(staged["stg_household"], staged["stg_monthly"])
        stored = kept("int_regional", model)
        mart = kept("mart_regional", marts.regional_mart(stored, refreshed))
        return {"int_regional": stored, "mart_regional": mart}

    def wages() -> dict[str, DataFrame]:
        cells = kept("int_wage_cells", marts.wage_cells(staged["stg_wages"]))
        stored = kept("int_wage_trends", marts.wage_trends(cells))
        return {
            "int_wage_trends": stored,
            "mart_wage": kept("mart_wage", marts.wage_mart(stored, refreshed)),
            "mart_industry": kept("mart_industry", marts.industry_mart(cells, refreshed)),
        }

    # The two chains do not need each other; run together they fill the executors
    # that the last tasks of one chain leave idle.
    with ThreadPoolExecutor() as pool:
        chains = [pool.submit(chain) for chain in (regional, wages)]
        built = [chain.result() for chain in chains]
    return {**raw, **staged, **built[0], **built[1]}, verdicts


def check_models(
    tables: dict[str, DataFrame], first_year: int = 2000, last_year: int = 2030
) -> DataFrame:
    """Verdicts of all declared checks and rules, one pass per table."""
    return checks.check_tables(tables, checks.all_checks(first_year, last_year))
