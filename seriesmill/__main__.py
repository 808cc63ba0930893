"""Load archives, build the models, run the checks.

`python -m seriesmill LANDING STORE` expects the archives of each survey in
a folder of its own below LANDING: household, wages, monthly. The exit status is
0 when everything loaded, 1 when some sources failed, 2 when none could be read
or loaded, and 3 when a check of severity error failed.
"""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from seriesmill import schema
from seriesmill.plans.build import build_and_check
from seriesmill.plans.checks import all_checks
from seriesmill.plans.ingest import Source, run_sources
from seriesmill.session import shuffle_settings
from seriesmill.sources.tables import TableStore

SURVEYS = {"household": "raw_household", "wages": "raw_wages", "monthly": "raw_monthly"}


def main(arguments: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="seriesmill", description=__doc__)
    parser.add_argument("landing", help="folder with one folder of archives per survey")
    parser.add_argument("store", help="folder for the stored tables")
    parser.add_argument("--start-year", type=int, default=schema.DEFAULT_START_YEAR)
    parser.add_argument("--input-gb", type=float, default=None, help="size of the raw files, to size the shuffles")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("seriesmill").getOrCreate()
    # Adaptive execution splits hot keys and large years; the job relies on it.
    settings = {"spark.sql.adaptive.enabled": "true"}
    if options.input_gb is not None:
        settings |= shuffle_settings(int(options.input_gb * 1e9))
    for name, value in settings.items():
        spark.conf.set(name, value)
    store = TableStore(spark, options.store.rstrip("/"))
    sources = [Source(n, f"{options.landing}/{n}", table) for n, table in SURVEYS.items()]
    report = run_sources(spark, sources, store, checks=all_checks())
    for line in report.lines:
        print(*line, sep="\t")
    if report.exit_code:
        return report.exit_code

    _, models = build_and_check(store, options.start_year)
    verdicts = reduce(DataFrame.unionByName, [*report.verdicts, models]).collect()
    for verdict in verdicts:
        print(*verdict, sep="\t")
    return 3 if any(verdict.status == "error" for verdict in verdicts) else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
