"""Run some jobs, or all of them with shared aggregates.

    python -m tagweave --in parquet:/data/in --out parquet:/data/out all
    spark-submit --py-files tagweave.zip tagweave/__main__.py \\
        --in catalog:shop_tags --out catalog:shop_tags gender rfm profile
    ... --in jdbc:mysql://host/db --properties db.json --out jdbc:mysql://host/db all
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tagweave.operators.recommend import REGULARISATION
from tagweave.operators.shopping import GoodsCoding
from tagweave.plans import jobs, profile
from tagweave.plans.settings import Settings
from tagweave.sources.tables import CatalogTables, FileTables, JdbcTables, Split
from tagweave.sources.taxonomy import Taxonomy


def place(spark: SparkSession, address: str, properties: dict):
    """``jdbc:...``, ``catalog:<database>`` or ``<file format>:<folder>``.

    ``properties`` may hold a key ``splits`` beside the connection's own:
    {"table": ["column", lower, upper, partitions]}.
    """
    kind, _, rest = address.partition(":")
    if kind == "jdbc":
        splits = {table: Split(*cut) for table, cut in properties.get("splits", {}).items()}
        connection = {k: v for k, v in properties.items() if k != "splits"}
        return JdbcTables(spark, address, connection, splits)
    if kind == "catalog":
        return CatalogTables(spark, rest or None, versioned=True)
    return FileTables(spark, rest, kind)


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(prog="tagweave", description=__doc__,
                                      formatter_class=argparse.RawTextHelpFormatter)
    options.add_argument("jobs", nargs="+", choices=["all", *jobs.TABLES, *jobs.REPAIRS])
    options.add_argument("--in", dest="source", required=True)
    options.add_argument("--out", required=True)
    options.add_argument("--properties", help="JSON file of JDBC properties and splits")
    options.add_argument("--taxonomy", default="tbl_basic_tags")
    for table in ("users", "orders", "logs", "goods"):
        options.add_argument(f"--{table}", default=f"tbl_{table}")
    options.add_argument("--as-of", help="day ages are counted to, today if absent")
    options.add_argument("--logs-as-of", help="the same for the logs, if another day")
    options.add_argument("--visit-lag", type=int, default=0,
                         help="days the logs lag behind, for the engagement tag")
    options.add_argument("--models", help="folder models are kept in")
    options.add_argument("--retrain", action="store_true")
    options.add_argument("--recommender-blocks", type=int, default=10)
    options.add_argument("--regularisation", type=float, default=REGULARISATION)
    options.add_argument("--longest-search-only", action="store_true",
                         help="fit clusters with the longest iteration limit only")
    options.add_argument("--skip-unscored", action="store_true",
                         help="leave out users whose metrics lie in no score band")
    options.add_argument("--half-open", nargs="*", default=[], metavar="TAG",
                         help="range tags whose bands reach to the next integer")
    options.add_argument("--to-midnight", action="store_true",
                         help="repairs drop the time of day")
    options.add_argument("--settings", help="JSON file with rfm_bands, rfe_bands and coding "
                                            "(lists of the goods vocabularies)")
    options.add_argument("--left", action="store_true",
                         help="keep users that lack tags in the profile")
    options.add_argument("--sort", action="store_true", help="sort tables by user")
    return options


def main(arguments: list[str] | None = None) -> None:
    chosen = parser().parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    properties = {}
    if chosen.properties:
        with open(chosen.properties) as file:
            properties = json.load(file)
    store = place(spark, chosen.source, properties)
    out = place(spark, chosen.out, properties)
    taxonomy = (None if set(chosen.jobs) <= set(jobs.REPAIRS)
                else Taxonomy(store.read(chosen.taxonomy)))
    more = {}
    if chosen.settings:
        with open(chosen.settings) as file:
            more = json.load(file)
        for name in ("rfm_bands", "rfe_bands"):
            if name in more:
                more[name] = {k: [tuple(b) for b in v] for k, v in more[name].items()}
        if "coding" in more:
            more["coding"] = GoodsCoding(**{k: tuple(v) for k, v in more["coding"].items()})
    settings = Settings(users=chosen.users, orders=chosen.orders, logs=chosen.logs,
                        goods=chosen.goods, orders_as_of=chosen.as_of,
                        logs_as_of=chosen.logs_as_of or chosen.as_of,
                        visit_lag_days=chosen.visit_lag, model_root=chosen.models,
                        retrain=chosen.retrain, recommender_blocks=chosen.recommender_blocks,
                        regularisation=chosen.regularisation,
                        try_all_iterations=not chosen.longest_search_only,
                        skip_unscored=chosen.skip_unscored,
                        half_open=frozenset(chosen.half_open),
                        to_midnight=chosen.to_midnight, **more)
    sort_by = "userId" if chosen.sort else None
    how = "left" if chosen.left else "inner"
    for name in chosen.jobs:
        if name == "all":
            profile.run_all(store, out, taxonomy, settings, how, sort_by)
        else:
            jobs.run(name, store, out, taxonomy, settings, sort_by, how)


if __name__ == "__main__":
    main()
