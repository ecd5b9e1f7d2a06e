"""The jobs by name: 22 tags, each with its own table, the profile, and three repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagweave.operators.staging import staged_run
from tagweave.plans import mining, profile, repair
from tagweave.plans.settings import Settings
from tagweave.plans.tags import (BY_NAME, MODEL, PREFERENCE_TABLE, PROFILE_TABLE, TAGS,
                                 run_tag, tag_table)
from tagweave.sources.taxonomy import Taxonomy

TABLES = {**{tag.name: tag.table for tag in TAGS}, "bp": PREFERENCE_TABLE,
          "profile": PROFILE_TABLE}
# Suffix of repaired tables.
REPAIRED = "_new"
REPAIRS = {"repair-orders": ("orders", repair.repair_orders),
           "shift-logs": ("logs", repair.shift_logs), "shift-users": ("users", repair.shift_users)}


def tag(name: str, store, taxonomy: Taxonomy, settings: Settings) -> DataFrame:
    """One tag table, computed from the inputs."""
    if name == "bp":
        return mining.preferences(store, settings)
    declared = BY_NAME[name]
    half_open = name in settings.half_open
    if declared.entity == MODEL:
        return tag_table(declared, mining.mined(name, store, settings), taxonomy, half_open)
    return run_tag(declared, store, taxonomy, settings.as_of(declared.entity), half_open)


def run(name: str, store, out, taxonomy: Taxonomy | None, settings: Settings,
        sort_by: str | None = None, how: str = "inner") -> None:
    """Compute one job and write its table; the profile joins the tables of the
    tags written before, ``how`` says whether users that lack some are kept. Repairs
    write a table named like their source with ``_new``. What a job stages goes at its end."""
    with staged_run(SparkSession.getActiveSession(), not getattr(out, "lazy", False)):
        _run(name, store, out, taxonomy, settings, sort_by, how)


def _run(name: str, store, out, taxonomy: Taxonomy | None, settings: Settings,
         sort_by: str | None, how: str) -> None:
    if name in REPAIRS:
        source, job = REPAIRS[name]
        table = getattr(settings, source)
        out.write(job(store.read(table), to_midnight=settings.to_midnight), table + REPAIRED)
        return
    if name not in TABLES:
        raise ValueError(f"no job {name!r}; there are {sorted([*TABLES, *REPAIRS])}")
    result = (profile.profile_from_tables(out, how) if name == "profile"
              else tag(name, store, taxonomy, settings))
    out.write(result, TABLES[name], sort_by=sort_by)
