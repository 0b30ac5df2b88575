"""Publication as a whole: a run builds beside what is published, and a manifest then names the run of every month.

A run has a mart of its own, below `runs/`. Readers follow the last manifest, so they see the state before the run until the run
is complete, and none of it if it fails. A run that failed is resumed under its name: layers that were complete are kept. Manifests are numbered files;
of two runs that publish at once, the second adds its months to what the first has published.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import asdict, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.plans import backfill
from creditloom.plans.backfill import Mart
from creditloom.sources.files import newest, numbered, read_json, write_json
from creditloom.sources.readers import Day, children, file_system, literal, read_snapshots, stored_months, within
from creditloom.sources.schemas import MONTHLY_TABLES, SNAPSHOT, STATIC_TABLES
from creditloom.sources.writers import WriteAudit

GOLD_TABLES = ["label_store", "feature_store"]
MONTHLY = [*[f"silver/{t}" for t in MONTHLY_TABLES], *[f"gold/{t}" for t in GOLD_TABLES]]
STATIC = [f"silver/{t}" for t in STATIC_TABLES]
ATTEMPTS = 20  # to publish while others do


def months_of(mart: Mart) -> list[str]:
    """First days of the months of a range, as text."""
    first, last = (dt.date.fromisoformat(str(day)) for day in (mart.start, mart.end))
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    days = [dt.date(first.year + (first.month - 1 + k) // 12, (first.month - 1 + k) % 12 + 1, 1) for k in range(count)]
    return [str(day) for day in days if within(day, mart.start, mart.end)]


def run_mart(mart: Mart, run: str) -> Mart:
    """The mart that a run builds; its vocabularies are those of all runs."""
    return replace(mart, root=f"{mart.root}/runs/{run}", vocabulary=mart.vocabulary or mart.path("vocabulary", "encoded"))


def manifest(spark: SparkSession, root: str) -> dict:
    """What is published: {table: {month: run}}, with an empty month for tables without months."""
    _, path = newest(spark, f"{root}/manifests")
    return read_json(spark, path) if path else {}


def publish(spark: SparkSession, mart: Mart, run: str) -> dict[str, WriteAudit]:
    """Build all layers for the mart's months in a run of that name and publish them; the audits of its tables.

    Every month of the range is the run's afterwards, also one that has no rows any more.
    """
    own = run_mart(mart, run)
    plan = {"source": mart.source, "start": str(mart.start), "end": str(mart.end)}
    started = read_json(spark, f"{own.root}/done/run.json")
    if started is None:
        write_json(spark, f"{own.root}/done/run.json", plan)
    elif started != plan:
        raise ValueError(f"run {run} was begun with {started}")
    audits: dict[str, WriteAudit] = {}
    for layer in ("bronze", "silver", "gold"):
        audits |= _layer(spark, own, layer, getattr(backfill, f"build_{layer}"))
    months = months_of(mart)
    _publish(spark, mart.root, {t: dict.fromkeys(months, run) for t in MONTHLY} | {t: {"": run} for t in STATIC})
    return audits


def _layer(spark: SparkSession, mart: Mart, layer: str, build: Callable) -> dict[str, WriteAudit]:
    """Build a layer, or take it over from the run's first attempt."""
    place = f"{mart.root}/done/{layer}.json"
    held = read_json(spark, place)
    if held is None:
        audits = build(spark, mart)
        write_json(spark, place, {t: {**asdict(a), "snapshots": list(map(str, a.snapshots))} for t, a in audits.items()})
        return audits
    return {t: WriteAudit(a["rows"], a["rejected"], [dt.date.fromisoformat(d) for d in a["snapshots"]]) for t, a in held.items()}


def _publish(spark: SparkSession, root: str, made: dict) -> None:
    for _ in range(ATTEMPTS):
        last, _ = newest(spark, f"{root}/manifests")
        held = manifest(spark, root)
        try:
            write_json(spark, numbered(f"{root}/manifests", last + 1), {t: held.get(t, {}) | made.get(t, {}) for t in {**held, **made}}, replace=False)
            return
        except FileExistsError:
            continue
    raise FileExistsError(f"could not publish to {root}")


def published(spark: SparkSession, root: str, table: str, start: Day = None, end: Day = None) -> DataFrame:
    """A published table such as `gold/label_store`, each month from its run; columns a run didn't have are NULL."""
    runs: dict[str, list[dt.date]] = {}
    for month, run in sorted(manifest(spark, root).get(table, {}).items()):
        if not month or within(dt.date.fromisoformat(month), start, end):
            runs.setdefault(run, []).extend([dt.date.fromisoformat(month)] if month else [])
    if not runs:
        raise FileNotFoundError(f"{table} is not published in {root}")
    parts = [_of_run(spark, f"{root}/runs/{run}/{table}", months) for run, months in runs.items()]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


def _of_run(spark: SparkSession, path: str, months: list[dt.date]) -> DataFrame:
    if not months:
        return spark.read.parquet(literal(path))
    rows = read_snapshots(spark, path)
    # A run whose months are all its own needs no filter.
    return rows if stored_months(spark, path) <= set(months) else rows.where(F.col(SNAPSHOT).isin(months))


def remove_unused(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete complete runs that none of the last `keep` manifests names; their names. Runs under way stay."""
    last, _ = newest(spark, f"{root}/manifests")
    used = set()
    for number in range(max(1, last - keep + 1), last + 1):
        for months in (read_json(spark, numbered(f"{root}/manifests", number)) or {}).values():
            used |= set(months.values())
    names = [x.getPath().getName() for x in children(spark, f"{root}/runs")]
    gone = [run for run in names if run not in used and read_json(spark, f"{root}/runs/{run}/done/gold.json") is not None]
    for run in gone:
        system, folder = file_system(spark, f"{root}/runs/{run}")
        system.delete(folder, True)
    return sorted(gone)
