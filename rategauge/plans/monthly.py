"""Runs from raw files to published tables: one month, or many in one pass.

A run reads its files once and leaves four tables in a folder of its own: the
classified records, what they add to the averages (counts and cents), the extreme
prices of each month and group, and the audit counts.  Then the months it touches
are merged: averages from the sums and lists from the extremes of all live runs,
without reading the records of earlier ones.  The last step publishes the manifest
that names all of it; until then, and if the run fails, every earlier table stays
as it was.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rategauge.functions import exact_sum, exact_total, mean_of
from rategauge.operators.clean import classify
from rategauge.operators.extremes import WHOLE, merged_lists, on_sides, whole_lists
from rategauge.operators.quality import quality_totals
from rategauge.operators.rank import OVER, UNDER, top_over_under
from rategauge.operators.tracking import add_tracking, file_name_column
from rategauge.plans.deviations import join_deviations
from rategauge.plans.manifest import BaseMoved, Manifest, Part, publish
from rategauge.plans.scratch import stored
from rategauge.plans.summaries import of_groups, summaries
from rategauge.plans.store import ACCEPTED, MERGE, OUTCOME, REJECTED, RUN, RUN_MONTH, Store
from rategauge.roles import LISTING, Roles
from rategauge.schemas import AUDIT_TABLE, average_table, classified_table, extremes_table, ranked_table, states_table
from rategauge.sinks.files import write_parquet
from rategauge.sources.guards import require_rows
from rategauge.sources.listings import listing_parts, month_file, united
from rategauge.sources.tables import SIDE

SUCCESS = "SUCCESS"
FAILED = "FAILED"


@dataclass(frozen=True)
class MonthlyRun:
    """One run: what it reads, where it writes, how it is labelled.

    Lists hold ``top_k`` records per data month and group.  ``roles`` are kept with
    the tables; a root takes runs of one mapping only.  A run that is repeated with
    the ``token`` of one that was published changes nothing and counts once.
    """

    month: str
    path: str
    root: str
    run_name: str
    run_type: str = "scheduled"
    top_k: int = 10
    multi_line: bool | None = None
    started: datetime | None = None
    roles: Roles = LISTING
    token: str | None = None


@dataclass(frozen=True)
class _Job:
    """A run under way: its files by run month, and how a row tells its run month."""

    id: str
    run: MonthlyRun
    files: dict[str, str]
    run_month: Column

    def folder(self, store: Store, table: str) -> str:
        return store.path(table, f"{RUN}={self.id}")

    def tracked(self, df: DataFrame, source: str | Column) -> DataFrame:
        return add_tracking(df, source, self.run.run_name, self.run.run_type, self.run.started)


def _check_roles(manifest: Manifest, roles: Roles) -> None:
    if manifest.roles not in (None, roles):
        raise ValueError(f"the tables were made with {manifest.roles}, not with {roles}")


def side_by_side(spark: SparkSession, *writes: Callable[[], object]) -> None:
    """Submit independent writes together, so that small ones fill what a large one leaves idle.

    All end before the first failure, in the order given, is raised.
    """
    with ThreadPoolExecutor(len(writes)) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for write in done:
        write.result()


# -- a run's own folder -----------------------------------------------------------


def _store_classified(store: Store, job: _Job) -> DataFrame:
    """The only pass over the raw files.  Files are sorted by month, which costs no shuffle."""
    roles, paths = job.run.roles, list(job.files.values())
    parts = listing_parts(store.spark, paths, multi_line=job.run.multi_line)
    require_rows(united(parts), ", ".join(paths))
    columns = (
        *(F.col(name).cast("string").alias(name) for name in roles.columns),
        file_name_column().alias("source_file"),
        job.run_month.alias(RUN_MONTH),
    )
    raw = united([part.select(*columns) for part in parts])
    schema = classified_table(roles)
    rows = job.tracked(classify(raw, roles), F.col("source_file"))
    outcome = F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED)
    rows = rows.select(*schema.names, RUN_MONTH, outcome.alias(OUTCOME))
    rows = rows.sortWithinPartitions(RUN_MONTH, OUTCOME, "year_month")
    write_parquet(rows, job.folder(store, "classified"), [RUN_MONTH, OUTCOME])
    records = store.read("classified", schema, [f"{RUN}={job.id}"], RUN, RUN_MONTH, OUTCOME)
    filled = {row[0] for row in records.select(RUN_MONTH).distinct().collect()}
    for month, path in job.files.items():
        if month not in filled:
            raise ValueError(f"no data found in {path}: check the path and the filters")
    return records


def _store_audit(store: Store, job: _Job, status: str, message: str, counts: DataFrame) -> None:
    """Audit rows of a run, in its own folder: a retry replaces them, the manifest counts them once."""
    path_of = F.create_map(*(F.lit(x) for pair in job.files.items() for x in pair))
    label = {
        "final_log_file_name": F.lit(job.run.run_name),
        "timestamp": F.lit(job.run.started).cast("timestamp"),
        "month": F.col(RUN_MONTH),
        "run_type": F.lit(job.run.run_type),
        "file_path": path_of[F.col(RUN_MONTH)],
        "status": F.lit(status),
        "message": F.lit(message),
    }
    rows = counts.withColumns(label)
    known = set(rows.columns)
    shaped = rows.select(
        *((F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in AUDIT_TABLE)
    )
    write_parquet(shaped.coalesce(1), job.folder(store, "run_audit"))


def _store_run(store: Store, job: _Job) -> dict[str, Part]:
    """Records, sums, extremes and audit of a run; none of it visible yet."""
    roles = job.run.roles
    records = _store_classified(store, job)
    keys = [RUN_MONTH, "year_month", roles.group]
    clean = records.filter(F.col(OUTCOME) == ACCEPTED)
    clean = clean.select(RUN_MONTH, *roles.columns, "price_num", "year_month", "source_file")
    sums = clean.groupBy(*keys).agg(F.count("*").alias("listing_count"), exact_total(F.col("price_num")).alias("cents"))
    counts = quality_totals(records, [RUN_MONTH, "source_file", "year_month"])
    side_by_side(
        store.spark,
        lambda: write_parquet(sums.select(*states_table(roles).names), job.folder(store, "states")),
        lambda: _store_audit(store, job, SUCCESS, "completed", counts),
    )
    states = store.read("states", states_table(roles), [f"{RUN}={job.id}"])
    extremes = summaries(clean, states, job.run.top_k, keys, roles)
    write_parquet(extremes.select(*extremes_table(roles).names), job.folder(store, "extremes"))

    held: dict[str, list[str]] = {month: [] for month in job.files}
    for run_month, month in states.select(RUN_MONTH, "year_month").distinct().collect():
        held[run_month].append(month)
    return {run_month: Part(job.id, tuple(sorted(months))) for run_month, months in held.items()}


# -- the months it touches --------------------------------------------------------


def merged_averages(store: Store, months: set[str]) -> DataFrame:
    """Averages of the months from the sums of all live runs; no record is read."""
    keys = ["year_month", store.roles.group]
    total = store.states(months).groupBy(*keys).agg(
        exact_sum(F.col("listing_count")).alias("listing_count"), exact_sum(F.col("cents")).alias("cents")
    )
    return total.select(*keys, "listing_count", mean_of(F.col("cents"), F.col("listing_count")).alias("avg_price"))


def merged_top_lists(store: Store, averages: DataFrame, months: set[str], k: int) -> DataFrame:
    """Both sides' lists from the extremes of all live runs; a record of both may stand there once.

    Groups that every run kept whole are ranked from what they kept, the others by
    their extremes; so are all where whole groups hold the fewer rows.
    """
    roles = store.roles
    keys = ["year_month", roles.group]
    extremes, whole = store.extremes(months), F.col(SIDE) == WHOLE
    sizes = dict(extremes.groupBy(whole).count().collect())
    if sizes.get(True, 0) <= sizes.get(False, 0):
        return _settled_lists(store, on_sides(extremes) if True in sizes else extremes, averages, months, k)
    if False not in sizes:
        return whole_lists(join_deviations(extremes, averages, roles), k, keys, roles).drop(RUN_MONTH)
    cut = stored(extremes.filter(~whole).groupBy(*keys).agg(F.count("*").alias("listing_count")), "cut")
    rest = on_sides(of_groups(extremes, cut, keys, "left_semi", roles))
    extremes = of_groups(extremes, cut, keys, "left_anti", roles)
    lists = whole_lists(join_deviations(extremes, averages, roles), k, keys, roles).drop(RUN_MONTH)
    return lists.unionByName(_settled_lists(store, rest, averages, months, k))


def _settled_lists(store: Store, extremes: DataFrame, averages: DataFrame, months: set[str], k: int) -> DataFrame:
    """Both sides' lists from extremes of either side.

    Records are read only of groups whose extremes do not settle their list.
    """
    roles = store.roles
    keys = ["year_month", roles.group]
    extremes = join_deviations(extremes, averages, roles)
    lists, short = merged_lists(stored(extremes, "extremes"), k, keys, roles)
    lists, short = lists.drop(RUN_MONTH), stored(short, "short")
    if short.isEmpty():
        return lists
    records = records_of(store, short, months)
    sides = zip((OVER, UNDER), top_over_under(join_deviations(records, averages, roles), k, roles, partition_by=keys))
    lists = lists.join(short, keys, "left_anti")
    for side, top in sides:
        lists = lists.unionByName(top.withColumn(SIDE, F.lit(side)))
    return lists


def records_of(store: Store, groups: DataFrame, months: set[str]) -> DataFrame:
    """Accepted records of the named months and groups of all live runs."""
    roles = store.roles
    records = store.classified(ACCEPTED, months=months)
    records = records.select(*roles.columns, "price_num", "year_month", "source_file")
    return records.join(groups.select("year_month", roles.group), ["year_month", roles.group], "left_semi")


def _merge(store: Store, job: _Job, parts: dict[str, Part]) -> Manifest:
    """Write averages and lists of all months that ``parts`` add to or take from; what to publish."""
    base, roles, k = store.manifest, job.run.roles, job.run.top_k
    live = base.parts | parts
    gone = {m for run_month in parts if run_month in base.parts for m in base.parts[run_month].months}
    touched = gone | {m for part in parts.values() for m in part.months}
    months = touched & {m for part in live.values() for m in part.months}
    name = f"{job.id}-{base.version + 1}"
    manifest = replace(
        base,
        version=base.version + 1,
        roles=roles,
        parts=live,
        merged={m: r for m, r in base.merged.items() if m not in touched} | dict.fromkeys(months, name),
        top_k={m: n for m, n in base.top_k.items() if m not in touched} | dict.fromkeys(months, k),
        audits=(*base.audits, job.id),
    )
    after = store.at(manifest)
    if months:
        averages = job.tracked(merged_averages(after, months), job.run.path)
        averages = averages.select(*average_table(roles).names).hint("rebalance", F.col("year_month"))
        write_parquet(averages, store.path("avg_price", f"{MERGE}={name}"), ["year_month"])
        held = after.averages().filter(F.col("year_month").isin(sorted(months)))
        held = held.select("year_month", roles.group, "listing_count", "avg_price")
        lists = merged_top_lists(after, held, months, k).hint("rebalance", F.col("year_month"))
        lists = job.tracked(lists, F.col("source_file")).select(*ranked_table(roles).names, SIDE)
        write_parquet(lists, store.path("top_priced", f"{MERGE}={name}"), ["year_month"])
    return manifest


def _publish(store: Store, job: _Job, parts: dict[str, Part]) -> Store:
    """Merge and publish; where another run came first, merge again with it."""
    while True:
        store = Store.open(store.spark, store.root)
        if job.id in store.manifest.audits:
            return store
        _check_roles(store.manifest, job.run.roles)
        manifest = _merge(store, job, parts)
        try:
            publish(store.spark, store.root, manifest)
        except BaseMoved:
            continue
        return store.at(manifest)


def _publish_failure(store: Store, job: _Job, error: Exception) -> None:
    """Record a failure without hiding it behind one of the audit's own."""
    try:
        failed = replace(job, id=f"failed-{uuid.uuid4().hex}")
        months = store.spark.createDataFrame([(m,) for m in job.files], f"{RUN_MONTH} string")
        _store_audit(store, failed, FAILED, f"{type(error).__name__}: {error}", months)
        while True:
            base = Store.open(store.spark, store.root).manifest
            try:
                audits = (*base.audits, failed.id)
                publish(store.spark, store.root, replace(base, version=base.version + 1, audits=audits))
                return
            except BaseMoved:
                continue
    except Exception as audit_error:
        error.add_note(f"the audit row could not be written: {audit_error}")


def _run(spark: SparkSession, run: MonthlyRun, files: dict[str, str], run_month: Column) -> Store:
    store = Store(spark, run.root.rstrip("/"), Manifest())
    job = _Job(run.token or uuid.uuid4().hex, replace(run, started=run.started or datetime.now(timezone.utc)), files, run_month)
    try:
        store = Store.open(spark, run.root)
        if job.id in store.manifest.audits:
            return store
        _check_roles(store.manifest, run.roles)
        parts = _store_run(store.at(replace(store.manifest, roles=run.roles)), job)
        return _publish(store, job, parts)
    except Exception as error:
        _publish_failure(store, job, error)
        raise


def run_month(spark: SparkSession, run: MonthlyRun) -> Store:
    """Read, classify, average, rank and publish one month; rerunning replaces it.

    Averages and lists belong to the month of the data, whatever files it came
    from.  An audit row is published whether the run succeeds or fails.
    """
    return _run(spark, run, {run.month: run.path}, F.lit(run.month))


def run_months(
    spark: SparkSession,
    months: Iterable[str],
    input_path: str,
    root: str,
    run_name: str,
    run_type: str = "adhoc",
    name: str = "listings",
    extension: str = "csv",
    **options,
) -> Store:
    """Backfill: all months in one pass and one publication, each replacing its own records.

    ``name`` and ``extension`` are those of the input files, whose names tell the run
    month of each row; ``options`` are further :class:`MonthlyRun` fields.  The number
    of Spark jobs does not depend on the number of months.  If one file is missing or
    empty nothing is published, and the backfill can simply be run again.
    """
    files = {month: month_file(input_path, month, name, extension) for month in months}
    pattern = rf"/{re.escape(name)}_([^/]*)\.{re.escape(extension)}(?:/|$)"
    run = MonthlyRun(", ".join(files), input_path, root, run_name, run_type, **options)
    return _run(spark, run, files, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))
