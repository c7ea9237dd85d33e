"""The tables below a root, read through its manifest."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rategauge.operators.rank import of_side
from rategauge.plans.manifest import Manifest, current
from rategauge.roles import LISTING, Roles
from rategauge.schemas import (
    AUDIT_TABLE,
    average_table,
    classified_table,
    extremes_table,
    ranked_table,
    states_table,
)
from rategauge.sources.guards import reading
from rategauge.sources.tables import SIDE

RUN, RUN_MONTH, OUTCOME, MERGE = "run", "run_month", "outcome", "merge"
ACCEPTED, REJECTED = "accepted", "rejected"


@dataclass(frozen=True)
class Store:
    """One version of a root.  Folders that the manifest does not name are never listed."""

    spark: SparkSession
    root: str
    manifest: Manifest

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Store:
        root = str(root).rstrip("/")
        return cls(spark, root, current(spark, root))

    def at(self, manifest: Manifest) -> Store:
        return replace(self, manifest=manifest)

    @property
    def roles(self) -> Roles:
        return self.manifest.roles or LISTING

    def path(self, table: str, *parts: str) -> str:
        return "/".join([self.root, table, *parts])

    def read(self, table: str, schema: StructType, folders: Iterable[str], *parted: str) -> DataFrame:
        """Rows in the folders below ``table``; ``parted`` columns come from folder names, as text."""
        names = {f.name for f in schema}
        whole = StructType([*schema.fields, *(StructField(p, StringType(), True) for p in parted if p not in names)])
        paths = [self.path(table, folder) for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], whole)
        with reading(self.path(table)):
            return self.spark.read.schema(whole).option("basePath", self.path(table)).parquet(*paths)

    # -- what runs wrote --------------------------------------------------------

    def classified(self, outcome: str | None = None, run_month: str | None = None, months: Iterable[str] | None = None) -> DataFrame:
        """Records with their verdicts; of the runs, outcome and data months asked for.

        Runs without records of the months are not read, the files of others are
        sorted by month.
        """
        wanted = None if months is None else set(months)
        runs = self.manifest.runs_of(wanted)
        folders = [f"{RUN}={r}/{RUN_MONTH}={m}" for r, ms in runs.items() for m in ms if run_month in (None, m)]
        schema = classified_table(self.roles)
        rows = self.read("classified", schema, folders, RUN, RUN_MONTH, OUTCOME)
        if outcome is not None:
            rows = rows.filter(F.col(OUTCOME) == outcome)
        if wanted is not None:
            rows = rows.filter(F.col("year_month").isin(sorted(wanted)))
        return rows.select(*schema.names)

    def _of_runs(self, table: str, schema: StructType, months: set[str]) -> DataFrame:
        """Rows of live run months in the data months, from small tables that runs left."""
        runs = self.manifest.runs_of(months)
        rows = self.read(table, schema, [f"{RUN}={r}" for r in runs], RUN)
        live = F.lit(False)
        for run, run_months in runs.items():
            live |= (F.col(RUN) == run) & F.col(RUN_MONTH).isin(run_months)
        return rows.filter(F.col(RUN).isin(list(runs)) & live & F.col("year_month").isin(sorted(months))).select(*schema.names)

    def states(self, months: set[str]) -> DataFrame:
        return self._of_runs("states", states_table(self.roles), months)

    def extremes(self, months: set[str]) -> DataFrame:
        return self._of_runs("extremes", extremes_table(self.roles), months)

    def audit(self) -> DataFrame:
        """One row per run, source file and data month; each run counts once."""
        rows = self.read("run_audit", AUDIT_TABLE, [f"{RUN}={r}" for r in self.manifest.audits], RUN)
        return rows.select(*AUDIT_TABLE.names)

    # -- what was merged --------------------------------------------------------

    def _merged(self, table: str, schema: StructType, month: str | None, *more: str) -> DataFrame:
        held = self.manifest.merged
        months = sorted(held) if month is None else [month] if month in held else []
        rows = self.read(table, schema, [f"{MERGE}={held[m]}/year_month={m}" for m in months], MERGE, "year_month", *more)
        return rows if month is None else rows.filter(F.col("year_month") == month)

    def averages(self, month: str | None = None) -> DataFrame:
        """Averages per data month and group, of all live runs."""
        schema = average_table(self.roles)
        return self._merged("avg_price", schema, month).select(*schema.names)

    def ranked(self, side: str, month: str | None = None) -> DataFrame:
        """One side of the top lists; ``top_k`` records per data month and group."""
        schema = ranked_table(self.roles)
        rows = self._merged("top_priced", schema, month, SIDE)
        return rows.filter(of_side(side)).select(*schema.names)
