"""The star schema on Parquet (S4-S6): snapshots, idempotent loads, loads that read only what their keys touch.

Layout under ``root``::

    _log/entry=<id>/                                         entries of the loads: claim, commit, release
    tbl_periodo/carga=<folder>/ ...                          dimensions (small)
    T_precios/carga=<folder>/id_indicador=<id>/anio_hecho=<year>/ ...   facts
    _loads/<folder>/annotated/target=<table>/                parsed payload rows of each load (rejects flagged)

*Snapshot.*  Every run of a load writes folders of its own (load id and a run id) and names them in the log as its last
step.  Readers read the log first and then only the folders of committed runs, the last one of each load id.  So a
reader sees a load as a whole or not at all, and a load run again under its id (a replayed stream batch, a retry after
a crash) replaces the earlier run.  A committed load that others followed stays: they refer to its members.

*One writer.*  A load begins with a claim in the log.  If another load id has a claim that was neither committed nor
released, or if one appears beside it, the load stops with ``ConcurrentLoad`` and releases its own claim: of two loads at
once at most one goes through (both may stop).  A run of the same load id takes the claim over, and the run it came
from can't commit any more.  A claim left by a process that died is taken over by its own load id, or given up by
``abandon``.

*Loads stay cheap.*  A fact's indicator and year follow from its key, and facts lie in folders of both.  Insert-or-ignore
reads the stored keys of those folders alone that the load has rows for.

A load runs as written steps, each reading the previous step's output, so lineage is cut at every table and a lost
executor only re-runs the current step: stage the annotated payload -> append new dimension members -> re-read the
dimensions -> append new facts -> commit.  Insert-or-ignore makes a repeated load add nothing to keyed tables (prices,
wages); employment rows always carry a NULL key part and are appended again, as the source behaviour does.

``root`` should be on shared storage (by default a folder under the session's ``spark.checkpoint.dir``) whose listing
shows what was written; nothing is ever overwritten or removed.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens import schemas as S
from wagelens.plans import ingest as I
from wagelens.session import scratch_path

FACT_PARTITIONS = ["id_indicador", S.FACT_YEAR]
LOAD_PARTITION = "carga"
DIMENSIONS = ("tbl_periodo", "tbl_indicador", "tbl_geografia")
_LOG = "load string, folder string, kind string, seq long"


class ConcurrentLoad(RuntimeError):
    """Another load of the warehouse has begun and is neither committed nor released."""


@dataclass
class LoadReport:
    load_id: str
    annotated_path: str
    rejects: int
    added: dict


class Warehouse:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or scratch_path(spark, f"warehouse-{uuid.uuid4().hex[:12]}")).rstrip("/")

    # ---------------------------------------------------------------- log

    def _entries(self) -> list:
        """The log; a few entries a load."""
        try:
            return self.spark.read.schema(_LOG).json(f"{self.root}/_log").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def _append(self, load_id: str, folder: str, kind: str, seq: int = 0) -> None:
        # a folder for each entry: two jobs that write into one folder would clear each other's temporary files
        entry = f"{self.root}/_log/entry={uuid.uuid4().hex}"
        self.spark.createDataFrame([(load_id, folder, kind, seq)], _LOG).coalesce(1).write.json(entry)

    @staticmethod
    def _folders(entries: list, kind: str) -> set[str]:
        return {e.folder for e in entries if e.kind == kind}

    def live(self, without: str | None = None) -> list[str]:
        """Folders of the committed loads, the last run of each; ``without``: a load id to leave out."""
        entries = self._entries()
        released, last = self._folders(entries, "release"), {}
        for e in entries:
            if e.kind == "commit" and e.folder not in released and e.load != without:
                last[e.load] = max(last.get(e.load, (-1, "")), (e.seq, e.folder))
        return [folder for _, folder in sorted(last.values())]

    def _pending(self, entries: list, but: str) -> set[tuple[str, str]]:
        """(load id, folder) of claims that are open, but for the run ``but``."""
        over = self._folders(entries, "commit") | self._folders(entries, "release")
        return {(e.load, e.folder) for e in entries if e.kind == "claim" and e.folder not in over and e.folder != but}

    def _claim(self, load_id: str, folder: str) -> None:
        for load, other in self._pending(self._entries(), folder):
            if load != load_id:
                raise ConcurrentLoad(f"load {load!r} has begun and is not committed; wait, run it again, or abandon({load!r})")
            self._append(load, other, "release")  # an earlier run of this load: taken over
        self._append(load_id, folder, "claim")
        others = self._pending(self._entries(), folder)
        if others:
            self._append(load_id, folder, "release")
            raise ConcurrentLoad(f"load {min(others)[0]!r} began at the same time")

    def _commit(self, load_id: str, folder: str) -> None:
        entries = self._entries()
        if folder in self._folders(entries, "release"):
            raise ConcurrentLoad(f"another run of load {load_id!r} has taken over")
        self._append(load_id, folder, "commit", 1 + sum(e.kind == "commit" for e in entries))

    def abandon(self, load_id: str) -> None:
        """Give up the open claims of a load whose process is gone; nothing of it is read."""
        for load, folder in self._pending(self._entries(), ""):
            if load == load_id:
                self._append(load, folder, "release")

    # ---------------------------------------------------------------- tables

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        """The rows of a table in the given folders; facts with their year."""
        if name not in S.TABLES:
            raise S.UnknownTable(name)
        year = [T.StructField(S.FACT_YEAR, T.IntegerType())] if name.startswith("T_") else []
        wanted = T.StructType([*S.TABLES[name].fields, *year])
        if not folders:
            return self.spark.createDataFrame([], wanted)
        schema = T.StructType([*wanted.fields, T.StructField(LOAD_PARTITION, T.StringType())])
        stored = self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*(f"{self.path(name)}/{LOAD_PARTITION}={f}" for f in folders))
        return stored.select(*wanted.fieldNames())

    def _write(self, df: DataFrame, name: str, folder: str) -> None:
        fact = name.startswith("T_")
        writer = df.select(*S.TABLES[name].fieldNames(), *([S.FACT_YEAR] if fact else [])).write
        if fact:
            writer = writer.partitionBy(*FACT_PARTITIONS)
        writer.parquet(f"{self.path(name)}/{LOAD_PARTITION}={folder}")

    def create(self) -> "Warehouse":
        """A warehouse without tables gets every table (empty, with its schema)."""
        if not self.live():
            folder = f"0.{uuid.uuid4().hex[:8]}"
            self._claim("0", folder)
            for name in S.TABLES:
                self._write(self._read(name, []), name, folder)
            self._commit("0", folder)
        return self

    def table(self, name: str, without: str | None = None) -> DataFrame:
        """A stored table; a table never written reads as empty (same schema).  ``without``: a load to leave out."""
        return self._read(name, self.live(without)).select(*S.TABLES[name].fieldNames())

    def star(self, without: str | None = None) -> I.Star:
        """One snapshot of all tables; ``empty`` when nothing was ever loaded."""
        folders = self.live(without)
        if not folders:
            return I.empty_star(self.spark)
        return I.Star(*[self._read(n, folders) for n in S.TABLES])

    # ---------------------------------------------------------------- loads

    def load(self, obs: DataFrame, raise_on_reject: bool = False, null_keys_conflict: bool = False,
             load_id: str | None = None) -> LoadReport:
        """One idempotent load of an exploded payload (see module doc); the same ``load_id`` replaces that load."""
        load_id = load_id or uuid.uuid4().hex[:12]
        folder = f"{load_id}.{uuid.uuid4().hex[:8]}"
        commits = [e for e in self._entries() if e.kind == "commit"]
        own = [e for e in commits if e.load == load_id]
        if own and max(commits, key=lambda e: e.seq).load != load_id:
            # Later loads refer to its dimension members: it stays as it is.
            path = f"{self.root}/_loads/{max(own, key=lambda e: e.seq).folder}/annotated"
            return LoadReport(load_id, path, I.split(self.spark.read.parquet(path)).rejects.count(), {})
        self._claim(load_id, folder)
        try:
            report = self._load(obs, raise_on_reject, null_keys_conflict, load_id, folder)
        except Exception:
            self._append(load_id, folder, "release")
            raise
        return report

    def _load(self, obs: DataFrame, raise_on_reject: bool, null_keys_conflict: bool, load_id: str, folder: str) -> LoadReport:
        before = self.live(without=load_id)
        stored = I.Star(*[self._read(n, before) for n in S.TABLES]) if before else I.empty_star(self.spark)
        path = f"{self.root}/_loads/{folder}/annotated"
        # one pass over the payload; each fact then reads only its own target's rows
        annotated = I.annotate(obs)
        annotated.write.partitionBy("target").parquet(path)
        annotated = self.spark.read.schema(annotated.schema).parquet(path)
        rejected = F.col("series_reason").isNotNull() | F.col("datum_reason").isNotNull()
        found = annotated.agg(F.count_if(rejected).alias("rejects"), F.count_if(F.col("series_reason").isNull()).alias("rows")).first()
        parsed = I.split(annotated)
        if raise_on_reject:
            I.check_rejects(parsed.rejects)
        if not found.rows:          # S6: empty input -> nothing written
            self._append(load_id, folder, "release")
            return LoadReport(load_id, path, found.rejects, {})

        for name, df in zip(DIMENSIONS, I.new_dimensions(parsed.rows, stored), strict=True):
            self._write(df, name, folder)
        dims = I.Star(*[self._read(n, [*before, folder]) for n in DIMENSIONS], *[None] * 3)

        facts = I.new_facts(parsed.rows, dims, self._touched(parsed.rows, dims, stored), null_keys_conflict, years=True)
        for name, df in facts.items():
            self._write(df, name, folder)
        self._commit(load_id, folder)
        return LoadReport(load_id, path, found.rejects, dict.fromkeys(facts))  # counted on request: counts()

    def _touched(self, rows: DataFrame, dims: I.Star, stored: I.Star) -> I.Star:
        """The stored tables, facts cut to the folders (indicator, year) that the load has rows for: at most 7 indicators' years."""
        if stored.empty:
            return stored
        named = {r.nombre: r.id_indicador for r in dims.indicador.collect()}  # one per source of the registry
        own = defaultdict(lambda: defaultdict(set))
        for r in rows.filter("has_datum").select("target", "indicador", F.year("fecha_iso").alias("year")).distinct().collect():
            own[r.target][named[r.indicador]].add(r.year)

        def cut(name: str, facts: DataFrame) -> DataFrame:
            keep = F.lit(False)
            for indicator, years in sorted(own[name].items()):
                keep = keep | ((F.col("id_indicador") == indicator) & F.col(S.FACT_YEAR).isin(sorted(years)))
            return facts.where(keep)

        return I.Star(stored.periodo, stored.indicador, stored.geografia, *(cut(n, f) for n, f in zip(
            ("T_precios", "T_salarios", "T_empleo"), (stored.precios, stored.salarios, stored.empleo), strict=True)))

    def staged(self, report: LoadReport) -> I.Parsed:
        """Parsed rows and rejects of a past load (read back from its staging table)."""
        return I.split(self.spark.read.parquet(report.annotated_path))

    def counts(self) -> DataFrame:
        """Row count per table (S6 style report)."""
        out = None
        folders = self.live()
        for name in S.TABLES:
            c = self._read(name, folders).agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
            out = c if out is None else out.unionByName(c)
        return out
