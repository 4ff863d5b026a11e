"""The summaries of the gold layer kept up to date load by load (Q4-Q9).

A load only adds facts, so each load's rows can be summed up once: the moments of its wages per (date, sex, sector,
region), of its general index per date and of its unemployment per (date, sex) are written beside the load and never
change.  The summaries merge the moments of the live loads (Chan's formula for variances), join the three sides and go
on as the factorised summaries do.  So a new batch costs a scan of that batch, and a summary costs a scan of the moments,
whose size is bounded by dates, sexes, sectors and regions for each load.

A load that was run again is another folder with moments of its own, so a replayed batch is not counted twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.operators import factorised as FZ
from wagelens.plans import gold as G
from wagelens.plans import ingest as I
from wagelens.sources.warehouse import DIMENSIONS, Warehouse

GRAIN = ["sector_cnae", "comunidad"]
SIDES = ("salarios", "indice", "paro")
DONE = "view"  # log entry of a load whose moments are written


@dataclass
class GoldMoments:
    """Stands in for ``gold.GoldParts`` in the factorised summaries."""
    wages: DataFrame
    index: DataFrame
    paro: DataFrame

    def where(self, cond: Column) -> "GoldMoments":
        """Filter on date, sex, sector or region of the wages."""
        return GoldMoments(self.wages.where(cond), self.index, self.paro)

    def blocks(self, grain: Sequence[str]) -> DataFrame:
        wages = FZ.merged(self.wages, ["fecha_iso", "sexo", *grain], "w", "w")
        index = FZ.merged(self.index, ["fecha_iso"], "p", "q")
        paro = self.paro.groupBy("fecha_iso", "sexo").agg(F.sum("n_e").alias("n_e"), F.sum("s_e").alias("s_e"))
        return FZ.joined(wages, index, paro, grain)

    def latest_index(self) -> DataFrame:
        return self.index.agg(F.max(F.struct("fecha_iso", "last")).alias("l")).select(F.col("l.last.valor_ipc").alias("valor"))


class GoldView:
    def __init__(self, warehouse: Warehouse):
        self.wh, self.spark = warehouse, warehouse.spark

    def _path(self, side: str, folder: str) -> str:
        return f"{self.wh.root}/_view/{side}/{folder}"

    def batch(self, folder: str, live: Sequence[str]) -> I.Star:
        """The facts of one load, with the dimension members of all (its facts may refer to earlier ones)."""
        facts = [self.wh._read(n, [folder]) for n in ("T_precios", "T_salarios", "T_empleo")]
        return I.Star(*[self.wh._read(n, list(live)) for n in DIMENSIONS], *facts)

    def refresh(self) -> list[str]:
        """Write the moments of every live load that has none; returns the loads' folders."""
        live = self.wh.live()
        done = self.wh._folders(self.wh._entries(), DONE)
        fresh = [f for f in live if f not in done]
        for folder in fresh:
            parts = G.gold_parts(self.batch(folder, live))
            index = FZ.index_side(parts.index).join(
                parts.index.groupBy("fecha_iso").agg(F.max(F.struct("indicador", "valor_ipc")).alias("last")), "fecha_iso")
            for side, df in zip(SIDES, (FZ.wage_side(parts.wages, GRAIN), index, FZ.unemployment_side(parts.paro)), strict=True):
                df.write.mode("overwrite").parquet(self._path(side, folder))  # an unfinished attempt is not in the log
            self.wh._append(folder.rpartition(".")[0], folder, DONE)
        return fresh

    def moments(self) -> GoldMoments | None:
        """The moments of the live loads; None before the first refresh."""
        done = self.wh._folders(self.wh._entries(), DONE)
        ready = [f for f in self.wh.live() if f in done]
        if not ready:
            return None
        return GoldMoments(*(self.spark.read.parquet(*(self._path(side, f) for f in ready)) for side in SIDES))
