"""Stored tables that a stream keeps current: a compacted base and the deltas of later batches.

::

    manifest/00000007.json            runs, what of them is folded into the base, the base's folders
    base/generation=6/<partition>/    rows, one per key, sorted by it
    deltas/run=1/batch_id=42/         the rows of one micro-batch, replaced when it is replayed

A *run* is one checkpoint's life. A new checkpoint over an old folder counts its batches from 0 again, so rows are ordered by
(run, batch), and the newest run wins. Older runs are fenced: their next batch is refused. The manifest is a chain of
numbered files that are created once; whoever finds the next number taken reads it and tries again.

Readers take the base and the deltas after it, so compaction may happen at any time, between the batches of a running job too.
It rewrites only the partitions that the deltas touch. Folders a manifest no longer names are kept for one
more compaction, for readers that began before it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.spread import latest_per_key
from wayfare.sources.files import Files

ORDER = ("run", "batch_id")
KEPT_MANIFESTS = 10
EMPTY = {"runs": [], "folded": {}, "base": {}, "before": {"folded": {}, "base": {}}, "schema": None}


class Superseded(RuntimeError):
    """A newer checkpoint writes to the table."""


class MaintainedTable:
    """One row per key: the last written, or what ``fold`` makes of all rows of the key.

    ``version`` orders the rows of a key within a batch. ``fold`` takes a frame and the full order, and must give the same when
    it is applied to its own results and later rows. Tables with ``partitions`` keep a base for each of their values.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[str] = (),
                 partitions: Sequence[str] = (), fold: Callable[[DataFrame, list[str]], DataFrame] | None = None):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)
        self.keys, self.partitions, self.fold = list(keys), list(partitions), fold
        self.order = [*ORDER, *version]

    # The manifest.

    def manifest(self) -> tuple[int, dict]:
        names = [n for n in self.files.names("manifest") if n.endswith(".json")]
        if not names:
            return 0, EMPTY
        return int(names[-1].removesuffix(".json")), json.loads(self.files.text(f"manifest/{names[-1]}"))

    def _commit(self, number: int, state: dict) -> bool:
        done = self.files.create(f"manifest/{number:08d}.json", json.dumps(state))
        if done and number > KEPT_MANIFESTS:
            self.files.delete(f"manifest/{number - KEPT_MANIFESTS:08d}.json")
        return done

    def open_run(self, run: str, schema: T.StructType) -> int:
        """The number of a run; an unknown one becomes the newest."""
        while True:
            number, state = self.manifest()
            if run not in state["runs"]:
                if not self._commit(number + 1, {**state, "runs": [*state["runs"], run], "schema": schema.jsonValue()}):
                    continue
                return len(state["runs"])
            if state["runs"][-1] != run:
                raise Superseded(f"{self.path} belongs to a newer checkpoint")
            return state["runs"].index(run)

    # Rows.

    def append(self, rows: DataFrame, run: str, batch_id: int) -> None:
        """Store the rows of a batch, evaluated once; a replayed batch replaces itself."""
        number = self.open_run(run, rows.schema)
        rows.write.mode("overwrite").parquet(f"{self.path}/deltas/run={number}/batch_id={batch_id}")

    def _schema(self, state: dict, *more: str) -> T.StructType:
        own = T.StructType.fromJson(state["schema"])
        fields = [f for f in own if f.name not in ORDER]
        return T.StructType(fields + [T.StructField(n, T.IntegerType() if n != "batch_id" else T.LongType()) for n in (*ORDER, *more)])

    def later(self, state: dict) -> list[tuple[int, int]]:
        """(run, batch) of the deltas that the base does not hold."""
        found = []
        for run in self.files.names("deltas"):
            done = state["folded"].get(run.removeprefix("run="), -1)
            for batch in self.files.names(f"deltas/{run}"):
                at = int(batch.removeprefix("batch_id="))
                if at > done and self.files.exists(f"deltas/{run}/{batch}/_SUCCESS"):
                    found.append((int(run.removeprefix("run=")), at))
        return sorted(found)

    def _deltas(self, state: dict, later: list[tuple[int, int]]) -> DataFrame:
        return (self.spark.read.schema(self._schema(state)).option("basePath", f"{self.path}/deltas")
                .parquet(*[f"{self.path}/deltas/run={r}/batch_id={b}" for r, b in later]))

    def _base(self, state: dict, only: set[str] | None = None) -> DataFrame | None:
        paths = [f"{self.path}/base/generation={g}/{p}".rstrip("/") for p, g in sorted(state["base"].items()) if only is None or p in only]
        if not paths:
            return None
        return (self.spark.read.schema(self._schema(state, "generation")).option("basePath", f"{self.path}/base")
                .parquet(*paths).drop("generation"))

    def _merged(self, base: DataFrame | None, deltas: DataFrame | None) -> DataFrame:
        if deltas is None:
            return base
        if self.fold:
            return self.fold(deltas if base is None else base.unionByName(deltas), self.order)
        last = latest_per_key(deltas, self.keys, self.order)
        if base is None:
            return last
        # The base already has one row per key: it is not shuffled where the keys of the deltas can be sent to it.
        again = last.select([F.col(k).alias(f"_new_{k}") for k in self.keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in self.keys])
        return base.join(again, same, "left_anti").unionByName(last)

    def current(self) -> DataFrame:
        """One row per key, as of the last finished batch."""
        _, state = self.manifest()
        later = self.later(state)
        if not later and not state["base"]:
            raise FileNotFoundError(f"no batch has been stored in {self.path}")
        rows = self._merged(self._base(state), self._deltas(state, later) if later else None)
        return rows.drop(*ORDER)

    def compact(self) -> bool:
        """Fold the deltas into the base; False if there is nothing to do or another compaction came first."""
        number, state = self.manifest()
        later = self.later(state)
        if not later:
            return False
        deltas, touched = self._deltas(state, later), None
        if self.partitions:
            # A row per partition that the deltas touch; names as Spark writes them are found where they were written.
            touched = self._folders_of(deltas, state)
        rows = self._merged(self._base(state, touched), deltas)
        generation = f"base/generation={number + 1}"
        by = [*self.partitions, *self.keys]
        writer = rows.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite")
        (writer.partitionBy(*self.partitions) if self.partitions else writer).parquet(f"{self.path}/{generation}")
        written = self.files.folders(generation, len(self.partitions))
        folded = {**state["folded"], **{str(run): batch for run, batch in later}}
        new = {**state, "folded": folded, "base": {**state["base"], **dict.fromkeys(written, number + 1)},
               "before": {"folded": state["folded"], "base": state["base"]}}
        if not self._commit(number + 1, new):
            return False
        self._clean(new)
        return True

    def _folders_of(self, deltas: DataFrame, state: dict) -> set[str]:
        """Base folders of the partitions that occur in the deltas."""
        values = {tuple(r) for r in deltas.select([F.col(p).cast("string") for p in self.partitions]).distinct().collect()}
        held = self._base(state)
        if held is None:
            return set()
        folders = {tuple(self._value(part) for part in folder.split("/")): folder for folder in state["base"]}
        return {folder for key, folder in folders.items() if key in values}

    def _value(self, part: str) -> str | None:
        value = part.partition("=")[2]
        catalog = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return None if value == catalog.DEFAULT_PARTITION_NAME() else catalog.unescapePathName(value)

    def _clean(self, state: dict) -> None:
        """Remove what neither this manifest nor the one before its compaction names."""
        for run, done in state["before"]["folded"].items():
            for batch in self.files.names(f"deltas/run={run}"):
                if int(batch.removeprefix("batch_id=")) <= done:
                    self.files.delete(f"deltas/run={run}/{batch}")
        named = {(g, p) for base in (state["base"], state["before"]["base"]) for p, g in base.items()}
        for name in self.files.names("base"):
            generation = int(name.removeprefix("generation="))
            for folder in self.files.folders(f"base/{name}", len(self.partitions)):
                if (generation, folder) not in named:
                    self.files.delete(f"base/{name}/{folder}".rstrip("/"))
            if generation not in {g for g, _ in named}:
                self.files.delete(f"base/{name}")
