"""A table of the latest row per key, kept as runs in levels, so that a stream can write to it at every trigger for good.

Each micro-batch becomes a run. Once ``fan`` runs of a level have gathered they are merged into one run of the next level,
the latest row per key; so there are fewer than ``fan`` runs per level, as many levels as the logarithm of the number of
triggers, and a row is rewritten once per level. A manifest per micro-batch names the runs that count; it is written last
and always follows from the manifests before its own micro-batch, so one that is repeated after a failure, or fails half
way, leaves nothing behind that a reader would see. Runs that neither of the last two manifests names are deleted; a
reader that lags further behind has to open the table again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Levels:
    """``keys`` name a row; without keys the table holds one row."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str], fan: int = 8):
        self.spark, self.folder, self.schema, self.keys, self.fan = spark, folder.rstrip("/"), schema, list(keys), fan
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _manifests(self) -> list[int]:
        folder = self._path(f"{self.folder}/manifest")
        if not self._files.exists(folder):
            return []
        return sorted(int(name) for s in self._files.listStatus(folder) if (name := s.getPath().getName()).isdigit())

    def runs(self, before: int | None = None) -> list[dict]:
        """The runs that count, oldest first: now, or before a micro-batch."""
        numbers = [n for n in self._manifests() if before is None or n < before]
        if not numbers:
            return []
        stream = self._files.open(self._path(f"{self.folder}/manifest/{numbers[-1]:012d}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _rows(self, runs: list[dict]) -> DataFrame:
        """The latest row per key of some runs; a run itself holds each key once."""
        parts = [
            self.spark.read.schema(self.schema).parquet(f"{self.folder}/{run['name']}").withColumn("_run", F.lit(place))
            for place, run in enumerate(runs)
        ]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        if len(parts) == 1:
            return parts[0].drop("_run")
        values = [name for name in self.schema.names if name not in self.keys]
        every = reduce(DataFrame.unionByName, parts)
        if not values:
            return every.select(*self.keys).distinct()
        # Column by column: numbers then stay in hash aggregation, where a struct would need a sort.
        latest = every.groupBy(*self.keys).agg(*(F.max_by(name, "_run").alias(name) for name in values))
        return latest.select(*self.schema.names)

    def read(self, before: int | None = None) -> DataFrame:
        return self._rows(self.runs(before))

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> dict:
        name = f"level={level}/run={first:012d}-{last:012d}"
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return {"name": name, "level": level, "first": first, "last": last}

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Enter a micro-batch, which holds each key at most once."""
        runs = [*self.runs(batch_id), self._write(rows, 0, batch_id, batch_id)]
        while True:
            level = runs[-1]["level"]
            full = [run for run in runs if run["level"] == level]
            if len(full) < self.fan:
                break
            runs = [run for run in runs if run["level"] != level]
            runs.append(self._write(self._rows(full), level + 1, full[0]["first"], full[-1]["last"]))
        self._commit(runs, batch_id)

    def replace(self, rows: DataFrame, batch_id: int) -> None:
        """Let a micro-batch take the place of all before it."""
        self._commit([self._write(rows, 0, batch_id, batch_id)], batch_id)

    def _commit(self, runs: list[dict], batch_id: int) -> None:
        before = self.runs(batch_id)
        out = self._files.create(self._path(f"{self.folder}/manifest/{batch_id:012d}"), True)
        out.write(json.dumps(runs).encode())
        out.close()
        needed = {run["name"] for run in [*before, *runs]}
        for level in self._files.listStatus(self._path(self.folder)):
            if level.getPath().getName().startswith("level="):
                for run in self._files.listStatus(level.getPath()):
                    if f"{level.getPath().getName()}/{run.getPath().getName()}" not in needed:
                        self._files.delete(run.getPath(), True)
        for old in self._manifests()[:-2]:
            self._files.delete(self._path(f"{self.folder}/manifest/{old:012d}"), False)
