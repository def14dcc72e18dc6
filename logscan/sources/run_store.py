"""A table of keyed rows kept as sorted-out runs in levels.

Every batch adds a run of its changes at level 0.  Once ``fanout`` runs of a
level exist they are merged into one run of the next level, so after n batches
at most (fanout - 1) * log(n) / log(fanout) + 1 runs are live and every row is
rewritten once per level.  A run is bucketed by a hash of the key (one folder a
bucket): a lookup reads one bucket of each live run.

Replay-safe: a batch derives its runs from the manifest of the batch before it,
writes them under names that only depend on its number, and writes its own
manifest last.  Runs that no kept manifest names are deleted afterwards; the
last ``KEEP`` manifests are kept, so that a replayed batch and readers of an
older state still find their runs.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscan.sources.folder import Folder

KEEP = 3
BUCKET = "_bucket"


class RunStore:
    def __init__(self, spark: SparkSession, path: str, key: str, merge: Callable[[DataFrame], DataFrame],
                 fanout: int = 4, buckets: int = 8):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.path, self.key, self.merge = spark, path.rstrip("/"), key, merge
        self.fanout, self.buckets = int(fanout), int(buckets)
        self.folder = Folder(spark, self.path)

    # ------------------------------------------------------------ manifests
    def _manifests(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.names("manifest") if n.endswith(".json") and n[0] not in "._")

    def manifest(self, batch: int | None = None) -> dict | None:
        """The newest manifest (or that of ``batch``): batch, runs, schema."""
        all_ = self._manifests()
        if not all_ or (batch is not None and batch not in all_):
            return None
        return self.folder.read_json(f"manifest/{all_[-1] if batch is None else batch}.json")

    # ----------------------------------------------------------------- runs
    def _write_run(self, rows: DataFrame, name: str) -> None:
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        (rows.withColumn(BUCKET, bucket).repartition(self.buckets, BUCKET)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/runs/{name}"))

    def _read_runs(self, runs: list[dict], schema: str) -> DataFrame:
        kind = T.StructType.fromJson(json.loads(schema)).add(BUCKET, T.IntegerType())
        parts = [self.spark.read.schema(kind).parquet(f"{self.path}/runs/{r['name']}") for r in runs]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def commit(self, batch: int, changes: DataFrame) -> dict:
        """Add the changes of a batch (at most one row per key)."""
        before = [b for b in self._manifests() if b < batch]
        last = self.manifest(before[-1]) if before else {"runs": []}
        schema = last.get("schema") or changes.schema.json()
        self._write_run(changes, f"{batch}-0")
        runs, level = [*last["runs"], {"name": f"{batch}-0", "level": 0}], 0
        while sum(r["level"] == level for r in runs) >= self.fanout:
            full = [r for r in runs if r["level"] == level]
            name = f"{batch}-{level + 1}"
            self._write_run(self.merge(self._read_runs(full, schema).drop(BUCKET)), name)
            runs = [r for r in runs if r["level"] != level] + [{"name": name, "level": level + 1}]
            level += 1
        m = {"batch": batch, "runs": runs, "schema": schema}
        self.folder.write_json(f"manifest/{batch}.json", m)
        self._sweep()
        return m

    def _sweep(self) -> None:
        kept = self._manifests()[-KEEP:]
        live = {r["name"] for b in kept for r in self.manifest(b)["runs"]}
        for b in self._manifests():
            if b not in kept:
                self.folder.delete(f"manifest/{b}.json")
        for name in self.folder.names("runs"):
            if name not in live:
                self.folder.delete(f"runs/{name}")

    # -------------------------------------------------------------- reading
    def read(self) -> DataFrame | None:
        """The merged rows of the newest manifest; None before the first one."""
        m = self.manifest()
        return self.merge(self._read_runs(m["runs"], m["schema"]).drop(BUCKET)) if m else None

    def lookup(self, keys: list) -> DataFrame | None:
        """The rows of ``keys``; only their buckets are read."""
        m = self.manifest()
        if not m:
            return None
        own = self.spark.createDataFrame([(k,) for k in keys], T.StructType(
            [f for f in T.StructType.fromJson(json.loads(m["schema"])).fields if f.name == self.key]))
        buckets = [r[0] for r in own.select(F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")).distinct().collect()]
        rows = self._read_runs(m["runs"], m["schema"]).where(F.col(BUCKET).isin(buckets) & F.col(self.key).isin(list(keys)))
        return self.merge(rows.drop(BUCKET))
