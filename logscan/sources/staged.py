"""Results appended run by run, each run once.

A run writes its CSV files into a folder of its own and then one manifest file
named by the run id, which makes the run part of the results.  The id is a hash
of the run's inputs (path, modification time, length), so a run that was killed
and starts again over the same files is known; the manifest names the inputs,
so files of a committed run that are still there are consumed and not read
again, also when others have arrived in between.  A run killed before its
manifest leaves a folder that no reader looks at.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from logscan.schema import LOG_SCHEMA
from logscan.sources.folder import Folder
from logscan.sources.sinks import write_csv


class StagedResults:
    """Layout: ``runs/<id>`` (CSV), ``manifest/<id>.json``, ``done/<id>.json``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def inputs(self, files) -> list[list]:
        """[path, modification time, length] of every file (one metadata call
        per file from the driver, as consuming them takes anyway)."""
        return [[f, *status] for f in sorted(files) if (status := self.folder.status(f))]

    @staticmethod
    def run_id(inputs: list[list]) -> str:
        return hashlib.sha256(json.dumps(inputs).encode()).hexdigest()[:32]

    def _ids(self, sub: str) -> set[str]:
        return {n[:-5] for n in self.folder.names(sub) if n.endswith(".json") and n[0] not in "._"}

    def committed(self) -> set[str]:
        return self._ids("manifest")

    def manifest(self, run_id: str) -> dict:
        return self.folder.read_json(f"manifest/{run_id}.json")

    def unfinished(self) -> list[dict]:
        """Manifests of committed runs whose inputs were not consumed yet."""
        return [self.manifest(r) for r in sorted(self.committed() - self._ids("done"))]

    def still_there(self, inputs: list[list]) -> list[str]:
        """Input files that are as the run read them (a replaced one is new)."""
        return [f for f, *status in inputs if self.folder.status(f) == status]

    def write(self, run_id: str, rows: DataFrame, single_file: bool = False) -> None:
        write_csv(rows, f"{self.folder.path}/runs/{run_id}", mode="overwrite", single_file=single_file)

    def commit(self, run_id: str, inputs: list[list], metrics: dict) -> None:
        self.folder.write_json(f"manifest/{run_id}.json", {"run_id": run_id, "inputs": inputs, "metrics": metrics})

    def finish(self, run_id: str) -> None:
        self.folder.write_json(f"done/{run_id}.json", {})

    def sweep(self) -> None:
        """Remove the folders of runs that never committed (no run may be going on)."""
        for name in self.folder.names("runs"):
            if name not in self.committed():
                self.folder.delete(f"runs/{name}")

    def read(self, schema=None) -> DataFrame | None:
        """The rows of all committed runs, as written; None before the first."""
        paths = [f"{self.folder.path}/runs/{r}" for r in sorted(self.committed())]
        if not paths:
            return None
        reader = self.spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader).csv(paths)


RESULT_SCHEMA = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in LOG_SCHEMA.fields if f.name != "_c0"]
                          + ["TimeVal float", "recon_error double"])
