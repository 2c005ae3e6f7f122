"""A run's tables by versions: written aside, and shown to readers all at once.

Each write of a table goes to a folder of its own. A commit writes one small file
that names the current folder of every table, and readers go by the latest such
file alone. So a run that is lost half way leaves what was there before, and
tables that belong together never appear apart.
"""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .sinks import read_table

MANIFESTS = "_manifests"


class RunTables:
    """The tables of a run folder as of its latest commit, and those staged since."""

    def __init__(self, spark: SparkSession, run_dir: str):
        self.spark, self.run_dir = spark, run_dir.rstrip("/")
        self.manifest = self._latest()
        self.staged: dict[str, str] = {}

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.run_dir}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self) -> list[int]:
        fs, folder = self._path(MANIFESTS)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n)))

    def _latest(self) -> dict:
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else {"number": 0, "tables": {}}

    def _read(self, number: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.run_dir}/{MANIFESTS}/{number:08d}.json", wholetext=True).first()["value"])

    def put_text(self, name: str, text: str) -> None:
        """A small file of the run, whole or not at all: it is written aside and renamed."""
        fs, target = self._path(name)
        _, aside = self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = fs.create(aside, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(aside, target):
            raise OSError(f"cannot write {target}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Stage a version of a table, and what was written read back. Others see it after commit only."""
        place = f"tables/{name}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.run_dir}/{place}")
        self.staged[name] = place
        return self.spark.read.schema(df.schema).parquet(f"{self.run_dir}/{place}")

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """The staged or else the current version of a table; one that was never committed but lies in the run's folder by its name will do, and with a schema a missing one is empty."""
        place = self.staged.get(name) or self.manifest["tables"].get(name)
        return self.spark.read.parquet(f"{self.run_dir}/{place}") if place else read_table(self.spark, self.run_dir, name, schema)

    def commit(self, **about: object) -> dict:
        """Show all staged tables at once; what ``about`` says is kept with them. Fails if somebody else has committed since this was opened."""
        if self._numbers()[-1:] != ([self.manifest["number"]] if self.manifest["number"] else []):
            raise RuntimeError(f"{self.run_dir} was committed to by another writer")
        number = self.manifest["number"] + 1
        made = {"number": number, "created_at_utc": datetime.now(timezone.utc).isoformat(timespec="seconds"), "tables": self.manifest["tables"] | self.staged, "about": about}
        self.put_text(f"{MANIFESTS}/{number:08d}.json", json.dumps(made, indent=2, sort_keys=True, ensure_ascii=False))
        self.manifest, self.staged = made, {}
        return made

    def drop_old(self, keep: int = 1) -> int:
        """Delete versions of tables that none of the last ``keep`` commits names, and say how many; no one may still read them or have tables staged."""
        numbers = self._numbers()
        named = {p for n in numbers[-keep:] for p in self._read(n)["tables"].values()} | set(self.staged.values())
        fs, top = self._path("tables")
        gone = 0
        for table in fs.listStatus(top) if fs.exists(top) else []:
            for version in fs.listStatus(table.getPath()):
                if f"tables/{table.getPath().getName()}/{version.getPath().getName()}" not in named:
                    gone += fs.delete(version.getPath(), True)
        for n in numbers[:-keep]:
            fs.delete(self._path(f"{MANIFESTS}/{n:08d}.json")[1], False)
        return gone
