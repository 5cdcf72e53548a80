"""Versioned Parquet tables with one pointer for all: a commit of several tables becomes visible at once.

A table is a set of parts, a folder each. What a batch brings is a part of its own, so a commit writes that part and
leaves the others as they are, and reading one batch opens its folders only. Only tables that change in place (sources,
mappings, quarantine items, golden values) are written whole. A commit writes its folders and then a pointer file that
names the folders of every table. Readers see the old state or the new one; a failed commit leaves folders that no
pointer names. There is one writer at a time: a second one fails at the pointer."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import upsert
from ..schemas import KEYS, TABLES

#: The part of a table that was written whole.
WHOLE = ""


class Store:
    """Tables under a root that Spark's file systems can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.version, self.current = self._load()

    def _pointers(self) -> list[str]:
        folder = self._path(f"{self.root}/_pointers")
        return sorted(n for s in self._fs.listStatus(folder) if (n := s.getPath().getName()).endswith(".json")) if self._fs.exists(folder) else []

    def _load(self) -> tuple[int, dict[str, dict[str, str]]]:
        named = self._pointers()
        if not named:
            return 0, {}
        # one line, as many entries as there are parts
        return int(named[-1][:-5]), json.loads(self.spark.read.text(f"{self.root}/_pointers/{named[-1]}").first()[0])

    def _read(self, name: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*[f"{self.root}/{f}" for f in folders])

    def table(self, name: str) -> DataFrame:
        return self._read(name, list(self.current.get(name, {}).values()))

    def batch(self, name: str, batch_id: str) -> DataFrame:
        """The rows of one batch, from the parts that can hold them."""
        parts = self.current.get(name, {})
        own = [f for p, f in parts.items() if p.split("/")[0] in (WHOLE, batch_id)]
        return self._read(name, own).where(F.col("batch_id") == batch_id)

    def tables(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in TABLES}

    def full(self, name: str, df: DataFrame) -> DataFrame:
        """df with the columns of a table; those that it lacks are null."""
        schema = self.spark.createDataFrame([], TABLES[name]).schema
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    def _write(self, name: str, df: DataFrame) -> str:
        folder = f"{name}/{uuid.uuid4().hex}"
        self.full(name, df).write.parquet(f"{self.root}/{folder}")
        return folder

    def commit(self, whole: dict[str, DataFrame] | None = None, batch: dict[str, DataFrame] | None = None, batch_id: str | None = None, added: dict[str, DataFrame] | None = None) -> None:
        """All at once: replace tables (whole), replace what batch_id brought to tables (batch), append rows whose keys
        are new (added; rows with a key that exists are dropped)."""
        nxt = {n: dict(p) for n, p in self.current.items()}
        for name, df in (whole or {}).items():
            nxt[name] = {WHOLE: self._write(name, df)}
        for name, df in (batch or {}).items():
            parts = nxt.setdefault(name, {})
            folder = self._write(name, df)
            if WHOLE in parts:  # a whole rewrite may hold the batch's rows
                rest = self._read(name, [parts[WHOLE]])
                if not rest.where(F.col("batch_id") == batch_id).isEmpty():
                    parts[WHOLE] = self._write(name, rest.where(F.col("batch_id") != batch_id))
            nxt[name] = {p: f for p, f in parts.items() if p.split("/")[0] != batch_id} | {batch_id: folder}
        for name, df in (added or {}).items():
            new = upsert(self.spark.createDataFrame([], TABLES[name]), self.full(name, df), KEYS[name])
            if self.current.get(name):
                known = self.table(name).select(*KEYS[name])
                new = new.join(known, [new[k].eqNullSafe(known[k]) for k in KEYS[name]], "left_anti")
            nxt.setdefault(name, {})[f"{batch_id or 'more'}/{uuid.uuid4().hex}"] = self._write(name, new)
        temp, final = self._path(f"{self.root}/_pointers/.{uuid.uuid4().hex}"), self._path(f"{self.root}/_pointers/{self.version + 1:012d}.json")
        self._fs.mkdirs(temp.getParent())
        out = self._fs.create(temp)
        out.write(bytearray(json.dumps(nxt).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(temp, final):
            raise RuntimeError("another writer has committed")
        self.current, self.version = nxt, self.version + 1

    def merged(self, name: str, incoming: DataFrame, policy: str = "overwrite", columns: list[str] | None = None) -> DataFrame:
        """The whole table with incoming rows by its key."""
        return upsert(self.table(name), self.full(name, incoming), KEYS[name], policy, columns)
