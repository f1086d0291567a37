"""Runs whose tables become visible together, or not at all.

A run writes its tables below ``root/runs/<id>/<table>``, where no reader looks.
``publish`` then commits one small file, ``root/ledger/<n>.json``, that names for every
published day its run and that run's tables.  Readers take the newest file, so they see
either all tables of a run or those of the run before: a run that fails halfway leaves
only a folder that nothing names.  A rerun of a day takes the day's place in the next
file.  Two runs that publish from one state can't both commit: the later one raises
``ConcurrentWriteError`` and can be repeated.

The file holds a line per day, nothing per row.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from platewise.sources.sinks import ConcurrentWriteError, _fs, commit_json, read_json


class Run:
    """Tables of one day on their way; ``publish`` makes them visible."""

    def __init__(self, ledger: Ledger, spark: SparkSession, day: dt.date):
        self.ledger, self.spark, self.day = ledger, spark, day
        self.id, self.tables = uuid.uuid4().hex, {}
        self._seen = ledger.state(spark)["number"]

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Store ``df`` as the run's ``table``; the stored rows, which only this run sees."""
        if table in self.tables:
            raise ValueError(f"run {self.id}: table {table} was written before")
        path = self.ledger.table_path(self.id, table)
        df.write.mode("errorifexists").parquet(path)
        self.tables[table] = df.schema.json()
        return self.spark.read.schema(df.schema).parquet(path)

    def before(self, table: str) -> DataFrame | None:
        """``table`` as the newest published day before this run's day holds it."""
        return self.ledger.read(self.spark, table, before=self.day)

    def publish(self) -> int:
        """Commit all tables of the run at once; the state's number."""
        state = self.ledger.state(self.spark)
        if state["number"] != self._seen:
            raise ConcurrentWriteError(f"{self.ledger.root}: another run was published since this one began")
        days = {**state["days"], self.day.isoformat(): {"run": self.id, "tables": self.tables}}
        number = self._seen + 1  # the commit raises where another run takes this number now
        commit_json(self.spark, f"{self.ledger.root}/ledger", f"{number:010d}.json", {"number": number, "days": days})
        return number


class Ledger:
    """Which run holds which day."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def table_path(self, run: str, table: str) -> str:
        return f"{self.root}/runs/{run}/{table}"

    def begin(self, spark: SparkSession, day: dt.date) -> Run:
        return Run(self, spark, day)

    def _numbers(self, spark: SparkSession) -> list[int]:
        fs, p = _fs(spark, f"{self.root}/ledger")
        names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def state(self, spark: SparkSession, number: int | None = None) -> dict:
        """The newest published state, or an earlier one that a reader holds on to."""
        done = self._numbers(spark)
        if number is None and not done:
            return {"number": 0, "days": {}}
        return read_json(spark, f"{self.root}/ledger/{done[-1] if number is None else number:010d}.json")

    def read(self, spark: SparkSession, table: str, before: dt.date | None = None, number: int | None = None) -> DataFrame | None:
        """``table`` of the newest day (below ``before``); None where no such day has it."""
        days = self.state(spark, number)["days"]
        for day in sorted(days, reverse=True):
            if table in days[day]["tables"] and (before is None or day < before.isoformat()):
                return self._table(spark, days[day], table)
        return None

    def read_days(self, spark: SparkSession, table: str, first: dt.date | None = None, last: dt.date | None = None,
                  number: int | None = None) -> DataFrame | None:
        """``table`` of all days from ``first`` to ``last`` together, for tables to which a day adds
        its rows.  Days outside aren't opened.  A column that only some days have is NULL in the others."""
        days, found = self.state(spark, number)["days"], {}
        for day in sorted(days):
            if table in days[day]["tables"] and (first is None or day >= first.isoformat()) and (last is None or day <= last.isoformat()):
                found.setdefault(days[day]["tables"][table], []).append(self.table_path(days[day]["run"], table))
        rows = None
        for schema, paths in found.items():  # one scan per schema, not per day
            part = spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*paths)
            rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
        return rows

    def _table(self, spark: SparkSession, entry: dict, table: str) -> DataFrame:
        schema = StructType.fromJson(json.loads(entry["tables"][table]))
        return spark.read.schema(schema).parquet(self.table_path(entry["run"], table))

    def drop_superseded(self, spark: SparkSession, keep: int = 2) -> int:
        """Remove the files of runs that the newest ``keep`` states no longer name, and the states
        before those; the number of runs removed.  Runs that never were published may still be
        under way, so they stay."""
        done = self._numbers(spark)
        old, held = done[:-keep], done[-keep:]
        named = {e["run"] for n in held for e in self.state(spark, n)["days"].values()}
        gone = {e["run"] for n in old for e in self.state(spark, n)["days"].values()} - named
        for path in [f"{self.root}/runs/{run}" for run in sorted(gone)] + [f"{self.root}/ledger/{n:010d}.json" for n in old]:
            fs, p = _fs(spark, path)
            fs.delete(p, True)
        return len(gone)
