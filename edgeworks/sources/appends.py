"""Stored matrices that grow by appends, each committed whole or not at all.

An append writes its rows into a folder of its own and then commits one entry
to the log beside them: the folder, its rows, the index they start from and
the next free one. Rows are stored with their index inside the append, so when
two appends race, the one that comes second takes the next entry and writes no
row again. Readers list only what the log names; what a lost append left behind
is never seen, until ``sweep`` deletes it.

The log asks for a file system with atomic renames.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ENTRY = "append string, rows bigint, first bigint, next bigint, cols bigint"


class MatrixLog:
    """A matrix ``index bigint, vector array<double>`` below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._fs = jvm.org.apache.hadoop.fs
        root = self._fs.Path(self.path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = root.getFileSystem(conf)
        self._context = self._fs.FileContext.getFileContext(root.toUri(), conf)

    def append(self, new_rows: DataFrame) -> dict:
        """Append rows (``index`` from 0) after the last stored one; the entry.

        No stored row is read. The index goes on from the entry before. An
        append without rows is not entered.
        """
        return self.commit(self.stage(new_rows))

    def stage(self, new_rows: DataFrame) -> dict:
        """Write the rows of an append; nobody sees them before ``commit``."""
        name = uuid.uuid4().hex
        seen = Observation()
        rows = new_rows.select(F.col("index").cast("bigint"), F.col("vector").cast("array<double>"))
        rows.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.min("index").alias("low"),
            F.max("index").alias("high"),
            F.max(F.size("vector")).alias("cols"),
        ).write.parquet(self._folder(name))
        got = seen.get
        if got.get("rows") and (got["low"] is None or got["low"] < 0):
            raise ValueError("the index of appended rows starts from 0")
        return {"append": name, "rows": got.get("rows") or 0, "high": got.get("high"), "cols": got.get("cols") or 0}

    def commit(self, staged: dict) -> dict:
        """Enter staged rows in the log, after whatever was committed before.

        Only one commit can take a number of the log. Whoever finds it taken
        looks again and takes the next.
        """
        if not staged["rows"]:
            return staged
        while True:
            done = self._numbers()
            last = json.loads(self._text(done[-1])) if done else {"next": 0}
            if any(staged["append"] == e["append"] for e in self.entries()):
                raise ValueError(f"append {staged['append']} is committed already")
            entry = {
                "append": staged["append"], "rows": staged["rows"], "first": last["next"],
                "next": last["next"] + staged["high"] + 1, "cols": staged["cols"],
            }
            if self._enter(done[-1] + 1 if done else 1, entry):
                return entry

    def entries(self) -> list[dict]:
        """The committed appends in their order; one small record each."""
        return [json.loads(self._text(n)) for n in self._numbers()]

    def read(self) -> DataFrame:
        """The committed rows as ``index, vector``."""
        entries = self.entries()
        if not entries:
            return self.spark.createDataFrame([], "index bigint, vector array<double>")
        stored = (
            self.spark.read.schema("index bigint, vector array<double>, append string")
            .option("basePath", f"{self.path}/rows")
            .parquet(*[self._folder(e["append"]) for e in entries])
        )
        # One row for each append, which the log holds on the driver anyway.
        firsts = self.spark.createDataFrame([(e["append"], e["first"]) for e in entries], "append string, first bigint")
        return stored.join(F.broadcast(firsts), "append").select(
            (F.col("index") + F.col("first")).alias("index"), "vector")

    def shape(self) -> tuple[int, int]:
        """Rows and columns by the log alone; no row is read."""
        entries = self.entries()
        return sum(e["rows"] for e in entries), max((e["cols"] for e in entries), default=0)

    def log(self) -> DataFrame:
        """The entries as a table."""
        fields = [f.split()[0] for f in ENTRY.split(", ")]
        return self.spark.createDataFrame([tuple(e[f] for f in fields) for e in self.entries()], ENTRY)

    def sweep(self) -> list[str]:
        """Delete the folders of appends that were never committed.

        Only while no append is under way: its rows look the same.
        """
        known = {e["append"] for e in self.entries()}
        left = [n for n in self._names("rows") if n.removeprefix("append=") not in known]
        for name in left:
            self._files.delete(self._fs.Path(f"{self.path}/rows/{name}"), True)
        return left

    def _folder(self, name: str) -> str:
        return f"{self.path}/rows/append={name}"

    def _names(self, folder: str) -> list[str]:
        where = self._fs.Path(f"{self.path}/{folder}")
        return [f.getPath().getName() for f in self._files.listStatus(where)] if self._files.exists(where) else []

    def _numbers(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self._names("log") if n.endswith(".json") and n[0].isdigit())

    def _text(self, number: int) -> str:
        source = self._files.open(self._fs.Path(f"{self.path}/log/{number:010d}.json"))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def _enter(self, number: int, entry: dict) -> bool:
        """Rename a finished file to the number; False when that is taken."""
        draft = self._fs.Path(f"{self.path}/log/draft-{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        try:
            out.write(bytearray(json.dumps(entry), "utf-8"))
        finally:
            out.close()
        gateway = self.spark.sparkContext._gateway
        plain = gateway.new_array(gateway.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(draft, self._fs.Path(f"{self.path}/log/{number:010d}.json"), plain)
            return True
        except Py4JJavaError as error:
            self._files.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
