"""Tables that several runs keep up together: key-hash buckets, and one manifest per version, written last.

A version names, for each table and bucket, the folders that hold its rows. Changes are written to new
folders first; the manifest that names them makes them visible, for all tables at once. A run that ends before
leaves folders that no manifest names, and the last version as it was. Manifests are small: one
entry per table, bucket and folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecshelf.session import durable

BUCKETS = 64
FOLDERS = 8  # that a bucket may have before `compact` merges it
_BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another run has committed the version that this one meant to write."""


class Shelf:
    """Named tables below `path`. `buckets` is fixed by the first version."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path
        self.state = self._last() or {"version": 0, "tag": None, "buckets": buckets, "tables": {}}

    @property
    def version(self) -> int:
        return self.state["version"]

    @property
    def tag(self) -> int | None:
        """What the last commit was tagged with, such as the number of a streaming batch."""
        return self.state["tag"]

    def read(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame | None:
        """The table's rows in this version, or those of some of its buckets; None if it does not exist."""
        table = self.state["tables"].get(name)
        if table is None:
            return None
        schema = T.StructType.fromJson(table["schema"])
        wanted = None if buckets is None else {str(b) for b in buckets}
        paths = [
            f"{self.path}/data/{folder}/{_BUCKET}={b}"
            for b, folders in table["folders"].items() if wanted is None or b in wanted for folder in folders
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def begin(self, tag: int | None = None) -> Change | None:
        """A change to commit; None if `tag` has been applied already, as when a batch is replayed."""
        if tag is not None and self.tag is not None and tag <= self.tag:
            return None
        return Change(self, tag)

    def bucket(self, keys: list[str]):
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(self.state["buckets"])).cast("int")

    def compact(self, most: int = FOLDERS) -> int:
        """Merge the buckets that have more than `most` folders, and only those; returns how many."""
        change, merged = Change(self, self.tag), 0
        for name, table in self.state["tables"].items():
            full = [int(b) for b, folders in table["folders"].items() if len(folders) > most]
            if full:
                change._put(name, table["keys"], self.read(name, full), full)
                merged += len(full)
        if merged:
            change.commit()
        return merged

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _last(self) -> dict | None:
        files, place = self._files()
        folder = place(f"{self.path}/versions")
        if not files.exists(folder):
            return None
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        found = sorted(n for n in names if n.endswith(".json"))
        if not found:
            return None
        return json.loads(self.spark.read.text(f"{self.path}/versions/{found[-1]}", wholetext=True).first()[0])

    def _written(self, folder: str) -> list[str]:
        files, place = self._files()
        names = [f.getPath().getName() for f in files.listStatus(place(f"{self.path}/data/{folder}"))]
        return [n.split("=")[1] for n in names if n.startswith(f"{_BUCKET}=")]


class Change:
    """Writes that become visible together."""

    def __init__(self, shelf: Shelf, tag: int | None):
        self.shelf, self.tag = shelf, tag
        self.tables = {n: {**t, "folders": {b: list(f) for b, f in t["folders"].items()}} for n, t in shelf.state["tables"].items()}

    def append(self, name: str, keys: list[str], rows: DataFrame) -> None:
        """Rows with keys that the table lacks; nothing of it is read or written again."""
        self._put(name, keys, rows, ())

    def upsert(self, name: str, keys: list[str], rows: DataFrame, gone: DataFrame | None = None) -> list[int]:
        """Rows replace those of their keys, keys in `gone` vanish; returns the buckets touched, the only ones read.

        `rows` and `gone` have one row per key.
        """
        rows = durable(rows.withColumn(_BUCKET, self.shelf.bucket(keys)))
        out = rows.select(*keys)
        if gone is not None:
            out = out.unionByName(gone.select(*keys))
        out = durable(out.distinct().withColumn(_BUCKET, self.shelf.bucket(keys)))
        touched = sorted(r[0] for r in out.select(_BUCKET).distinct().collect())  # at most as many as there are buckets
        rows = rows.drop(_BUCKET)
        old = self.shelf.read(name, touched)
        if old is not None and touched:
            rows = old.join(out.drop(_BUCKET), keys, "left_anti").unionByName(rows)
        self._put(name, keys, rows, touched)
        return touched

    def _put(self, name: str, keys: list[str], rows: DataFrame, replaced: Iterable[int]) -> None:
        folder = uuid.uuid4().hex
        schema = json.loads(rows.schema.json())
        for field in schema["fields"]:
            field["nullable"] = True
        table = self.tables.setdefault(name, {"schema": schema, "keys": keys, "folders": {}})
        if [f["name"] for f in table["schema"]["fields"]] != rows.columns:
            raise ValueError(f"{name} has columns {[f['name'] for f in table['schema']['fields']]}, not {rows.columns}")
        cut = rows.withColumn(_BUCKET, self.shelf.bucket(keys))
        # A bucket's rows are written together, so that readers meet few files.
        cut.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.shelf.path}/data/{folder}")
        for b in replaced:
            table["folders"].pop(str(b), None)
        for b in self.shelf._written(folder):
            table["folders"].setdefault(b, []).append(folder)

    def commit(self) -> int:
        """Make the change visible; the shelf then shows it. Raises `Conflict` if another run was faster."""
        shelf = self.shelf
        state = {**shelf.state, "version": shelf.version + 1, "tag": self.tag if self.tag is not None else shelf.tag, "tables": self.tables}
        files, place = shelf._files()
        target = place(f"{shelf.path}/versions/{state['version']:012d}.json")
        draft = place(f"{shelf.path}/versions/{uuid.uuid4().hex}.draft")
        stream = files.create(draft, True)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if files.exists(target) or not files.rename(draft, target):
            files.delete(draft, False)
            raise Conflict(f"version {state['version']} exists")
        shelf.state = state
        return state["version"]
