"""Tables that grow by batches: a batch adds files and a manifest, readers merge, an index leads to the files of a key.

Rows are written as new files below ``data/batch=<version>/<part>=<value>`` and count from the moment the manifest of
that version is there. A manifest is one small file that names all live folders, so readers see a whole batch or nothing
of it, and a crash leaves the view before. A batch that is in already is not written again. Nothing stored is rewritten
but by ``compact``, which merges the folders of a part into one, and ``expire``, which lets whole parts go.

``merge`` makes the current rows of several batches' rows (``newest``, ``summed``). Only parts with more than one live
folder are merged when read.

For the columns in ``index`` each batch also writes which key hashes its files hold, spread over ``SLOTS`` folders by
hash. A lookup reads the slots of its keys and then opens only the files they name.

One writer at a time per table, as a streaming query is; readers need no lock. Files that no manifest of the last few
names are deleted by ``vacuum``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

SLOTS = 64
Merge = Callable[[DataFrame], DataFrame]


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def newest(keys: Sequence[str]) -> Merge:
    """The row of the latest batch for each key."""

    def merge(rows: DataFrame) -> DataFrame:
        latest = Window.partitionBy(*keys).orderBy(F.desc("batch"))
        return rows.withColumn("__n", F.row_number().over(latest)).filter("__n = 1").drop("__n", "batch")

    return merge


def summed(keys: Sequence[str], sums: Sequence[str]) -> Merge:
    """The sums of all batches for each key."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])

    return merge


@dataclass(frozen=True)
class Manifest:
    """The state of a table: live (version, part) folders, the last batch that is in, and a text the writer keeps."""

    version: int = 0
    applied: int = -1
    live: tuple[tuple[int, str], ...] = ()
    schema: str | None = None
    note: str | None = None


@dataclass(frozen=True)
class AppendTable:
    spark: SparkSession
    path: str
    part: str
    merge: Merge
    index: tuple[str, ...] = ()
    sort: tuple[str, ...] = field(default=())

    # files

    def _at(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _delete(self, *names: str) -> None:
        fs, path = self._at(*names)
        fs.delete(path, True)

    def _names(self, *names: str) -> list[str]:
        fs, path = self._at(*names)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self._names("manifests") if n.isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return Manifest()
        text = self.spark.read.text(f"{self.path}/manifests/{version:012d}", wholetext=True).first()[0]
        held = json.loads(text)
        return Manifest(**held | {"live": tuple((int(v), p) for v, p in held["live"])})

    def _commit(self, manifest: Manifest) -> None:
        fs, made = self._at("manifests", f"_{manifest.version:012d}")
        out = fs.create(made, True)
        out.write(bytearray(json.dumps(vars(manifest)).encode()))
        out.close()
        _, path = self._at("manifests", f"{manifest.version:012d}")
        if not fs.rename(made, path):
            raise FileExistsError(f"another writer has committed version {manifest.version} of {self.path}")

    # writing

    def _write(self, rows: DataFrame, version: int) -> list[str]:
        """Write a version's files and index; returns the parts it has. What a failed attempt left is replaced."""
        folder = f"{self.path}/data/batch={version}"
        spread = rows.hint("rebalance", F.col(self.part)).sortWithinPartitions(self.part, *self.sort)
        spread.write.mode("overwrite").partitionBy(self.part).parquet(folder)
        parts = [n.partition("=")[2] for n in self._names("data", f"batch={version}") if n.startswith(f"{self.part}=")]
        if self.index and parts:
            written = self.spark.read.schema(rows.schema).parquet(folder)
            keys = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), key_hash(F.col(c)).alias("key")) for c in self.index if c in rows.columns]))
            file = F.concat_ws("/", F.element_at(F.split("_metadata.file_path", "/"), -2), F.col("_metadata.file_name"))
            found = written.select(file.alias("file"), keys.alias("k")).select("file", "k.field", "k.key").filter("key IS NOT NULL").distinct()
            slotted = found.withColumn("slot", slot_of(F.col("key")))
            slotted.repartition("slot").sortWithinPartitions("slot", "field", "key").write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/index/batch={version}")
        return parts

    def append(self, rows: DataFrame, batch: int, note: str | None = None, replace: Sequence[str] = ()) -> bool:
        """Add a batch; False if it, or a later one, is in already. Batches come in rising numbers.

        With ``replace``, what these parts held before is no longer live.
        """
        now = self.manifest()
        if batch <= now.applied:
            return False
        version = now.version + 1
        parts = self._write(rows, version)
        known = StructType.fromJson(json.loads(now.schema)) if now.schema else StructType()
        for f in rows.schema:
            if f.name not in known.names:
                known = known.add(f)
        live = tuple((v, p) for v, p in now.live if p not in replace) + tuple((version, p) for p in parts)
        self._commit(Manifest(version, batch, live, known.json(), now.note if note is None else note))
        return True

    def compact(self, above: int = 1) -> int:
        """Merge the parts with more than ``above`` live folders into one folder each; returns how many."""
        now = self.manifest()
        parts = [p for p, n in _counts(now.live).items() if n > above]
        if not parts:
            return 0
        version = now.version + 1
        written = self._write(self.read(parts), version)
        live = tuple((v, p) for v, p in now.live if p not in parts) + tuple((version, p) for p in written)
        self._commit(Manifest(version, now.applied, live, now.schema, now.note))
        return len(parts)

    def expire(self, before: str) -> int:
        """Let all parts below ``before`` go; returns how many. Their files are deleted by the next ``vacuum``."""
        now = self.manifest()
        live = tuple((v, p) for v, p in now.live if p >= before)
        gone = len(_counts(now.live)) - len(_counts(live))
        if gone:
            self._commit(Manifest(now.version + 1, now.applied, live, now.schema, now.note))
        return gone

    def vacuum(self, keep: int = 2) -> int:
        """Delete the folders that none of the last ``keep`` manifests names, and older manifests; returns how many folders."""
        versions = self.versions()
        kept = versions[-keep:]
        live = {entry for v in kept for entry in self.manifest(v).live}
        newest_, gone = max(versions, default=0), 0
        for v in sorted({v for n in self._names("data") if n.startswith("batch=") for v in [int(n[6:])]}):
            if v > newest_:
                continue  # a write that has not been committed yet
            parts = [n.partition("=")[2] for n in self._names("data", f"batch={v}") if n.startswith(f"{self.part}=")]
            for p in parts:
                if (v, p) not in live:
                    self._delete("data", f"batch={v}", f"{self.part}={p}")
                    gone += 1
            if not any((v, p) in live for p in parts):
                self._delete("data", f"batch={v}")
                self._delete("index", f"batch={v}")
        for v in versions[:-keep]:
            self._delete("manifests", f"{v:012d}")
        return gone

    # reading

    def _scan(self, manifest: Manifest, paths: Iterable[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(manifest.schema)).add("batch", LongType())
        paths = list(paths)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)

    def _merged(self, manifest: Manifest, paths: dict[tuple[int, str], list[str]], columns: list[str], only: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """The current rows of these folders' files; ``only`` picks rows by key, so it may come before the merge."""
        several = {p for p, n in _counts(manifest.live).items() if n > 1}
        single = only(self._scan(manifest, [f for (_, p), fs in paths.items() if p not in several for f in fs])).select(*columns)
        many = [f for (_, p), fs in paths.items() if p in several for f in fs]
        return single.unionByName(self.merge(only(self._scan(manifest, many))).select(*columns)) if many else single

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, parts: Iterable[str] | tuple[str, str] | None = None, *, between: tuple[str, str] | None = None) -> DataFrame:
        """The current rows, of some parts or of those in a range only."""
        now = self.manifest()
        if now.schema is None:
            raise FileNotFoundError(f"nothing has been written to {self.path}")
        chosen = None if parts is None else set(parts)
        live = [(v, p) for v, p in now.live if (chosen is None or p in chosen) and (between is None or between[0] <= p <= between[1])]
        return self._merged(now, {(v, p): [self._folder(v, p)] for v, p in live}, StructType.fromJson(json.loads(now.schema)).names)

    def _folder(self, version: int, part: str) -> str:
        return f"{self.path}/data/batch={version}/{self.part}={part}"

    def files_of(self, column: str, keys: Sequence | DataFrame) -> dict[tuple[int, str], list[str]]:
        """The live files that may hold rows with these keys, a list of values or the rows of a frame, by folder."""
        if column not in self.index:
            raise ValueError(f"{column} is not indexed")
        now = self.manifest()
        versions = sorted({v for v, _ in now.live})
        if not versions:
            return {}
        index = self.spark.read.schema("file string, field string, key bigint, batch bigint, slot int").option("basePath", f"{self.path}/index")
        index = index.parquet(*[f"{self.path}/index/batch={v}" for v in versions]).filter(F.col("field") == column)
        if isinstance(keys, DataFrame):
            asked = keys.select(key_hash(F.col(column)).alias("key")).distinct()
            hits = index.join(asked.withColumn("slot", slot_of(F.col("key"))), ["slot", "key"], "left_semi")
        else:
            hashed = self.spark.range(1).select(F.explode(F.array(*[key_hash(F.lit(k)) for k in keys])).alias("key")) if len(keys) else None
            known = [r["key"] for r in hashed.collect()] if hashed is not None else []
            hits = index.filter(F.col("slot").isin([k % SLOTS for k in known]) & F.col("key").isin(known))
        out: dict[tuple[int, str], list[str]] = {}
        live = set(now.live)
        for r in hits.select("batch", "file").distinct().collect():  # one row a file at most
            part = r["file"].partition("/")[0].partition("=")[2]
            if (r["batch"], part) in live:
                out.setdefault((r["batch"], part), []).append(f"{self.path}/data/batch={r['batch']}/{r['file']}")
        return out

    def rows_of(self, column: str, keys: Sequence | DataFrame, *, through: str | None = None) -> DataFrame:
        """The current rows with these keys, read from the files that the index names.

        Without ``through``, ``column`` must be one of the keys of the merge. Of another column, which later batches may
        have changed, the rows found are looked up again by ``through``, which is such a key.
        """
        now = self.manifest()
        if now.schema is None:
            raise FileNotFoundError(f"nothing has been written to {self.path}")
        if isinstance(keys, DataFrame):
            asked = keys.select(column).distinct()
            only = lambda rows: rows.join(asked, column, "left_semi")
        else:
            only = lambda rows: rows.filter(F.col(column).isin(list(keys)))
        files = self.files_of(column, keys)
        if through is not None:
            found = only(self._scan(now, [f for fs in files.values() for f in fs])).select(through)
            return only(self.rows_of(through, found))
        return self._merged(now, files, StructType.fromJson(json.loads(now.schema)).names, only)


def key_hash(key: Column) -> Column:
    return F.when(key.isNotNull(), F.xxhash64(key.cast("string")))


def slot_of(key: Column) -> Column:
    return F.pmod(key, F.lit(SLOTS)).cast("int")


def _counts(live: Iterable[tuple[int, str]]) -> dict[str, int]:
    return reduce(lambda out, entry: out | {entry[1]: out.get(entry[1], 0) + 1}, live, {})


EVENT_KEY = ("session", "ts", "eventid")


def event_store(spark: SparkSession, path: str) -> AppendTable:
    """Events by day; (session, ts, eventid) is the key, the last arrival wins. Indexed by session and address."""
    return AppendTable(spark, path, "day", newest(EVENT_KEY), ("session", "src_ip"), ("session", "ts"))
