"""Tables of one folder that change together: files are written first, and one small manifest publishes them all.

A version is a file `_versions/<number>.json` that names, for each table and year, the folder that holds its rows. Readers
take the last version, or any before it, and read its folders only. A writer writes new folders, then moves its manifest
into place, which fails if another writer took the number; until then, and if it never gets there, readers see the version
before. Folders that no version names are removed by `vacuum`.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another writer published the same version first; nothing of this one is visible."""


class Versions:
    def __init__(self, spark: SparkSession, root: str, month: str = "yyyymm"):
        self.spark, self.root, self.month = spark, root.rstrip("/"), month
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join((self.root, *parts)))

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [x.getPath().getName() for x in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def numbers(self) -> list[int]:
        """Published versions, oldest first."""
        return sorted(int(n.removesuffix(".json")) for n in self._names("_versions") if n.endswith(".json") and n[0] != ".")

    def manifest(self, version: int | None = None) -> dict:
        """{table: {schema, years: {year: folder}}} of a version; the last one, or nothing where there is none."""
        numbers = self.numbers()
        if version is None:
            if not numbers:
                return {}
            version = numbers[-1]
        elif version not in numbers:
            raise ValueError(f"no version {version} in {self.root}")
        stream = self._fs.open(self._path("_versions", f"{version:010d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: int, manifest: dict) -> None:
        self._fs.mkdirs(self._path("_versions"))
        new, final = self._path("_versions", f".{uuid.uuid4().hex}"), self._path("_versions", f"{version:010d}.json")
        out = self._fs.create(new, False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        kind = getattr(self._hadoop, "Options$Rename")
        try:  # NONE: an existing version is never replaced
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), self.spark._jsc.hadoopConfiguration()).rename(self._fs.makeQualified(new), self._fs.makeQualified(final), gateway.new_array(kind, 0))
        except Exception as e:
            self._fs.delete(new, False)
            if self._fs.exists(final):
                raise Conflict(f"version {version} of {self.root} is there already") from e
            raise

    def read(self, table: str, version: int | None = None, years: list[int] | None = None) -> DataFrame:
        """The rows of a table in a version, of some years if given: other years' folders are not opened."""
        tables = self.manifest(version)
        if table not in tables:
            raise ValueError(f"no table {table} in version {version or 'last'} of {self.root}")
        schema = StructType.fromJson(tables[table]["schema"])
        folders = [f"{self.root}/{f}" for y, f in sorted(tables[table]["years"].items()) if years is None or int(y) in years]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def years(self, table: str, version: int | None = None) -> list[int]:
        return sorted(int(y) for y in self.manifest(version).get(table, {"years": {}})["years"])

    def _write(self, table: str, rows: DataFrame) -> dict[str, str]:
        """Write rows by year into a new folder; its years with their folders."""
        year = F.floor(F.col(self.month) / 100).cast("int")
        folder = f"{table}/{uuid.uuid4().hex}"
        ordered = rows.withColumn("__year__", year).repartitionByRange("__year__", *rows.columns[:2]).sortWithinPartitions("__year__", *rows.columns[:2])
        ordered.write.partitionBy("__year__").parquet(f"{self.root}/{folder}")
        return {n.removeprefix("__year__="): f"{folder}/{n}" for n in self._names(folder) if n.startswith("__year__=")}

    def replace_years(self, tables: dict[str, DataFrame], years: list[int] | None = None) -> int:
        """Publish a version in which each table's years are those of its rows; the other years and tables stay as they are.

        years: these are replaced, also by nothing, and rows of others are left out; without it, the years that rows hold.
        Columns are matched by name with the table's, which must be the same.
        """
        numbers = self.numbers()
        base = numbers[-1] if numbers else 0
        manifest = self.manifest(base) if numbers else {}
        for name, rows in tables.items():
            if name in manifest:
                schema = StructType.fromJson(manifest[name]["schema"])
                if set(schema.names) != set(rows.columns):
                    raise ValueError(f"columns of {name} are {', '.join(schema.names)}")
                rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
            if years is not None:
                rows = rows.where(F.floor(F.col(self.month) / 100).isin(years))
            new = self._write(name, rows)
            old = manifest.get(name, {"years": {}})["years"]
            kept = {y: f for y, f in old.items() if y not in new and (years is None or int(y) not in years)}
            manifest[name] = {"schema": rows.schema.jsonValue(), "years": kept | new}
        self._publish(base + 1, manifest)
        return base + 1

    def load_years(self, tables: dict[str, DataFrame], years: list[int], force: bool = False) -> list[int]:
        """Load the years that a table lacks, or all of them if forced; returns the years loaded. Nothing to do writes nothing."""
        todo = years if force else [y for y in years if any(y not in self.years(t) for t in tables)]
        if todo:
            self.replace_years(tables, todo)
        return todo

    def vacuum(self, keep: int = 1) -> int:
        """Forget all versions but the last `keep`, and delete the folders that none of those names; returns how many."""
        numbers = self.numbers()
        named = {f.split("/__year__=")[0] for v in numbers[-keep:] for t in self.manifest(v).values() for f in t["years"].values()}
        for v in numbers[:-keep]:
            self._fs.delete(self._path("_versions", f"{v:010d}.json"), False)
        gone = 0
        for table in self._names(""):
            for folder in self._names(table) if table != "_versions" else []:
                if f"{table}/{folder}" not in named:
                    gone += bool(self._fs.delete(self._path(table, folder), True))
        return gone


def reload_year(store: Versions, detail: DataFrame, totals: DataFrame, year: int, names: tuple[str, str] = ("detail", "totals")) -> int:
    """Replace one year of both facts in one version; months of totals without detail are provisional and stay out."""
    months = detail.where(F.floor(F.col(store.month) / 100) == year).select(store.month).distinct()
    return store.replace_years({names[0]: detail, names[1]: totals.join(months, store.month, "left_semi").select(*totals.columns)}, [year])
