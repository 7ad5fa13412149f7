"""Token counts as rollups that are kept by deltas.

A ledger is a folder with one part for each committed batch. A batch holds changes of documents - insert, revise, delete -
turned into signed rows: what a document counted before is taken away, what it counts now is added. A batch's rollup is the
sum of its signed rows by source, language and tokenizer version; totals are sums of the batches' rollups. Counts are
additive, so totals never need the documents again. `compact` merges batches when they have become many.

Commits are idempotent: a batch is written under its own name, as one folder that counts once its success marker is
there. Committing a name again changes nothing; a batch that broke off is overwritten.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written
from .packing import Encoder, vocabulary_path

KEYS = ("source", "lang", "tokenizer_version")


def _lengths(vocabulary):
    def run(batches):
        import pyarrow as pa

        encoder = Encoder(vocabulary or vocabulary_path())
        for b in batches:
            for i in range(0, len(b), 256):
                part = b.slice(i, 256)
                n = np.array([len(x) // 2 for x in encoder.encode(part.column("text").to_pylist())], np.int64)
                yield part.drop_columns(["text"]).append_column("tokens", pa.array(n))

    return run


def counted(docs: DataFrame, tokenizer_version: str = "byte_bpe_50k", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, lang, tokenizer_version, tokens) of every document, from whole texts; null texts count 0."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = d.mapInArrow(_lengths(vocabulary), "doc_id long, source string, lang string, tokens long")
    return rows.select("doc_id", "source", "lang", F.lit(tokenizer_version).alias("tokenizer_version"), "tokens")


class Ledger:
    """Batches of signed rows below `path` (any file system Spark writes to)."""

    SCHEMA = "doc_id long, source string, lang string, tokenizer_version string, docs long, tokens long"

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _folders(self) -> tuple[list[str], set[str]]:
        """Names of the complete folders, and of the batches that merged ones among them stand for."""
        fs, path = self._fs()
        if not fs.exists(path(self.path)):
            return [], set()
        names = [x.getPath().getName() for x in fs.listStatus(path(self.path))]
        whole = [n[6:] for n in names if n.startswith("batch=") and fs.exists(path(f"{self.path}/{n}/totals/_SUCCESS"))]
        covers = [c for n in whole if fs.exists(path(c := f"{self.path}/batch={n}/covers"))]
        covered = {r.name for r in self.spark.read.schema("name string").parquet(*covers).collect()} if covers else set()
        return whole, covered

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        whole, covered = self._folders()
        return sorted({*whole, *covered})

    def _read(self, what: str, schema: str) -> DataFrame:
        whole, covered = self._folders()
        paths = [f"{self.path}/batch={b}/{what}" for b in sorted(set(whole) - covered)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def current(self, ids: DataFrame | None = None) -> DataFrame:
        """What each document counts now: one row for each document and tokenizer version that is not deleted.

        ids: a frame of doc_id; only their history is grouped.
        """
        rows = self._read("rows", self.SCHEMA)
        if ids is not None:
            rows = rows.join(ids, "doc_id", "left_semi")
        return rows.groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply changes (op, doc_id, source, lang, tokenizer_version, tokens); op: insert, revise or delete.

        Returns False, and does nothing, if the batch was committed before. An insert of a document that is there, and a
        revise of one that is not, set it; a delete of one that is not there does nothing. A delete with a null
        tokenizer_version takes all versions. Of several changes to one document and version in a batch, a delete stands,
        else the one with the greatest tokens, source and language. Null sources and languages are keys of their own. A
        null doc_id or op is ignored.
        """
        if batch in self.batches():
            return False
        c = changes.where("doc_id is not null and op in ('insert', 'revise', 'delete')").select("op", F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "tokenizer_version", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
        c = changed = written(c, "changes")  # changes are counted once
        before = self.current(c.select("doc_id").distinct()) if self.batches() else self.spark.createDataFrame([], self.SCHEMA)
        every = c.where("op = 'delete' and tokenizer_version is null").select("doc_id").distinct().join(before.select("doc_id", "tokenizer_version").distinct(), "doc_id")
        c = c.where("tokenizer_version is not null").unionByName(every.select(F.lit("delete").alias("op"), "doc_id", F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"), "tokenizer_version", F.lit(0).cast("long").alias("tokens")))
        w = Window.partitionBy("doc_id", "tokenizer_version").orderBy(F.col("op") == "delete", "tokens", F.col("source").asc_nulls_first(), F.col("lang").asc_nulls_first())
        last = Window.partitionBy("doc_id", "tokenizer_version")
        c = c.withColumn("rank", F.row_number().over(w)).withColumn("top", F.max("rank").over(last)).where("rank = top").drop("rank", "top")
        added = c.where("op <> 'delete'").select("doc_id", *KEYS, F.lit(1).cast("long").alias("docs"), "tokens")
        old = before.join(c.select("doc_id", "tokenizer_version"), ["doc_id", "tokenizer_version"], "left_semi")
        taken = old.select("doc_id", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        self._write(batch, added.unionByName(taken))
        discard(changed)
        return True

    def _write(self, batch: str, rows: DataFrame) -> None:
        """A batch's signed rows, then its rollup, whose success marker makes it count."""
        at, totals = f"{self.path}/batch={batch}/rows", f"{self.path}/batch={batch}/totals"
        rows.write.mode("overwrite").parquet(at)
        self.spark.read.schema(self.SCHEMA).parquet(at).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(totals)

    def compact(self, batch: str) -> None:
        """Merge the committed batches into one of this new name: what each document counts now.

        The merged folder names the batches it stands for, so those delivered again still change nothing; readers take it
        in their place as soon as it is complete, and their folders go after that. Called again after a failure, it
        finishes; no other commit may run meanwhile.
        """
        whole, covered = self._folders()
        if batch not in whole:
            names = self.spark.createDataFrame([(x,) for x in {*whole, *covered}], "name string")
            names.write.mode("overwrite").parquet(f"{self.path}/batch={batch}/covers")
            self._write(batch, self.current().select("doc_id", *KEYS, "docs", "tokens"))
        fs, path = self._fs()
        whole, covered = self._folders()
        for old in set(whole) & covered:
            fs.delete(path(f"{self.path}/batch={old}"), True)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer_version, n_docs, n_tokens): sums of the batches' rollups; keys without documents are left out."""
        t = self._read("totals", "source string, lang string, tokenizer_version string, docs long, tokens long")
        return t.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")
