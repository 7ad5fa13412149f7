"""What the training-data operators share: reading tables, cutting lineage, hashing words in numpy."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space, the word separators of every operator here.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Regular expression of a word, for Spark SQL and Python alike.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20  # of an Arrow batch that goes to a Python worker

U = np.uint64
_R = 0x9E3779B97F4A7C4B  # odd multiplier of the rolling polynomial; 3 mod 4, so powers stay apart
_R_INV = pow(_R, -1, 1 << 64)
_BYTES = np.random.RandomState(20240117).randint(1, 1 << 62, 256, dtype=np.int64).astype(U) * U(4) + U(3)
_BYTES_LOWER = _BYTES.copy()
_BYTES_LOWER[65:91] = _BYTES[97:123]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; where the session has none, a local session gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = set_dir.get() if set_dir.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def written(df: DataFrame, what: str = "part") -> DataFrame:
    """Write df to the shared folder and read it back: the lineage is cut, lost executors cost nothing computed before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/harborline-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._harborline_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what `written` wrote, once nothing that is still to be computed reads it."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._harborline_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def tidied(run, rows: int | None = None):
    """run, for mapInArrow, with what it took given back to the system after each batch and at its end: a worker that is used again would keep it.

    rows: batches reach run in slices of so many rows at most, so copies of their texts stay small.
    """

    def tidy():
        import ctypes

        import pyarrow as pa

        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim is not None:
            trim(0)

    def each(batches):
        for b in batches:
            for i in range(0, b.num_rows, rows or b.num_rows or 1):
                yield b.slice(i, rows)
            del b
            tidy()

    def wrapped(batches):
        try:
            yield from run(each(batches))
        finally:  # run's own variables are gone by now
            tidy()

    return wrapped


def mapped(df: DataFrame, run, schema, rows: int | None = None) -> DataFrame:
    """df.mapInArrow(tidied(run, rows), schema), its batches cut by bytes as well as by rows, so neither side holds much text at once.

    A session without a limit of bytes of its own gets BATCH_BYTES, and keeps it, as frames run later; results do not depend on it.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT, None) is None:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    return df.mapInArrow(tidied(run, rows), schema)


def few(rows: DataFrame, most: int = 2_000_000) -> DataFrame:
    """Rows of a few numbers each, marked for a broadcast if they are counted to be at most `most`; else left to a shuffle."""
    return F.broadcast(rows) if rows.count() <= most else rows


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df with a long column that tells its rows apart and is the same whenever it is read.

    Rows of files are numbered by their file and their place in it, at no cost but for a list of the files; rows that come
    from elsewhere are written first.
    """
    spark = df.sparkSession
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("__path__"), F.col("_metadata.row_index").alias("__place__"))
    except AnalysisException:
        return written(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
    paths = placed.select("__path__").distinct().withColumn("__file__", F.row_number().over(Window.orderBy("__path__")).cast("long"))
    paths = written(paths, "files")  # a row a file
    rows = placed.join(few(paths, 100_000), "__path__")
    return rows.withColumn(name, F.expr("shiftleft(__file__, 40) + __place__")).drop("__path__", "__file__", "__place__")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply) on uint64 arrays."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


STEP = 1 << 18  # bytes of text that words are looked for in at once
_powers: dict = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n + 1:
        size = max(n + 1, STEP + 4096)
        p, q = np.full(size, _R, U), np.full(size, _R_INV, U)
        p[0] = q[0] = 1
        _powers["p"], _powers["q"] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _powers["p"], _powers["q"]


def scan_words(buf: bytes, lower: bool = False, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes), code points and 64-bit hash of every word of a UTF-8 buffer, in order.

    Works through the buffer in steps cut at white space, so temporary arrays stay small whatever the length.
    lower: A-Z hash as a-z.
    """
    values = _BYTES_LOWER if lower else _BYTES
    b = np.frombuffer(buf, np.uint8)
    out, at = [], 0
    while at < len(b):
        to = min(at + step, len(b))
        while to < len(b) and not SPACE[b[to]]:
            more = np.flatnonzero(SPACE[b[to : to + step]])
            to = to + int(more[0]) if len(more) else min(to + step, len(b))
        s = b[at:to]
        edge = np.diff(np.concatenate(([1], SPACE[s].view(np.int8), [1])))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        p, q = _pow(len(s))
        h = np.zeros(len(s) + 1, U)
        np.cumsum(values[s] * p[: len(s)], out=h[1:])
        chars = np.zeros(len(s) + 1, np.int64)
        np.cumsum((s & 0xC0) != 0x80, out=chars[1:])
        out.append((starts + at, ends + at, chars[ends] - chars[starts], mix((h[ends] - h[starts]) * q[starts])))
        at = to
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def blocks(texts: list, limit: int = 1 << 20):
    """Yield (first, last) ranges of a list of bytes with about `limit` bytes each; a longer text stands alone."""
    first = size = 0
    for i, t in enumerate(texts):
        n = len(t or b"")
        if i > first and size + n > limit:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(texts):
        yield first, len(texts)


def joined(texts: list) -> tuple[bytes, np.ndarray]:
    """Texts (bytes or None) joined by a line feed, and where each begins (with the end as the last)."""
    parts = [t or b"" for t in texts]
    begins = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in parts], out=begins[1:])
    return b"\n".join(parts), begins


def chain(hashes: list[np.ndarray]) -> np.ndarray:
    """Order-dependent hash of equally long arrays of hashes."""
    h = hashes[0]
    for x in hashes[1:]:
        h = mix(h * U(0xD6E8FEB86659FD93) + x)
    return h


def column_bytes(column) -> list:
    """A string column of a record batch as bytes or None."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


def n_words(text):
    """Number of words of a text column, native; null counts 0."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long"), F.lit(0).cast("long"))
