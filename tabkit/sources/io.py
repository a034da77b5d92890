"""Readers and writers.

Paths are any Hadoop-compatible URI (local, HDFS, object stores).  Writers
produce directories of part files written by the executors in parallel;
nothing is funnelled through one task or the driver.  Versioned tables and
pointers use the Hadoop FileSystem API so they work on shared storage.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.session import scratch_path

# The text tokens a default CSV load reads as missing (the
# default missing-value list of the table library the reference loads with).
DEFAULT_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                     "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                     "n/a", "nan", "null")

CORRUPT = "_corrupt_record"


# ---------------------------------------------------------------------------
# S1 CSV tables
# ---------------------------------------------------------------------------
def _as_struct(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T._parse_datatype_string(schema)


def read_table(spark: SparkSession, path: str, schema, na_tokens=DEFAULT_NA_TOKENS,
               multiline: bool = False) -> DataFrame:
    """Read a headered CSV with an explicit schema; the ``na_tokens``
    (one list for all columns, or a ``{column: tokens}`` mapping, so that a
    token such as ``NA`` can be a real level in one column and missing in
    another) become null.

    Every column is read as text first, tokens are nulled, then each column
    is cast to its type in the same projection (a value that is neither a
    token nor parseable fails the query under ANSI casts rather than
    silently becoming null).  Quotes inside a quoted field are doubled;
    ``multiline`` allows line breaks there (then a file is one task).
    """
    st = _as_struct(schema)
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    # columns are found by the names in the header, whatever their order; all
    # files must have the header of the first.  An empty field is read as null
    # (the CSV reader's default)
    header = reader.csv(path).columns
    missing = [f.name for f in st.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: no column(s) {missing} in the header {header}")
    raw_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
    raw = reader.schema(raw_schema).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    exprs = []
    for f in st.fields:
        toks = na_tokens.get(f.name, ()) if isinstance(na_tokens, Mapping) else na_tokens
        c = F.col(f"`{f.name}`")
        if toks:
            c = F.when(~c.isin(*toks), c)
        exprs.append(c.cast(f.dataType).alias(f.name))
    return raw.select(*exprs)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Headered CSV directory (one part file per task, written in parallel);
    quotes inside a quoted field are doubled."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def write_predictions(df: DataFrame, path: str, id_col: str, pred_col: str,
                      mode: str = "overwrite") -> str:
    """Write ``id, prediction`` as headered CSV without an index column.
    The output is a directory of part files; callers that need one file
    concatenate the parts outside Spark."""
    return write_table(df.select(id_col, pred_col), path, mode)


# ---------------------------------------------------------------------------
# S2 / S3 JSON records
# ---------------------------------------------------------------------------
def read_records(spark: SparkSession, path: str, schema, multiline: bool = False,
                 keep_corrupt: bool = True) -> DataFrame:
    """Read JSON records with an explicit (nested) schema.

    ``multiline=True`` reads files holding one JSON array each (a whole file
    is one task -- only for small landed files); JSON lines (the default)
    split into tasks by size.  Malformed records are kept in
    ``_corrupt_record`` for :func:`split_valid`.
    """
    st = _as_struct(schema)
    if keep_corrupt and CORRUPT not in st.fieldNames():
        st = T.StructType(st.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.schema(st).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multiline).json(path))


def split_valid(df: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """S3: (good, bad).  Bad = not a JSON object (or unparseable), or no
    ``id_col``; bad rows carry ``reason`` and the raw text when available."""
    has_corrupt = CORRUPT in df.columns
    corrupt = F.col(CORRUPT).isNotNull() if has_corrupt else F.lit(False)
    ok = ~corrupt & F.col(id_col).isNotNull()
    good = df.where(ok)
    good = good.drop(CORRUPT) if has_corrupt else good
    bad = df.where(~ok).withColumn(
        "reason", F.when(corrupt, F.lit("not_an_object")).otherwise(F.lit("missing_id")))
    return good, bad


def parse_json_column(df: DataFrame, col: str, schema, out_col: str | None = None) -> DataFrame:
    """S2 for JSON held in a string column: ``from_json`` with a schema
    (malformed text gives null)."""
    return df.withColumn(out_col or col, F.from_json(F.col(col), _as_struct(schema)
                                                     if not isinstance(schema, T.DataType) else schema))


# ---------------------------------------------------------------------------
# S5 versioned read-modify-write
# ---------------------------------------------------------------------------
POINTER = "_CURRENT-"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system; other failures are raised."""
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def _current_number(spark: SparkSession, base: str) -> int:
    """The highest version that has a pointer file (0 before the first)."""
    fs, p, _ = _fs(spark, base)
    if not fs.exists(p):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return max((int(n.removeprefix(POINTER)) for n in names if n.startswith(POINTER)), default=0)


def _point_to(spark: SparkSession, base: str, number: int, folder: str) -> bool:
    """Create the pointer file of a version, which holds its folder; False
    where another writer has that number.  Pointers are only ever added, each
    by one create call, and the highest counts: there is no moment without a
    pointer."""
    fs, p, _ = _fs(spark, f"{base}/{POINTER}{number:06d}")
    try:
        out = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    out.write(bytearray(folder.encode()))
    out.close()
    return True


def current_version(spark: SparkSession, base_path: str) -> str | None:
    """The directory of the table's newest finished version (None before the
    first write)."""
    base = base_path.rstrip("/")
    n = _current_number(spark, base)
    if not n:
        return None
    fs, p, _ = _fs(spark, f"{base}/{POINTER}{n:06d}")
    length = fs.getFileStatus(p).getLen()
    if not length:  # a pointer without content: the folder of its number
        return f"{base}/v={n:06d}"
    stream = fs.open(p)
    try:
        return f"{base}/{bytes(stream.readNBytes(length)).decode()}"
    finally:
        stream.close()


def version_number(spark: SparkSession, base_path: str) -> int:
    """The number of the newest finished version (0 before the first)."""
    return _current_number(spark, base_path.rstrip("/"))


def read_current(spark: SparkSession, base_path: str) -> DataFrame:
    """Read the current version of a versioned table."""
    path = current_version(spark, base_path)
    if path is None:
        raise FileNotFoundError(f"no version written under {base_path}")
    return spark.read.parquet(path)


class VersionConflict(RuntimeError):
    """Another writer finished a version after the one that was read."""


def rewrite_table(df: DataFrame, base_path: str, read_version: int | None = None) -> str:
    """Read-modify-write of one feature table.  Spark cannot overwrite a
    path it is reading, so each step writes a new version and then adds its
    pointer; readers of the old version are undisturbed, and a failed step
    leaves the last good version current.

    Writers do not meet: each writes a folder of its own, and takes the next
    number by creating its pointer, which only one can; the other goes on to the
    number after.  With ``read_version`` (:func:`version_number` before reading)
    a version that another writer finished in between is a
    :class:`VersionConflict` and not lost."""
    spark = df.sparkSession
    base, own = base_path.rstrip("/"), f"w-{uuid.uuid4().hex}"
    n = _current_number(spark, base) + 1
    df.write.parquet(f"{base}/{own}/v={n:06d}")
    while True:
        newest = _current_number(spark, base)
        if read_version is not None and newest != read_version:
            raise VersionConflict(f"{base}: read version {read_version}, now {newest}")
        if newest >= n:
            fs, old, jvm = _fs(spark, f"{base}/{own}/v={n:06d}")
            n = newest + 1
            fs.rename(old, jvm.org.apache.hadoop.fs.Path(f"{base}/{own}/v={n:06d}"))
        if _point_to(spark, base, n, f"{own}/v={n:06d}"):
            return f"{base}/{own}/v={n:06d}"


# ---------------------------------------------------------------------------
# S8 metrics log
# ---------------------------------------------------------------------------
def metrics_long(df: DataFrame, keys: Iterable[str], metrics: Iterable[str]) -> DataFrame:
    """Wide per-key metrics -> long ``(keys..., metric, value)``."""
    metrics = list(metrics)
    return df.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot(list(keys), metrics, "metric", "value")


def log_metrics(df: DataFrame, path: str, run_id: str, keys: Iterable[str],
                metrics: Iterable[str], batch: str = "0") -> DataFrame:
    """Append run metrics as a long table
    ``(run_id, keys..., metric, value)`` to a parquet log; returns the rows
    appended.

    A batch of metrics (a report: one row per key and metric) is one file, named
    by a hash of ``run_id`` and ``batch`` and moved into the log when it is
    complete, so that logging a batch again, after a failure or by a second
    writer, adds nothing."""
    keys, spark = list(keys), df.sparkSession
    long = metrics_long(df, keys, metrics).select(F.lit(run_id).alias("run_id"), *keys, "metric", "value")
    name = hashlib.sha256(f"{len(run_id)}:{run_id}{batch}".encode()).hexdigest()[:32]
    base = path.rstrip("/")
    fs, target, jvm = _fs(spark, f"{base}/{name}.parquet")
    if fs.exists(target):
        return long.limit(0)
    folder = f"{base}/_writing-{uuid.uuid4().hex}"  # names that begin like this are no data
    long.coalesce(1).write.parquet(folder)
    here = jvm.org.apache.hadoop.fs.Path(folder)
    for status in fs.listStatus(here):
        if status.getPath().getName().endswith(".parquet") and not fs.exists(target):
            fs.rename(status.getPath(), target)
    fs.delete(here, True)
    return long


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory in the shared checkpoint folder."""
    return scratch_path(spark, f"{label}-{uuid.uuid4().hex[:12]}")
