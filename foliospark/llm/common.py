"""What the operators share: reading tables, the shared folder, byte-level word splitting."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of bytes outside \x00-\x2F \x3A-\x60 \x7B-\x7F, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a local one of our own only in local mode."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"file://{tempfile.gettempdir()}/checkpoints"


#: Narrow rows to a file where their number is known: small tables shouldn't be hundreds of files.
FILE_ROWS = 20_000


def materialize(df: DataFrame, tag: str, rows: int | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors.

    rows: about how many it has, if known; the tasks that write it, 8 at least, follow from that. The tables go when the
    `scratch` they were written in ends, or else the driver.
    """
    return materialize_all([df if rows is None else df.coalesce(max(8, -(-rows // FILE_ROWS)))], tag)


def materialize_all(frames: Iterable[DataFrame], tag: str) -> DataFrame:
    """As materialize, for frames (one at least) of one schema, each written before the next is asked for."""
    path = None
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for df in frames:
        spark, schema = df.sparkSession, df.schema
        if path is None:
            path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
            if not _WRITTEN:
                atexit.register(_remove_all)
            _WRITTEN[path] = spark
        # what was shuffled to write the table is of no use once it stands
        before = spark.conf.get(cleanup, "false")
        spark.conf.set(cleanup, "true")
        try:
            df.write.mode("append").parquet(path)
        finally:
            spark.conf.set(cleanup, before)
    return spark.read.schema(schema).parquet(path)


#: The tables that are still there, oldest first.
_WRITTEN: dict[str, SparkSession] = {}


def _tables_of(df: DataFrame) -> list[str]:
    """The tables of `materialize` that df reads."""
    folders = {file.rsplit("/", 1)[0].rsplit("/", 1)[-1] for file in df.inputFiles()}
    return [path for path in _WRITTEN if path.rsplit("/", 1)[-1] in folders]


def discard(df: DataFrame) -> None:
    """Removes the tables of `materialize` that df reads: it can't be used after that."""
    for path in _tables_of(df):
        _remove(_WRITTEN.pop(path), path)


@contextmanager
def scratch():
    """Removes, at its end, the tables of `materialize` that were written inside, but those that frames given to the function it gives read."""
    before, kept = set(_WRITTEN), set()

    def keep(df: DataFrame) -> DataFrame:
        kept.update(_tables_of(df))
        return df

    yield keep
    for path in [p for p in _WRITTEN if p not in before and p not in kept]:
        _remove(_WRITTEN.pop(path), path)


def _remove_all() -> None:
    for path, spark in _WRITTEN.items():
        _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may be gone already
        pass


def fresh(*frames: DataFrame, base: str = "tmp") -> str:
    """A column name that none of the frames has, whatever the case."""
    taken = {c.lower() for f in frames for c in f.columns}
    return next(n for i in range(10**6) if (n := f"__{base}_{i}") not in taken)


def free_name(df: DataFrame, name: str) -> str:
    """What an operator calls a column that it adds: `name`, or if df has that (in any case) `name_1`, `name_2`, ..."""
    taken = {c.lower() for c in df.columns}
    return next(n for i in range(10**6) if (n := f"{name}_{i}" if i else name).lower() not in taken)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def by_name(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots included."""
    return df[quoted(name)]


def words_of(text: bytes) -> list[bytes]:
    """The words of a whole text (UTF-8), A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


def chunks(column, most: int = 1 << 20):
    """Slices (start, stop) of an Arrow string or binary array, of about `most` bytes each, one row at least."""
    import numpy as np

    n = len(column)
    if not n:
        return
    sizes = column.view("binary" if str(column.type) in ("string", "binary") else "large_binary")
    import pyarrow.compute as pc

    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(sizes), 0)))
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield start, min(stop, n)
        start = min(stop, n)


def as_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string array, null as empty."""
    import pyarrow as pa

    kind = pa.large_binary() if column.type in (pa.large_string(), pa.large_binary()) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def unit_hash(*parts: Column) -> Column:
    """A uniform double in (0, 1) from the md5 of the parts, the same in every engine: 52 bits."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def bounded_batches(spark: SparkSession, rows: int = 2000, size: int = 8 << 20) -> None:
    """What goes to a Python worker at a time, by rows and by bytes: long texts must not add up to the executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
