"""Shared helpers: table loading, text UDFs over Arrow batches, held-out folds."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botsieve.session import work_dir
from botsieve.sources.shared_files import SharedFiles

# Words of the digest contracts: runs without ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
RUN_BYTES = 1 << 20
BATCH_KEY, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark from wherever ``sf_dir`` lies."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared work folder, read back: cuts lineage,
    is computed once, and survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    for made in MADE:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


MADE: list[list[str]] = []


def only_result(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``make()`` as a written table. The other tables that were written to make
    it, its inner cut points, are deleted: nothing reads them once the result is
    on disk."""
    made: list[str] = []
    MADE.append(made)
    try:
        result = written(make(), name)
    finally:
        MADE.pop()
    files = SharedFiles(result.sparkSession)
    for path in made[:-1]:
        files.delete(path)
    return result


def utf8(col: str | Column) -> Column:
    """A text column as its UTF-8 bytes (null: empty)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("binary"), F.lit(b""))


def batch_udf(make: Callable[[], Callable[..., pa.Array]], return_type: str, columns: int = 1) -> Callable[..., Column]:
    """An Arrow UDF whose ``make()`` runs once per task and gives the function
    from Arrow columns to one Arrow column. The function sees rows in runs of
    about ``RUN_BYTES`` of the first column (or one longer row), so what a task
    holds at once does not grow with the rows of a partition."""
    small_batches(SparkSession.active())
    if columns == 1:
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            f = make()
            for batch in batches:
                for a, b in runs(batch):
                    yield f(batch[a:b])
    else:
        def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            f = make()
            for batch in batches:
                for a, b in runs(batch[0]):
                    yield f(*(column[a:b] for column in batch))
    return F.arrow_udf(run, return_type)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 8 MB in place of Spark's default of 64 MB: each task
    holds a batch several times over, in the JVM and in Python. A value that
    the user has set stays."""
    if spark.conf.get(BATCH_KEY) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, "8m")


def runs(texts: pa.Array, most: int = RUN_BYTES, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Bounds of runs of about ``most`` bytes and at most ``rows`` rows."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        stop = max(at + 1, min(at + rows, full))
        yield at, stop
        at = stop


def struct_array(return_type: list[tuple[str, pa.DataType]], columns: list) -> pa.StructArray:
    """Python or Arrow columns as one Arrow struct column."""
    arrays = [values if isinstance(values, pa.Array) else pa.array(values, kind) for (_, kind), values in zip(return_type, columns)]
    return pa.StructArray.from_arrays(arrays, fields=[pa.field(n, k) for n, k in return_type])


def slices(texts: pa.Array, most: int = 1 << 18, rows: int = 64) -> Iterator[list[bytes]]:
    """Whole texts of a binary column (null: empty) in runs of about ``most``
    bytes and at most ``rows`` rows."""
    for a, b in runs(texts, most, rows):
        yield [t.as_py() or b"" for t in texts[a:b]]


def unused(columns: list[str], *names: str) -> list[str]:
    """``names`` with underscores added until no column has them."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def fold(col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % parts
