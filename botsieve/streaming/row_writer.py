"""A per-row writer whose rows are kept, each exactly once.

``writeStream.foreach(StagedRows(...))`` hands rows one by one to a writer per
(partition, epoch). The rows go to a file that only this attempt writes, in
pieces of ``ROWS``, and ``close`` gives it its final name, one for the partition
and epoch. An attempt that fails or is killed leaves a file that no reader
looks at; its retry, or a replay of the whole epoch, puts the same rows under
the same name. A stateful query keeps its partitions across restarts, so the
names of an epoch do not change.
"""

from __future__ import annotations

import uuid
from datetime import timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROWS = 10_000


class StagedRows:
    """Writes rows of ``schema`` below ``path``, a shared folder (mounted on every
    executor, or any URI that Arrow's file systems open)."""

    def __init__(self, path: str, schema: T.StructType, rows: int = ROWS):
        self.path, self.schema, self.rows = path.rstrip("/"), to_arrow_schema(schema), rows
        self.times = [i for i, f in enumerate(schema.fields) if isinstance(f.dataType, T.TimestampType)]

    def open(self, partition_id: int, epoch_id: int) -> bool:
        from pyarrow import fs
        folder = f"{self.path}/epoch={epoch_id}"
        if folder.startswith("file:"):
            folder = "file:///" + folder[len("file:"):].lstrip("/")
        self.files, folder = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        self.files.create_dir(folder, recursive=True)
        self.final = f"{folder}/part-{partition_id:05d}.parquet"
        self.draft = f"{folder}/_part-{partition_id:05d}-{uuid.uuid4().hex}"   # readers skip names with an underscore
        self.held, self.out, self.writer = [], None, None
        return True

    def process(self, row) -> None:
        values = list(row)
        for i in self.times:    # a row has timestamps as local times
            values[i] = values[i] and values[i].astimezone(timezone.utc)
        self.held.append(values)
        if len(self.held) >= self.rows:
            self._flush()

    def _flush(self) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq
        if self.writer is None:
            self.out = self.files.open_output_stream(self.draft)
            self.writer = pq.ParquetWriter(self.out, self.schema)
        self.writer.write_table(pa.table([pa.array(c, f.type) for c, f in zip(zip(*self.held), self.schema)], schema=self.schema))
        self.held = []

    def close(self, error) -> None:
        if error is None and self.held:
            self._flush()
        if self.writer is not None:
            self.writer.close()
            self.out.close()
        if error is not None:
            raise error
        if self.writer is not None:     # no rows: no file, at each attempt
            self.files.move(self.draft, self.final)


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all epochs, with the epoch."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])).parquet(path)

