"""A stored Parquet table as a stream that admits so many rows a trigger and can be replayed from any row.

The offset is a row number over the table's files in the order of their paths. The driver holds the list of files with their row counts, which
Spark has counted; rows are read by the tasks, each from its own stretch of a file. The files must not change while a query uses them.
A micro-batch is asked for again by the same two offsets, so a restart neither loses nor repeats rows.
"""

from __future__ import annotations

import bisect
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "rows_of_table"


@dataclass
class Stretch(InputPartition):
    """Rows ``first`` to ``last`` (excluded) of one file."""

    path: str
    first: int
    last: int


class RowReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.limit, self.stretch = schema, int(options["limit"]), int(options["stretch"])
        self.files = json.loads(options["files"])
        self.ends = list(itertools.accumulate(n for _, n in self.files))
        self.at: int | None = None  # admitted so far; a restarted query tells by its first commit or replay

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        total = self.ends[-1] if self.ends else 0
        self.at = min(total, (self.at or 0) + self.limit)
        return {"row": self.at}

    def commit(self, end: dict) -> None:
        self.at = max(self.at or 0, end["row"])

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        self.at = max(self.at or 0, end["row"])
        found, row = [], start["row"]
        i = bisect.bisect_right(self.ends, row)
        while row < end["row"]:
            path, rows = self.files[i]
            before = self.ends[i] - rows
            last = min(end["row"], self.ends[i])
            found += [Stretch(path, a - before, min(a + self.stretch, last) - before) for a in range(row, last, self.stretch)]
            row, i = last, bisect.bisect_right(self.ends, last)
        return found

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        system, path = fs.FileSystem.from_uri(partition.path)
        with system.open_input_file(path) as opened:
            file = pq.ParquetFile(opened)
            sizes = [file.metadata.row_group(g).num_rows for g in range(file.num_row_groups)]
            ends = list(itertools.accumulate(sizes))
            groups = [g for g, e in enumerate(ends) if e > partition.first and e - sizes[g] < partition.last]
            at = ends[groups[0]] - sizes[groups[0]]
            for batch in file.iter_batches(row_groups=groups, columns=self.schema.names):
                low, high = max(partition.first - at, 0), min(partition.last - at, batch.num_rows)
                at += batch.num_rows
                if low < high:
                    part = pa.Table.from_batches([batch.slice(low, high - low)]).select(self.schema.names)
                    yield from part.cast(schema).to_batches()


class RowsOfTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> RowReader:
        return RowReader(schema, self.options)


def files_of(table: DataFrame) -> list[tuple[str, int]]:
    """Path and row count of each file of a stored table, in the order of the paths; empty files are left out."""
    counted = table.select(F.col("_metadata.file_path").alias("path")).groupBy("path").count().orderBy("path")
    return [(r["path"], r["count"]) for r in counted.collect()]  # as many rows as files


def read_rows_as_stream(spark: SparkSession, path: str, limit: int, stretch: int = 1_000_000) -> DataFrame:
    """The Parquet table at ``path`` as a stream of at most ``limit`` rows a micro-batch, read by one task for each ``stretch`` rows of a file."""
    if limit < 1 or stretch < 1:
        raise ValueError("limit and stretch are at least one row")
    table = spark.read.parquet(path)
    spark.dataSource.register(RowsOfTable)
    return (spark.readStream.format(FORMAT).schema(table.schema).option("limit", limit).option("stretch", stretch)
            .option("files", json.dumps(files_of(table))).load())
