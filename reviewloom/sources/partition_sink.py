"""Writing to an external store in two phases, so that retried tasks cannot double rows.

Every task stages its rows and hands a receipt to the driver; only when all tasks have
ended are the receipts published together.  A task that is run again stages anew, and
what no receipt names is never published; a write that fails discards what was staged.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


class PartitionSink(Protocol):
    """A store that can hold rows back until they are published; it is pickled to the workers."""

    def stage(self, run: str, partition: int, rows: Iterator[Row]) -> dict:
        """Take a task's rows without showing them; the receipt says what was taken."""

    def publish(self, run: str, receipts: Sequence[dict]) -> None:
        """Show the rows of all receipts at once; a second call for the same run changes nothing."""

    def discard(self, run: str, receipts: Sequence[dict]) -> None:
        """Forget staged rows of a write that failed."""


@dataclass
class Receipt(WriterCommitMessage):
    content: dict


def write_partitions(df: DataFrame, sink: PartitionSink, keys: Sequence[str] = (), partitions: int = 10) -> str:
    """Write ``df`` through ``sink`` with at most ``partitions`` writers at a time, rows of equal keys in one; returns the run's name."""
    run = uuid.uuid4().hex

    class Writer(DataSourceWriter):
        def write(self, iterator: Iterator[Row]) -> Receipt:
            context = TaskContext.get()
            return Receipt(sink.stage(run, context.partitionId() if context else 0, iterator))

        def commit(self, messages: list) -> None:
            sink.publish(run, [m.content for m in messages if m is not None])

        def abort(self, messages: list) -> None:
            sink.discard(run, [m.content for m in messages if m is not None])

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"partition_sink_{run}"

        def writer(self, schema: StructType, overwrite: bool) -> Writer:
            return Writer()

    df.sparkSession.dataSource.register(Source)
    dealt = df.repartition(partitions, *keys) if keys else df.repartition(partitions)
    dealt.write.format(Source.name()).mode("append").save()
    return run


class JsonFolderSink:
    """JSON lines in a folder that driver and workers share; readers follow the manifests."""

    def __init__(self, folder: str, fail: tuple[str, int] | None = None) -> None:
        self.folder = folder.removeprefix("file:")
        self.fail = fail  # a marker file and a partition that fails while the file is missing, for tests of recovery

    def stage(self, run: str, partition: int, rows: Iterator[Row]) -> dict:
        name = f"{run}-{partition}-{uuid.uuid4().hex}.jsonl"
        os.makedirs(f"{self.folder}/staged", exist_ok=True)
        count = 0
        with open(f"{self.folder}/staged/{name}", "w") as out:
            for row in rows:
                out.write(json.dumps(row.asDict(recursive=True), default=str) + "\n")
                count += 1
                if self.fail and partition == self.fail[1] and not os.path.exists(self.fail[0]):
                    with open(self.fail[0], "w"):
                        raise RuntimeError("the store went away")
        return {"file": name, "rows": count}

    def publish(self, run: str, receipts: Sequence[dict]) -> None:
        # One small file makes all rows visible; it appears whole, under a name of its own.
        manifest, passing = f"{self.folder}/manifest-{run}.json", f"{self.folder}/passing-{uuid.uuid4().hex}"
        with open(passing, "w") as out:
            json.dump({"files": [r["file"] for r in receipts if r["rows"]], "rows": sum(r["rows"] for r in receipts)}, out)
        os.replace(passing, manifest)

    def discard(self, run: str, receipts: Sequence[dict]) -> None:
        for name in os.listdir(f"{self.folder}/staged") if os.path.isdir(f"{self.folder}/staged") else []:
            if name.startswith(f"{run}-"):
                os.remove(f"{self.folder}/staged/{name}")

    def published(self, spark: SparkSession, schema: StructType | str) -> DataFrame:
        """All rows that were published."""
        files = []
        for name in sorted(os.listdir(self.folder)):
            if name.startswith("manifest-"):
                with open(f"{self.folder}/{name}") as manifest:
                    files += [f"{self.folder}/staged/{f}" for f in json.load(manifest)["files"]]
        return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)
