"""A build as tables that depend on tables: each is written as soon as its inputs are stored.

Every table that shuffles is made in a session of its own, which reads its
inputs back from their files and whose shuffles are sized for them: the rows
counted while the inputs were written, times the width of their columns.  So
two builds of different size in one session, and a small and a large table of
one build, get different partition numbers; adaptive execution coalesces what
map-side combination made small.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

PARTITION_BYTES = 128 << 20
_INITIAL_NUMBER = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_STRING_BYTES = 24
_NUMBER_BYTES = {"int": 4, "boolean": 1}
_ROW_BYTES = 16


def row_bytes(schema: StructType) -> int:
    """Estimated bytes of a shuffled row."""

    def width(kind: DataType) -> int:
        return _STRING_BYTES if isinstance(kind, StringType) else _NUMBER_BYTES.get(kind.simpleString(), 8)

    return _ROW_BYTES + sum(width(field.dataType) for field in schema)


def partitions_for(inputs: list[tuple[int, StructType]], partition_bytes: int, least: int) -> int:
    """Shuffle partitions for inputs of so many rows."""
    size = sum(rows * row_bytes(schema) for rows, schema in inputs)
    return max(least, -(-size // partition_bytes))


def sibling_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings, whose own can differ."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


class Build:
    """Tables under ``folder``, each written when its inputs are."""

    def __init__(self, spark: SparkSession, folder: str, partition_bytes: int = PARTITION_BYTES):
        self.spark, self.folder, self.partition_bytes = spark, folder, partition_bytes
        self.rows: dict[str, int] = {}
        self.partitions: dict[str, int] = {}
        self.times: dict[str, tuple[float, float]] = {}
        self._schemas: dict[str, StructType] = {}
        self._steps: dict[str, Future] = {}
        self._pool = ThreadPoolExecutor(max_workers=32)  # more than there are steps: waiting steps hold a thread

    def read(self, name: str, spark: SparkSession | None = None) -> DataFrame:
        return (spark or self.spark).read.schema(self._schemas[name]).parquet(f"{self.folder}/{name}")

    def _sized(self, name: str, inputs: tuple[str, ...]) -> SparkSession:
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = partitions_for([(self.rows[i], self._schemas[i]) for i in inputs], self.partition_bytes, least)
        # a number that the caller has set stays
        self.partitions[name] = int(self.spark.conf.get(_INITIAL_NUMBER, None) or wanted)
        own = sibling_session(self.spark)
        own.conf.set(_INITIAL_NUMBER, str(self.partitions[name]))
        return own

    def _after(self, name: str, inputs: tuple[str, ...], step: Callable[[], object]) -> Future:
        def run():
            for i in inputs:
                self._steps[i].result()
            began = time.time()
            try:
                return step()
            finally:
                self.times[name] = (began, time.time())

        self._steps[name] = self._pool.submit(run)
        return self._steps[name]

    def _store(self, name: str, df: DataFrame) -> None:
        counted = Observation()
        seen = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        seen.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        self._schemas[name] = df.schema
        self.rows[name] = counted.get["rows"]

    def source(self, name: str, df: DataFrame) -> None:
        """A table made from outside the build."""
        self._after(name, (), lambda: self._store(name, df))

    def table(self, name: str, inputs: tuple[str, ...], make: Callable[..., DataFrame]) -> None:
        """A table made from stored ones."""

        def step():
            own = self._sized(name, inputs)
            self._store(name, make(*[self.read(i, own) for i in inputs]))

        self._after(name, inputs, step)

    def then(self, name: str, inputs: tuple[str, ...], run: Callable[..., object], sized: bool = True) -> Future:
        """The result of other work on stored tables, in a sized session or in the caller's."""

        def step():
            own = self._sized(name, inputs) if sized else self.spark
            return run(*[self.read(i, own) for i in inputs])

        return self._after(name, inputs, step)

    def finish(self, *names: str) -> None:
        """Wait for these steps; the first failure is raised."""
        for name in names:
            self._steps[name].result()

    def close(self) -> None:
        """Wait until nothing of the build runs any more."""
        self._pool.shutdown(wait=True)
