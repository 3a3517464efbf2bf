"""Check metrics for every micro-batch of a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from layerkit.operators.checks import Check, DuplicateCheck, Policy, check_results, results_of_counts

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ALL = "_all"


class CheckQueries:
    """The streaming queries behind `check_stream`."""

    def __init__(self, queries: Sequence[StreamingQuery]):
        self.queries = list(queries)

    def awaitTermination(self) -> None:  # noqa: N802 - as a streaming query has it
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for the queries started meanwhile, which take a copy of it."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _keys_at(target: str, check: DuplicateCheck) -> str:
    return f"{target}_keys/{check.name}"


def repeated_keys(spark: SparkSession, check: DuplicateCheck, target: str) -> DataFrame:
    """Keys that occur more than once in all batches `check_stream` has seen, with their counts. Reads what
    was repeated in each batch, not every key."""
    n = F.col(check.count_as)
    return spark.read.parquet(_keys_at(target, check)).groupBy(*check.keys).agg(F.max(n).alias(check.count_as))


def key_counts(stream: DataFrame, check: DuplicateCheck) -> DataFrame:
    """Rows per key so far, and in one more row, marked `_all`, of the whole stream; counted in the state
    store, so a batch brings only the keys it has touched."""
    both = stream.select(*check.keys, F.explode(F.array(F.lit(False), F.lit(True))).alias(_ALL))
    keys = [F.when(~F.col(_ALL), F.col(k)).alias(k) for k in check.keys]
    return both.groupBy(_ALL, *keys).agg(F.count(F.lit(1)).alias(check.count_as))


def _watch_keys(stream: DataFrame, pos: int, check: DuplicateCheck, target: str, policy: Policy | None):
    """Stores the keys of each batch that are repeated by now, and the check's result row."""
    sums = f"{target}_rows/{check.name}"
    n = F.col(check.count_as)

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = f"{_keys_at(target, check)}/batch_id={batch_id}"
        one = f"{sums}/batch_id={batch_id}"
        # the changed groups are read twice but come from the state once
        batch.persist()
        try:
            batch.where(~F.col(_ALL) & (n > 1)).drop(_ALL).write.mode("overwrite").parquet(touched)
            batch.where(_ALL).select(n.alias("rows")).coalesce(1).write.mode("overwrite").parquet(one)
        finally:
            batch.unpersist()
        issues = spark.read.parquet(touched).count()
        layout = T.StructType([T.StructField("rows", T.LongType())])
        # a batch without rows has no such line
        upto = spark.read.schema(layout).parquet(one).first()
        earlier = spark.read.schema(layout).parquet(f"{sums}/batch_id={batch_id - 1}").first() if batch_id else None
        before = earlier[0] if earlier else 0
        now = upto[0] if upto else before
        results = results_of_counts(spark, [(pos, check)], [(pos, now - before, issues)], policy)
        results.coalesce(1).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}/part={pos}")

    return key_counts(stream, check).writeStream.outputMode("update").foreachBatch(store)


def check_stream(
    stream: DataFrame,
    checks: Sequence[Check],
    target: str,
    checkpoint: str,
    policy: Policy | None = None,
) -> CheckQueries:
    """Store one result row per check and batch at `target`, partitioned by `batch_id`. A
    batch run again replaces its own rows. The checks see the batch as their table.

    A duplicate check also knows the keys of earlier batches: it is a query of its own that keeps the
    counts of all keys in the state store (RocksDB), so a batch costs by its own rows however many came before.
    """
    spark = stream.sparkSession
    rest = [(pos, c) for pos, c in enumerate(checks) if not isinstance(c, DuplicateCheck)]

    def store(batch: DataFrame, batch_id: int) -> None:
        wanted = [c for _, c in rest]
        results = check_results(batch.sparkSession, wanted, {c.table: batch for c in wanted}, policy)
        place = F.get(F.array(*[F.lit(pos) for pos, _ in rest]), F.col("check_pos"))
        results = results.withColumn("check_pos", place)
        results.coalesce(1).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}/part=rows")

    writers = [(f"{checkpoint}/rows", stream.writeStream.foreachBatch(store))] if rest else []
    for pos, check in enumerate(checks):
        if isinstance(check, DuplicateCheck):
            writers.append((f"{checkpoint}/keys-{check.name}", _watch_keys(stream, pos, check, target, policy)))
    with _set(spark, _PROVIDER, _ROCKSDB):
        return CheckQueries([
            writer.option("checkpointLocation", at).trigger(availableNow=True).start() for at, writer in writers
        ])
