"""Structured Streaming forms: turn ingest, answered queries, tiered document ingest, ledger, counts, rolling latencies, breaker.

Each runs until its input is used up and gives the table it wrote. State and rows lie in the shared folder, so a job that is started again with
the same ``base`` goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from recollect.functions.embed import hash_embedder
from recollect.functions.gate import skip_store
from recollect.functions.text import fixed_chunks, uuid5
from recollect.operators.chunks import changes
from recollect.runtime import scratch, stage

#: Latencies that the rolling percentiles look back on.
LATENCIES = 200


def _stream(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder as a stream."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    files = path if spark.read.format("binaryFile").load(path).select("path").where(~F.col("path").endswith(name)).limit(1).count() else folder
    reader = spark.readStream.schema(schema)
    return reader.parquet(files) if files == path else reader.option("pathGlobFilter", name).parquet(folder)


def _base(spark: SparkSession, label: str, base: str | None) -> str:
    return base or scratch(spark, f"streams/{label}")


def _drained(rows: DataFrame, label: str, mode: str = "append", base: str | None = None) -> DataFrame:
    """Run a stream over all that is there; what it wrote."""
    spark = rows.sparkSession
    base = _base(spark, label, base)
    query = rows.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{base}/state").option("path", f"{base}/rows").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")


def _batched(rows: DataFrame, label: str, save: Callable[[DataFrame, int], None], mode: str = "append", base: str | None = None) -> None:
    """Run a stream over all that is there, a batch at a time."""
    state = f"{_base(rows.sparkSession, label, base)}/state"
    rows.writeStream.outputMode(mode).option("checkpointLocation", state).foreachBatch(save).trigger(availableNow=True).start().awaitTermination()


def ingested_turns(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, turn of the turns worth storing, appended as they arrive."""
    turns = _stream(spark, path).where(F.trim("text") != "").where(~skip_store(F.col("text")))
    return _drained(turns.select("conv_id", "turn"), "turns")


def ingested_points(spark: SparkSession, path: str, namespace: str, dims: int = 64, base: str | None = None) -> DataFrame:
    """point_id, session_id, msg_id, role, chunk_index, text, dense of the turns worth storing: their pieces, with ids made from their place, and vectors."""
    turns = _stream(spark, path).withColumn("text", F.trim("text")).where("text != ''").where(~skip_store(F.col("text")))
    parts = turns.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("msg_id"), "role", F.posexplode(fixed_chunks(F.col("text"))).alias("chunk_index", "text"))
    name = F.concat_ws(":", *[F.col(c).cast("string") for c in ("session_id", "msg_id", "chunk_index")])
    return _drained(parts.select(uuid5(namespace, name).alias("point_id"), "*", hash_embedder(dims)("text").alias("dense")), "points", base=base)


def answered(queries: DataFrame, answer: Callable[[DataFrame], DataFrame], schema: str, base: str | None = None) -> DataFrame:
    """What ``answer`` gives for each batch of a stream of queries, gathered ahead of being asked for."""
    spark = queries.sparkSession
    base = _base(spark, "answers", base)
    _batched(queries, "answers", lambda batch, number: answer(batch).write.mode("append").parquet(f"{base}/rows/batch={number}"), base=base)
    return spark.read.schema(schema).option("basePath", f"{base}/rows").parquet(f"{base}/rows").drop("batch")


def ingest_files(index, files: DataFrame, tiers: dict[str, Callable[[DataFrame], object]]) -> DataFrame:
    """path, tier, status of files (path, root, content, sha): each tier takes those that are new or changed for it.

    ``index`` keeps a marker ``<tier>_sha:<path>`` once a tier has taken a file, so a tier that fails or is added later catches up by itself.
    """
    out = None
    for tier, take in tiers.items():
        mark = f"{tier}_sha:"
        old = index.meta().where(F.startswith("k", F.lit(mark))).select(F.substring("k", len(mark) + 1, 1 << 20).alias("path"), F.col("v").alias("sha"))
        status = changes(files.select("path", "sha"), old).where("status in ('new', 'changed')")
        kept = stage(files.join(status, "path").select("path", "status", "sha", "root", "content"), f"tier-{tier}")
        if not kept.isEmpty():
            take(kept.drop("status"))
            index.set_meta(kept.select(F.concat(F.lit(mark), "path").alias("k"), F.col("sha").alias("v")))
        one = kept.select("path", F.lit(tier).alias("tier"), "status")
        out = one if out is None else out.unionByName(one)
    return out


def ingest_stream(files: DataFrame, index, tiers: dict[str, Callable[[DataFrame], object]], base: str | None = None) -> None:
    """Incremental ingest of a stream of files, batch by batch."""
    _batched(files, "files", lambda batch, number: ingest_files(index, batch, tiers), base=base)


def ledger_stream(events: DataFrame, base: str | None = None) -> DataFrame:
    """Ledger events of a stream, appended; counters are a view over what was appended."""
    return _drained(events, "ledger", base=base)


def counted_hits(events: DataFrame, key: str, hit, base: str | None = None) -> DataFrame:
    """key, attempts, hits so far, of a stream; the latest count of each key."""
    spark = events.sparkSession
    base = _base(spark, "hits", base)
    counts = events.groupBy(key).agg(F.count("*").alias("attempts"), F.count_if(hit).alias("hits"))
    _batched(counts, "hits", lambda batch, number: batch.withColumn("number", F.lit(number)).write.mode("append").parquet(f"{base}/rows"), "update", base)
    rows = spark.read.parquet(f"{base}/rows")
    return rows.groupBy(key).agg(F.max_by("attempts", "number").alias("attempts"), F.max_by("hits", "number").alias("hits"))


def rolling_latency(events: DataFrame, last: int = LATENCIES) -> DataFrame:
    """key, seq, p50, p95 over the last ``last`` values of each key (key, seq, value), as a stateful stream."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        out = []
        for row in pd.concat(list(frames)).sort_values("seq").itertuples():
            held = [*held, row.value][-last:]
            ordered = sorted(held)
            out.append((key[0], row.seq, *(ordered[max(1, -(-len(ordered) * p // 100)) - 1] for p in (50, 95))))
        state.update((held,))
        yield pd.DataFrame(out, columns=["key", "seq", "p50", "p95"])

    return events.groupBy("key").applyInPandasWithState(fold, "key long, seq long, p50 double, p95 double", "held array<double>", "append", GroupStateTimeout.NoTimeout)


class LastWrite(StreamingQueryListener):
    """What streams last wrote and how they ended, by name; ``tell`` is called with each event at level ``verbose``, with ends only at ``minimal``."""

    def __init__(self, tell: Callable[[str, dict], None] | None = None, level: str = "minimal"):
        self.status: dict[str, dict] = {}
        self.tell, self.level = tell, level

    def _note(self, name: str, event: str, **values) -> None:
        self.status.setdefault(name, {}).update(values)
        if self.tell and (self.level == "verbose" or (self.level == "minimal" and event != "progress")):
            self.tell(event, {"name": name, **values})

    def onQueryStarted(self, event) -> None:
        self._note(str(event.name or event.id), "started", running=True, error=None)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._note(str(p.name or p.id), "progress", batch=p.batchId, rows=p.numInputRows, at=p.timestamp)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._note(next((n for n, s in self.status.items() if s.get("running") and n == str(event.id)), str(event.id)), "ended", running=False, error=event.exception)


def windowed_counts(spark: SparkSession, path: str, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """day, event_type, n: events counted in event-time windows, in update batches merged by the latest count."""
    base = _base(spark, "counts", None)
    events = _stream(spark, path).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"))

    def save(batch: DataFrame, number: int) -> None:
        batch.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.lit(number).alias("batch")).write.mode("append").parquet(f"{base}/rows")

    query = counts.writeStream.outputMode("update").option("checkpointLocation", f"{base}/state").foreachBatch(save).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema("day string, event_type string, n long, batch long").parquet(f"{base}/rows")
    return rows.groupBy("day", "event_type").agg(F.max_by("n", "batch").alias("n"))


def breaker(attempts: DataFrame, limit: int = 5, pause: float = 120.0) -> DataFrame:
    """Streaming circuit breaker: endpoint, seq, is_open, failures of each attempt (endpoint, seq, ts, ok)."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failures, until = state.get if state.exists else (0, -1.0)
        out = []
        for row in pd.concat(list(frames)).sort_values("seq").itertuples():
            if 0 <= until <= row.ts:
                failures, until = 0, -1.0
            blocked = until >= 0
            if not blocked:
                failures = 0 if row.ok else failures + 1
                until = row.ts + pause if failures >= limit else -1.0
            out.append((key[0], row.seq, blocked, failures))
        state.update((failures, until))
        yield pd.DataFrame(out, columns=["endpoint", "seq", "is_open", "failures"])

    return attempts.groupBy("endpoint").applyInPandasWithState(fold, "endpoint string, seq long, is_open boolean, failures long", "failures long, until double", "append", GroupStateTimeout.NoTimeout)
