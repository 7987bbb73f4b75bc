"""The store as a whole: a folder of Parquet tables with search, recall, upsert, scroll, forget, collect and prepare.

Points are appended as versions and read as the latest of each id, so writers never rewrite; ``compact`` does. Every read
excludes archived points unless asked. One call answers a whole table of queries.
"""

from __future__ import annotations

import time
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.conf import EngineConf, warn_once
from recollect.functions import embed, entities, gate, temporal
from recollect.functions.text import TEXT_LIMIT, valid_point_id
from recollect.operators import chunks, docindex, filters, lexical, rank, store
from recollect.runtime import stage
from recollect.streaming import jobs

SCHEMA = "point_id long, version long, text string, session_id string, kind string, source string, ts double, importance double, archived boolean, superseded_by long, deleted boolean, dense array<double>"
EVENTS = "point_id long, ts double, seq long, event string, delta int, text string"
EVENT_NAMES = ("add", "update", "recall", "feedback", "delete")
TOOLS = ("search", "upsert", "recall", "collect", "prepare", "forget", "md_search")


class MemoryStore:
    def __init__(self, spark: SparkSession, path: str, conf: EngineConf | None = None, embedder=None):
        self.spark, self.path, self.conf = spark, path.rstrip("/"), conf or EngineConf()
        self.embed = embedder or embed.hash_embedder(self.conf.dims)
        for name, schema in (("points", SCHEMA), ("ledger", EVENTS)):
            if not self._exists(name):
                spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{name}")

    def _exists(self, name: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def drop(self) -> bool:
        """Delete the store's folder; whether it was there."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def _append(self, rows: DataFrame) -> None:
        """Add versions; columns that are not given are null."""
        wanted = self.spark.createDataFrame([], SCHEMA).schema
        own = {c for c in rows.columns}
        rows.select([(F.col(f.name) if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted]).write.mode("append").parquet(f"{self.path}/points")

    def points(self, include_archived: bool = False) -> DataFrame:
        versions = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/points")
        latest = versions.groupBy("point_id").agg(F.max_by(F.struct(*[c for c in versions.columns if c != "point_id"]), "version").alias("p")).select("point_id", "p.*")
        rows = latest.where(~F.coalesce("deleted", F.lit(False))).drop("deleted")
        return rows if include_archived else rows.where(~F.coalesce("archived", F.lit(False)))

    def upsert(self, rows: DataFrame, version: int | None = None) -> None:
        """Points (point_id, text, ...) that pass the store gate, embedded; an id that exists is replaced."""
        kept = rows.where(~gate.skip_store(F.col("text"))) if self.conf.gate else rows
        kept = kept.withColumn("text", F.substring("text", 1, TEXT_LIMIT))
        self._append(kept.withColumn("dense", self.embed("text")).withColumn("version", F.lit(version or time.time_ns())))

    def search(self, queries: DataFrame, k: int | None = None, spec: dict | None = None, scope: dict | None = None) -> DataFrame:
        """query_id, point_id, score, rank, text, ts of the best points for each query (query_id, query)."""
        k = min(max(k or self.conf.top_k, 1), 100)
        allowed = filters.matching(self.points(), spec, scope)
        asked = queries.withColumn("dense", self.embed("query"))
        found = rank.dense_topk(allowed, asked, k, self.conf.metric)
        if self.conf.hybrid:
            texts = allowed.select(F.col("point_id").alias("chunk_id"), "text")

            def sparse():
                terms = lexical.query_terms(queries)
                scores = lexical.bm25(lexical.postings(texts, "text", asked=terms), lexical.corpus_stats(texts, "text"), terms)
                return lexical.topk(scores, k).withColumnRenamed("chunk_id", "point_id")

            found = rank.hybrid(found, sparse, k, on_error=lambda e: warn_once("sparse", f"search goes on without its sparse arm: {type(e).__name__}"))
        return found.join(allowed.select("point_id", "text", "ts"), "point_id")

    def recall(self, queries: DataFrame, now: datetime | None = None, k: int | None = None, scope: dict | None = None) -> DataFrame:
        """The recall pipeline: gate, search, near copies out, and the stages that are switched on."""
        asked = queries.where(~gate.skip_recall(F.col("query"))) if self.conf.gate else queries
        found = self.search(asked, k, scope=scope).join(asked.select("query_id", "query"), "query_id")
        found = rank.without_near_copies(found.where("text != ''"))
        if self.conf.temporal:
            found = found.withColumn("w", temporal.window_udf(now or datetime.now(UTC))("query"))
            found = rank.time_window(found, F.col("w.start"), F.col("w.end")).drop("w")
        if self.conf.entities:
            found = rank.boosted(found, entities.coverage(entities.mentions(F.col("query")), F.col("text")))
        if self.conf.rerank:
            found = rank.reranked(found, rank.word_overlap(F.col("query"), F.col("text")))
        return found

    def scroll(self, session_id: str | None = None, limit: int = 100, include_archived: bool = False) -> DataFrame:
        scope = {"session_id": session_id} if session_id is not None else {}
        return filters.matching(self.points(include_archived), {}, scope, include_archived).where("text != ''").orderBy("point_id").limit(min(max(limit, 1), 1000))

    def forget(self, ids: list[str], confirm: bool = False) -> DataFrame:
        """seq, id, status of the requested ids; with ``confirm`` those found are deleted."""
        asked = self.spark.createDataFrame([(i, str(x)) for i, x in enumerate(ids)], "seq int, id string")
        known = self.points(True).select(F.col("point_id").cast("string").alias("point_id"))
        plan = store.forget_plan(asked, known)
        plan = self.spark.createDataFrame(plan.collect(), plan.schema)  # at most FORGET_LIMIT rows, pinned before they are deleted
        if confirm:
            gone = plan.where("status = 'found'").where(valid_point_id(F.col("id"))).select(F.col("id").try_cast("long").alias("point_id")).where("point_id is not null").distinct()
            self._append(gone.withColumn("deleted", F.lit(True)).withColumn("version", F.lit(time.time_ns())))
        return plan

    def flag(self, flags: DataFrame) -> None:
        """Set archived, superseded_by or both of points (point_id, archived, superseded_by)."""
        marked = store.flagged(self.points(True), flags, "point_id", *[c for c in ("archived", "superseded_by") if c in flags.columns])
        self._append(marked.join(flags.select("point_id"), "point_id", "left_semi").withColumn("version", F.lit(time.time_ns())))

    def record(self, events: DataFrame) -> None:
        """Append ledger events (point_id, ts, seq, event, delta, text) of known names."""
        wrong = events.where(~F.col("event").isin(*EVENT_NAMES)).limit(1).collect()
        if wrong:
            raise ValueError(f"unknown event {wrong[0]['event']!r}")
        events.select("point_id", "ts", "seq", "event", "delta", "text").write.mode("append").parquet(f"{self.path}/ledger")

    def ledger(self) -> DataFrame:
        return store.newest_events(self.spark.read.schema(EVENTS).parquet(f"{self.path}/ledger"))

    def compact_ledger(self) -> None:
        """Write the newest events of each point in place of all."""
        self._put("ledger", self.ledger().drop("n"))

    # --- maintenance

    def decay(self, now: float, half_life: float = store.HALF_LIFE_DAYS, apply: bool = False) -> DataFrame:
        """Counters of a decay scan, one row; with ``apply`` what falls below is archived."""
        plan = stage(store.decay_plan(self.points(), now, half_life), "decay-plan")
        if apply:
            self.flag(store.decay_flags(plan))
        return store.decay_counters(plan)

    def unarchive(self) -> None:
        self.flag(stage(store.unarchived_flags(self.points(True)), "unarchive"))

    def dedup(self, threshold: float = 0.92, limit: int | None = None, allow_unbounded: bool = False, block: str = "session_id") -> DataFrame:
        """point_id, superseded_by, archived of the points that a newer, similar one supersedes; they are flagged so."""
        flags = stage(store.duplicate_flags(self.points().withColumn(block, F.coalesce(block, F.lit(""))), block, threshold, limit, allow_unbounded), "dedup")
        self.flag(flags)
        return flags

    def unmerge(self) -> None:
        """Points that were superseded are as before."""
        back = stage(self.points(True).where("superseded_by is not null"), "unmerge")
        self._append(back.withColumn("superseded_by", F.lit(None).cast("long")).withColumn("archived", F.lit(False)).withColumn("version", F.lit(time.time_ns())))

    # --- documents

    @property
    def documents(self) -> docindex.LexicalIndex:
        return docindex.LexicalIndex(self.spark, f"{self.path}/documents")

    def _embed_files(self, files: DataFrame) -> None:
        """Chunks of files with ids and vectors; what was there for their paths goes."""
        rows = chunks.with_ids(chunks.chunked(files.select("path", "content"))).select("path", "heading", "content", "chunk_id", self.embed("content").alias("dense"), F.lit(time.time_ns()).alias("version"))
        rows.write.mode("append").parquet(f"{self.path}/document_vectors")

    def md_ingest(self, files: DataFrame) -> DataFrame:
        """path, tier, status of the files (path, root, content, sha) that were new or changed for the lexical or the semantic tier."""
        index = self.documents
        return jobs.ingest_files(index, files, {"lexical": index.replace, "semantic": self._embed_files})

    def md_search(self, queries: DataFrame, mode: str = "auto", limit: int = 5, root: str | None = None) -> tuple[DataFrame, DataFrame]:
        """(hits, notes) of the two-tier document search; see ``docindex.md_search``."""

        def semantic(asked: DataFrame) -> DataFrame:
            rows = self.spark.read.parquet(f"{self.path}/document_vectors")
            newest = rows.groupBy("path").agg(F.max("version").alias("version"))
            rows = rows.join(newest, ["path", "version"], "left_semi").withColumn("point_id", F.xxhash64("chunk_id"))
            rows = rows.where(docindex.root_of(F.col("path")) == root) if root else rows
            hits = rank.dense_topk(rows, asked.withColumn("dense", self.embed("query")), 2 * limit)
            return hits.join(rows.select("point_id", "path"), "point_id")

        return docindex.md_search(queries, lambda q: self.documents.search(q, limit, root), semantic, mode, limit)

    def status(self) -> DataFrame:
        """item, value of the store: settings, points, documents and the last write."""
        own = [(k, str(v)) for k, v in sorted(vars(self.conf).items())]
        counts = self.collect().first().asDict() | {f"document_{k}": v for k, v in self.documents.stats().first().asDict().items()}
        last = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/points").agg(F.max("version")).first()[0]
        return self.spark.createDataFrame([*own, *[(k, str(v)) for k, v in counts.items()], ("last_write", str(last))], "item string, value string")

    def call(self, tool: str, **arguments):
        """A tool by its name: search, upsert, recall, collect, prepare, forget, md_search."""
        if tool not in TOOLS:
            raise ValueError(f"unknown tool {tool!r}")
        return getattr(self, tool)(**arguments)

    def collect(self) -> DataFrame:
        """One row: points, archived, sessions and vector width."""
        p = self.points(True)
        return p.agg(F.count("*").alias("points"), F.count_if("archived").alias("archived"), F.count_distinct("session_id").alias("sessions"), F.max(F.size("dense")).alias("width"))

    def prepare(self) -> DataFrame:
        """fault, n: what is wrong with vectors and texts; empty if the store is ready."""
        p = self.points(True)
        fault = F.coalesce(store.vector_faults(F.col("dense"), self.conf.dims), F.when(F.trim("text") == "", "blank text"))
        return p.select(fault.alias("fault")).where("fault is not null").groupBy("fault").agg(F.count("*").alias("n"))

    def _put(self, name: str, rows: DataFrame) -> None:
        """Write rows as a new folder and put it in a table's place."""
        target = f"{self.path}/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(target)
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(target).getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(fs_path(f"{self.path}/{name}"), True)
        fs.rename(fs_path(target), fs_path(f"{self.path}/{name}"))

    def compact(self) -> None:
        """Write the latest versions in place of all."""
        self._put("points", self.points(True).withColumn("deleted", F.lit(False)))
