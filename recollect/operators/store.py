"""Store: latest-wins upserts, flags, deletion, backfill, ledger and maintenance of points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recollect.functions.text import fixed_chunks, uuid5, valid_point_id

HALF_LIFE_DAYS = 180.0
EXEMPT_IMPORTANCE = 0.7
EXEMPT_SOURCES = ("cli", "tui")
ARCHIVE_BELOW = 0.05
FORGET_LIMIT = 100
LEDGER_KEEP = 50


def upserted(old: DataFrame, new: DataFrame, key: str, version: str) -> DataFrame:
    """One row for each key, the one of the highest version; of equal versions the new row, then the one of the greatest values."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    pick = F.max_by(F.struct(*[F.col(c) for c in old.columns]), F.struct(version, "__new", F.xxhash64(*old.columns)))
    return both.groupBy(F.col(key).alias("__key")).agg(pick.alias("__row")).select("__row.*")


def flagged(points: DataFrame, flags: DataFrame, key: str, *columns: str) -> DataFrame:
    """``columns`` taken from ``flags`` where it has the key and a value; of several values of one key the greatest."""
    marks = flags.groupBy(key).agg(*[F.max(c).alias(f"__{c}") for c in columns])
    joined = points.join(marks, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns}).drop(*[f"__{c}" for c in columns])


def forget_plan(requested: DataFrame, points: DataFrame, limit: int = FORGET_LIMIT) -> DataFrame:
    """id, status (found, missing, invalid) of the first ``limit`` requested ids (seq, id)."""
    ids = requested.select("seq", F.trim("id").alias("id")).where("id != ''").orderBy("seq").limit(limit)
    known = points.select(F.col("point_id").alias("id"), F.lit(True).alias("known")).distinct()
    status = F.when(~valid_point_id(F.col("id")), "invalid").when(F.col("known"), "found").otherwise("missing")
    return ids.join(known, "id", "left").select("seq", "id", status.alias("status"))


def backfill(messages: DataFrame, namespace: str, kinds: list[str], existing: DataFrame) -> DataFrame:
    """Points of messages (session_id, msg_id, role, text) whose session is not stored yet."""
    clean = messages.where(F.col("role").isin(kinds)).withColumn("text", F.trim("text")).where("text != ''").join(existing.select("session_id").distinct(), "session_id", "left_anti")
    parts = clean.select("session_id", "msg_id", "role", F.posexplode(fixed_chunks(F.col("text"))).alias("chunk_index", "text"))
    name = F.concat_ws(":", F.col("session_id").cast("string"), F.col("msg_id").cast("string"), F.col("chunk_index").cast("string"))
    return parts.withColumn("point_id", uuid5(namespace, name))


def decay_score(age_days: Column, half_life: float = HALF_LIFE_DAYS) -> Column:
    if half_life <= 0:
        raise ValueError("half_life must be positive")
    return F.pow(F.lit(0.5), F.greatest(age_days, F.lit(0.0)) / half_life)


def decay_exempt(importance: Column, source: Column) -> Column:
    weighty = F.coalesce((importance >= EXEMPT_IMPORTANCE) & ~F.isnan(importance) & (importance < float("inf")), F.lit(False))
    return weighty | F.coalesce(F.lower(F.trim(source)).isin(*EXEMPT_SOURCES), F.lit(False))


def decay_plan(points: DataFrame, now: float, half_life: float = HALF_LIFE_DAYS, below: float = ARCHIVE_BELOW) -> DataFrame:
    """points with score and decision: exempt, no_timestamp, archive or keep."""
    scored = points.withColumn("score", decay_score((F.lit(now) - F.col("ts")) / 86400.0, half_life))
    decision = F.when(decay_exempt(F.col("importance"), F.col("source")), "exempt").when(F.col("ts").isNull(), "no_timestamp").when(F.col("score") < below, "archive").otherwise("keep")
    return scored.withColumn("decision", decision)


def decay_counters(plan: DataFrame) -> DataFrame:
    """considered, exempt, no_timestamp, below of a decay plan, one row."""
    is_ = lambda d: F.count_if(F.col("decision") == d)
    return plan.agg(F.count("*").alias("considered"), is_("exempt").alias("exempt"), is_("no_timestamp").alias("no_timestamp"), is_("archive").alias("below"))


def decay_flags(plan: DataFrame) -> DataFrame:
    """point_id, archived of the points that a decay plan archives; for ``flagged``."""
    return plan.where("decision = 'archive'").select("point_id", F.lit(True).alias("archived"))


def unarchived_flags(points: DataFrame) -> DataFrame:
    """point_id, archived = false of every archived point."""
    return points.where("archived").select("point_id", F.lit(False).alias("archived"))


def duplicate_flags(points: DataFrame, block: str, threshold: float = 0.92, limit: int | None = None, allow_unbounded: bool = False) -> DataFrame:
    """point_id, superseded_by, archived of the points that a newer, similar one of their block supersedes.

    Points (point_id, ts, dense, block) with a vector are clustered newest first; the first of a cluster stays. ``limit`` is how many of the newest
    points are looked at; to look at all of them has to be asked for.
    """
    if limit is None and not allow_unbounded:
        raise ValueError("a limit is needed, or allow_unbounded")
    real = points.where(F.size("dense") > 0)
    newest = [F.col("ts").desc_nulls_last(), F.col("point_id")]
    if limit is not None:
        real = real.orderBy(*newest).limit(limit)
    placed = real.withColumn("pos", F.row_number().over(Window.partitionBy(block).orderBy(*newest)))
    found = first_fit_clusters(placed, block, threshold)
    return found.where("point_id != cluster").select("point_id", F.col("cluster").alias("superseded_by"), F.lit(True).alias("archived"))


def unmerged_flags(points: DataFrame) -> DataFrame:
    """point_id, archived = false of every superseded point; ``superseded_by`` is to be cleared with it."""
    return points.where("superseded_by is not null").select("point_id", F.lit(False).alias("archived"))


def without_sparse(points: DataFrame, sparse: DataFrame) -> DataFrame:
    """Points that do not carry a sparse part yet, for a backfill that can be taken up again (point_id of both)."""
    return points.join(sparse.where(F.size("indices") > 0).select("point_id").distinct(), "point_id", "left_anti")


def sparse_part(text: Column, cells: int = 1 << 20) -> Column:
    """Sparse part of a text: indices (hashed terms, ascending) and values (how often each occurs)."""
    from recollect.functions.text import index_tokens

    hashed = F.transform(index_tokens(text), lambda t: F.pmod(F.xxhash64(t), F.lit(cells)).cast("int"))
    indices = F.array_sort(F.array_distinct(hashed))
    return F.struct(indices.alias("indices"), F.transform(indices, lambda i: F.size(F.filter(hashed, lambda h: h == i)).cast("double")).alias("values"))


def with_sparse(points: DataFrame, existing: DataFrame, text: str = "text") -> DataFrame:
    """point_id, indices, values: what exists, and the sparse part of every point that lacks one and has tokens."""
    fresh = without_sparse(points, existing).select("point_id", sparse_part(F.col(text)).alias("s")).select("point_id", "s.*").where(F.size("indices") > 0)
    return existing.where(F.size("indices") > 0).select("point_id", "indices", "values").unionByName(fresh)


def widened(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``rows`` with the columns (name to type) that they lack, null; those they have stay."""
    own = {c.lower() for c in rows.columns}
    return rows.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c.lower() not in own})


def newest_status(writes: DataFrame) -> DataFrame:
    """One row for each collection of writes (collection, ts, ok, error): when it was last written and the error of the latest one, if it failed."""
    latest = writes.groupBy("collection").agg(F.max_by(F.struct("ts", "ok", "error"), "ts").alias("w"), F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_good"), F.count_if(~F.col("ok")).alias("failures"))
    return latest.select("collection", F.col("w.ts").alias("last_write"), "last_good", "failures", F.when(~F.col("w.ok"), F.col("w.error")).alias("error"))


def merged_payloads(rows: DataFrame, group: str) -> DataFrame:
    """One payload for each group (columns point_id, text, ts, importance, chunk_index, session_id, pos)."""
    newest = F.struct(F.coalesce("ts", F.lit(float("-inf"))).alias("t"), (-F.col("pos")).alias("p"))
    longest = F.struct(F.length("text").alias("l"), F.coalesce("ts", F.lit(float("-inf"))).alias("t"), (-F.col("pos")).alias("p"))
    finite = F.when(~F.isnan("importance") & (F.abs("importance") < float("inf")), F.col("importance"))
    one = (F.count_distinct("chunk_index") == 1) & (F.count("chunk_index") == F.count("*"))
    merged = rows.groupBy(group).agg(
        F.max_by("point_id", newest).alias("point_id"),
        F.max_by("text", longest).alias("text"),
        F.max("ts").alias("ts"),
        F.max(finite).alias("importance"),
        F.when(one, F.max("chunk_index")).alias("chunk_index"),
        F.max_by("session_id", newest).alias("session_id"),
        F.array_sort(F.collect_set("session_id")).alias("sessions"),
    )
    others = F.filter("sessions", lambda s: s != F.col("session_id"))
    return merged.withColumn("merged_session_ids", F.array_join(others, ",")).drop("sessions")


def first_fit_clusters(points: DataFrame, block: str, threshold: float = 0.92) -> DataFrame:
    """point_id, cluster (its first point) of every cluster of several within each block: each vector joins the first cluster whose running mean is near enough.

    The result depends on the order (pos), so a block is one sequence; blocks are independent and bound the work.
    """
    if not -1 <= threshold <= 1:
        raise ValueError("threshold must be within [-1, 1]")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", kind="stable")
        means, counts, first, label = [], [], [], []
        for point, v in zip(rows["point_id"], rows["dense"], strict=True):
            v = np.asarray(v if v is not None else [], dtype=np.float64)
            norm = np.sqrt((v * v).sum())
            hit = -1
            if norm > 0:
                for i, m in enumerate(means):
                    size = np.sqrt((m * m).sum())
                    if len(m) != len(v):
                        raise ValueError("vectors of different width")
                    if size > 0 and float(v @ m) / (norm * size) >= threshold:
                        hit = i
                        break
            if hit < 0:
                if norm > 0:
                    means.append(v.copy())
                    counts.append(1)
                    first.append(point)
                label.append(point)
            else:
                counts[hit] += 1
                means[hit] += (v - means[hit]) / counts[hit]
                label.append(first[hit])
        out = pd.DataFrame({"point_id": rows["point_id"].to_numpy(), "cluster": label})
        return out[out.groupby("cluster")["point_id"].transform("size") > 1]

    return points.select(F.col(block).alias("block"), "pos", "point_id", "dense").groupBy("block").applyInPandas(lambda p: run(p), "point_id long, cluster long")


def usage(events: DataFrame) -> DataFrame:
    """Counters of each point from recall and feedback events (point_id, ts, seq, event, delta)."""
    recall = F.col("event") == "recall"
    vote = F.when(F.col("event") == "feedback", F.coalesce("delta", F.lit(0)))
    kept = events.where(recall | (vote != 0))
    return kept.groupBy("point_id").agg(
        F.count_if(recall).alias("retrieval_count"),
        F.coalesce(F.sum(F.greatest(vote, F.lit(0))), F.lit(0)).alias("helpful_count"),
        F.coalesce(F.sum(F.greatest(-vote, F.lit(0))), F.lit(0)).alias("unhelpful_count"),
        F.min_by("ts", "seq").alias("first_seen"),
        F.max_by(F.when(recall, F.col("ts")), F.when(recall, F.col("seq"))).alias("last_accessed"),
    )


def trust(helpful: Column, unhelpful: Column) -> Column:
    """Laplace-smoothed share of helpful votes, ties to even."""
    return F.bround((helpful + 1) / (helpful + unhelpful + 2), 4)


def newest_events(events: DataFrame, keep: int = LEDGER_KEEP) -> DataFrame:
    order = Window.partitionBy("point_id").orderBy(F.col("ts").desc(), F.col("seq").desc())
    return events.withColumn("n", F.row_number().over(order)).where(F.col("n") <= keep)


def breaker_states(attempts: DataFrame, limit: int = 5, pause: float = 120.0) -> DataFrame:
    """endpoint, seq, is_open, failures after each attempt (endpoint, seq, ts, ok), folded in order.

    Attempts while open are not made and change nothing; after the pause the count starts again. Endpoints are
    independent; one endpoint's attempts are one sequence.
    """

    def run(key, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values("seq")
        failures, until, out = 0, None, []
        for seq, ts, ok in zip(rows["seq"], rows["ts"], rows["ok"], strict=True):
            if until is not None and ts >= until:
                failures, until = 0, None
            blocked = until is not None
            if not blocked:
                failures = 0 if ok else failures + 1
                if failures >= limit:
                    until = ts + pause
            out.append((key[0], seq, blocked, failures))
        yield pd.DataFrame(out, columns=["endpoint", "seq", "is_open", "failures"])

    return attempts.groupBy("endpoint").applyInPandas(lambda key, pdf: next(run(key, iter([pdf]))), "endpoint string, seq long, is_open boolean, failures long")


def quantized(vector: Column) -> Column:
    """Eight-bit codes of a vector between its least and greatest value."""
    low, high = F.array_min(vector), F.array_max(vector)
    return F.transform(vector, lambda x: F.when(high > low, F.round((x - low) / (high - low) * 255) - 128).otherwise(F.lit(0.0)).cast("int"))


def vector_faults(vector: Column, width: int) -> Column:
    """Null for a good vector, else what is wrong with it."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNull() | (F.size(vector) == 0), "empty").when(F.size(vector) != width, "width").when(bad, "not finite")
