"""Ranking: dense top-k, rank fusion, time spread, greedy duplicate suppression, rerank and cascade.

Order is data: every stage carries ``rank`` by query, and ties go by rank or id. Candidate lists hold at most k
rows for each query, so windows by query are small however large the store is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recollect.runtime import bound_batches, stage

#: Query vectors sent to the executors at most; a larger query table is processed in blocks of this many.
QUERY_BLOCK = 4096
SCORE_DIGITS = 6
#: Points of a part when all pairs of a scope are multiplied.
PAIR_BLOCK = 2048


def _scores(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    if metric == "euclid":
        return -np.sqrt(np.maximum(0.0, (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * (q @ x.T)))
    s = q @ x.T
    if metric == "cosine":
        norms = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((x * x).sum(1))[None, :]
        s = np.divide(s, norms, out=np.zeros_like(s), where=norms > 0)
    return s


def dense_topk(points: DataFrame, queries: DataFrame, k: int, metric: str = "cosine", same: str | None = None) -> DataFrame:
    """query_id, point_id, score, rank: the k points of highest score for each query.

    ``points``: point_id long, dense array; ``queries``: query_id long, dense array. ``same`` names a column of both
    that must be equal (a scope). Each task multiplies blocks of points with a block of queries and keeps k rows for each
    query; those meet in one window by query. The driver holds one block of queries at a time. Euclid scores are negative distances.
    Vectors of unlike widths are an error.
    """
    spark = points.sparkSession
    bound_batches(spark, 4096)
    asked = queries.select("query_id", "dense", *([same] if same else [])).where("dense is not null")
    total = asked.count()
    if total <= QUERY_BLOCK:
        found = _block_topk(points, asked.collect(), k, metric, same)
    else:
        parts = 2 * total // QUERY_BLOCK + 1
        asked = stage(asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts))), "query-blocks")
        found = None
        for part in range(parts):
            one = stage(_block_topk(points, asked.where(F.col("part") == part).drop("part").collect(), k, metric, same), "query-block-hits")  # about QUERY_BLOCK / 2 rows
            found = one if found is None else found.unionByName(one)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "point_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _matrix(vectors: pa.ListArray, width: int | None) -> np.ndarray:
    """Rows of a list column as one array, without a Python object for each number."""
    flat, sizes = vectors.flatten().to_numpy(zero_copy_only=False), np.diff(vectors.offsets.to_numpy())
    wide = width if width is not None else int(sizes[0])
    if (sizes != wide).any():
        raise ValueError(f"vectors of different width: {wide} and {sorted(set(sizes.tolist()) - {wide})}")
    return flat.astype(np.float64, copy=False).reshape(len(sizes), wide)


def _best(query: np.ndarray, point: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k rows of highest score of each query, ties by point."""
    order = np.lexsort((point, -score, query))
    query, point, score = query[order], point[order], score[order]
    head = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else order
    place = np.arange(len(query)) - np.repeat(head, np.diff(np.append(head, len(query))))
    return query[place < k], point[place < k], score[place < k]


def _block_topk(points: DataFrame, block: list, k: int, metric: str, same: str | None) -> DataFrame:
    block = sorted(block, key=lambda r: r["query_id"])
    ids = np.array([r["query_id"] for r in block], dtype=np.int64)
    q = _matrix(pa.array([r["dense"] for r in block], pa.list_(pa.float64())), None) if block else None
    scopes = np.array([r[same] for r in block], dtype=object) if same else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            point = batch.column(0).to_numpy(zero_copy_only=False)
            s = np.round(_scores(q, _matrix(batch.column(1), q.shape[1]), metric), SCORE_DIGITS) + 0.0
            if scopes is not None:
                s[scopes[:, None] != np.array(batch.column(2).to_pylist(), dtype=object)[None, :]] = -np.inf
            least = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(ids), -np.inf)
            i, j = np.nonzero((s >= least[:, None]) & (s > -np.inf))
            best = _best(*(np.concatenate(x) for x in zip(best, (i, point[j], s[i, j]), strict=True)), k)
        yield pa.RecordBatch.from_arrays([pa.array(ids[best[0]], pa.int64()), pa.array(best[1], pa.int64()), pa.array(best[2], pa.float64())], names=["query_id", "point_id", "score"])

    own = points.where("dense is not null").select(F.col("point_id").cast("long"), F.col("dense").cast("array<double>"), *([same] if same else []))
    return own.mapInArrow(run, "query_id long, point_id long, score double")


def pairs_at_least(points: DataFrame, threshold: float, same: str, metric: str = "cosine", block: int = PAIR_BLOCK) -> DataFrame:
    """query_id, point_id, score of every pair query_id < point_id of one scope (column ``same``) at or above the threshold.

    A scope is cut into parts of about ``block`` points by a hash of the id; each pair of parts meets in one task and is multiplied. Nothing goes to the driver.
    """
    own = points.where("dense is not null").select(F.col("point_id").cast("long"), "dense", F.col(same).alias("scope")).where("scope is not null")
    sizes = own.groupBy("scope").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    placed = own.join(sizes, "scope").withColumn("part", F.pmod(F.xxhash64("point_id"), F.col("parts")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[rows["part"] == key[1]], rows[rows["part"] == key[2]]
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "point_id": [], "score": []})
        s = np.round(_scores(np.array(a["dense"].tolist()), np.array(b["dense"].tolist()), metric), SCORE_DIGITS) + 0.0
        left, right = a["point_id"].to_numpy(), b["point_id"].to_numpy()
        hit = s >= threshold
        if key[1] == key[2]:
            hit &= left[:, None] < right[None, :]
        i, j = np.nonzero(hit)
        return pd.DataFrame({"query_id": np.minimum(left[i], right[j]), "point_id": np.maximum(left[i], right[j]), "score": s[i, j]})

    met = met.select("scope", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "point_id", "dense")
    return met.groupBy("scope", "low", "high").applyInPandas(run, "query_id long, point_id long, score double")


def fused(arms: list[DataFrame], k: int, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of candidate lists (query_id, point_id, rank)."""
    union = arms[0].select("query_id", "point_id", "rank")
    for arm in arms[1:]:
        union = union.unionByName(arm.select("query_id", "point_id", "rank"))
    scored = union.groupBy("query_id", "point_id").agg(F.round(F.sum(F.lit(1.0) / (constant + F.col("rank"))), 9).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "point_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hybrid(dense: DataFrame, sparse: Callable[[], DataFrame], k: int, constant: int = 60, on_error: Callable | None = None) -> DataFrame:
    """Dense candidates fused with the sparse arm; a sparse arm that fails, when it is built or when it runs, leaves the dense ones as they are."""
    try:
        arm = stage(sparse().select("query_id", "point_id", "rank"), "sparse-arm")
    except Exception as e:  # noqa: BLE001 - search goes on without this arm
        if on_error:
            on_error(e)
        return dense.where(F.col("rank") <= k)
    return fused([dense, arm], k, constant)


def first_per_text(rows: DataFrame) -> DataFrame:
    """The first candidate of each text for each query (query_id, rank, text); equal texts collapse."""
    nth = F.row_number().over(Window.partitionBy("query_id", "text").orderBy("rank"))
    return _renumbered(rows.withColumn("nth", nth).where("nth = 1").drop("nth"), F.col("rank"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 if either is empty or has no length; vectors of unlike widths are an error."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    product = total(F.zip_with(a, b, lambda x, y: x * y))
    norms = F.sqrt(total(F.transform(a, lambda x: x * x))) * F.sqrt(total(F.transform(b, lambda x: x * x)))
    empty = (F.size(a) == 0) | (F.size(b) == 0)
    return F.when(empty, F.lit(0.0)).when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors of different width")).cast("double")).when(norms == 0, F.lit(0.0)).otherwise(product / norms)


def _renumbered(rows: DataFrame, *order: Column) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))


def _bucket(low: Column, span: Column, count: int) -> Column:
    """Which of ``count`` equal parts of the span the time lies in."""
    raw = F.when(span > 0, ((F.col("ts") - low) / span * count).cast("long")).otherwise(0)
    return F.least(F.greatest(raw, F.lit(0)), F.lit(count - 1))


def bucket_spread(rows: DataFrame, start: Column, stop: Column, buckets: int = 6, per_bucket: int = 2) -> DataFrame:
    """Candidates reordered: up to ``per_bucket`` of each of equal time spans in time order, then the rest as they were.

    Bounds default to the list's own span and are swapped if reversed. Expects query_id, rank, ts.
    """
    count, keep = max(1, buckets), max(0, per_bucket)
    group = Window.partitionBy("query_id")
    a, b = F.coalesce(start, F.min("ts").over(group)), F.coalesce(stop, F.max("ts").over(group))
    low, span = F.least(a, b), F.abs(b - a)
    placed = rows.withColumn("bucket", _bucket(low, span, count))
    nth = F.row_number().over(Window.partitionBy("query_id", "bucket").orderBy("rank"))
    placed = placed.withColumn("chosen", nth <= keep)
    first = F.when(F.col("chosen"), F.col("bucket")).otherwise(count)
    return _renumbered(placed, first, F.col("rank")).drop("bucket", "chosen")


def time_window(rows: DataFrame, start: Column, stop: Column, buckets: int = 6, per_bucket: int = 2) -> DataFrame:
    """Candidates within the half-open window, spread over it, then those without a time; a query without any
    candidate inside keeps its list as it was. Expects query_id, rank, ts."""
    inside = F.coalesce((start.isNull() | (F.col("ts") >= start)) & (stop.isNull() | (F.col("ts") < stop)), F.lit(False))
    marked = rows.withColumn("w0", start).withColumn("w1", stop).withColumn("inside", inside & F.col("ts").isNotNull() & (start.isNotNull() | stop.isNotNull()))
    group = Window.partitionBy("query_id")
    marked = marked.withColumn("hits", F.count_if("inside").over(group))
    own = F.when(F.col("inside"), F.col("ts"))
    marked = marked.withColumns({"w0": F.coalesce("w0", F.min(own).over(group)), "w1": F.coalesce("w1", F.max(own).over(group))})
    kept = marked.where("hits = 0 or inside or ts is null")
    raw = _bucket(F.least("w0", "w1"), F.abs(F.col("w1") - F.col("w0")), max(1, buckets))
    nth = F.row_number().over(Window.partitionBy("query_id", "inside", "bucket").orderBy("rank"))
    kept = kept.withColumn("bucket", raw).withColumn("chosen", F.col("inside") & (nth <= max(0, per_bucket)))
    # spread candidates, then those without a time; a list that is left alone has one part and no buckets
    part = F.when(F.col("hits") == 0, 0).otherwise((~F.col("inside")).cast("int"))
    place = F.when(F.col("hits") == 0, 0).when(F.col("chosen"), F.col("bucket")).otherwise(max(1, buckets))
    return _renumbered(kept, part, place, F.col("rank")).drop("w0", "w1", "inside", "hits", "bucket", "chosen")


def without_near_copies(rows: DataFrame, jaccard: float = 0.72, containment: float = 0.86) -> DataFrame:
    """Greedy in rank order: a candidate goes if its words overlap too much with one kept before it.

    Expects query_id, rank, text and keeps all columns; texts without words go.
    """
    from recollect.functions.text import space_words

    sized = rows.withColumn("words", space_words(F.col("text"))).where(F.size("words") > 0)
    lists = sized.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "words"))).alias("items"))
    kind = "array<struct<rank:int,words:array<string>>>"

    def alike(a, b):
        both = F.size(F.array_intersect(a, b))
        return (both / F.size(F.array_union(a, b)) >= jaccard) | (both / F.least(F.size(a), F.size(b)) >= containment)

    kept = F.aggregate("items", F.array().cast(kind), lambda done, x: F.when(F.exists(done, lambda d: alike(d["words"], x["words"])), done).otherwise(F.array_append(done, x)))
    ranks = lists.select("query_id", F.explode(F.transform(kept, lambda s: s["rank"])).alias("rank"))
    return sized.drop("words").join(ranks, ["query_id", "rank"])


def boosted(rows: DataFrame, overlap: Column, weight: float = 0.15) -> DataFrame:
    """Reordered by score plus clamped weight times overlap; the score itself stays."""
    w = max(0.0, min(1.0, float(weight)))
    return _renumbered(rows, (F.col("score") + w * overlap).desc(), F.col("rank"))


def word_overlap(query: Column, text: Column) -> Column:
    """Default rerank score: share of the query's words that the text has."""
    from recollect.functions.text import space_words

    q = space_words(query)
    return F.coalesce(F.size(F.array_intersect(q, space_words(text))) / F.nullif(F.size(q), F.lit(0)), F.lit(0.0))


_MODELS: dict[Callable, object] = {}


def rerank_udf(loader: Callable[[], object]):
    """Column function of (query, text): the score of a cross-encoder; null where the model fails for a query.

    ``loader`` gives an object with ``rerank(query, texts) -> scores`` and runs once in each worker.
    """

    @F.pandas_udf("double")
    def score(queries: pd.Series, texts: pd.Series) -> pd.Series:
        model = _MODELS.get(loader) or _MODELS.setdefault(loader, loader())
        out = pd.Series(np.nan, index=texts.index)
        for query, own in texts.groupby(queries.fillna(""), sort=False):
            try:
                got = np.asarray(list(model.rerank(query, own.fillna("").tolist())), dtype=np.float64)
                if len(got) == len(own):
                    out[own.index] = got
            except Exception:  # noqa: BLE001 - a query without scores keeps its order
                continue
        return out

    return score


def reranked(rows: DataFrame, scorer: Column, top: int | None = None) -> DataFrame:
    """Reordered by the scorer; a query with any missing or non-finite score, or under two rows, keeps its order."""
    group = Window.partitionBy("query_id")
    scored = rows.withColumn("rr", scorer.cast("double"))
    bad = F.col("rr").isNull() | F.isnan("rr") | (F.abs("rr") == F.lit(float("inf")))
    scored = scored.withColumn("keep", F.bool_or(bad).over(group) | (F.count("*").over(group) < 2))
    order = _renumbered(scored, F.when(F.col("keep"), F.lit(0.0)).otherwise(-F.col("rr")), F.col("rank")).drop("rr", "keep")
    return order.where(F.col("rank") <= top) if top and top > 0 else order


def cascade(queries: DataFrame, levels: list[tuple[str, Callable[[DataFrame], DataFrame]]], on_error: Callable | None = None) -> DataFrame:
    """query_id, the level's rows, level, reason, attempted, degraded: each query is answered by the first level that has rows for it.

    A level sees only the queries still open; what it finds is written before the next one is asked, so a level that fails, when it is built or when it
    runs, is noted and passed over, and no level runs twice. ``reason`` is why the first level did not answer; ``degraded``: another one did.
    A hook that fails is passed over too.
    """
    if not levels:
        raise ValueError("no levels configured")
    left, out, reasons, tried = stage(queries, "cascade-open"), None, [], []
    for name, level in levels:
        tried.append(name)
        try:
            found = stage(level(left), f"cascade-{name}")
        except Exception as e:  # noqa: BLE001 - a failing level must not take the others with it
            reasons.append(f"{name} failed: {type(e).__name__}: {str(e)[:200]}")
            if on_error:
                try:
                    on_error(name, e)
                except Exception:  # noqa: BLE001
                    pass
            continue
        why = F.lit(reasons[0] if reasons else None).cast("string")
        rows = found.select(*found.columns, F.lit(name).alias("level"), why.alias("reason"), F.lit(",".join(tried)).alias("attempted"), F.lit(name != tried[0]).alias("degraded"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        left = stage(left.join(found.select("query_id").distinct(), "query_id", "left_anti"), "cascade-open")
        reasons.append(f"{name} returned no results")
    if out is None:
        raise ValueError(reasons[0])
    return out
