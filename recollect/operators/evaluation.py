"""Retrieval metrics over ranks (null: not found), intervals and comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Z_95, Z_95_LONG = 1.96, 1.959963985


def recall_at(rank: Column, k: int) -> Column:
    return F.avg(F.coalesce((rank <= k).cast("int"), F.lit(0)))


def mean_reciprocal(rank: Column) -> Column:
    return F.avg(F.coalesce(F.lit(1.0) / rank, F.lit(0.0)))


def ndcg_log2(rank: Column, k: int) -> Column:
    return F.avg(F.when(rank <= k, F.lit(1.0) / F.log2(rank + 1)).otherwise(0.0))


def ndcg_linear(rank: Column, k: int) -> Column:
    return F.avg(F.when(rank <= k, F.lit(1.0) / rank).otherwise(0.0))


def wilson(hits: Column, n: Column, z: float = Z_95) -> tuple[Column, Column]:
    """Wilson interval within [0, 1]; (0, 0) without trials."""
    p = hits / F.nullif(n, F.lit(0))
    denominator = 1 + z * z / n
    center = (p + z * z / (2 * n)) / denominator
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / denominator
    low, high = F.greatest(F.lit(0.0), center - half), F.least(F.lit(1.0), center + half)
    return F.when(n > 0, low).otherwise(0.0), F.when(n > 0, high).otherwise(0.0)


def nearest_rank(values: Column, percent: int) -> Column:
    """Nearest-rank percentile of a sorted array; 0 if it is empty."""
    n = F.size(values)
    at = F.greatest(F.lit(1), F.ceil(n * percent / F.lit(100.0)).cast("int"))
    return F.coalesce(F.get(values, at - 1), F.lit(0.0))


def nearest_rank_by(rows: DataFrame, group: str, value: str, percents: tuple[int, ...]) -> DataFrame:
    """group and p<percent>: nearest-rank percentiles, without a group's values in one buffer.

    Equal values are counted first; a running sum over the distinct ones says where each rank lies.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(group))
    upto = F.sum("n").over(Window.partitionBy(group).orderBy(value))
    placed = counts.withColumns({"total": total, "upto": upto})
    at = lambda p: F.greatest(F.lit(1), F.ceil(F.col("total") * p / F.lit(100.0)))
    return placed.groupBy(group).agg(*[F.min(F.when(F.col("upto") >= at(p), F.col(value))).alias(f"p{p}") for p in percents])


def crude_median(values: Column) -> Column:
    """Element n // 2 of a sorted array; null if it is empty."""
    return F.get(values, F.floor(F.size(values) / 2).cast("int"))


def hit_at(rank: Column, k: int) -> Column:
    return F.coalesce(rank <= k, F.lit(False))


def win_loss(rank: Column, baseline: Column, k: int) -> tuple[Column, Column]:
    """How many queries one arm finds within k and the other does not, and the other way round."""
    own, other = hit_at(rank, k), hit_at(baseline, k)
    return F.count_if(own & ~other), F.count_if(other & ~own)


def substantive(answer: Column, least: int = 10) -> Column:
    """Whether an answer is long enough that holding it says something."""
    return F.length(F.trim(answer)) >= least


def case_margins(targets: DataFrame, distractors: DataFrame, absent: int = 11) -> DataFrame:
    """case, decidable, beats, margin of targets joined to their own distractors (both: case, rank, score)."""
    t = targets.select("case", F.col("rank").alias("t"), F.col("score").alias("st"))
    x = distractors.select("case", F.col("rank").alias("x"), F.col("score").alias("sx"))
    seen = F.col("t").isNotNull() | F.col("x").isNotNull()
    both = F.col("t").isNotNull() & F.col("x").isNotNull()
    beats = F.coalesce("t", F.lit(absent)) < F.coalesce("x", F.lit(absent))
    return t.join(x, "case").select("case", seen.alias("decidable"), (seen & beats).alias("beats"), F.when(both, F.abs(F.col("st") - F.col("sx"))).alias("margin"))


def answer_rank(texts: Column, answer: Column) -> Column:
    """Place of the first text that holds the answer, ignoring case; null if none does."""
    return F.nullif(F.array_position(F.transform(texts, lambda t: F.contains(F.lower(t), F.lower(answer))), F.lit(True)), F.lit(0))


def miss(case: Column, rank: Column, hits: Column) -> Column:
    """A missed case as JSON: the case, the rank it was found at (left out if it was not) and what was retrieved instead (array of structs)."""
    return F.to_json(F.struct(case.alias("case"), rank.alias("rank"), hits.alias("retrieved")))


def known_answer(hits: Column, needles: Column, root: Column) -> tuple[Column, Column]:
    """(hit, in_corpus) for hits (array of path, heading, snippet, best first): one of them holds every needle; the best one's path lies below the root."""
    whole = F.transform(hits, lambda h: F.concat_ws(" ", h["path"], h["heading"], h["snippet"]))
    found = (F.size(needles) == 0) | F.exists(whole, lambda t: holds_all(t, needles))
    return found, F.coalesce(F.startswith(F.get(hits, 0)["path"], F.concat(root, F.lit("/"))), F.lit(False))


def holds_all(text: Column, needles: Column) -> Column:
    return F.forall(needles, lambda n: F.contains(F.lower(text), F.lower(n)))
