"""Markdown chunks: heading breadcrumbs, packed paragraphs, ordinals and ids; incremental ingest by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recollect.functions.text import CHUNK_CHARS, packed_paragraphs, stripped, uuid5, without_frontmatter

#: Name space of ids built from URLs (RFC 4122).
URL_SPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"

_LINE_END = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"
_HEADING = r"^(#{1,6})\s+(.*)"


def sections(files: DataFrame) -> DataFrame:
    """path, pos, heading (breadcrumb), body of every section with text. Expects path, content.

    The breadcrumb of a line is the latest heading of each level that no later, shallower heading has closed.
    """
    lines = files.select("path", F.posexplode(F.split(without_frontmatter(F.col("content")), _LINE_END)).alias("pos", "line"))
    level = F.length(F.regexp_extract("line", _HEADING, 1))
    lines = lines.withColumn("level", level).withColumn("title", F.trim(F.regexp_extract("line", _HEADING, 2)))
    up_to = Window.partitionBy("path").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("section", F.count_if(F.col("level") > 0).over(up_to))
    crumbs = []
    for k in range(1, 7):
        at = F.max(F.when(F.col("level") == k, F.col("pos"))).over(up_to)
        closed = F.coalesce(F.max(F.when((F.col("level") > 0) & (F.col("level") < k), F.col("pos"))).over(up_to), F.lit(-1))
        title = F.last(F.when(F.col("level") == k, F.col("title")), ignorenulls=True).over(up_to)
        crumbs.append(F.when(at > closed, title))
    lines = lines.withColumn("heading", F.concat_ws(" > ", *crumbs))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("level") == 0, F.struct("pos", "line")))), lambda s: s["line"]), "\n")
    out = lines.groupBy("path", "section").agg(F.min("pos").alias("pos"), F.max("heading").alias("heading"), F.regexp_replace(body, r"\A\s+|\s+\z", "").alias("body"))
    return out.where("body != ''").select("path", "pos", "heading", "body")


def chunked(files: DataFrame, limit: int = CHUNK_CHARS) -> DataFrame:
    """path, pos, part, heading, content of every chunk.

    Text before any heading is labelled with the path. A file without text under a heading or before one still has one chunk: the
    beginning of its raw content, or its path if it is blank.
    """
    label = F.when(F.col("heading") == "", F.col("path")).otherwise(F.col("heading")).alias("heading")
    full = sections(files).select("path", "pos", label, F.posexplode(packed_paragraphs(F.col("body"), limit)).alias("part", "content"))
    left = F.concat_ws("", F.transform(F.split(without_frontmatter(F.coalesce("content", F.lit(""))), _LINE_END), lambda line: F.regexp_replace(line, _HEADING, "")))
    raw = F.substring(stripped(F.coalesce("content", F.lit(""))), 1, limit)
    bare = files.where(stripped(left) == "").select("path", F.lit(0).alias("pos"), F.col("path").alias("heading"), F.lit(0).alias("part"), F.when(raw == "", F.col("path")).otherwise(raw).alias("content"))
    return full.select("path", "pos", "part", "heading", "content").unionByName(bare)


def with_ids(chunks: DataFrame) -> DataFrame:
    """Ordinal within (path, heading) and the id made from the three."""
    order = Window.partitionBy("path", "heading").orderBy("pos", "part")
    rows = chunks.withColumn("ordinal", F.row_number().over(order) - 1)
    return rows.withColumn("chunk_id", uuid5(URL_SPACE, F.concat_ws("\u0000", "path", "heading", F.col("ordinal").cast("string"))))


def changes(new: DataFrame, old: DataFrame, key: str = "path") -> DataFrame:
    """key, status (new, changed, unchanged, deleted) of two snapshots with a content hash ``sha``."""
    n, o = (side.select(key, F.struct("sha").alias(name)) for side, name in ((new, "n"), (old, "o")))
    status = F.when(F.col("o").isNull(), "new").when(F.col("n").isNull(), "deleted").when(F.col("n.sha").eqNullSafe(F.col("o.sha")), "unchanged").otherwise("changed")
    return n.join(o, key, "full").select(key, status.alias("status"))


def replaced(index: DataFrame, fresh: DataFrame, key: str = "path") -> DataFrame:
    """Rows of changed or new files take the place of what the index held for them."""
    return index.join(fresh.select(key).distinct(), key, "left_anti").unionByName(fresh)
