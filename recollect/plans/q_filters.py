"""Queries of filters, scans and ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from recollect.functions import text as T
from recollect.operators import filters, store
from recollect.plans.base import POINTS, points, query, table


def _filter(name, spec, sql, scope=None, include_archived=True):
    def run(spark, d):
        return filters.matching(points(spark, d), spec, scope, include_archived).select("point_id", "session_id", "kind", "source", "value")

    run.__name__ = name
    query(f"WITH {POINTS} SELECT point_id, session_id, kind, source, value FROM points WHERE {sql}")(run)


_filter("filter_eq", {"kind": "click"}, "kind = 'click'")
_filter("filter_ne_keeps_null", {"source": {"ne": "cli"}}, "source IS DISTINCT FROM 'cli'")
_filter("filter_in", {"kind": {"in": ["click", "view"]}}, "kind IN ('click', 'view')")
_filter("filter_nin_keeps_null", {"source": {"nin": ["cli", "tui"]}}, "source IS NULL OR source NOT IN ('cli', 'tui')")
_filter("filter_range", {"value": {"gt": 10, "lte": 50.5}}, "value > 10 AND value <= 50.5")
_filter("filter_range_absent", {"ts": {"gte": 1705000000, "lt": 1706000000}}, "coalesce(ts >= 1705000000 AND ts < 1706000000, false)")
_filter("filter_contains_token", {"text": {"contains": "Click ITEM"}}, "list_has_all(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), ['click', 'item'])")
_filter("filter_exists", {"source": "*"}, "source IS NOT NULL")
_filter("filter_and_or_not", {"AND": [{"value": {"gte": 1}}], "OR": [{"kind": "click"}, {"source": "cli"}], "NOT": [{"kind": "error"}, {"value": {"gt": 400}}]}, "value >= 1 AND (kind = 'click' OR coalesce(source = 'cli', false)) AND kind <> 'error' AND NOT value > 400")
_filter("filter_nested", {"OR": [{"AND": [{"kind": "view"}, {"NOT": [{"source": "web"}]}]}, {"kind": {"ne": "view"}, "value": {"lt": 5}}]}, "(kind = 'view' AND source IS DISTINCT FROM 'web') OR (kind <> 'view' AND value < 5)")
_filter("filter_scope_and", {"kind": {"in": ["click", "view"]}}, "session_id = 7 AND kind IN ('click', 'view')", scope={"session_id": 7})
_filter("filter_type_clash", {"OR": [{"kind": 5}, {"kind": {"gt": 3}}, {"value": "click"}, {"archived": "true"}, {"NOT": [{"session_id": {"ne": "7"}}]}, {"kind": {"in": [5, "view"]}}]}, "kind = 'view'")
_filter("filter_absent_key", {"nothing": {"ne": 1}, "none": {"nin": [1, 2]}, "NOT": [{"nowhere": "*"}, {"nowhere": {"gt": 1}}], "OR": [{"nowhere": 1}, {"kind": "click"}]}, "kind = 'click'")
_filter("filter_no_token", {"OR": [{"text": {"contains": "!!!"}}, {"kind": {"icontains": "Error"}}, {"value": {"contains": "1"}}]}, "kind = 'error'")
_filter("archived_excluded", {}, "archived IS NULL OR NOT archived", include_archived=False)


@query(f"WITH {POINTS} SELECT point_id FROM points WHERE point_id % 3 <> 0 AND kind IN ('click', 'view')")
def filter_arrays(spark, d):
    """An array matches by any element; an empty one is absent."""
    tags = F.when(F.col("point_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("kind", F.lit("x")))
    return filters.matching(points(spark, d).withColumn("tags", tags), {"tags": "*", "AND": [{"tags": {"in": ["click", "view"]}}, {"tags": {"ne": "error"}}, {"NOT": [{"tags": 5}]}]}, include_archived=True).select("point_id")


@query(f"WITH {POINTS} SELECT point_id, text, kind FROM points WHERE session_id = 7 AND text <> '' AND (archived IS NULL OR NOT archived) ORDER BY point_id LIMIT 20")
def scroll_session(spark, d):
    rows = filters.matching(points(spark, d), {}, {"session_id": 7}).where("text != ''")
    return rows.orderBy("point_id").limit(20).select("point_id", "text", "kind")


@query(f"WITH {POINTS} SELECT point_id, kind, session_id FROM points")
def collection_scan(spark, d):
    return points(spark, d).select("point_id", "kind", "session_id")


@query("SELECT 'events' AS collection, count(*) AS points, (SELECT count(*) FROM embeddings) AS vectors, (SELECT max(len(embedding)) FROM embeddings)::INTEGER AS width FROM events")
def collection_info(spark, d):
    n = table(spark, d, "events").agg(F.count("*").alias("points"))
    v = table(spark, d, "embeddings").agg(F.count("*").alias("vectors"), F.max(F.size("embedding")).alias("width"))
    return n.crossJoin(v).select(F.lit("events").alias("collection"), "points", "vectors", "width")  # one row each


@query(f"WITH {POINTS}, asked(id) AS (VALUES (1), (5), (999999999), (12)) SELECT id::BIGINT AS id, text, point_id IS NOT NULL AS found FROM asked LEFT JOIN points ON point_id = id")
def points_lookup_missing(spark, d):
    asked = spark.createDataFrame([(1,), (5,), (999999999,), (12,)], "id long")
    found = points(spark, d).where(F.col("point_id").isin(1, 5, 999999999, 12)).select(F.col("point_id").alias("id"), "text", F.lit(True).alias("hit"))
    return asked.join(found, "id", "left").select("id", "text", F.coalesce("hit", F.lit(False)).alias("found"))


_LIMITS = ["5", "0", "-3", "1000", "abc", "7.5", None, "100", "101", "9999999999", "-9999999999", " 7 "]


@query("SELECT raw, CAST(least(greatest(coalesce(CASE WHEN trim(raw) SIMILAR TO '[+-]?[0-9]+' THEN CAST(trim(raw) AS HUGEINT) END, 10), 1), 100) AS INTEGER) AS k FROM (VALUES ('5'), ('0'), ('-3'), ('1000'), ('abc'), ('7.5'), (NULL), ('100'), ('101'), ('9999999999'), ('-9999999999'), (' 7 ')) t(raw)")
def limit_clamp(spark, d):
    rows = spark.createDataFrame([(x,) for x in _LIMITS], "raw string")
    return rows.select("raw", T.clamped(F.col("raw"), 10, 100).alias("k"))


@query(r"SELECT id, regexp_full_match(id, '[0-9]{1,20}|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}') AS ok FROM (VALUES ('12'), ('x1'), ('123456789012345678901'), ('6ba7b811-9dad-11d1-80b4-00c04fd430c8'), ('6ba7b811-9dad'), ('')) t(id)")
def point_id_valid(spark, d):
    ids = ["12", "x1", "123456789012345678901", "6ba7b811-9dad-11d1-80b4-00c04fd430c8", "6ba7b811-9dad", ""]
    return spark.createDataFrame([(x,) for x in ids], "id string").select("id", T.valid_point_id(F.col("id")).alias("ok"))


@query(f"""WITH {POINTS}, asked(seq, id) AS (VALUES (1, '3'), (2, 'nope'), (3, '999999999'), (4, ' 8 '), (5, ''), (6, '-1'))
SELECT seq, trim(id) AS id, CASE WHEN NOT regexp_full_match(trim(id), '[0-9]{{1,20}}') THEN 'invalid' WHEN EXISTS (SELECT 1 FROM points WHERE CAST(point_id AS VARCHAR) = trim(id)) THEN 'found' ELSE 'missing' END AS status
FROM asked WHERE trim(id) <> ''""")
def forget_classify(spark, d):
    asked = spark.createDataFrame([(1, "3"), (2, "nope"), (3, "999999999"), (4, " 8 "), (5, ""), (6, "-1")], "seq int, id string")
    return store.forget_plan(asked, points(spark, d).select(F.col("point_id").cast("string").alias("point_id")))


@query(f"WITH {POINTS} SELECT kind, count(*) AS n FROM points WHERE point_id NOT IN (3, 8, 21) GROUP BY 1")
def forget_apply(spark, d):
    asked = spark.createDataFrame([(1, "3"), (2, " 8 "), (3, "21"), (4, "999999999"), (5, "x")], "seq int, id string")
    known = points(spark, d).select(F.col("point_id").cast("string").alias("point_id"))
    gone = store.forget_plan(asked, known).where("status = 'found'").select(F.col("id").try_cast("long").alias("point_id"))
    return points(spark, d).join(F.broadcast(gone), "point_id", "left_anti").groupBy("kind").agg(F.count("*").alias("n"))


@query(f"WITH {POINTS} SELECT point_id, substr(text, 1, 12) AS short, CASE WHEN length(text) <= 10 THEN text ELSE substr(text, 1, 10) || '…' END AS summary FROM points")
def text_truncation(spark, d):
    t = F.col("text")
    return points(spark, d).select("point_id", T.truncated(t, 12).alias("short"), T.summary(t, 10).alias("summary"))


@query(r"SELECT page_id, regexp_replace(replace(url, '://', '://user:pw@'), '^([A-Za-z][A-Za-z0-9+.-]*://)[^@/]*@', '\1') AS clean FROM pages")
def url_redact(spark, d):
    return table(spark, d, "pages").select("page_id", T.without_userinfo(F.replace("url", F.lit("://"), F.lit("://user:pw@"))).alias("clean"))


@query("SELECT event_id AS point_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def payload_json_props(spark, d):
    return table(spark, d, "events").select(F.col("event_id").alias("point_id"), F.get_json_object("props", "$.k").cast("long").alias("k"))


@query(r"""WITH raw AS (SELECT event_id AS point_id, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN event_id % 5 = 0 THEN 'never' ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) END AS raw, ts FROM events)
SELECT point_id, CASE WHEN raw IS NULL OR raw = 'never' THEN NULL ELSE CAST(epoch_us(ts) // 1000000 AS DOUBLE) END AS ts FROM raw""")
def payload_epoch_normalize(spark, d):
    i, ts = F.col("event_id"), F.expr("cast(ts as timestamp_ntz)")
    us = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = F.when(i % 11 == 0, F.lit(None)).when(i % 7 == 0, iso).when(i % 5 == 0, F.lit("never")).otherwise(us.cast("string"))
    return table(spark, d, "events").select(i.alias("point_id"), T.epoch_seconds(raw).cast("double").alias("ts"))


@query("SELECT v, lower(trim(v)) IN ('1', 'true', 'yes', 'on') AS is_on FROM (VALUES ('1'), (' On '), ('off'), ('maybe'), ('TRUE')) t(v)")
def knob_parse(spark, d):
    return spark.createDataFrame([("1",), (" On ",), ("off",), ("maybe",), ("TRUE",)], "v string").select("v", T.truthy(F.col("v")).alias("is_on"))
