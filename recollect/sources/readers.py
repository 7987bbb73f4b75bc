"""Sources: markdown trees, agent logs, conversations, points; each a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recollect.functions.text import stamp

MAX_FILE_BYTES = 5 << 20

_LOG_LINE = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(?:[,.]\d+)?)\s+([A-Z]+)\s+([^:\s]+):\s?(.*)$"


def markdown_files(spark: SparkSession, root: str, label: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """path (label/relative), content, sha of every *.md below root, but for hidden or skipped folders and files over the limit."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(root)
    clean = F.regexp_replace("path", r"^[a-z]+:/*", "/")
    base = "/" + root.split(":")[-1].strip("/") + "/"
    rows = files.where(F.col("length") <= MAX_FILE_BYTES).withColumn("relative", F.substring_index(clean, base, -1))
    parts = F.split("relative", "/")
    hidden = F.exists(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: p.startswith(".") | p.isin(*skip, ""))
    return rows.where(~hidden).select(F.concat(F.lit(label + "/"), "relative").alias("path"), F.decode("content", "UTF-8").alias("content"), F.sha2("content", 256).alias("sha"))


def log_files(spark: SparkSession, root: str, name: str = "*.log*") -> DataFrame:
    """value, file, age, line of a log and its rotated siblings (``x.log``, ``x.log.1``, ...): the greatest suffix is the oldest file; in order of age descending, then line."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name).load(root).where(F.col("length") <= MAX_FILE_BYTES)
    file = F.regexp_extract("path", r"([^/]+)$", 1)
    base, age = F.regexp_replace(file, r"\.[0-9]+$", ""), F.coalesce(F.regexp_extract(file, r"\.([0-9]+)$", 1).try_cast("int"), F.lit(0))
    return files.select(base.alias("file"), age.alias("age"), F.posexplode(F.split(F.regexp_replace(F.decode("content", "UTF-8"), r"\n\z", ""), "\n")).alias("line", "value"))


def in_log_order(lines: DataFrame) -> DataFrame:
    """Lines (file, age, line) with their place ``seq`` in the file as it was before it was rotated."""
    return lines.withColumn("seq", F.row_number().over(Window.partitionBy("file").orderBy(F.col("age").desc(), "line")))


def configured_roots(spark: SparkSession, roots: dict[str, str], skip: tuple[str, ...] = (), overlay: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Markdown files of every configured root (label to folder); ``overlay`` adds folders to skip below one label."""
    out = None
    for label, folder in sorted(roots.items()):
        one = markdown_files(spark, folder, label, (*skip, *(overlay or {}).get(label, ())))
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], "path string, content string, sha string") if out is None else out


def ordered_sessions(sessions: DataFrame, messages: DataFrame, chosen: list[str] | None = None) -> DataFrame:
    """Sessions (session_id, started_at, source, ...) with the number of their messages, in the order of their start; without one it counts as 0.

    ``chosen`` keeps sessions whose source is among these.
    """
    kept = sessions if chosen is None else sessions.where(F.col("source").isin(chosen))
    counts = messages.groupBy("session_id").agg(F.count("*").alias("n_messages"))
    joined = kept.join(counts, "session_id", "left").withColumn("n_messages", F.coalesce("n_messages", F.lit(0).cast("long")))
    return joined.orderBy(F.coalesce("started_at", F.lit(0.0)), "session_id")


def haystack_sessions(examples: DataFrame) -> DataFrame:
    """question_id, session_id, turn, role, content, is_answer of every turn of the sessions of long-memory examples.

    ``examples``: question_id, haystack_sessions (array of arrays of role, content), haystack_session_ids, answer_session_ids.
    """
    each = examples.select("question_id", "answer_session_ids", F.explode(F.arrays_zip(F.col("haystack_session_ids").alias("session_id"), F.col("haystack_sessions").alias("turns"))).alias("h"))
    turns = each.select("question_id", "answer_session_ids", F.col("h.session_id").alias("session_id"), F.posexplode("h.turns").alias("turn", "t"))
    return turns.select("question_id", "session_id", "turn", "t.role", "t.content", F.coalesce(F.array_contains("answer_session_ids", F.col("session_id")), F.lit(False)).alias("is_answer"))


def parsed_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """day, ts, level, logger, msg of every line that is a JSON object or a plain log line; others are dropped."""
    text = F.col(line)
    get = lambda *paths: F.coalesce(*[F.get_json_object(text, f"$.{p}") for p in paths])
    is_json = text.startswith("{") & F.get_json_object(text, "$").isNotNull()
    plain = text.rlike(_LOG_LINE)
    pick = lambda json, group: F.when(is_json, json).when(plain, F.regexp_extract(text, _LOG_LINE, group))
    rows = lines.withColumns({"ts": pick(get("ts", "timestamp", "time"), 1), "level": pick(get("level", "levelname"), 2), "logger": pick(get("logger", "name"), 3), "msg": pick(get("msg", "message"), 4)})
    day = F.when(F.col("ts").rlike(r"^\d{4}-\d\d-\d\d"), F.substring("ts", 1, 10)).otherwise("undated")
    return rows.where(is_json | plain).withColumn("day", day)


def log_entry(level: Column, logger: Column, msg: Column) -> Column:
    return F.concat(F.lit("- **"), F.coalesce(level, F.lit("INFO")), F.lit(" | "), F.coalesce(logger, F.lit("-")), F.lit("** — "), F.substring(F.coalesce(msg, F.lit("")), 1, 4000))


def turn_pairs(messages: DataFrame) -> DataFrame:
    """session_id, msg_id, user, assistant of each user turn that an assistant turn follows at once, neither blank."""
    order = Window.partitionBy("session_id").orderBy("msg_id")
    ahead = messages.withColumn("next_role", F.lead("role").over(order)).withColumn("next_text", F.lead("text").over(order))
    return ahead.where("role = 'user' and next_role = 'assistant' and trim(text) != '' and trim(next_text) != ''").select("session_id", "msg_id", F.col("text").alias("user"), F.col("next_text").alias("assistant"))


def tool_names(calls: Column) -> Column:
    """Names in a JSON list of tool calls, once each, at most eight, and how many more there are."""
    parsed = F.from_json(calls, "array<struct<name:string,function:struct<name:string>>>")
    names = F.array_distinct(F.filter(F.transform(parsed, lambda c: F.coalesce(c["function"]["name"], c["name"])), lambda n: n.isNotNull()))
    more = F.size(names) - 8
    return F.concat(F.array_join(F.slice(names, 1, 8), ", "), F.when(more > 0, F.concat(F.lit(" (+"), more.cast("string"), F.lit(" more)"))).otherwise(F.lit("")))


def session_page(sessions: DataFrame, messages: DataFrame, limit: int = 20000) -> DataFrame:
    """session_id, n_turns, markdown: heading, a list of what is known of the session, its turns, and the tools each turn called.

    Sessions: session_id, title, display_name, source, model, started_at, ended_at, end_reason; messages: session_id, msg_id, role, text, tool_calls. A turn without
    text but with tool calls is kept for these; sessions under two turns are left out.
    """
    mark = "… [truncated]"
    body = F.when(F.length("text") > limit, F.concat(F.substring("text", 1, limit), F.lit(mark))).otherwise(F.coalesce("text", F.lit("")))
    tools = tool_names(F.coalesce("tool_calls", F.lit("[]")))
    kept = messages.where(F.col("role").isin("user", "assistant")).withColumn("tools", tools).where((F.trim(F.coalesce("text", F.lit(""))) != "") | (F.col("tools") != ""))
    head = F.concat(F.lit("## "), "role", F.lit(" ("), F.col("msg_id").cast("string"), F.lit(")"))
    turn = F.concat_ws("\n\n", head, F.when(F.trim(body) != "", body), F.when(F.col("tools") != "", F.concat(F.lit("*tools: "), "tools", F.lit("*"))))
    turns = kept.groupBy("session_id").agg(F.count("*").alias("n_turns"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("msg_id", turn.alias("md")))), lambda s: s["md"]), "\n\n").alias("turns")).where("n_turns >= 2")
    title = F.concat(F.lit("# "), F.coalesce("title", "display_name", F.concat(F.lit("session "), F.col("session_id").cast("string"))))
    known = (("source", F.coalesce("source", F.lit("-"))), ("model", F.col("model")), ("started", stamp(F.col("started_at"))), ("ended", stamp(F.col("ended_at"))), ("end reason", F.col("end_reason")), ("turns", F.col("n_turns").cast("string")))
    bullets = F.concat_ws("\n", *[F.when(v.isNotNull(), F.concat(F.lit(f"- {k}: "), v)) for k, v in known])
    return sessions.join(turns, "session_id").select("session_id", "n_turns", F.concat_ws("\n\n", title, bullets, "turns").alias("markdown"))


def write_pages(pages: DataFrame, path: str, name: str = "session_id", text: str = "markdown") -> None:
    """Pages as text files, one folder for each (``page=<name>``)."""
    pages.select(F.col(name).cast("string").alias("page"), F.col(text).alias("value")).write.mode("overwrite").option("lineSep", "\n").partitionBy("page").text(path)


def session_markdown(sessions: DataFrame, messages: DataFrame, limit: int = 20000) -> DataFrame:
    """session_id, markdown: a heading, the source, and each user or assistant turn; sessions under two turns are left out."""
    mark = "… [truncated]"
    body = F.when(F.length("text") > limit, F.concat(F.substring("text", 1, limit), F.lit(mark))).otherwise(F.col("text"))
    kept = messages.where(F.col("role").isin("user", "assistant") & (F.trim("text") != ""))
    turn = F.concat(F.lit("## "), "role", F.lit(" ("), F.col("msg_id").cast("string"), F.lit(")\n\n"), body)
    turns = kept.groupBy("session_id").agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("msg_id", turn.alias("md")))), lambda s: s["md"]), "\n\n").alias("turns")).where("n >= 2")
    title = F.concat(F.lit("# "), F.coalesce("title", "display_name", F.concat(F.lit("session "), F.col("session_id").cast("string"))))
    return sessions.join(turns, "session_id").select("session_id", F.concat(title, F.lit("\n\n- source: "), F.coalesce("source", F.lit("-")), F.lit("\n\n"), "turns").alias("markdown"))
