"""Text and scalar expressions: tokens, truncation, ids, snippets, chunks, clamps. All are JVM-side columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_LIMIT = 2000
REASON_LIMIT = 200
CHUNK_CHARS = 1400
SNIPPET_CHARS = 200

def _latin_folds() -> tuple[str, str]:
    """Latin letters that decompose into a plain letter and marks, and those letters."""
    parts = [(chr(c), unicodedata.normalize("NFD", chr(c))) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
    kept = [(c, d[0]) for c, d in parts if len(d) > 1 and d[0].isascii() and all(map(unicodedata.combining, d[1:]))]
    return "".join(c for c, _ in kept), "".join(d for _, d in kept)


def fold_marks(text: Column) -> Column:
    """Strip the marks of Latin letters, composed or decomposed; letters that do not decompose (ß, ł, ø) stay."""
    return F.regexp_replace(F.translate(text, *_latin_folds()), r"(?<=[A-Za-z])\p{Mn}+", "")


def index_tokens(text: Column) -> Column:
    """Tokens of the lexical index: runs of letters and digits, lower-cased, marks stripped."""
    return F.regexp_extract_all(fold_marks(F.lower(F.coalesce(text, F.lit("")))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def whole_tokens(text: Column) -> Column:
    """Tokens that ``contains`` matches on; an operand's tokens must all be there."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def has_all_tokens(text: Column, operand: Column) -> Column:
    own, asked = whole_tokens(text), whole_tokens(operand)
    return F.forall(asked, lambda t: F.array_contains(own, t))


def space_words(text: Column) -> Column:
    """Distinct lower-cased words between white space."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != ""))


def truncated(text: Column, limit: int, mark: str = "") -> Column:
    """First ``limit`` characters; with a mark, cut so that text and mark fit the limit."""
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit - len(mark)), F.lit(mark)))


def summary(text: Column, limit: int = 70) -> Column:
    """White space collapsed, cut after ``limit`` characters with an ellipsis."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(F.length(flat) <= limit, flat).otherwise(F.concat(F.substring(flat, 1, limit), F.lit("…")))


def uuid5(namespace: str, name: Column) -> Column:
    """Name-based UUID (version 5) of a namespace UUID and a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(63)).bitwiseOR(128)))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 19, 2), F.lit("-"), F.substring(h, 21, 12))


def fixed_chunks(text: Column, width: int = TEXT_LIMIT) -> Column:
    """Consecutive pieces of ``width`` characters."""
    n = F.ceil(F.length(text) / F.lit(width)).cast("int")
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(text, i * width + 1, F.lit(width)))).otherwise(F.array().cast("array<string>"))


def without_frontmatter(text: Column) -> Column:
    """A leading ``---`` block removed, once."""
    return F.regexp_replace(text, r"(?s)\A---\s*\n.*?\n---\s*\n", "")


def stripped(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def packed_paragraphs(body: Column, limit: int = CHUNK_CHARS) -> Column:
    """A section's text whole if it fits, else its paragraphs packed in order up to the limit.

    Blank paragraphs are dropped; the others keep their text as it is, and only the ends of a finished chunk are stripped.
    """
    paragraphs = F.filter(F.split(body, r"\n\s*\n"), lambda p: stripped(p) != "")
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))

    def step(state, para):
        flush = (F.length(state["cur"]) + F.length(para) + 2 > limit) & (state["cur"] != "")
        return F.struct(
            F.when(flush, F.array_append(state["out"], stripped(state["cur"]))).otherwise(state["out"]).alias("out"),
            F.when(flush | (state["cur"] == ""), para).otherwise(F.concat(state["cur"], F.lit("\n\n"), para)).alias("cur"),
        )

    packed = F.aggregate(paragraphs, empty, step, lambda s: F.when(s["cur"] != "", F.array_append(s["out"], stripped(s["cur"]))).otherwise(s["out"]))
    return F.when(F.length(body) <= limit, F.array(body)).otherwise(packed)


def snippet(text: Column, query: Column, width: int = SNIPPET_CHARS) -> Column:
    """Text around the first query token that occurs, with ellipses where it is cut."""
    tokens = F.regexp_extract_all(F.lower(query), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    low = F.lower(text)
    places = F.filter(F.transform(tokens, lambda t: F.call_function("locate", t, low)), lambda p: p > 0)
    at = F.get(places, 0) - 1
    start = F.greatest(F.lit(0), at - width // 3)
    stop = F.least(F.length(text), start + width)
    flat = lambda s: F.translate(s, "\n", " ")
    inside = F.concat(F.when(start > 0, F.lit("…")).otherwise(F.lit("")), flat(F.substr(text, start + 1, stop - start)), F.when(stop < F.length(text), F.lit("…")).otherwise(F.lit("")))
    head = F.concat(flat(F.substring(text, 1, width)), F.when(F.length(text) > width, F.lit("…")).otherwise(F.lit("")))
    return F.when(F.size(places) > 0, inside).otherwise(head)


def clamped(value: Column, default: int, ceiling: int) -> Column:
    """An integer limit: the default if it is no whole number, within 1 and the ceiling however many digits it has."""
    text = F.trim(value.cast("string"))
    digits = F.when(text.rlike(r"^[+-]?[0-9]+$"), F.when(F.length(F.regexp_replace(text, r"^[+-]?0*", "")) > 18, F.when(text.startswith("-"), F.lit(1)).otherwise(F.lit(ceiling))).otherwise(text.try_cast("long")))
    return F.least(F.greatest(F.coalesce(digits, F.lit(default)), F.lit(1)), F.lit(ceiling)).cast("int")


def valid_point_id(value: Column) -> Column:
    """An unsigned integer of up to 20 digits, or a UUID."""
    return F.coalesce(value.rlike(r"\A(?:[0-9]{1,20}|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})\z"), F.lit(False))


def without_userinfo(url: Column) -> Column:
    return F.regexp_replace(url, r"^([A-Za-z][A-Za-z0-9+.-]*://)[^@/]*@", "$1")


def epoch_seconds(raw: Column, strict: bool = False) -> Column:
    """A timestamp text as epoch seconds: a number, or ISO 8601 (no zone: UTC); null otherwise.

    ``strict`` takes ISO 8601 only.
    """
    number = raw.try_cast("double")
    number = F.when(F.isnan(number) | (F.abs(number) == F.lit(float("inf"))), F.lit(None)).otherwise(number)
    zoned = F.when(raw.rlike(r"(Z|[+-]\d\d:\d\d)$"), raw).otherwise(F.concat(raw, F.lit("Z")))
    iso = F.when(raw.rlike(r"^\d{4}-\d\d-\d\dT"), F.unix_micros(F.try_to_timestamp(zoned)) / 1e6)
    return iso if strict else F.coalesce(number, iso)


def iso_from_epoch(seconds: Column) -> Column:
    """ISO 8601 in UTC, of epoch seconds; null of null."""
    micros = (seconds * 1000000).cast("long")
    return F.concat(F.date_format(F.to_utc_timestamp(F.timestamp_micros(micros), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def stamp(seconds: Column, zone: str = "UTC") -> Column:
    """Date and time to the second in a zone, ``-`` without a time."""
    utc = F.to_utc_timestamp(F.timestamp_micros((seconds * 1000000).cast("long")), F.current_timezone())
    return F.coalesce(F.date_format(F.from_utc_timestamp(utc, zone), "yyyy-MM-dd HH:mm:ss"), F.lit("-"))


def result_line(score: Column, point_id: Column, text: Column) -> Column:
    """A hit as a line: score, id, text."""
    return F.concat(F.lit("["), F.format_string("%.2f", score), F.lit("] ("), point_id.cast("string"), F.lit(") "), text)


def parsed_results(page: Column) -> Column:
    """Hits (score, point_id, text) of a page of result lines; a hit's text goes on until the next hit begins."""
    begins = r"(?m)^\[(-?[0-9.]+)\] \(([^)]+)\) "
    marked = F.regexp_replace(page, begins, "\u0001$1\u0002$2\u0002")
    parts = F.filter(F.split(marked, "\u0001"), lambda p: F.contains(p, F.lit("\u0002")))
    field = lambda p, i: F.split(p, "\u0002", 3)[i]
    return F.transform(parts, lambda p: F.struct(field(p, 0).cast("double").alias("score"), field(p, 1).alias("point_id"), F.regexp_replace(field(p, 2), r"\n\z", "").alias("text")))


def counted(n: Column) -> Column:
    """A count with thousands separators."""
    return F.format_number(n.cast("long"), 0)


def status_line(name: Column, millis: Column, collection: Column, hits: Column, attempts: Column) -> Column:
    """name, milliseconds, collection and hits of attempts, as far as there are any."""
    return F.concat_ws(" · ", name, F.concat(F.round(millis).cast("long").cast("string"), F.lit(" ms")), collection, F.concat(F.lit("hits "), hits.cast("string"), F.lit("/"), attempts.cast("string")))


def json_bytes(payload: Column) -> Column:
    """Bytes of a payload (struct) as JSON."""
    return F.octet_length(F.to_json(payload))


def truthy(value: Column) -> Column:
    """Switch text: on words are true, everything else is off."""
    return F.coalesce(F.lower(F.trim(value)).isin("1", "true", "yes", "on"), F.lit(False))
