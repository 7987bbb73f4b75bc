"""Line deduplication by winnowing over line hashes.

A text is cut at newlines; blank lines are passed over. Every line starts a *gram*, the shortest run of lines with
at least ``GRAM_WORDS`` words, and a *window*, the grams that start within the next ``WINDOW_WORDS`` words. The gram
with the smallest hash in a window is selected, so two equal runs of ``GRAM_WORDS + WINDOW_WORDS`` words or more
are guaranteed to have a selected gram in common. Selected grams that stand in several places mark where runs
repeat. From each mark matches are extended both ways: every full run (the shortest of at least the guaranteed words) that holds the mark is
compared with the others by 128 bits over all its lines; a run that stood earlier - in a smaller doc_id, or further up in the same document - is
deleted. Overlapping equal runs on both sides of a mark add up to the longest repeated run. (Two unequal runs among 10**11 have equal bits
with a probability below 10**-16.)

Only DataFrame expressions are used. Counts are combined before every shuffle, and joins meet marked positions
with aggregated hashes, so a run that stands in a third of all rows costs one row for each place.

Defined cases: null and empty texts have no lines; lines are compared without white space at their ends; runs shorter than
the guarantee stay, whatever their number; repeated rows (equal doc_id and text) are one document read
once; different texts under one doc_id are documents of their own, in the order of a hash of the text, each with its own row in the report; a row with a null doc_id is left alone; a run that
overlaps its own repetition keeps only what precedes it; lines of equal hash and place are ties that no choice depends on; a very long text is one
row for each line; an empty table gives an empty report; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recollect.runtime import small_side, stage

GRAM_WORDS = 25
WINDOW_WORDS = 25
#: First places of repeated runs (48 bytes each) broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 50_000

#: A document is known by its doc_id and a hash of its text.
DOC = ["doc_id", "version"]

_EDGE = r"^[ \t-\r]+|[ \t-\r]+$"
_SPACE = r"[ \t-\r]+"


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, version, pos, h, h2, words of every line that is not blank; pos is the line's place in the text."""
    cut = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    clean = F.regexp_replace("line", _EDGE, "")
    rows = cut.select(*DOC, "pos", clean.alias("line")).where("line != ''")
    return rows.select(*DOC, "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(7), "line").alias("h2"), F.size(F.split("line", _SPACE)).cast("long").alias("words"))


def runs(docs: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, version, pos, gram, picks, run, run2, stop of every line; gram and run are null where the text ends before.

    ``picks``: the place of the smallest gram of the window that starts here, if it is complete. ``run`` and ``run2`` hash the lines from
    pos to stop, the shortest run of the guaranteed words.
    """
    full = gram_words + window_words
    by_doc = Window.partitionBy(*DOC).orderBy("pos")
    # of repeated rows each line is read once
    placed = lines(docs).withColumn("above", F.lag("pos").over(by_doc)).where("above is null or above != pos").drop("above")
    begin = F.sum("words").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("at", F.coalesce(begin, F.lit(0)).cast("long"))
    by_word = Window.partitionBy(*DOC).orderBy("at")
    of_gram, of_run, of_window = (by_word.rangeBetween(0, n - 1) for n in (gram_words, full, window_words))
    after = F.col("at") + F.col("words")
    seen = placed.select(
        *DOC,
        "pos",
        "at",
        F.collect_list("h").over(of_gram).alias("gram_lines"),
        (F.max(after).over(of_gram) - F.col("at")).alias("gram_size"),
        F.collect_list("h").over(of_run).alias("run_lines"),
        F.collect_list("h2").over(of_run).alias("run_lines2"),
        (F.max(after).over(of_run) - F.col("at")).alias("run_size"),
        F.max("pos").over(of_run).alias("stop"),
    )
    whole_run = F.col("run_size") >= full
    grams = seen.select(
        *DOC,
        "pos",
        "at",
        F.when(F.col("gram_size") >= gram_words, F.xxhash64(F.lit(1), "gram_lines")).alias("gram"),
        F.when(whole_run, F.xxhash64(F.lit(2), "run_lines")).alias("run"),
        F.when(whole_run, F.xxhash64(F.lit(3), "run_lines2")).alias("run2"),
        F.when(whole_run, F.col("stop")).alias("stop"),
    )
    # The window that starts here is complete if the run is; its smallest gram (rightmost of equals) is selected.
    least = F.when(F.col("run").isNotNull(), F.min(F.struct("gram", (-F.col("pos")).alias("back"))).over(of_window))
    return grams.select(*DOC, "pos", "gram", "run", "run2", "stop", (-least["back"]).alias("picks"))


def repeated_runs(docs: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, version, pos, stop, first_doc: the runs of the guaranteed length that stood earlier, and where."""
    table = stage(runs(docs, gram_words, window_words), "line-runs")
    picked = table.where("picks is not null").select(*DOC, F.col("picks").alias("pos")).distinct()
    selected = table.where("gram is not null").select(*DOC, "pos", "gram").join(picked, [*DOC, "pos"], "left_semi")
    selected = stage(selected, "line-fingerprints")
    common = small_side(stage(selected.groupBy("gram").agg(F.count("*").alias("places")).where("places > 1").select("gram"), "line-common"), BROADCAST_ROWS)
    none = F.lit(None)
    marks = selected.join(common, "gram", "left_semi").select(*DOC, "pos", none.cast("int").alias("stop"), none.cast("long").alias("run"), none.cast("long").alias("run2"), F.col("pos").alias("mark"))
    # A run is looked at if it holds a mark: the first mark at or after its start comes before its stop.
    both = table.where("run is not null").select(*DOC, "pos", "stop", "run", "run2", none.cast("int").alias("mark")).unionByName(marks)
    ahead = Window.partitionBy(*DOC).orderBy("pos").rangeBetween(0, Window.unboundedFollowing)
    near = both.withColumn("mark", F.min("mark").over(ahead)).where("run is not null and mark <= stop")
    near = stage(near.select(*DOC, "pos", "stop", "run", "run2"), "line-candidates")
    place = F.struct(*DOC, "pos")
    first = near.groupBy("run", "run2").agg(F.min(place).alias("first"), F.count("*").alias("places")).where("places > 1").select("run", "run2", "first")
    # one staged row for each repeated run: the places of a very common one can be split over tasks
    later = near.join(small_side(stage(first, "line-firsts"), BROADCAST_ROWS), ["run", "run2"]).where(place != F.col("first"))
    return later.select(*DOC, "pos", "stop", F.col("first.doc_id").alias("first_doc"))


def removed_lines(docs: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, version, ranges (sorted, disjoint structs start, stop), sources (documents of the first places)."""
    found = repeated_runs(docs, gram_words, window_words)
    # merge overlapping ranges of a document
    order = Window.partitionBy(*DOC).orderBy("pos", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    part = found.withColumn("new", (F.coalesce(before, F.lit(-2)) < F.col("pos")).cast("int"))
    part = part.withColumn("island", F.sum("new").over(order))
    ranges = part.groupBy(*DOC, "island").agg(F.min("pos").alias("start"), F.max("stop").alias("stop"), F.collect_set("first_doc").alias("from"))
    return ranges.groupBy(*DOC).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("from")))).alias("sources"),
    )


def report(docs: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """One row per document that loses lines: doc_id, n_ranges, n_removed, removed (``start-stop`` line places), sources."""
    gone = removed_lines(docs, gram_words, window_words)
    written = F.concat_ws(",", F.transform("ranges", lambda r: F.concat(r["start"].cast("string"), F.lit("-"), r["stop"].cast("string"))))
    size = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"] + 1)
    return gone.select("doc_id", F.size("ranges").cast("long").alias("n_ranges"), size.alias("n_removed"), written.alias("removed"), "sources")


def without_repeats(docs: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with the later repeated runs deleted from ``text``; every other column is kept."""
    gone = removed_lines(docs, gram_words, window_words).select(F.col("doc_id").alias("__doc"), F.col("version").alias("__version"), F.col("ranges").alias("__ranges"))
    joined = docs.join(gone, (docs["doc_id"] == gone["__doc"]) & (F.xxhash64(docs["text"]) == gone["__version"]), "left")
    inside = lambda i: F.exists("__ranges", lambda r: (i >= r["start"]) & (i <= r["stop"]))
    text = F.array_join(F.filter(F.split(docs["text"], "\n"), lambda line, i: ~inside(i)), "\n")
    return joined.withColumn("text", F.when(F.col("__ranges").isNull(), docs["text"]).otherwise(text)).select(*docs.columns)
