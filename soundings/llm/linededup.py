"""Line deduplication by winnowing: later copies of repeated runs of lines go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import BLANKS
from .shared import dropped, row_key, staged


def _lines(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Hash, number, and words before it (``s``) of every line that has a word; no text is carried."""
    keyed = docs.select(F.col(doc_id).alias("_o"), row_key(doc_id, text).alias("_k"), F.split(F.col(text), "\n").alias("_t"))
    one = keyed.select("_o", "_k", F.posexplode("_t").alias("ln", "line"))
    plain = F.translate("line", BLANKS[1:], " " * (len(BLANKS) - 1))
    return one.select("_o", "_k", "ln", F.xxhash64("line").alias("h"), F.size(F.filter(F.split(plain, " "), lambda w: w != "")).alias("nw")).where("nw > 0")


def windows(docs: DataFrame, min_words: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """For every line with a word, the shortest run of lines from it on (``a``) and up to it (``b``) with ``min_words`` words; NULL where the text has no such run.

    A struct has ``content`` (hash of the run's line hashes), ``first`` and ``last``; ``a`` has the run's least line hash ``fp`` and its place ``at``, and ``b``
    the ``fp`` of the run that begins where it begins. ``picked``: this line's window picks another place than the last one's."""
    lines = _lines(docs, text, doc_id)
    by = Window.partitionBy("_k")
    # Repeated rows share a key; they are one document here. All steps up to the windows use this one shuffle.
    lines = lines.repartition("_k").groupBy("_k", "ln").agg(F.first("_o").alias("_o"), F.first("h").alias("h"), F.first("nw").alias("nw"))
    lines = lines.withColumn("e", F.sum("nw").over(by.orderBy("ln").rowsBetween(Window.unboundedPreceding, 0)))
    lines = lines.withColumn("s", F.col("e") - F.col("nw"))
    ahead = by.orderBy("s").rangeBetween(0, min_words - 1)
    least = F.min(F.struct("h", "ln")).over(ahead)
    run = F.struct(F.xxhash64(F.collect_list("h").over(ahead), F.lit(0)).alias("content"), F.col("ln").alias("first"), F.max("ln").over(ahead).alias("last"), least["h"].alias("fp"), least["ln"].alias("at"))
    lines = lines.withColumn("a", F.when(F.max("e").over(ahead) - F.col("s") >= min_words, run))
    back = by.orderBy("e").rangeBetween(-(min_words - 1), 0)
    run = F.struct(F.xxhash64(F.collect_list("h").over(back), F.lit(1)).alias("content"), F.min("ln").over(back).alias("first"), F.col("ln").alias("last"), F.first("a.fp").over(back).alias("fp"))
    lines = lines.withColumn("b", F.when(F.col("e") - F.min("s").over(back) >= min_words, run))
    last = F.lag("a.at").over(by.orderBy("e"))
    return lines.select("_o", "_k", "a", "b", (F.col("a.at").isNotNull() & ~F.col("a.at").eqNullSafe(last)).alias("picked"))


def repeated_spans(docs: DataFrame, min_words: int = 50, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Line ranges (``_k``, ``first``, ``last``) that repeat an earlier position, with the earlier document in ``source``.

    Winnowing: a window is a run of lines with ``min_words`` words, and the line with the least hash in it is its fingerprint. Neighbouring windows
    mostly pick the same place, so fingerprints are fewer than lines. A repeated run of at least ``min_words`` words holds a whole window, so both
    its copies pick the same fingerprint there: the guarantee. Fingerprints that stand at one place only are left; places of the others are joined.
    Around those, matches are extended to both sides: a line goes with the match if the window that begins at it, or the one that ends at it, is
    equal line by line (by the hash of its lines) to one at an earlier position. Windows are grouped, not paired, so a line that stands in
    very many documents costs no more than its places."""
    own = staged(windows(docs, min_words, text, doc_id), "windows")
    picked = own.where("picked").select(F.col("a.fp").alias("fp"), F.struct("_k", "a.at").alias("at"))
    often = staged(picked.groupBy("fp").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).where("lo <> hi").select("fp"), "fingerprints")
    sides = F.explode(F.array("a", F.struct("b.content", "b.first", "b.last", "b.fp", F.lit(None).cast("int").alias("at"))))
    met = own.select("_o", "_k", sides.alias("w")).where("w.fp is not null").select("_o", "_k", "w.content", "w.first", "w.last", "w.fp")
    met = staged(met.join(often, "fp", "left_semi"), "met")
    dropped(own, often)
    earliest = met.groupBy("fp", "content").agg(F.min(F.struct("_o", "_k", "first")).alias("src"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = met.join(staged(earliest, "earliest"), ["fp", "content"])
    later = (F.col("src._k") != F.col("_k")) | (F.col("src.first") != F.col("first"))
    return joined.where(later).select("_k", "first", "last", F.col("src._o").alias("source"))


def _marked(spans: DataFrame) -> DataFrame:
    """The numbers of all deleted lines of a document as merged ranges."""
    w = Window.partitionBy("_k").orderBy("first", "last")
    spans = spans.select("_k", "first", "last").distinct()
    spans = spans.withColumn("reach", F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("run", F.sum(F.when(F.col("first") <= F.col("reach") + 1, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = spans.groupBy("_k", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.groupBy("_k").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_runs"))


def _without(lines: Column, runs: Column) -> Column:
    """``lines`` without the ranges in ``runs``; pieces between ranges are sliced, not tested line by line."""
    ends = F.concat(F.transform(runs, lambda r: r["first"]), F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["last"] + 1))
    pieces = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda p: F.slice(lines, p["s"] + 1, F.greatest(p["e"] - p["s"], F.lit(0))))
    return F.flatten(pieces)


def line_dedup(docs: DataFrame, min_words: int = 50, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Delete later copies of runs of lines with at least ``min_words`` words.

    Returns ``row`` (the input's columns, its text replaced), ``n_lines``, ``n_deleted`` and ``emptied``
    (it had lines with words and has none left). Order of positions: ``doc_id`` (null first), then a hash
    of the row's text, then line number; the first position stays. A run is a sequence of lines with words,
    blank lines between them going with it; two copies must agree in every such line. Null texts stay null,
    empty ones empty. Rows equal in id and text count as one document and share its fate."""
    spans = _marked(repeated_spans(docs, min_words, text, doc_id))
    own = docs.select(F.struct("*").alias("row")).withColumn("_k", row_key(f"row.{doc_id}", f"row.{text}"))
    own = own.join(spans, "_k", "left")
    old = F.col(f"row.`{text}`")
    lines = F.split(old, "\n")
    kept = F.when(F.col("_runs").isNull(), old).otherwise(F.array_join(_without(lines, F.col("_runs")), "\n"))
    gone = F.coalesce(F.aggregate("_runs", F.lit(0), lambda a, r: a + r["last"] - r["first"] + 1), F.lit(0))
    own = own.select("row", kept.alias("_new"), F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), gone.alias("n_deleted"))
    emptied = (F.col("n_deleted") > 0) & (F.translate("_new", BLANKS, "") == "")
    return own.select(F.col("row").withField(f"`{text}`", F.col("_new")).alias("row"), F.when(old.isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"), F.col("n_deleted").cast("long").alias("n_deleted"), F.coalesce(emptied, F.lit(False)).alias("emptied"))
