"""Line dedup with a log-template tree, in DataFrame operations only.

A line's words that hold a digit are variable fields. The line falls through a
tree of fixed depth: its number of words, then its leading words; where it ends
is its leaf. In a leaf, a word is constant at its place if enough documents,
and a large enough share of the leaf's, have it there, else the place is one
more variable field. A line's template is its constant words in their places.
If most places beyond the leading ones are constant and enough documents have
the template, it recurs, and its lines are dropped, all but the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halyard.llm.common import discard, durable

#: Words that less of a leaf's documents have at their place are values of a field, at every size of the table.
FIELD_SHARE = 0.1
FIELD, BLANK = "<*>", "[ \\t\\r\\f]+"
#: Words that hold a digit; begun only where a word begins, and without backtracking.
VARIABLE = r"(?<![^ \t\r\f])[^ \t\r\f0-9]*+[0-9][^ \t\r\f]*+"
#: Leaves that differ inside are few; up to so many they are sent to all tasks, beyond it they are joined by shuffle.
BROADCAST_LEAVES = 500_000


def spaced(line: Column) -> Column:
    """The line trimmed, its words one space apart. Most lines are so, and are only looked through."""
    odd = line.contains("  ") | line.contains("\t") | line.contains("\r") | line.contains("\f")
    return F.when(odd, F.regexp_replace(F.trim(line), BLANK, " ")).otherwise(F.trim(line))


def tree_lines(docs: DataFrame, leading: int, with_line: bool = False) -> DataFrame:
    """(doc_id, th, at, n, leaf, m1, m2[, line]): every line, its number of words, its leaf and two hashes of it.

    Short lines are not filtered here: a filter would be moved to where the
    lines are made and do the work on each of them a second time.
    """
    cut = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "line"))
    lines = cut.withColumn("line", spaced(F.col("line")))
    lines = lines.withColumn("line", F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", VARIABLE, FIELD)).otherwise(F.col("line")))
    n = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    lines = lines.withColumn("n", n).withColumn("leaf", F.xxhash64("n", F.substring_index("line", " ", leading)))
    keep = ["doc_id", "th", "at", "n", "leaf", F.xxhash64("line").alias("m1"), F.xxhash64(F.lit(1), "line").alias("m2")]
    return lines.select(*keep, *(["line"] if with_line else []))


def drop_places(docs: DataFrame, min_docs: int = 5, leading: int = 3, least_words: int = 3, constant: float = 0.5, keep_first: bool = True, share: float = FIELD_SHARE, beyond: bool = True) -> DataFrame:
    """(doc_id, th, places): the lines to drop, by number from 0, of each text that has any. See drop_templates."""
    spark = docs.sparkSession
    lines, lines_path = durable(tree_lines(docs, leading), "lines")
    lines = lines.where(F.col("n") >= least_words)
    kind = ["leaf", "m1", "m2"]
    in_docs, in_docs_path = durable(lines.groupBy(*kind, "doc_id", "th").agg(F.min("at").alias("at")).groupBy(*kind).count(), "line-kinds")
    leaves = in_docs.groupBy("leaf").agg(F.sum("count").alias("docs"), F.count("*").alias("kinds")).where(F.col("docs") >= min_docs)
    leaves, leaves_path = durable(leaves, "line-leaves")
    # leaves with several kinds of line: which words are constant
    mixed = leaves.where("kinds > 1").select("leaf")
    if mixed.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES:
        mixed = F.broadcast(mixed)
    texts = tree_lines(docs, leading, True).join(mixed, "leaf").groupBy(*kind).agg(F.first("line").alias("line")).select(*kind, F.split("line", " ").alias("words"))
    sample, sample_path = durable(texts.join(in_docs, kind), "line-texts")
    placed = sample.select(*kind, "count", F.posexplode("words").alias("place", "word"))
    common = placed.groupBy("leaf", "place", "word").agg(F.sum("count").alias("docs")).where((F.col("docs") >= min_docs) & (F.col("word") != FIELD))
    if share:
        # a place's words that few of the leaf have are values of a field, however many documents those are
        common = common.join(leaves.select("leaf", F.col("docs").alias("of")), "leaf").withColumn("wide", F.col("docs") >= share * F.col("of")).drop("of")
    common, common_path = durable(common.drop("docs"), "line-words")
    constants = placed.join(common, ["leaf", "place", "word"], "inner" if share else "left_semi")
    held = F.struct("place", "word")
    shapes = [F.array_sort(F.collect_list(F.when(F.col("wide"), held))), F.array_sort(F.collect_list(held))] if share else [F.array_sort(F.collect_list(held))]
    shaped = constants.groupBy(*kind).agg(F.array(*shapes).alias("shapes"))
    # all of a leaf have the leading words: with beyond these tell nothing
    judged = F.col("words") - leading if beyond else F.col("words")
    said = (lambda t: F.size(F.filter(t, lambda x: x["place"] >= leading))) if beyond else F.size
    enough = F.filter("shapes", lambda t: (said(t) >= constant * judged) & (said(t) > 0))
    # the wider template, if it says enough, has all documents of the narrower
    general = sample.select(*kind, F.size("words").alias("words")).join(shaped, kind).select(*kind, F.get(enough, F.lit(0)).alias("template")).where("template is not null")
    named = general.select(*kind, F.xxhash64("template").alias("t1"), F.xxhash64(F.lit(1), "template").alias("t2"))
    named, named_path = durable(named, "line-templates")
    # any other line of a crowded leaf is a template by itself
    inside = lines.join(leaves.select("leaf"), "leaf")
    told = inside.join(named, kind, "left").select("doc_id", "th", "at", "leaf", F.coalesce("t1", "m1").alias("t1"), F.coalesce("t2", "m2").alias("t2"))
    told, told_path = durable(told, "line-told")
    template = ["leaf", "t1", "t2"]
    seen = told.groupBy(*template, "doc_id", "th").agg(F.min("at").alias("at"))
    again = seen.groupBy(*template).agg(F.count("*").alias("docs"), F.min(F.struct("doc_id", "th", "at")).alias("first")).where(F.col("docs") >= min_docs)
    again, again_path = durable(again, "line-again")
    gone = told.join(again, template)
    if keep_first:
        gone = gone.where(~F.struct("doc_id", "th", "at").eqNullSafe(F.col("first")))
    out, _ = durable(gone.groupBy("doc_id", "th").agg(F.collect_set("at").alias("places")), "line-drops")
    discard(spark, lines_path, in_docs_path, leaves_path, sample_path, common_path, named_path, told_path, again_path)
    return out


def drop_templates(docs: DataFrame, min_docs: int = 5, leading: int = 3, least_words: int = 3, constant: float = 0.5, keep_first: bool = True, share: float = FIELD_SHARE, beyond: bool = True) -> DataFrame:
    """docs, all its columns and rows, with the lines of recurring templates dropped; adds (or replaces) _lines and _dropped.

    A template recurs if min_docs different texts or more have it, by doc_id and
    text; its line in the smallest doc_id (nulls first, then by hash of the text
    and place) stays with keep_first. Lines of fewer than least_words words are
    never dropped. Lines are cut at line feeds alone. A null text stays null; an
    empty one has one line; a text may become empty. Repeated rows count as one
    document and get the same treatment. An empty table gives no rows.

    With share, words that less than this share of their leaf's documents have
    at their place are taken as values of a field first; where too few words are
    left for a template, the words of min_docs documents decide. So fields stay
    fields when each of their values comes to min_docs documents.

    With beyond, the words after the leading ones are asked for the constant
    part, as the leading are equal in a leaf: lines that differ are one template
    only if enough of what can differ is the same.
    """
    slim = docs.select("doc_id", "text")
    places = drop_places(slim, min_docs, leading, least_words, constant, keep_first, share, beyond)
    # the row travels as one column, so no name of its columns meets one of ours
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("h"))
    # the same plan at every size: both sides go by their text's key
    joined = rows.join(places.hint("merge"), rows["row.doc_id"].eqNullSafe(places["doc_id"]) & (rows["h"] == places["th"]), "left")
    text, gone = F.col("row.text"), F.col("places")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(gone, i)), "\n")
    lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.split(text, "\n")))
    new = F.when(gone.isNull(), text).otherwise(kept).alias("text")
    counts = [lines.cast("long").alias("_lines"), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("_dropped")]
    names = [c for c in docs.columns if c not in ("_lines", "_dropped")]
    return joined.select(*[new if c == "text" else F.col("row").getField(c).alias(c) for c in names], *counts)
