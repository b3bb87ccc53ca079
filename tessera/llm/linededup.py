"""Line dedup by a deletion-neighbourhood join, with DataFrame functions only.

Two lines are near when one word inserted, deleted or replaced makes them
equal. Every variant of a line with one word deleted is a hashed key; equal
keys are joined, the edit distance is verified on the words, and the earliest
line stays.

Lines of the same words are first reduced to their earliest one. Before the
variants are made, lines are dropped that cannot have a neighbour: of two near
lines, the first or the last half of the words agrees, so only lines that
share a half go on. This loses no pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.text import small
from tessera.session import cut_lineage

#: lines of fewer words are not near to any line
MIN_WORDS = 5
#: characters, without blanks, from which on exact copies of a line of fewer words go if they are asked for
MIN_CHARS = 20


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, th, line_no, line``: every line, its blanks all spaces; a row
    is named by its doc_id and the hash of its text."""
    # once for a text, so that no line needs a regular expression
    spaced = F.regexp_replace("text", r"[\x09\x0B-\x0D]", " ")
    return docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("th"),
                                                        F.posexplode(F.split(spaced, "\n")).alias("line_no", "line"))


def _line_words(line: Column) -> Column:
    """The plain words of a line of :func:`_lines`."""
    return F.array_remove(F.split(line, " "), "")


def _half_keys(n: Column) -> list[Column]:
    """Hashes of the first and the last half of the words, for a pair of lines
    the shorter of which has ``n`` words; null without words there."""
    half = F.floor(n / 2).cast("int")
    return [F.when(half > 0, F.xxhash64(F.slice("w", F.lit(1), half), n, F.lit("first"))),
            F.when(half > 0, F.xxhash64(F.slice("w", -half, half), n, F.lit("last")))]


def _slot(word: Column, place: Column) -> Column:
    return F.xxhash64(word, place.cast("long"))


def near_lines(docs: DataFrame, min_words: int = MIN_WORDS, min_chars: int | None = None) -> DataFrame:
    """``doc_id, th, line_no`` of every line to remove: those whose words equal
    those of an earlier line, or are within one word edit of an earlier one;
    ``th`` is the hash of the row's text.

    Earlier means a smaller (doc_id, th, line number), a null doc_id first. A line
    within one edit of an earlier line goes even if that one goes too. Lines
    of fewer than ``min_words`` words stay and remove nothing; with ``min_chars``
    those of so many characters or more, blanks left out, go as exact copies of
    an earlier line (a line of an unspaced script is one word).
    """
    n = F.size("w")
    same, less = _half_keys(n), _half_keys(n - 1)
    chars = F.lit(0) if min_chars is None else F.char_length(F.array_join("w", ""))
    seen = _lines(docs).select("doc_id", "th", "line_no", _line_words(F.col("line")).alias("w"))
    seen = seen.select("doc_id", "th", "line_no", F.xxhash64("w").alias("a"), F.xxhash64(F.lit(7), "w").alias("b"), n.alias("n"), chars.alias("chars"),
                               same[0].alias("k1"), same[1].alias("k2"), less[0].alias("k3"), less[1].alias("k4"))
    seen = cut_lineage(seen.drop("chars") if min_chars is None else seen)
    long = seen.where(F.col("n") >= min_words)
    if min_chars is None:
        seen = long
    else:  # exact copies of lines of few but long words too
        seen = seen.where((F.col("n") >= min_words) | (F.col("chars") >= min_chars))
    at = F.struct("doc_id", "th", "line_no")
    # lines that share a half with a line of other words; only they can have a neighbour
    halves = long.select("a", F.explode(F.array("k1", "k2", "k3", "k4")).alias("k"))
    shared = halves.groupBy("k").agg(F.min("a").alias("x"), F.max("a").alias("y")).where("x <> y").select("k")
    wanted = halves.join(small(cut_lineage(shared)), "k", "left_semi").select("a").distinct()
    wanted = small(cut_lineage(wanted))
    # the earliest line of each word list, one list having one hash but for chance; only these lines are cut into words again
    firsts = long.join(wanted, "a", "left_semi").groupBy("a", "b").agg(F.min(at).alias("at"))
    named = cut_lineage(firsts.select(F.col("at.doc_id").alias("d"), F.col("at.th").alias("t"), F.col("at.line_no").alias("l")))
    some = _lines(docs).join(small(named), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")) & (F.col("line_no") == F.col("l")), "left_semi")
    # rows that repeat doc_id and text hold the same line
    some = some.select(at.alias("at"), _line_words(F.col("line")).alias("w")).groupBy("at").agg(F.min("w").alias("w")).select("at", "w", F.size("w").alias("n"))
    some = cut_lineage(some)
    removed = _verified(_candidates(some), some)
    # equal words: 128 bits of hash
    firsts = seen.groupBy("a", "b").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = firsts.join(removed.select(F.col("at").alias("first"), F.lit(True).alias("near")), "first", "left").where("copies > 1 OR near")
    both = seen.select("doc_id", "th", "line_no", "a", "b").join(firsts, ["a", "b"])
    return both.where(F.col("near") | (at != F.col("first"))).select("doc_id", "th", "line_no")


def _candidates(lines: DataFrame) -> DataFrame:
    """``early, late, place`` of lines that share a variant: equal but for the
    word at ``place``, or one of them without the word at ``place``."""
    # the key of a word list is the xor of hashes of its words with their places;
    # running sums give the key of every variant in time linear in the line
    words = lines.repartition("at").select("at", "n", F.posexplode("w").alias("p", "word"))
    words = words.withColumn("stay", _slot(F.col("word"), F.col("p"))).withColumn("move", _slot(F.col("word"), F.col("p") - 1))
    line = Window.partitionBy("at").orderBy("p")
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("at").orderBy("p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.bit_xor("stay").over(upto).bitwiseXOR(F.col("stay"))
    after = F.bit_xor("move").over(whole).bitwiseXOR(F.bit_xor("move").over(upto))
    variants = words.select("at", "n", "p", before.bitwiseXOR(after).alias("k"), F.bit_xor("stay").over(whole).alias("whole"))
    # one word replaced: same variant, same place, same length; the earliest of the group is near to all others
    same = F.xxhash64("k", "p", "n")
    group = variants.groupBy(same.alias("g")).agg(F.min("at").alias("early"), F.max("at").alias("last")).where("early <> last").select("g", "early")
    replaced = variants.select(same.alias("g"), "at", "p").join(small(cut_lineage(group)), "g").where("at > early").select(
        "early", F.col("at").alias("late"), F.col("p").alias("place"))
    # one word deleted: the variant is the other line as a whole; lines differ, so there is one such line for a key
    others = cut_lineage(variants.where("p = 0").select(F.col("whole").alias("k"), F.col("at").alias("short"), F.col("n").alias("m")))
    deleted = variants.select("k", "at", "n", "p").join(small(others), "k").where("m = n - 1")
    deleted = deleted.select(F.least("at", "short").alias("early"), F.greatest("at", "short").alias("late"), F.col("p").alias("place"))
    return replaced.union(deleted)


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """``at`` of the later lines whose words really are within one edit."""
    x = lines.select(F.col("at").alias("early"), F.col("w").alias("u"))
    y = lines.select(F.col("at").alias("late"), F.col("w").alias("v"))
    both = pairs.join(x, "early").join(y, "late")
    rest = lambda w, m: F.slice(w, F.col("place") + m, F.size(w))
    same = F.slice("u", F.lit(1), F.col("place")) == F.slice("v", F.lit(1), F.col("place"))
    tail = F.when(F.size("u") == F.size("v"), rest("u", 2) == rest("v", 2)).when(
        F.size("u") < F.size("v"), rest("u", 1) == rest("v", 2)).otherwise(rest("u", 2) == rest("v", 1))
    return both.where(same & tail).select(F.col("late").alias("at")).distinct()


def dedupe_lines(docs: DataFrame, min_words: int = MIN_WORDS, min_chars: int | None = None) -> DataFrame:
    """``docs`` with the lines of :func:`near_lines` cut out of ``text``, and
    ``_n_lines, _n_removed`` (which replace columns of these names).

    Reads ``doc_id, text``; all other columns pass through. Lines end at
    ``\\n``; those that stay keep their characters and order. A null text stays
    null with 0 lines; a text that loses every line becomes empty. Rows are
    told apart by doc_id and text, a null doc_id like any other; only those that
    repeat both count as one document and lose the same line numbers. An empty
    table gives no rows.
    """
    gone = near_lines(docs, min_words, min_chars).groupBy(F.col("doc_id").alias("id"), "th").agg(
        F.sort_array(F.collect_set("line_no")).alias("gone"))  # lines of one document
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own"), F.xxhash64("text").alias("hash"))  # packed, so that no column's name can clash
    both = rows.join(gone, F.col("own").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("th")), "left")
    both = both.withColumn("lines", F.split("row.text", "\n"))
    touched = F.col("gone").isNotNull() & F.col("lines").isNotNull()
    both = both.withColumn("kept", F.when(touched, F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))))
    text = F.when(touched, F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")).otherwise(F.col("row.text"))
    n_lines = F.when(F.col("lines").isNull(), F.lit(0)).otherwise(F.size("lines"))
    removed = F.when(touched, F.size("lines") - F.size("kept")).otherwise(F.lit(0))
    return both.select(*[text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns
                         if c not in ("_n_lines", "_n_removed")],
                       n_lines.cast("long").alias("_n_lines"), removed.cast("long").alias("_n_removed"))
