"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per document: word, symbol, repeated-line and repeated-window counts.  Across
documents: the hash of each normalised line (blanks collapsed, trimmed,
lower-cased), and per host the number of distinct documents that hold it.
Documents with equal normalised text count once, so copies of a page do not
make its lines boilerplate.  Lines above the limit are removed, and a document
that keeps too small a share of its words is rejected.

The text is read once; everything after works on a narrow written table.
Distinct documents are counted with map-side pre-aggregation, and the join of
lines with the frequent ones is salted, so a line or host that a third of all
rows hold spreads over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch

_WORD = r"[^\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words inside a window of ``width`` words that occurs twice or more in the array.

    Windows are compared by 64-bit hash.
    """
    def covered(positions: Column) -> Column:
        last = F.size(positions) - 1
        return F.aggregate(
            F.sequence(F.lit(0), last), F.lit(0).cast("long"),
            lambda a, k: a + F.when(k == last, width).otherwise(
                F.least(F.lit(width), F.get(positions, k + 1) - F.get(positions, k))))

    def positions(s: Column) -> Column:
        same = F.filter(s, lambda e, k: (F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
                                             | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))))
        return F.array_sort(F.transform(same, lambda e: e["i"]))

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            _let(pairs, lambda s: _let(positions(s), covered)))

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - width),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    return _let(F.transform(words, lambda w: F.xxhash64(w)),
                lambda w: F.when(F.size(w) <= width, F.lit(0).cast("long")).otherwise(_let(hashes(w), count)))


def normal_lines(text: Column) -> Column:
    """The non-empty lines of a text, blanks collapsed, trimmed, lower-cased."""
    flat = F.lower(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " "))
    return F.filter(F.transform(F.split(flat, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def _measures(docs: DataFrame, id_col: str, host_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({_WORD})"), 1)
    raw = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    lines = _let(normal_lines(text), lambda ls: F.struct(
        F.xxhash64(F.concat_ws("\n", ls)).alias("content"),
        F.transform(ls, lambda x: F.struct(
            F.xxhash64(x).alias("line"),
            (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words"))).alias("lines")))
    return docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                       repeated_words(w).alias("n_repeat_words"))).alias("w"),
        (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(raw, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        lines.alias("l"),
    ).select("uid", "doc_id", "host", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words",
             "l.content", "l.lines")


def line_rules(docs: DataFrame, max_docs: int = 100, min_kept_percent: int = 30, min_words: int = 10,
               max_repeat_percent: int = 20, id_col: str = "doc_id", host_col: str = "source",
               text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per input row: the measures, base_failed, n_removed_words, removed_lines, kept.

    ``removed_lines`` holds the hashes of the document's lines that more than
    ``max_docs`` distinct documents of its host hold.  Null text counts as
    empty; an empty text fails the base rules.  Null hosts form one host with
    the empty name.  Repeated rows and null ids are judged like any other
    row.  An empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "line-rules")
    rows = scratch.stage(_measures(docs, id_col, host_col, text_col), "rows")
    lines = rows.select("uid", "host", "content", F.inline("lines"))
    often = (lines.groupBy("host", "line").agg(F.count_distinct("content").alias("docs"))
             .filter(F.col("docs") > max_docs).select("host", "line")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    removed = (lines.select("uid", "host", "line", "words", F.pmod(F.hash("uid"), F.lit(salts)).alias("salt"))
               .join(often, ["host", "line", "salt"])
               .groupBy("uid").agg(F.sum("words").alias("n_removed_words"),
                                   F.collect_set("line").alias("removed_lines")))
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    gone = F.coalesce("n_removed_words", F.lit(0))
    return (rows.drop("content", "lines").join(removed, "uid", "left")
            .withColumn("n_removed_words", gone.cast("long")).withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (100 * (F.col("n_words") - F.col("n_removed_words"))
                                           >= min_kept_percent * F.col("n_words")))
            .drop("uid", "host"))


def remove_frequent_lines(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs`` without their frequent lines, other columns unchanged.  Needs unique ids."""
    v = verdicts.filter("kept").select(F.col("doc_id").alias("_id"), "removed_lines")
    left = F.filter(F.split(F.col(text_col), "\n"), lambda x: ~F.array_contains(
        F.col("removed_lines"), F.xxhash64(F.trim(F.lower(F.regexp_replace(x, r"[\x20\x09\x0B-\x0D]+", " "))))))
    text = F.when(F.col("removed_lines").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    return (docs.join(v, docs[id_col].eqNullSafe(v["_id"])).withColumn(text_col, text)
            .select(*docs.columns))
