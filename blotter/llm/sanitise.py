"""Information-theoretic sanitisation, in DataFrame functions only.

Protected entities are the e-mail addresses, IP addresses, card and phone
numbers that the patterns find.  A term in a document with an entity discloses
it when two things hold: the entity is likely once the term is known,

    p(e | t) = (both + 1/6) / (docs_t + 1/3)  >=  ``generalise_at``

(the median under Jeffreys' prior, so few documents make a term less certain),
and the term says much that was not known before: the pointwise mutual
information log(p(e | t) / p(e)) is at least ``least_gain`` nats.  Neither
threshold depends on the size of the table.  All counts are of distinct texts,
so copies are no evidence.  Every term of every document with an entity is
scored, also of entities that stand in one document (``min_support`` above 1
leaves out rarer pairs).  A term is removed from ``remove_at`` on, generalised
below, wherever it stands in the documents with that entity (other documents
keep it).

The text is read once for entities, once for the documents that hold one (only
these are shuffled; a copy of each is written), once for the rows that hold each term and once for
the texts that have copies, whose further rows are taken off those counts.
Matches and counts are narrow rows; positions come from running sums over the
pieces between matches, so long texts with many matches stay linear.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, free_names

#: The contract's patterns with possessive quantifiers, and starts only where a leftmost match can
#: start, so that no text makes them backtrack quadratically.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_ORDER = [*KINDS, "term"]
_TERM = r"[\p{L}\p{M}]+"


def _matches(text: Column, kind: str) -> Column:
    """Array of (kind, k, gap, value): the k-th match, the characters since the one before."""
    found = F.regexp_extract_all(text, F.lit(f"({KINDS[kind]})"), 1)
    if _HINT[kind]:
        found = F.when(F.contains(text, F.lit(_HINT[kind])), found).otherwise(F.array().cast("array<string>"))

    def rows(m: Column) -> Column:
        return F.transform(F.array(F.split(text, KINDS[kind], -1)), lambda p: F.transform(m, lambda v, k: F.struct(
            F.lit(kind).alias("kind"), k.alias("k"), F.length(F.get(p, k)).alias("gap"), v.alias("value"))))[0]

    empty = F.array().cast("array<struct<kind:string,k:int,gap:int,value:string>>")
    return F.transform(F.array(found), lambda m: F.when(F.size(m) > 0, rows(m)).otherwise(empty))[0]


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    part_ok = F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3) & (
        F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255))
    luhn = F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda a, i: a + F.transform(F.array(F.substring(F.reverse(digits), i, F.lit(1)).cast("int")), lambda d: F.when(
            i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d))[0])
    return (F.when(kind == "email", True).when(kind == "ip", part_ok)
            .when(kind == "card", n.between(16, 19) & (F.when(n.between(16, 19), luhn) % 10 == 0))
            .when(kind == "phone", n.between(8, 15)))


def _entity(kind: Column, value: Column) -> Column:
    """The entity a match names: spelling differences that do not change it are dropped."""
    return F.concat_ws(":", kind, F.when(kind.isin("email", "ip"), F.lower(value))
                       .otherwise(F.regexp_replace(value, "[^0-9]", "")))


def _distinct_terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({_TERM})"), 1))


def _places(texts: DataFrame) -> DataFrame:
    """(content, term, start, end) of every word of the texts."""
    text = F.col("text")
    words, pieces = F.regexp_extract_all(text, F.lit(f"({_TERM})"), 1), F.split(text, _TERM, -1)
    rows = texts.select("content", F.posexplode(F.transform(F.arrays_zip(words.alias("w"), pieces.alias("p")), lambda x: F.struct(
        x["w"].alias("w"), F.length(x["p"]).alias("gap")))).alias("j", "x")).filter("x.w is not null")
    upto = Window.partitionBy("content").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("x.gap") + F.length("x.w")).over(upto)
    return (rows.withColumn("end", end).select("content", F.lower("x.w").alias("term"),
                                               (F.col("end") - F.length("x.w")).alias("start"), "end"))


class Findings:
    """Written narrow tables of one corpus: ``rows`` (uid, doc_id, loc) and ``spans`` (uid, kind, start, end, action)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_support: int = 1, generalise_at: float = 0.8, remove_at: float = 0.9,
                 least_gain: float = math.log(5)):
        scratch = Scratch(docs.sparkSession, "sanitise")
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        found = scratch.stage(docs.select(
            F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
            F.xxhash64(text).alias("loc"),
            F.concat(*[_matches(text, k) for k in KINDS]).alias("found")), "found")
        self.rows = scratch.stage(found.select("uid", "doc_id", "loc"), "rows")
        upto = Window.partitionBy("uid", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
        base = (found.select("uid", F.col("loc").alias("content"), F.inline("found"))
                .withColumn("end", F.sum(F.col("gap") + F.length("value")).over(upto))
                .withColumn("start", F.col("end") - F.length("value"))
                .filter(_valid(F.col("kind"), F.col("value")))
                .withColumn("entity", _entity(F.col("kind"), F.col("value"))).drop("gap", "value"))
        base = scratch.stage(base, "base")
        scratch.drop("found")
        every = docs.select(F.xxhash64(text).alias("content"), text.alias("text"))
        holding = F.exists(F.concat(*[_matches(F.col("text"), k) for k in KINDS]), lambda x: _valid(x["kind"], x["value"]))
        texts = scratch.stage(every.filter(holding).dropDuplicates(["content"]), "texts")
        # entities that stand in the same texts are disclosed alike: one row a set of texts
        held = base.select("entity", "content").distinct()
        groups = held.groupBy("entity").agg(
            F.count("*").alias("docs_e"), F.xxhash64(F.count("*"), F.bit_xor("content"), F.bit_xor(F.xxhash64("content"))).alias("g"))
        holds = scratch.stage(held.join(groups, "entity").select("g", "docs_e", "content").distinct(), "holds")
        both = holds.join(texts.select("content", F.explode(_distinct_terms(F.col("text"))).alias("term")), "content")
        disclosing = self._weigh(every, self.rows, both, min_support, generalise_at, least_gain, scratch)
        hits = (both.join(disclosing, ["g", "term"])
                .groupBy("content", "term").agg(F.max("disclosure").alias("disclosure")))
        hits = scratch.stage(hits, "hits")
        for done in ("holds", "pairs", "copies", "disclosing"):
            scratch.drop(done)
        extra = (_places(texts.join(hits.select("content").distinct(), "content", "left_semi"))
                 .join(hits, ["content", "term"])
                 .select("content", "start", "end", F.when(F.col("disclosure") >= remove_at, "remove")
                         .otherwise("generalise").alias("action")))
        spans = base.select(F.col("content").alias("c"), F.col("start").alias("s"), F.col("end").alias("e")).distinct()
        inside = (F.col("content") == F.col("c")) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end"))
        extra = (extra.join(spans, inside, "left_anti").groupBy("content")
                 .agg(F.collect_list(F.struct(F.lit("term").alias("kind"), "start", "end", "action")).alias("x")))
        extra = self.rows.join(extra, F.col("loc") == F.col("content")).select("uid", F.inline("x"))
        self.spans = scratch.stage(
            base.select("uid", "kind", "start", "end", F.lit("generalise").alias("action")).unionByName(extra), "spans")
        for done in ("base", "texts", "hits"):
            scratch.drop(done)

    @staticmethod
    def _weigh(every, rows, both, min_support, generalise_at, least_gain, scratch) -> DataFrame:
        """(g, term, disclosure) of the terms that disclose an entity of the group g."""
        pair = (both.groupBy("g", "docs_e", "term").agg(F.count("*").alias("both"))
                .filter(F.col("both") >= min_support).withColumn("h", F.xxhash64("term")))
        pair = scratch.stage(pair, "pairs")
        hashes = F.transform(_distinct_terms(F.col("text")), lambda w: F.xxhash64(w))
        terms = every.select(F.explode(hashes).alias("h"))
        n = rows.select(F.count_distinct("loc").alias("n")).scalar().cast("double")
        # rows with a term, less the further copies of the texts that hold it
        copies = rows.groupBy(F.col("loc").alias("content")).agg((F.count("*") - 1).alias("more")).filter("more > 0")
        copies = scratch.stage(copies, "copies")
        again = (every.join(copies.select("content"), "content", "left_semi").dropDuplicates(["content"])
                 .select("content", F.explode(hashes).alias("h")).join(copies, "content")
                 .groupBy("h").agg(F.sum("more").alias("more")))
        spread = terms.groupBy("h").agg(F.count("*").alias("rows_t"))
        likely = (F.col("both") + 1 / 6) / (F.col("rows_t") - F.coalesce("more", F.lit(0)) + 1 / 3)
        scored = pair.join(spread, "h").join(again, "h", "left").withColumn("n", n).withColumn("disclosure", likely)
        gain = F.log(F.col("disclosure") * F.col("n") / F.col("docs_e"))
        return scratch.stage(scored.filter((F.col("disclosure") >= generalise_at) & (gain >= least_gain))
                             .select("g", "term", "disclosure"), "disclosing")


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, n_term, spans.

    Spans are code points, end exclusive, as ``kind:start:end``; kinds in the
    order email, ip, card, phone, term.  Null text counts as empty and has no
    span; repeated rows and null ids are searched like any other row (copies
    count once as evidence).  An empty table gives no rows; other columns are
    not read.
    """
    found = Findings(docs, id_col, text_col, **limits)
    order = F.array_position(F.array(*[F.lit(k) for k in _ORDER]), F.col("kind"))
    text = F.concat_ws(":", "kind", "start", "end")
    listed = (found.spans.groupBy("uid")
              .agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "start", "end", text.alias("t")))).alias("s"),
                   *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in _ORDER]))

    def joined(s: Column) -> Column:
        return F.array_join(F.transform(s, lambda x: x["t"]), ",")

    base = F.filter(F.col("s"), lambda x: x["o"] < len(_ORDER))
    return (found.rows.join(listed, "uid", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in _ORDER],
        F.sha2(F.coalesce(joined(base), F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(joined(F.col("s")), F.lit("")).alias("spans")))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]`` (a term to remove: by nothing); other columns unchanged.

    Overlapping spans are replaced once, by the kind of the first.  Every row
    comes back once, repeated rows and null ids included; null text stays
    null, and columns may have any names.
    """
    found = Findings(docs, id_col, text_col, **limits)
    before = Window.partitionBy("uid").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy("uid").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.col("start") >= F.coalesce(F.max("end").over(before), F.lit(0))
    put = F.when(F.col("action") == "remove", "").otherwise(F.concat(F.lit("["), F.upper("kind"), F.lit("]")))
    joint = (found.spans.withColumn("fresh", fresh.cast("int")).withColumn("g", F.sum("fresh").over(order))
             .groupBy("uid", "g").agg(F.min("start").alias("from"), F.max("end").alias("to"),
                                      F.min_by(put, F.struct("start", -F.col("end"))).alias("put"))
             .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("from", "to", "put"))).alias("_cuts")))
    cut, id_, loc = free_names(docs, "_cuts", "_id", "_loc")
    cuts = (found.rows.join(joint, "uid")      # rows of one id and text have the same cuts
            .select(F.col("doc_id").alias(id_), F.col("loc").alias(loc), F.col("_cuts").alias(cut)).dropDuplicates([id_, loc]))
    text, s = F.col(text_col), F.col(cut)
    pieces = F.transform(s, lambda x, k: F.concat(F.substring(
        text, F.coalesce(F.get(s, k - 1)["to"], F.lit(0)).cast("int") + 1,
        (x["from"] - F.coalesce(F.get(s, k - 1)["to"], F.lit(0))).cast("int")), x["put"]))
    tail = F.substring(text, F.get(s, F.size(s) - 1)["to"].cast("int") + 1, F.length(text))
    clean = F.when(s.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), tail))
    same = docs[id_col].eqNullSafe(cuts[id_]) & (F.xxhash64(F.coalesce(text, F.lit(""))) == cuts[loc])
    return docs.join(cuts, same, "left").withColumn(text_col, clean).select(*docs.columns)
