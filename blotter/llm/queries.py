"""Registered queries ``opN_<name>`` on the driver tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import Scratch, table
from blotter.llm.exact_dedup import exact_dedup
from blotter.llm.labels import fold
from blotter.llm.line_crf import fit as fit_lines
from blotter.llm.line_crf import score_quality
from blotter.llm.line_frequency import line_rules
from blotter.llm.merkle_manifest import build_manifest, check_leaves
from blotter.llm.ngram_join import ngram_components
from blotter.llm.packing import pack
from blotter.llm.periodic_runs import find_runs
from blotter.llm.repeated_phrases import remove_repeats
from blotter.llm.sanitise import find_private
from blotter.llm.sentencepiece_codec import decode, encode
from blotter.llm.toxic_neighbours import fit as fit_examples
from blotter.llm.toxic_neighbours import score_toxicity
from blotter.llm.vector_graph import build_index, search
from blotter.llm.warc_bundles import read_bundles, write_bundles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Unsigned crc32 of the decimal doc_id, bit by bit (DuckDB has no such function).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                               lambda x, z: xor(x >> 1, 3988292384 * (x & 1)) + z)), 4294967295::BIGINT)"""


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_exact_dedup", r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op4_ngram_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2),
                            lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * i >= 85 * (nx.n + ny.n - i)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.x, r.c FROM r JOIN e ON e.y = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
""")
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), n=4, percent=85)


@query("op6_harmonic_packing")
def op6_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_repeated_phrases", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 34], ' ')) AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM w)),
again AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM win SEMI JOIN again USING (g)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
         FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w)
         ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""")
def op8_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), window=35, with_text=False).drop("kept_text")


@query("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its token count, a digest of its ids, and what decoding the ids gives."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    both = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return both.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query("op3_line_frequency", r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times
        FROM (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
              FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d))),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM win WHERE times > 1) GROUP BY doc_id),
raw AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup_lines
        FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
        WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
ln AS (SELECT doc_id, host, x FROM (SELECT doc_id, host, trim(unnest(string_split(
         lower(regexp_replace(t, '[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10))), ' ') AS x FROM d) WHERE x <> ''),
body AS (SELECT doc_id, md5(string_agg(x, chr(10) ORDER BY k)) AS content
         FROM (SELECT doc_id, unnest(string_split(lower(regexp_replace(t, '[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10))) AS y,
                      trim(y, ' ') AS x, generate_subscripts(string_split(t, chr(10)), 1) AS k FROM d)
         WHERE x <> '' GROUP BY doc_id),
often AS (SELECT host, x FROM ln JOIN body USING (doc_id) GROUP BY host, x HAVING count(DISTINCT content) > 100),
gone AS (SELECT doc_id, sum(len(string_split(x, ' '))) AS n FROM ln SEMI JOIN often USING (host, x) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_removed_words
      FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN raw USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept
FROM m
""")
def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(table(spark, sf_dir, "documents"), max_docs=100, min_kept_percent=30).drop("removed_lines")


@query("op7_sanitise")
def op7_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_private(table(spark, sf_dir, "documents"))


@query("op2_warc_bundles", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(x, 5 * (k // 4) + 1, 5))::INTEGER >> (15 - 5 * (k % 4))) & 31)::INTEGER + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM g
""")
def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark, 'bundles').path}/archive"
    write_bundles(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    return read_bundles(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_line_crf")
def op9_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    crf = fit_lines(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return score_quality(docs, crf).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query("op5_toxic_neighbours")
def op5_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_examples(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return score_toxicity(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "evidence")


def _leaf_sql(n_chars: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


@query("op11_merkle_manifest", f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {_leaf_sql('n_chars')} AS h,
    CASE WHEN {_CRC} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} ELSE {_leaf_sql('n_chars')} END AS shown FROM documents),
leaf AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
lv(lang, level, pos, h, n) AS (SELECT lang, 0, pos, h, n FROM leaf
  UNION ALL SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
            FROM lv WHERE n > 1 GROUP BY lang, level, pos // 2, n),
sub AS (SELECT lang, level AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
               count(*) OVER () AS m FROM lv WHERE n = 1),
tv(level, pos, h, m) AS (SELECT 0, tree, subroot, m FROM sub
  UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (m + 1) // 2
            FROM tv WHERE m > 1 GROUP BY level, pos // 2, m),
step AS (SELECT leaf.doc_id, up.level, leaf.pos >> up.level AS p, near.h AS s
         FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang
         JOIN (SELECT DISTINCT level FROM lv) up ON up.level < sub.height
         LEFT JOIN lv near ON near.lang IS NOT DISTINCT FROM leaf.lang AND near.level = up.level
                          AND near.pos = xor(leaf.pos >> up.level, 1)
         UNION ALL
         SELECT leaf.doc_id, sub.height + up.level, sub.tree >> up.level, near.h
         FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang
         JOIN (SELECT DISTINCT level FROM tv WHERE m > 1) up ON true
         LEFT JOIN tv near ON near.level = up.level AND near.pos = xor(sub.tree >> up.level, 1)),
fold(doc_id, level, x) AS (SELECT doc_id, 0, shown FROM leaf
  UNION ALL SELECT doc_id, level + 1, sha256(CASE WHEN p % 2 = 1 THEN s || x ELSE x || coalesce(s, '') END)
            FROM fold JOIN step USING (doc_id, level)),
proof AS (SELECT doc_id, sha256(coalesce(string_agg(s, '' ORDER BY level), '')) AS proof_sha256 FROM step GROUP BY doc_id),
got AS (SELECT doc_id, arg_max(x, level) AS folded_root FROM fold GROUP BY doc_id)
SELECT leaf.doc_id, leaf.h AS leaf, sub.subroot, tv.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       folded_root, folded_root = tv.h AS verified
FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang JOIN tv ON tv.m = 1
LEFT JOIN proof USING (doc_id) JOIN got USING (doc_id)
""")
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.when(fold("doc_id", 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    manifest = build_manifest(table(spark, sf_dir, "documents"), presented={"n_chars": more})
    return check_leaves(manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every document whose crc32 ends in 0 the words from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    planted = docs.filter(h % 10 == 0).select("doc_id", "text", words.alias("w"), F.floor(h / 10).alias("g"))
    planted = planted.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    planted = planted.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    same = F.slice("w", F.lit(1), F.col("a").cast("int"))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - F.col("a") - 1),
                        lambda k: F.get("w", (F.col("a") + k % F.col("p")).cast("int")))
    text = F.when(F.col("n") > 0, F.array_join(F.concat(same, again), " ")).otherwise(F.lit(""))
    return planted.select("doc_id", text.alias("text")).union(
        docs.filter((h % 10 != 0) | h.isNull()).select("doc_id", "text"))


@query("op13_periodic_runs", f"""
WITH t AS (SELECT doc_id, {_CRC} AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS o FROM documents),
g AS (SELECT *, len(o) AS n, h // 10 AS g FROM t),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM g),
d AS (SELECT doc_id, n, CASE WHEN a = n THEN o ELSE o[1:a] || list_transform(range(0, n - a),
        lambda k: o[a + k % (1 + (n - a) // (3 + g % 8)) + 1]) END AS ws FROM a),
w AS (SELECT doc_id, n, unnest(ws) AS word, unnest(range(0, n)) AS i FROM d),
-- a run of four periods or more, so equal words at its distance stand three periods in a row
e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM w x JOIN w y ON y.doc_id = x.doc_id AND y.word = x.word
      AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e)
      GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT s.* FROM s ANTI JOIN s AS u ON u.doc_id = s.doc_id AND u.start <= s.start AND u.q < s.q AND s.q % u.q = 0
                                         AND u.start + u.length >= s.start + s.length),
best AS (SELECT doc_id, count(*) AS n_runs, arg_min((start, length, q), (-length, start, q)) AS b,
                string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM r),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS c FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b[1] AS start, b[2] AS length, b[3] AS period,
       1000 * b[2] // b[3] AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(c, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(_with_planted_runs(table(spark, sf_dir, "documents")))
    first = F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], y["length"] - x["length"])
                         .when(x["start"] != y["start"], x["start"] - y["start"])
                         .otherwise(x["period"] - y["period"]).cast("int"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return (found.withColumn("best", F.get(first, 0))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


@query("op12_vector_graph")
def op12_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(build_index(vectors, neighbours=5), vectors.filter("vec_id % 50 = 0"), k=5)
