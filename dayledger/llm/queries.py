"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import decontaminate, exact_dedup, fim, html_extract, mixing, packing, pii, quality, runs, sharding, simhash, toxicity, url_filter
from dayledger.llm.common import stored, table
from dayledger.llm.tokens import Vocabulary

#: Key of the registered query; users bring their own.
PII_KEY = b"surrogates"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed 5 : 2 : 1 by source to 150 % of their words, no document more than twice."""
    return mixing.taken(table(spark, sf_dir, "documents")).drop("source")


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, equal texts together where they fit."""
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents; the largest doc_id stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op2_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""

ORACLES["op1_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM d GROUP BY source),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS cap FROM s),
f AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - COALESCE(sum(cap) OVER before, 0))
                / (sum(w) OVER () - COALESCE(sum(w) OVER before, 0)) AS level, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS pos
      FROM w WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT pos AS open_at, level AS open_level FROM f WHERE level * w < cap ORDER BY pos LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN open_at IS NULL OR pos < open_at THEN cap ELSE least(cap, open_level * w) END AS target
      FROM f LEFT JOIN o ON true),
e AS (SELECT source, doc_id, size, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL),
k AS (SELECT e.*, t.source_size, t.target, size * n AS load,
             CAST('0x' || left(md5('17|' || COALESCE(CAST(doc_id AS VARCHAR), '') || '|' || CAST(size AS VARCHAR)), 13) AS BIGINT) AS key
      FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, sum(load) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS stop FROM k),
x AS (SELECT source, doc_id, size, (greatest(0, least(load, floor(target) - stop + load))
             + greatest(0, least(load, floor(target) - stop - source_size + load))) // n AS taken FROM q)
SELECT d.doc_id, d.size, t.source_size, t.target, CAST(COALESCE(x.taken, 0) AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source AND d.doc_id IS NOT DISTINCT FROM x.doc_id AND d.size = x.size"""


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the groups linked at 4 or fewer differing bits."""
    found = simhash.grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and benchmark items that the documents hold, exact or edited."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), "first_word", "last_word")


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rule, else by trust and distrust that links carry between hosts."""
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op9_url_filter"] = url_filter.sql()


@query
def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two thirds of the labels."""
    found = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from three quarters of the labels."""
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and the kinds of what was found."""
    found = pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)
    return found.select("doc_id", F.size("spans").cast("long").alias("n_entities"),
                        F.array_join(F.array_sort(F.array_distinct(F.col("spans.kind"))), ",").alias("kinds"), "text")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; where crc32 of the id ends in 0, words from one place on repeat those from there
    with a period, both drawn from the crc32. Other texts stay as they are."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    drawn = docs.where(h % 10 == 0).select("doc_id", words.alias("w"), F.floor(h / 10).alias("g"))
    n = F.coalesce(F.size("w"), F.lit(0))
    drawn = drawn.where(n > 0).withColumn("a", F.col("g") % n).withColumn(
        "p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    planted = drawn.withColumn("at", at).select("doc_id", F.array_join(F.transform("at", lambda i: F.get("w", i.cast("int"))), " ").alias("text"))
    empty = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return docs.where((h % 10 != 0) | empty).select("doc_id", "text").unionByName(planted)


@query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and the text with each cut to its first period."""
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = runs.strongest(F.col("runs"))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                         F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "best.*", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                        "runs_sha256", "collapsed_sha256")


def byte_bpe() -> Vocabulary:
    """The public byte-level vocabulary of 50,257 ids that is installed with the Python of the executors."""
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256},
                      r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+")


@query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as tokens in sequences of at most 1024."""
    rows = packing.pieces(table(spark, sf_dir, "documents"), byte_bpe(), end=2, capacity=1024)
    rows = rows.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(rows, 1024)


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in the order it has for learning to fill in the middle, as digests."""
    made = fim.transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(fim.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


ORACLES["op13_fill_in_middle"] = """
WITH d AS (
  SELECT doc_id, COALESCE(text, '') AS t, length(COALESCE(text, '')) AS n, sha256('1:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
r AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b FROM r),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
