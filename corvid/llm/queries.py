"""The registered training-data queries and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import table
from corvid.llm.decontaminate import contamination
from corvid.llm.exact_dedup import exact_duplicates
from corvid.llm.html_render import render_pages
from corvid.llm.lexical_search import ranked_search
from corvid.llm.line_dedup import removed_lines
from corvid.llm.minhash_dedup import near_duplicates
from corvid.llm.overlap_join import linked_documents
from corvid.llm.packing import pack_documents
from corvid.llm.pitman_yor import language_model_scores
from corvid.llm.quality_knn import quality_scores
from corvid.llm.secrets_scan import scan_secrets
from corvid.llm.toxicity import severity_scores
from corvid.llm.whitening import whitened_components

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine (installed beside Python, not part of the repository)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def _linked_sql(percent: int) -> str:
    """DuckDB: components of documents by the plain definition (every pair with a common shingle is counted)."""
    return rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS row_id, doc_id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT row_id, doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN CAST([] AS VARCHAR[])
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
shingles AS (SELECT row_id, len(s) AS n, unnest(s) AS t FROM sets),
common AS (SELECT a.row_id AS x, b.row_id AS y, a.n + b.n AS total, count(*) AS c
           FROM shingles a JOIN shingles b ON a.t = b.t AND a.row_id < b.row_id GROUP BY ALL),
links AS (SELECT x, y FROM common WHERE 100 * c >= {percent} * (total - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT row_id AS n, row_id AS m FROM sets
          UNION SELECT reach.n, both_ways.y FROM reach JOIN both_ways ON reach.m = both_ways.x),
named AS (SELECT reach.n, min(doc_id) AS component_id FROM reach JOIN sets ON sets.row_id = reach.m GROUP BY reach.n)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN named ON named.n = sets.row_id
"""


def _lines_sql(percent: int) -> str:
    """DuckDB: repeated lines by the plain definition (every pair of lines with a common shingle is counted)."""
    spaces = r"[ \t\x0B\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
    unspaced = (r"[\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}"
                r"\x{20000}-\x{323AF}]")
    return rf"""
WITH cut AS (SELECT coalesce(doc_id, 9223372036854775807) AS d, string_split(text, chr(10)) AS l FROM documents),
raw AS (SELECT d, unnest(range(len(l))) AS line_no, unnest(l) AS l FROM cut WHERE l IS NOT NULL),
lines AS (SELECT DISTINCT d, line_no, trim(regexp_replace(l, '{spaces}', ' ', 'g'), ' ') AS line FROM raw),
placed AS (SELECT *, rank() OVER (PARTITION BY line ORDER BY d, line_no) AS k FROM lines WHERE line <> ''),
words AS (SELECT d, line_no, line, CASE WHEN NOT contains(line, ' ') AND regexp_matches(line, '{unspaced}')
                 THEN string_split(line, '') ELSE string_split(line, ' ') END AS w FROM placed WHERE k = 1),
sets AS (SELECT d, line_no, list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
         FROM words WHERE len(w) > 5 OR (len(w) = 5 AND NOT contains(line, ' '))),
shingles AS (SELECT d, line_no, len(s) AS n, unnest(s) AS t FROM sets),
similar_lines AS (
  SELECT DISTINCT d, line_no FROM (
    SELECT x.d, x.line_no, count(*) AS c, x.n + y.n AS total
    FROM shingles x JOIN shingles y ON x.t = y.t AND (y.d < x.d OR (y.d = x.d AND y.line_no < x.line_no))
    GROUP BY x.d, x.line_no, y.d, y.line_no, x.n, y.n) WHERE 100 * c >= {percent} * (total - c)),
gone AS (SELECT d, line_no, 0 AS alike FROM placed WHERE k > 1
         UNION ALL SELECT d, line_no, 1 AS alike FROM similar_lines),
listed AS (SELECT d, count(*) AS n, CAST(sum(alike) AS BIGINT) AS n_alike,
                  string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS places FROM gone GROUP BY d)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, coalesce(n, 0) AS n_removed,
       coalesce(n_alike, 0) AS n_similar, coalesce(places, '') AS removed_lines
FROM documents LEFT JOIN listed ON listed.d = coalesce(doc_id, 9223372036854775807)
"""


@query("op3_exact_dedup", r"""
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY len DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY len DESC, doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS len,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
      FROM documents)
""")
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents, white space aside."""
    return (exact_duplicates(table(spark, sf_dir, "documents"))
            .withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest"))


@query("op10_minhash_dedup", f"""SELECT *, doc_id = component_id AS kept FROM ({_linked_sql(75)})""")
def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (5-word shingles, similarity of at least 0.75)."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word benchmark windows in all documents."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near_items")


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_line_dedup", _lines_sql(75))
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the lines that repeat an earlier line of the corpus."""
    docs = table(spark, sf_dir, "documents")
    gone = (removed_lines(docs).groupBy("doc_id")
            .agg(F.count(F.lit(1)).alias("_removed"), F.count(F.when(F.col("reason") == "similar", 1)).alias("_similar"),
                 F.array_join(F.array_sort(F.collect_list("line_no")).cast("array<string>"), ",").alias("_lines")))
    sizes = docs.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    return sizes.join(gone.withColumnRenamed("doc_id", "_doc"), F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select(
        "doc_id", "n_lines", F.coalesce("_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("_similar", F.lit(0)).cast("long").alias("n_similar"),
        F.coalesce("_lines", F.lit("")).alias("removed_lines"))


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    import public_tokenizers
    found = scan_secrets(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans",
                        "n_random")


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected toxicity grade of all documents."""
    return severity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_html_extraction")
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of all pages."""
    return render_pages(table(spark, sf_dir, "pages")).select("page_id", F.length("text").cast("long").alias("n_chars"),
                                                              "text")


@query("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of all documents."""
    return language_model_scores(table(spark, sf_dir, "documents"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened principal components of all embeddings."""
    return whitened_components(table(spark, sf_dir, "embeddings"))


@query("op12_ngram_join", _linked_sql(80))
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under a shingle similarity of at least 0.8."""
    return linked_documents(table(spark, sf_dir, "documents"))


@query("op13_ranked_search", r"""
WITH lower_docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT row_id, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
          FROM lower_docs WHERE t IS NOT NULL),
lens AS (SELECT row_id, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY row_id),
total AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM lens),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
tf AS (SELECT row_id, term, count(*) AS tf FROM words
       WHERE term IN (SELECT term FROM item_terms) GROUP BY row_id, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
           FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
part AS (SELECT row_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))) AS s
         FROM tf JOIN lens USING (row_id) JOIN weight USING (term), total),
scored AS (SELECT item_id, row_id, CAST(sum(s) AS BIGINT) AS score
           FROM item_terms JOIN part USING (term) GROUP BY item_id, row_id),
ranked AS (SELECT item_id, doc_id, score,
                  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
           FROM scored JOIN lens USING (row_id) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""")
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
