"""The registered queries of this subpackage: thin calls of the operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm import embeddedup, filteraudit, language, lexical, linededup, packing, permutation, pieces, pii, prefixhash, simhash, toxicity, urlfilter
from lodgeflow.llm.common import fold, read_table

#: A public SentencePiece model; the driver reads it and the workers get its bytes.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language.train(docs.filter(fold(F.col("doc_id"), 4) != 2))
    return (docs.select("doc_id", held_out.alias("held_out"), language.label(docs, model).alias("r"))
            .select("doc_id", "held_out", "r.lang_pred", "r.score", "r.n_spans"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str, model: str = PIECE_MODEL) -> DataFrame:
    """Piece ids of every document, and whether decoding them gives the text back."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    with open(model, "rb") as f:
        coded = docs.select("doc_id", pieces.encode(docs, f.read()).alias("r"))
    return coded.select("doc_id", F.size("r.ids").alias("n_tokens"), "r.lossless", "r.ids")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return permutation.search(vectors, F.col("vec_id") % 100 == 0)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in training sequences."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms that disclose it."""
    found = pii.find(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"),
                        pii.digest(F.array_sort(F.concat("base", "terms"))).alias("spans"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that stand earlier in the table."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup(docs).select("doc_id", "removed_chunks", "removed_lines", "text")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(fold(F.col("doc_id"), 5) != 0))
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return (docs.select("doc_id", held_out.alias("held_out"), toxicity.score(docs, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and whether it is kept, of every vector."""
    return embeddedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    index = lexical.build(read_table(spark, sf_dir, "documents"))
    return lexical.search(index, read_table(spark, sf_dir, "benchmark")).select("item_id", "rank", F.col("doc").alias("doc_id"), "score")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and its likeness to this and to the next."""
    return prefixhash.fingerprints(read_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from every source, in all their orders."""
    return filteraudit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_url_filter": op3_url_filter,
    "op4_nearest": op4_nearest,
    "op5_simhash": op5_simhash,
    "op6_packing": op6_packing,
    "op7_pii": op7_pii,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_fingerprints": op12_fingerprints,
    "op13_filter_audit": op13_filter_audit,
}

_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
ORACLE_SQL: dict[str, str] = {
    "op11_lexical_search": f"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, total GROUP BY term),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scores AS (SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_filter_audit": r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM texts),
marked AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (SELECT part, (CASE WHEN len(w) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN first < doc_id THEN 16 ELSE 0 END) AS mask,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM worded LEFT JOIN marked USING (doc_id)),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS g, sum(toxic) AS x FROM masks GROUP BY part, mask),
letters(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31),
steps AS (SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS BIGINT) AS earlier
  FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
results AS (SELECT part, filter_order, step, bit,
    CAST(sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN mask & earlier > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN g ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN x ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM results""",
}
