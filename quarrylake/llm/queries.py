"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylake.llm import chat, decontam, divergence, langid, linededup, manifest, mixing, mixture, neardup, substring, toxicity
from quarrylake.llm.common import fold, table
from quarrylake.llm.maxscore import integer_vectors, top_k
from quarrylake.llm.oracle import DIVERGENCE, MANIFEST, MIXTURE
from quarrylake.llm.packing import pack

TOKENIZER = "word_bpe_49k.json"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of at most 4096 tokens, one row per piece."""
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_file(TOKENIZER))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "window_size", "step_id",
    )


def op2_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector with all others."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors, 20)


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted windows."""
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.windows(rows.unionByName(more), tokenizer_file(TOKENIZER)))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of the documents that is similar to an earlier one (no start), and every run of words that an earlier place has."""
    docs = table(spark, sf_dir, "documents")
    return substring.repeated(docs).unionByName(substring.spans(docs), allowMissingColumns=True).drop("version")


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents, learned from the folds other than 1 of 5."""
    return mixing.score(table(spark, sf_dir, "documents"), fold("doc_id", 5) == 1)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of the folds other than 0 of 5."""
    docs = table(spark, sf_dir, "documents")
    learned = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    found = toxicity.score(docs, toxicity.fit(docs, learned))
    return found.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least id of its class of near-duplicates."""
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copies")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the folds other than 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    found = langid.predict(docs, langid.fit(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents that an earlier one matches; exact: in the same words."""
    return linededup.later_matches(table(spark, sf_dir, "documents")).select("doc_id", "line_no", "exact")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, folded from a copy in which half of the documents lost their line feeds."""
    stripped = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    proved = manifest.manifest(table(spark, sf_dir, "documents"), seen={"text": F.coalesce(stripped, "text")})
    return proved.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified"
    )


def op12_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix of the documents takes of each, copies counted."""
    mixed = mixture.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source of a language lies from the others, and its ten most telling terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_maxscore_topk, op3_chat_windows, op4_substring_dedup, op5_context_mixing, op6_toxicity, op7_minhash_near_dedup, op8_language_id, op9_line_dedup, op10_decontamination, op11_merkle_manifest, op12_source_mixture, op13_source_divergence)
}
ORACLE_SQL: dict[str, str] = {
    "op2_maxscore_topk": """
WITH v AS (
    SELECT DISTINCT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS c
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
        CAST(list_dot_product(CAST(q.c AS DOUBLE[]), CAST(d.c AS DOUBLE[])) AS BIGINT) AS score
    FROM v q, v d WHERE q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
""",
    "op9_line_dedup": """
WITH texts AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
        unnest(range(len(string_split(text, chr(10))))) AS line_no FROM texts),
sets AS (
    SELECT doc_id, text, CAST(line_no AS INTEGER) AS line_no, list_sort(list_distinct(list_filter(string_split(
        translate(lower(line), chr(9) || chr(13) || chr(12) || chr(11), '    '), ' '), lambda w: w <> ''))) AS words
    FROM split),
lines AS (SELECT *, hash(words) AS id FROM sets WHERE len(words) >= 3),
firsts AS (
    SELECT id, any_value(words) AS words, min({'doc_id': doc_id, 'line_no': line_no}) AS first FROM lines GROUP BY id),
counts AS (SELECT w, count(*) AS n FROM (SELECT unnest(words) AS w FROM firsts) GROUP BY w),
ranked AS (
    SELECT f.id, len(f.words) AS size, u.w,
        row_number() OVER (PARTITION BY f.id ORDER BY c.n, u.w) AS pos
    FROM firsts f, LATERAL (SELECT unnest(f.words) AS w) u JOIN counts c ON c.w = u.w),
prefix AS (SELECT * FROM ranked WHERE pos <= size - (size * 80 + 99) // 100 + 1),
pairs AS (
    SELECT DISTINCT a.id AS a, b.id AS b FROM prefix a JOIN prefix b ON a.w = b.w AND a.id <> b.id
    WHERE least(a.size, b.size) * 100 >= greatest(a.size, b.size) * 80),
near AS (
    SELECT DISTINCT b
    FROM pairs JOIN firsts x ON x.id = a JOIN firsts y ON y.id = b
    WHERE x.first < y.first AND len(list_intersect(x.words, y.words)) * 100
        >= (len(x.words) + len(y.words) - len(list_intersect(x.words, y.words))) * 80)
SELECT l.doc_id, l.line_no, {'doc_id': l.doc_id, 'line_no': l.line_no} > f.first AS exact
FROM lines l JOIN firsts f ON f.id = l.id LEFT JOIN near n ON n.b = l.id
WHERE n.b IS NOT NULL OR {'doc_id': l.doc_id, 'line_no': l.line_no} > f.first
""",
    "op11_merkle_manifest": MANIFEST,
    "op12_source_mixture": MIXTURE,
    "op13_source_divergence": DIVERGENCE,
}
