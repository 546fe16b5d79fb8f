"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import (
    alignment, chat, collocations, fertility, group_join, license_scan, line_runs, packing, projected_nn, simhash, toxicity, viterbi, warc,
)

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.tiktoken"
BYTE_LEVEL = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_files(docs: DataFrame) -> DataFrame:
    """The documents as files of a tree: one repository a source, shelves of 500 and boxes of 50 ids. The first document
    of a box is its licence file; all others are text files."""
    n = F.col("doc_id")
    name = F.when(n % 50 == 0, F.concat(F.lit("LICENSE-"), n)).otherwise(F.concat(F.lit("doc-"), n, F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(n / 500), F.floor(n / 50), name)
    return docs.select("doc_id", path.alias("path"), "text")


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(table(spark, sf_dir, "documents"))
    found = license_scan.scan(files)
    doc = F.regexp_extract("path", r"-(\d+)[^/]*$", 1).cast("long")
    return found.select(doc.alias("doc_id"), "path", "license", F.round("cosine", 6).alias("cosine"), "source", "from_dir")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_runs.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)


def projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return projected_nn.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), projected_nn.ProjectionConfig(k=10))


def fertility_config() -> fertility.FertilityConfig:
    return fertility.FertilityConfig(model=public_tokenizers.path(PIECES))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fertility.rate(table(spark, sf_dir, "documents"), fertility_config(), keep_text=False)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "chars_per_token", "byte_share", "token_entropy", "script", F.array_join("failed", ",").alias("failed"),
    )


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    vocabulary = public_tokenizers.path(BYTES)
    return chat.read_back(chat.format_turns(turns.unionByName(more), vocabulary), vocabulary)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), size=4096)


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = viterbi.encode_documents(docs, public_tokenizers.path(PIECES))
    return out.select(
        "doc_id", F.col("pieces.ids").alias("ids"), F.size("pieces.ids").cast("long").alias("n_ids"),
        (F.col("pieces.decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score_documents(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity.score").alias("score"), F.col("toxicity.spans").alias("spans")
    )
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = alignment.align_documents(docs, public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), collocations.PhraseConfig(longest=3, least=10, within=50, top=2000))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.similar_documents(table(spark, sf_dir, "documents"), group_join.JaccardConfig(words=3, percent=90)).drop("class_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scans": license_scans,
    "op2_line_dedup": line_dedup,
    "op3_simhash": simhash_near_dedup,
    "op4_projected_neighbours": projected_neighbours,
    "op5_quality_rules": quality_rules,
    "op6_chat_formatting": chat_formatting,
    "op7_best_fit_packing": best_fit_packing,
    "op8_sentencepiece": sentencepiece,
    "op9_toxicity": toxicity_scores,
    "op10_warc": warc_archives,
    "op11_cross_tokenizer_alignment": cross_tokenizer_alignment,
    "op12_phrase_collocations": phrase_collocations,
    "op13_ngram_jaccard_join": ngram_jaccard_join,
}

_KEY = r"translate(trim(line, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: 160 bits as 32 letters: five hex digits are four letters.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(h, {5 * group + 1}, 5))::INT >> {shift} & 31) + 1, 1)"
    for group in range(8)
    for shift in (15, 10, 5, 0)
)

ORACLES: dict[str, str] = {
    "op2_line_dedup": f"""
        WITH dealt AS (
          SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
        keyed AS (SELECT *, {_KEY} AS key FROM dealt),
        common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
          sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN common c ON keyed.key = c.key GROUP BY doc_id""",
    "op10_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS b, sha1(coalesce(html, '')) AS h FROM pages),
        k AS (SELECT h, max(page_id) AS keep FROM p GROUP BY h)
        SELECT page_id, CAST(strlen(b) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
          CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
        FROM p JOIN k USING (h)""",
    "op12_phrase_collocations": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
          FROM documents),
        ws AS (SELECT lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
        grams AS (
          SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS g
          FROM ws, (VALUES (1), (2), (3)) s(k)),
        f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
        cuts AS (
          SELECT lang, k, g, a, p AS cut, array_to_string(w[1 : p], ' ') AS le, array_to_string(w[p + 1 : k], ' ') AS ri
          FROM c, (VALUES (1), (2)) s(p) WHERE p < k),
        scored AS (
          SELECT c.lang, c.k, c.g, c.a, c.cut, x.f AS l, y.f AS r,
            (1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f))::BIGINT AS score
          FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = c.le AND x.k = c.cut JOIN f y ON y.lang = c.lang AND y.g = c.ri AND y.k = c.k - c.cut),
        least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
        held AS (
          SELECT lang, array_to_string(w[i : i + 1], ' ') AS g, max(a) AS longer FROM c, (VALUES (1), (2)) s(i) WHERE k = 3 GROUP BY ALL),
        kept AS (SELECT least.* FROM least LEFT JOIN held USING (lang, g) WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
        FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
    "op13_ngram_jaccard_join": r"""
        WITH RECURSIVE ws AS (
          SELECT doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
          FROM documents),
        sets AS (
          SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))) END AS s FROM ws),
        grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        held AS (SELECT g, count(*) AS df FROM grams GROUP BY g),
        rare AS (SELECT grams.*, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS pos FROM grams JOIN held USING (g)),
        near AS (
          SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM rare x JOIN rare y ON x.g = y.g AND x.doc_id < y.doc_id
          WHERE x.pos <= x.n - (90 * x.n + 99) // 100 + 1 AND y.pos <= y.n - (90 * y.n + 99) // 100 + 1
            AND 100 * x.n >= 90 * y.n AND 100 * y.n >= 90 * x.n),
        links AS (
          SELECT a, b FROM near JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
          WHERE 190 * len(list_intersect(p.s, q.s)) >= 90 * (len(p.s) + len(q.s))),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, edges.b FROM reach r JOIN edges ON r.b = edges.a)
        SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, component_id
        FROM sets JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = doc_id""",
}
