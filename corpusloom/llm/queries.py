"""The registered queries of this package and, where SQL can express one, its SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    bit_pack, bm25_wand, bpe_trie, collocations, lang_crf, merkle, mixture_pack, pii, secrets, sentence_dedup, simhash, variants, vptree,
)
from corpusloom.session import new_folder

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", simhash.hex_digits(F.col("bits")).alias("fingerprint"), "component_id", "links")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = secrets.scan(docs)
    kinds = F.transform(F.split("base", ","), lambda s: F.substring_index(s, ":", 1))
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in ("assign", "access", "hex")
    ]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe_trie.encode_documents(docs, public_tokenizers.path(BYTE_BPE), digests=True)


def op4_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op5_mixture_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = mixture_pack.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source"
    )


def op6_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive of all pages against a replica in which, by a rule on page_id, records were damaged or lost."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    damaged = F.when(F.col("page_id") % 97 == 5, F.concat(F.col("html"), F.lit("?"))).otherwise(F.col("html"))
    record = merkle.warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record")
    copied = merkle.warc_record(F.col("page_id"), F.col("url"), damaged).alias("record")
    archive = pages.select(F.col("page_id").alias("record_id"), record)
    replica = pages.where("page_id % 101 != 7").select(F.col("page_id").alias("record_id"), copied)
    return merkle.audit(archive, replica)


def op7_bit_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    bit_pack.write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE), end_id=2)
    return bit_pack.read_token_files(spark, path, ids=False)


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_dedup.remove_repeats(docs).withColumnRenamed("_removed", "n_removed")


def op9_bm25_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    queries = docs.where("doc_id % 50 = 0").withColumnRenamed("doc_id", "query_id")
    return bm25_wand.search(docs, queries, k=10)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return lang_crf.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(_table(spark, sf_dir, "documents"), least_length=7, least=2, ratio=10)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"), longest=3, least=10, covered=50, top=2_000)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = [f"n_{kind}" for kind in pii.BASE]
    return pii.find(docs).select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_secret_scan,
        op3_bpe_trie,
        op4_vp_tree,
        op5_mixture_pack,
        op6_merkle_audit,
        op7_bit_packed_tokens,
        op8_sentence_spans,
        op9_bm25_wand,
        op10_language,
        op11_variants,
        op12_collocations,
        op13_pii,
    )
}
_RECORD = """'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || octet_length(encode({html})) || chr(13) || chr(10) || chr(13) || chr(10)
    || {html} || chr(13) || chr(10) || chr(13) || chr(10)"""

ORACLE: dict[str, str] = {
    "op6_merkle_audit": f"""
        WITH records AS (
            SELECT page_id, {_RECORD.format(html="coalesce(html, '')")} AS record,
                   CASE WHEN page_id % 101 != 7 THEN
                        {_RECORD.format(html="coalesce(CASE WHEN page_id % 97 = 5 THEN html || '?' ELSE html END, '')")} END AS copied
            FROM pages WHERE page_id IS NOT NULL),
        hashed AS (
            SELECT page_id, octet_length(encode(record)) AS length, sha256(record) AS digest, sha256(copied) AS replica_digest
            FROM records)
        SELECT page_id AS record_id, CAST(1 AS BIGINT) AS copy,
               row_number() OVER (ORDER BY page_id) - 1 AS leaf,
               CAST(coalesce(sum(length) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset,
               CAST(length AS BIGINT) AS length, digest, replica_digest,
               CASE WHEN replica_digest IS NULL THEN 'missing' WHEN digest != replica_digest THEN 'corrupt' ELSE 'ok' END AS status
        FROM hashed""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
        grams AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM placed, range(1, 4) AS lengths(k) WHERE i + k - 1 <= len(w)),
        f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
        candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
        cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, (1000000 * c.a * c.a) // (l.f * r.f) AS score
            FROM cuts c
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        longer AS (
            SELECT lang, array_to_string(part, ' ') AS phrase, max(a) AS a
            FROM (SELECT lang, a, unnest([w[1:2], w[2:3]]) AS part FROM candidates WHERE k = 3) GROUP BY ALL),
        kept AS (
            SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
            WHERE g.a IS NULL OR 100 * g.a < 50 * b.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
               CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, cut
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
