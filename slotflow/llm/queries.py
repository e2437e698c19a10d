"""The registered queries of the text operators, over whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from slotflow.llm import bpe, codes, conversations, decontaminate, dedup, language, mixing, pii, quality, sharding, simhash, tokens, warc
from slotflow.llm.common import prepare
from slotflow.session import new_table_path

PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"
TOKEN_LIMIT = 4096


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, folder, "documents"), public_tokenizers.path(PIECES))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, folder, "documents"), public_tokenizers.path(WORDS))


def held_out(folds: int, fold: int) -> Column:
    """Whether a document is kept from training; one without an id is neither held out nor learned from."""
    return F.coalesce(language.fold("doc_id", folds) == fold, F.lit(False)).alias("held_out")


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.learn(docs.where(language.fold("doc_id", 5) != 0))
    return language.detect(docs, model).select("doc_id", held_out(5, 0), "lang_pred", "score", "mixture")


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), words=3, distance=2)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality.quality_scores(docs, labels, language.fold("doc_id", 3) != 1)
    return scored.select("doc_id", held_out(3, 1), "score", "predicted")


def op6_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    placed = sharding.hilbert_shards(docs, ["lang", "source", "n_chars"], shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def span_list(spans: Column) -> Column:
    """kind:start:end, joined by comma."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest are of the plain spans; ``spans`` and ``n_added`` also tell those found in disguise."""
    found = pii.personal_data(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["plain"])
    number = lambda kind: F.size(F.filter("spans", lambda s: s["plain"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    added = F.size(F.filter("spans", lambda s: ~s["plain"])).cast("long").alias("n_added")
    digest = F.sha2(F.encode(span_list(base), "UTF-8"), 256).alias("base_sha256")
    return found.select("doc_id", *[number(k) for k in pii.KINDS], digest, span_list(F.col("spans")).alias("spans"), added)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"), words=5, threshold=0.8)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    path = new_table_path(spark)
    warc.write_archive(pages, path)
    kind = pages.schema["page_id"].dataType
    records = warc.rebuilt(spark, path)
    return records.select(
        F.col("key").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "content_length",
        F.octet_length("record").cast("long").alias("record_bytes"),
    )


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, folder, "documents"), digests=True)


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = codes.compressed(table(spark, folder, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    digest = F.lit(codes.book_digest(books)).alias("codebooks_sha256")
    return codes.with_label_errors(coded).select("vec_id", "code", "error", "label_error", digest)


def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"), weights=(3, 1, 2), share=1.5, most=2)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with the contract's faults; a dropped turn stays as a row that is not ``present``."""
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    lot = F.crc32(F.encode(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")), "UTF-8")) % 20
    rows = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), lot.alias("lot"))
    text = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("lot") != 0).alias("present"),
        F.explode(F.when(F.col("lot") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_report(damaged(table(spark, folder, "conversations")), present="present")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_bpe": op2_bpe,
    "op3_language": op3_language,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_hilbert_shards": op6_hilbert_shards,
    "op7_personal_data": op7_personal_data,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_source_mix": op12_source_mix,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": pipeline,
}

def _nearest(r: int) -> str:
    """near{r}: the entry of book{r} that every piece is nearest to."""
    far = "list_sum(list_transform(list_zip(piece, centre), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""near{r} AS (
    SELECT row_no, part, piece, entry, far FROM (SELECT *, {far} AS far FROM pieces JOIN book{r} USING (part))
    QUALIFY row_number() OVER (PARTITION BY row_no, part ORDER BY far, entry) = 1
)"""


def _round(r: int) -> str:
    """near{r}, and book{r + 1}: its entries as floored means of their pieces, unused ones as they were."""
    return f"""{_nearest(r)}, sums{r} AS (
    SELECT part, entry, place, sum(value) AS total, count(*) AS n
    FROM (SELECT part, entry, unnest(piece) AS value, generate_subscripts(piece, 1) AS place FROM near{r}) GROUP BY ALL
), means{r} AS (
    -- // rounds towards zero
    SELECT part, entry, list(CAST((total - (((total % n) + n) % n)) // n AS BIGINT) ORDER BY place) AS mean FROM sums{r} GROUP BY ALL
), book{r + 1} AS (
    SELECT part, entry, coalesce(mean, centre) AS centre FROM book{r} LEFT JOIN means{r} USING (part, entry)
)"""


ORACLES = {
    "op8_decontamination": r"""
WITH cut AS (
    SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS words FROM benchmark
), items AS (
    SELECT DISTINCT item_id, w, list_sort(list_distinct(list_transform(range(1, len(words) - w + 2), lambda i: array_to_string(words[i:i + w - 1], ' ')))) AS grams
    FROM (SELECT *, least(len(words), 5) AS w FROM cut) WHERE w > 0
), numbered AS (
    SELECT *, row_number() OVER () AS text_no, len(grams) AS n FROM items
), wanted AS (
    SELECT item_id, text_no, w, n, unnest(grams) AS gram FROM numbered
), split AS (
    SELECT DISTINCT doc_id, text, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS words FROM documents
), held AS (
    SELECT DISTINCT doc_id, text, s.w, unnest(list_transform(range(1, greatest(len(words) - s.w + 2, 1)), lambda i: array_to_string(words[i:i + s.w - 1], ' '))) AS gram
    FROM split, (SELECT DISTINCT w FROM numbered) s
), counted AS (
    SELECT doc_id, text, item_id, text_no, n, count(*) AS found FROM held JOIN wanted USING (w, gram) GROUP BY ALL
), enough AS (
    SELECT * FROM counted WHERE found >= ceil(n * 0.8 - 1e-9)
)
SELECT doc_id, item_id, CAST(n AS INTEGER) AS n_shingles, CAST(found AS INTEGER) AS n_found, found / n AS containment
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY found / n DESC, found DESC, n DESC) AS place FROM enough) WHERE place = 1
""",
    "op9_warc": r"""
WITH cut AS (
    SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), typed AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM cut
), chosen AS (
    SELECT *, payload_bytes >= 100 AND page_id IS DISTINCT FROM first AND first IS NOT NULL AS again FROM typed
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to,
    -- the block is the HTTP header, and the payload unless it is a revisit
    CAST(length(http) + CASE WHEN again THEN 0 ELSE payload_bytes END AS BIGINT) AS content_length,
    -- header lines, the block, and two line ends
    CAST(strlen(lines) + length(http) + CASE WHEN again THEN 0 ELSE payload_bytes END + 4 AS BIGINT) AS record_bytes
FROM (
    SELECT *, 'WARC/1.1' || e || 'WARC-Type: ' || CASE WHEN again THEN 'revisit' ELSE 'response' END || e || 'WARC-Record-ID: <urn:page:' || page_id || '>' || e
        || 'WARC-Date: 1970-01-01T00:00:00Z' || e || 'WARC-Target-URI: ' || regexp_replace(coalesce(url, ''), '[\r\n]', '', 'g') || e
        || 'WARC-Payload-Digest: sha256:' || payload_digest || e
        || CASE WHEN again THEN 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || e || 'WARC-Refers-To: <urn:page:' || first || '>' || e ELSE '' END
        || 'Content-Type: application/http; msgtype=response' || e
        || 'Content-Length: ' || (length(http) + CASE WHEN again THEN 0 ELSE payload_bytes END) || e || e AS lines
    FROM (SELECT *, 'HTTP/1.1 200 OK' || e || 'Content-Type: text/html; charset=utf-8' || e || 'Content-Length: ' || payload_bytes || e || e AS http
        FROM (SELECT *, chr(13) || chr(10) AS e FROM chosen))
)
""",
    "op10_exact_dedup": r"""
WITH cut AS (
    SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
), grouped AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
        row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM cut
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM grouped
""",
    "op11_vector_codes": f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS row_no, vec_id, label, v, len(v) // 16 AS w FROM kept
), pieces AS (
    SELECT row_no, p AS part, v[p * w + 1:(p + 1) * w] AS piece FROM numbered, range(16) parts(p)
), book0 AS (
    SELECT part, row_no AS entry, piece AS centre FROM pieces WHERE row_no < 64
), {_round(0)}, {_round(1)}, {_nearest(2)}, books AS (
    SELECT string_agg(array_to_string(centre, ','), ',' ORDER BY part, entry) AS numbers FROM book2
), coded AS (
    SELECT row_no, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM near2 GROUP BY row_no
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha256(numbers) AS codebooks_sha256
FROM coded JOIN numbered USING (row_no), books
""",
}
