"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    alignment,
    bpe,
    exact_dedup,
    html_extraction,
    importance,
    language,
    mixing,
    packing,
    pii,
    quality,
    secret_scan,
    simhash,
    warc,
)

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, most_bits=3)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(language.fold("doc_id") != 0))
    judged = language.identify(docs.select("doc_id", "text"), model)
    held_out = (language.fold("doc_id") == 0).alias("held_out")
    return judged.select("doc_id", held_out, "lang_pred", "score", "accepted")


# Pages whose main text is known teach the extraction; so many are enough.
LABELLED_PAGES = 300
PAGE_OF_DOCUMENT = r"^https?://[^/]+/[^/]+/(\d+)"


def labelled_pages(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """Some pages and the documents they show, which their addresses number."""
    number = F.regexp_extract("url", PAGE_OF_DOCUMENT, 1).try_cast("long").alias("doc_id")
    pages = table(spark, folder, "pages")
    known = pages.select("page_id", number).filter("doc_id is not null")
    chosen = known.orderBy(F.xxhash64("page_id"), "page_id").limit(LABELLED_PAGES).collect()
    documents = table(spark, folder, "documents").filter(
        F.col("doc_id").isin([row.doc_id for row in chosen])
    )
    texts = dict(documents.select("doc_id", "text").collect())
    shown = pages.filter(F.col("page_id").isin([row.page_id for row in chosen]))
    pairs = shown.select("page_id", number, "html").orderBy("page_id").collect()
    return [(row.html, texts[row.doc_id]) for row in pairs if row.doc_id in texts]


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    weights = html_extraction.learn(labelled_pages(spark, folder))
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_extraction.extract(pages, weights).select("page_id", "url", "text", "n_chars")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.revisit_resolution(table(spark, folder, "pages"), min_bytes=0)


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = exact_dedup.exact_duplicates(docs, keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = bpe.token_digests(docs, public_tokenizers.path(VOCABULARY))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("personal", lambda s: s["base"])

    def of(kind: str):
        return F.filter(base, lambda s: s["kind"] == kind)

    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("personal")).alias("spans"),
    )


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.fit(docs))

    def of(kind: str):
        return F.filter("secrets", lambda s: s["kind"] == kind)

    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("secrets")).alias("spans"),
    )


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    entries = quality.stored_ledger(table(spark, folder, "documents").select("doc_id", "text"))
    return quality.apply_policy(entries).drop("n_lines", "n_echoes", "n_plain_words")


def quality_ablations(spark: SparkSession, folder: str) -> DataFrame:
    """What each rule of the policy does alone, from the stored ledger's bits."""
    entries = quality.stored_ledger(table(spark, folder, "documents").select("doc_id", "text"))
    return quality.ablations(entries)


def op11_importance(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.cross_tokenizer(table(spark, folder, "documents"), *files)


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_language_id": op2_language_id,
    "op3_html_extraction": op3_html_extraction,
    "op4_warc": op4_warc,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_bpe": op6_bpe,
    "op7_packing": op7_packing,
    "op8_pii": op8_pii,
    "op9_secrets": op9_secrets,
    "op10_quality": op10_quality,
    "quality_ablations": quality_ablations,
    "op11_importance": op11_importance,
    "op12_alignment": op12_alignment,
    "op13_mixing": op13_mixing,
}

# The ledger of the quality rules: measurements, and a bit for each rule in order.
LEDGER_SQL = r"""
    WITH t AS (
        SELECT doc_id, coalesce(text, '') AS text,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                           lambda w: w <> '') AS words
        FROM documents
    ), places AS (
        SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS run
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM t)
    ), again AS (
        SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1
    ), covered AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM again, range(8) AS r(k) GROUP BY doc_id
    ), lines AS (
        SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
    ), measured AS (
        SELECT doc_id, len(words) AS n_words,
               length(array_to_string(words, '')) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(n_lines, 0) AS n_lines,
               len(list_filter(range(2, len(words) + 1),
                               lambda i: words[i] = words[i - 1])) AS n_echoes,
               len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) AS n_plain
        FROM t LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
    )
    , ledger AS (
        SELECT *, (n_words < 20)::BIGINT
                  + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
                  + 4 * (10 * n_symbols > 3 * n_words)::BIGINT
                  + 8 * (10 * n_echoes > 3 * n_words)::BIGINT
                  + 16 * (word_chars > 25 * n_words)::BIGINT
                  + 32 * (2 * word_chars < 3 * n_words)::BIGINT
                  + 64 * (10 * n_plain < 3 * n_words)::BIGINT
                  + 128 * (n_lines >= 5 AND 10 * n_dup_lines > 5 * n_lines)::BIGINT
                  + 256 * (10 * n_symbols > n_words)::BIGINT
                  + 512 * (n_lines >= 5 AND 10 * n_dup_lines > 3 * n_lines)::BIGINT
                  + 1024 * (10 * n_echoes > n_words)::BIGINT AS failed
        FROM measured
    )
"""

SQL = {
    "op4_warc": """
        WITH t AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS hex FROM pages
        ), d AS (
            SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first_id,
                   array_to_string(list_transform(range(8), lambda g: array_to_string(
                       list_transform([15, 10, 5, 0], lambda b: substr(
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                           ((('0x' || substr(hex, g * 5 + 1, 5))::INT >> b) & 31) + 1, 1)), '')),
                       '') AS payload_digest
            FROM t
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM d
    """,
    "op5_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS plain
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(plain) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY plain)
    """,
    "op10_quality": LEDGER_SQL
    + """
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
               n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               failed & 255 = 0 AND bit_count(failed & 1792) < 2 AS kept, 2 AS policy_version
        FROM ledger
    """,
    "quality_ablations": LEDGER_SQL
    + """
        , rules(rule, bit) AS (VALUES
            ('few_words', 1), ('repeated_windows', 2), ('many_symbols', 4), ('echoed_words', 8),
            ('long_words', 16), ('short_words', 32), ('few_plain_words', 64),
            ('repeated_lines', 128), ('some_symbols', 256), ('some_repeated_lines', 512),
            ('some_echoes', 1024)
        ), each AS (
            SELECT rule, failed, failed & bit <> 0 AS hit, failed & ~bit AS rest
            FROM rules LEFT JOIN ledger ON true
        )
        SELECT 2 AS version, rule, count(*) FILTER (hit) AS failed,
               count(*) FILTER ((rest & 255 = 0 AND bit_count(rest & 1792) < 2)
                   AND NOT (failed & 255 = 0 AND bit_count(failed & 1792) < 2)) AS changed,
               count(failed) AS n_rows
        FROM each GROUP BY rule
    """,
    "op11_importance": r"""
        WITH crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
        ), texts AS (
            SELECT 0 AS side, row_number() OVER () AS row, doc_id, text FROM documents
            UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
        ), words AS (
            SELECT side, row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
        ), runs AS (
            SELECT side, row, unnest(list_concat(w,
                list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                list_transform(range(1, len(w) - 1),
                               lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
            FROM words
        ), counted AS (
            SELECT side, row, f, count(*) AS n FROM runs GROUP BY ALL
        ), features AS (
            SELECT f, xor(list_reduce(
                list_transform(range(length(hex(encode(f))) // 2),
                               lambda i: ('0x' || hex(encode(f))[2 * i + 1:2 * i + 2])::BIGINT),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295),
                4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT f FROM counted), crc
        ), placed AS (
            SELECT side, row, bucket, sum(n) AS n FROM counted JOIN features USING (f) GROUP BY ALL
        ), sums AS (
            SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s,
                   coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t FROM placed GROUP BY 1
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000)
                / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS gain FROM sums
        ), weighed AS (
            SELECT row, sum(n * gain)::BIGINT AS weight, sum(n)::BIGINT AS n_features
            FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY 1
        ), scored AS (
            SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
                   coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((
                       ('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT
                   AS score
            FROM words LEFT JOIN weighed USING (row) WHERE side = 0
        ), placed_scores AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
                   count(*) OVER () AS able
            FROM scored WHERE n_words >= 20
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN place <= 5 * able // 100 THEN place END AS rank
        FROM scored LEFT JOIN placed_scores USING (doc_id)
    """,
    "op13_mixing": r"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   ('0x' || sha256('42:' || doc_id)[1:15])::BIGINT AS place
            FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
            FROM docs GROUP BY 1
        ), levels AS (
            SELECT 0 AS step, sum(source_size)::HUGEINT AS rest, sum(weight)::HUGEINT AS w FROM sources
            UNION ALL
            SELECT step + 1,
                   sum(source_size) - sum(CASE WHEN 3 * source_size * w < weight * rest
                                               THEN 3 * source_size ELSE 0 END),
                   sum(CASE WHEN 3 * source_size * w < weight * rest THEN 0 ELSE weight END)
            FROM levels, sources WHERE step < 40 GROUP BY step, rest, w
        ), level AS (
            SELECT rest, w FROM levels ORDER BY step DESC LIMIT 1
        ), targets AS (
            SELECT source, source_size,
                   CASE WHEN 3 * source_size * w < weight * rest THEN (3 * source_size)::DOUBLE
                        ELSE (weight * rest)::DOUBLE / w::DOUBLE END AS target
            FROM sources, level
        ), laid AS (
            SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS goal,
                   coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY place, doc_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
            FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
        )
        SELECT doc_id, size, source_size, target,
               (CASE WHEN source_size = 0 THEN 0 ELSE goal // source_size * size
                   + greatest(0, least(size, goal % source_size - begin)) END)::BIGINT AS taken
        FROM laid
    """,
}
