"""The operators as queries over the driver tables, with SQL twins where SQL can say it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanspark.llm import (
    chat,
    context_tree,
    decontaminate,
    line_templates,
    packing,
    quality,
    ranked_search,
    sharding,
    simhash,
    substring,
    token_alignment,
    token_shards,
    warc,
)
from gleanspark.llm.rows import KEYS
from gleanspark.workspace import fresh_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.segments(rows.unionByName(own)))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-shards")
    index, places = token_shards.write_shards(_read(spark, sf_dir, "documents"), path)
    return token_shards.read_pieces(places, index, path).drop("row")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.byte_shards(_read(spark, sf_dir, "documents"), 16)
    return found.select(
        "*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_templates.drop_recurring(_read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "text", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped")
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(documents, benchmark)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), with_ids=False)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(_read(spark, sf_dir, "documents"), with_text=False)
    return found.select(F.col(KEYS[0]).alias("doc_id"), *substring.RESULT)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    found = quality.judge(documents, labels)
    wanted = [*quality.BASE, "base_failed", "kept", "stratum", *quality.RULES, "reasons"]
    return found.select(F.col(KEYS[0]).alias("doc_id"), *wanted)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(_read(spark, sf_dir, "documents"))
    return found.select(
        F.col(KEYS[0]).alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    index = warc.write_archives(_read(spark, sf_dir, "pages"), path)
    found = warc.read_records(index, path, with_payload=False)
    ids = {n: F.col(n).cast("bigint") for n in ("page_id", "refers_to")}
    return found.withColumns(ids).drop("url")


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(_read(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")
    return ranked_search.search(documents, benchmark).drop("reads", "postings")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(_read(spark, sf_dir, "documents"), with_groups=False)


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_token_output": op2_token_output,
    "op3_sharding": op3_sharding,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_warc": op10_warc,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_ranked_search": op12_ranked_search,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE = {
    "op1_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), marked AS (
            SELECT *, lag(role, 1, 'start') OVER w AS before, lead(role) OVER w IS NULL AS last,
                length(regexp_replace(text, '([\\<\[])', '\1\\', 'g'))
                + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                  ELSE 21 + length(regexp_replace(role, '([\\<\[])', '\1\\', 'g')) END AS chars
            FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), judged AS (
            SELECT *, CASE WHEN (before, role) NOT IN (('start', 'system'), ('start', 'user'),
                    ('system', 'user'), ('user', 'assistant'), ('assistant', 'user'))
                    THEN role || ' after ' || before END AS error,
                CASE WHEN last AND role <> 'assistant' THEN 'ends with ' || role END AS ending
            FROM marked
        ), said AS (
            SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
                sha256(string_agg(role || chr(10) || text || chr(10), ''
                    ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
                coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                    FILTER (role = 'assistant'), '') AS learned,
                coalesce(first(error ORDER BY turn NULLS FIRST, role, text)
                    FILTER (error IS NOT NULL), max(ending)) AS first_error
            FROM judged GROUP BY conv_id
        )
        SELECT conv_id, n_turns, turns_sha256, length(learned) AS loss_chars,
            sha256(learned) AS loss_sha256, formatted_chars, first_error IS NULL AS valid, first_error
        FROM said
    """,
    # Templates are told apart by their words here, by hashes in the operator.
    "op4_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, i - 1 AS line_no, string_split(text, chr(10))[i] AS line
            FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
                  FROM documents)
        ), split AS (
            SELECT doc_id, line_no, trim(regexp_replace(line, '[ \t\x0b\x0c\r]+', ' ', 'g')) AS plain
            FROM lines
        ), tokens AS (
            SELECT *, len(string_split(plain, ' ')) AS n,
                list_transform(string_split(plain, ' '),
                    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS masked
            FROM split WHERE plain <> ''
        ), leaves AS (
            SELECT *, n || ' ' || array_to_string(masked[1:3], ' ') AS leaf FROM tokens
        ), once AS (
            SELECT plain, any_value(n) AS n, any_value(leaf) AS leaf, any_value(masked) AS masked,
                count(DISTINCT doc_id) AS docs
            FROM leaves GROUP BY plain
        ), crowded AS (
            SELECT leaf FROM once WHERE n >= 5 GROUP BY leaf
            HAVING sum(docs) >= 3 AND count(*) > 1
        ), words AS (
            SELECT *, count(*) OVER (PARTITION BY plain) AS literals
            FROM (SELECT plain, leaf, n, docs, unnest(range(1, n + 1)) AS pos, unnest(masked) AS word
                  FROM once SEMI JOIN crowded USING (leaf) WHERE n >= 5)
            WHERE word <> '<*>' QUALIFY literals >= 0.5 * n
        ), counted AS (
            SELECT leaf, pos, word, sum(docs) AS times FROM words GROUP BY ALL HAVING times >= 3
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY plain ORDER BY times DESC) AS place
            FROM words JOIN counted USING (leaf, pos, word)
        ), judged AS (
            SELECT *, max(CASE WHEN place = ceil(0.7::DOUBLE * literals) THEN times END)
                OVER (PARTITION BY plain) AS last
            FROM ranked
        ), general AS (
            SELECT plain, any_value(leaf) || chr(10)
                || string_agg(pos || ' ' || word, chr(9) ORDER BY pos) AS template
            FROM judged WHERE times >= 0.5 * last GROUP BY plain
        ), named AS (
            SELECT doc_id, line_no, coalesce(template, chr(11) || plain) AS template
            FROM leaves LEFT JOIN general USING (plain)
        ), recurring AS (
            SELECT template, min(doc_id) AS first FROM named
            GROUP BY template HAVING count(DISTINCT doc_id) >= 3
        ), drops AS (
            SELECT doc_id, line_no FROM named JOIN recurring USING (template)
            WHERE doc_id <> first
        ), kept AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text, count(*) AS n
            FROM lines ANTI JOIN drops USING (doc_id, line_no) GROUP BY doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
            coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines,
            coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k.n, 0) AS n_dropped
        FROM documents d LEFT JOIN kept k USING (doc_id)
    """,
    "op5_decontamination": r"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents
            UNION ALL SELECT 'i', item_id, text FROM benchmark
        ), plain AS (
            SELECT kind, id, list_filter(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x09-\x0D\x20-\x2F:-@\[-`{-~]+'), lambda w: w <> '') AS words
            FROM texts
        ), shingles AS (
            SELECT DISTINCT kind, id, unnest(list_transform(
                range(1, greatest(2, len(words) - 3)),
                lambda i: array_to_string(words[i:i + 4], ' '))) AS shingle
            FROM plain WHERE len(words) > 0
        ), sizes AS (
            SELECT id AS item_id, count(*) AS item_shingles FROM shingles WHERE kind = 'i' GROUP BY id
        ), shared AS (
            SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared
            FROM shingles d JOIN shingles i USING (shingle)
            WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY ALL
        )
        SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles AS containment
        FROM shared JOIN sizes USING (item_id) WHERE shared >= 0.8 * item_shingles
    """,
    "op10_warc": r"""
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), originals AS (
            SELECT payload_digest, max(page_id) AS original FROM payloads
            WHERE payload_bytes >= 1000 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN original <> page_id THEN original END AS refers_to
        FROM payloads LEFT JOIN originals USING (payload_digest)
    """,
    "op12_ranked_search": r"""
        WITH texts AS (
            SELECT 'd' AS kind, doc_id AS id, text FROM documents
            UNION ALL SELECT 'i', item_id, text FROM benchmark
        ), words AS (
            SELECT kind, id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM texts
        ), counts AS (
            SELECT kind, id, term, count(*) AS tf FROM words GROUP BY ALL
        ), lengths AS (
            SELECT id AS doc_id, sum(tf)::BIGINT AS n FROM counts WHERE kind = 'd' GROUP BY id
        ), corpus AS (
            SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM lengths
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM counts, corpus WHERE kind = 'd' GROUP BY term, docs
        ), found AS (
            SELECT i.id AS item_id, d.id AS doc_id, sum(i.tf * w * ((1000000000 * d.tf)
                // (1000 * d.tf + 12 * (75 + (25 * n * docs) // length))))::BIGINT AS score
            FROM counts i JOIN counts d USING (term) JOIN weights USING (term)
                JOIN lengths ON doc_id = d.id, corpus
            WHERE i.kind = 'i' AND d.kind = 'd' GROUP BY ALL
        )
        SELECT item_id, row_number() OVER w::INT AS rank, doc_id, score
        FROM found WHERE score > 0 WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
        QUALIFY row_number() OVER w <= 20
    """,
}
