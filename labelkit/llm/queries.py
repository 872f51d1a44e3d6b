"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelkit.llm.common import documents, table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.exact_dedup import duplicate_groups

    found = duplicate_groups(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.simhash import near_duplicates

    found = near_duplicates(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.mixing import mix

    return mix(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "source", "copies", "tokens", "epoch", "weight", "realised", "block", "block_pos"
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.url_filter import judge_urls, rule_table

    found = judge_urls(table(spark, sf_dir, "pages"), rule_table(spark))
    return found.withColumnRenamed("id", "page_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.quality import score_documents

    found = score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.pii import find_personal_data

    found = find_personal_data(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
        F.sha2("base_spans", 256).alias("base_sha256"), "spans",
    )


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.packing import pack

    return pack(documents(spark, sf_dir), tokenizer_path()).withColumnRenamed("id", "doc_id")


def op7_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.brown import score_texts

    return score_texts(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op9_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.ann import nearest_neighbours

    return nearest_neighbours(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.licenses import scan_licenses

    return scan_licenses(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op11_galloping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.alignment import align_tokens

    found = align_tokens(documents(spark, sf_dir), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


def op12_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.sharding import shard_rows

    placed = shard_rows(documents(spark, sf_dir))
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelkit.llm.negatives import mine_hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = mine_hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


_ALL = (
    op1_exact_dedup, op2_simhash_near_dedup, op3_quality_classifier, op4_pii, op5_packing,
    op6_temperature_mixing, op7_brown_lm, op8_url_filter, op9_multi_index_hashing, op10_license_scan,
    op11_galloping_alignment, op12_feistel_sharding, op13_angular_negatives,
)
QUERIES = {f.__name__: f for f in _ALL}

ORACLE = {
    "op1_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
    "op6_temperature_mixing": """
WITH RECURSIVE grouped AS (
  SELECT doc_id, source, coalesce(text, '') AS body, count(*) AS copies,
         CAST(sum(1 + len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) AS BIGINT) AS tokens
  FROM documents GROUP BY ALL
), units AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY tokens, doc_id NULLS FIRST) = 1 AS is_least FROM grouped
), shares AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS held FROM units GROUP BY source
), whole AS (
  SELECT sum(held)::DOUBLE AS total, count(*) AS n, min(held) AS least,
         -sum(held / (SELECT sum(held) FROM shares) * ln(held / (SELECT sum(held) FROM shares))) AS own
  FROM shares
), search(step, lo, hi) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN fits THEN lo ELSE mid END, CASE WHEN fits THEN mid ELSE hi END
  FROM (
    SELECT step, lo, hi, mid,
           ln(z) - mid / z * plogp <= own + 0.5 * (ln(n) - own) AND pow(least / total, mid) / z * total / least <= 4 AS fits
    FROM (
      SELECT step, lo, hi, mid, any_value(w.own) AS own, any_value(w.n) AS n, any_value(w.total) AS total,
             any_value(w.least) AS least, sum(pow(s.held / w.total, mid)) AS z,
             sum(pow(s.held / w.total, mid) * ln(s.held / w.total)) AS plogp
      FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid FROM search WHERE step < 50), shares s, whole w
      GROUP BY step, lo, hi, mid
    )
  )
), chosen AS (SELECT round(hi, 9) AS exponent FROM search WHERE step = 50
), weighed AS (
  SELECT source, held, round(pow(held / total, exponent) / sum(pow(held / total, exponent)) OVER (), 9) AS weight, total
  FROM shares, whole, chosen
), budgets AS (
  SELECT source AS s, held, weight, CAST(round(weight * total, 0) AS BIGINT) AS budget FROM weighed
), plans AS (
  SELECT *, budget // held AS full_epochs,
         greatest(CAST(ceil(budget / greatest(ceil((SELECT sum(budget) FROM budgets) / 1048576), 1)) AS BIGINT), 1) AS quota
  FROM budgets
), epochs AS (
  SELECT u.*, p.*, epoch, full_epochs = 0 AND is_least AND tokens > budget AS forced, md5('42:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')) AS key,
         md5('42:block:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')) AS in_block
  FROM units u JOIN plans p ON u.source IS NOT DISTINCT FROM p.s, unnest(range(0, full_epochs + 1)) AS e(epoch)
  WHERE epoch < full_epochs OR tokens <= budget - full_epochs * held OR (full_epochs = 0 AND is_least AND tokens > budget)
), placed AS (
  SELECT *, epoch * held + sum(tokens) OVER (PARTITION BY source, epoch ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS pos
  FROM epochs
), taken AS (SELECT *, CAST((pos - tokens) // quota AS BIGINT) AS block FROM placed WHERE 2 * pos - tokens <= 2 * budget OR forced)
SELECT doc_id, source, copies, tokens, epoch, weight,
       (sum(tokens) OVER (PARTITION BY source))::DOUBLE / sum(tokens) OVER () AS realised, block,
       row_number() OVER (PARTITION BY block ORDER BY in_block, source, doc_id) - 1 AS block_pos
FROM taken
""",
    "op8_url_filter": """
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, row_number() OVER () AS n, translate(regexp_extract(rest, '^[^/?#]*'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), rules(action, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), best AS (
  SELECT n, arg_max(r.host || r.path, length(r.host) * 10000 + length(r.path)) AS rule,
         arg_max(r.action, length(r.host) * 10000 + length(r.path)) AS action
  FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM split LEFT JOIN best USING (n)
""",
    "op12_feistel_sharding": """
WITH RECURSIVE crc_table AS (
  SELECT [list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)
          FOR n IN range(256)] AS entries
), docs AS (
  SELECT doc_id, coalesce(text, '') AS body, encode(coalesce(text, '')) AS content FROM documents
), numbered AS (
  SELECT doc_id, octet_length(content) + 16 AS size, hex(content) AS digits,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(body)) - 1 AS number
  FROM docs
), sized AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS side FROM docs
), keys AS (
  SELECT r, [('0x' || substr(md5('42:' || r || ':' || p), 1, 8))::BIGINT >> 1 | 1 FOR p IN ['a', 'b', 'c', 'd']] AS k
  FROM unnest(range(8)) t(r)
), walk(number, r, l, h, n, side) AS (
  SELECT number, 0, number // side, number % side, n, side FROM numbered, sized
  UNION ALL
  SELECT number, r + 1, h, (l + xor(v, v >> 29) % side) % side, n, side
  FROM (
    SELECT number, w.r, l, h, n, side, (xor(h * k[1] + k[2], (h * k[1] + k[2]) >> 32) & 4294967295) * k[3] + k[4] AS v
    FROM walk w JOIN keys ON keys.r = w.r % 8
    WHERE w.r = 0 OR w.r % 8 > 0 OR l * side + h >= n
  )
), placed AS (SELECT number, l * side + h AS p FROM walk WHERE r > 0 AND r % 8 = 0 AND l * side + h < n)
SELECT doc_id, CAST(size AS BIGINT) AS size,
       xor(list_reduce([('0x' || byte)::BIGINT FOR byte IN regexp_extract_all(digits, '..')],
                       lambda c, b: xor(c >> 8, entries[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) AS text_crc32,
       'rows' AS law, CAST(p % 40 AS INTEGER) AS shard, p // 40 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN placed USING (number), crc_table
""",
    "op13_angular_negatives": """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
QUALIFY rank <= 5
""",
}
