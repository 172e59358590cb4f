"""The registered queries of the operators and the SQL that says the same."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import (
    alignment,
    conversations,
    decontaminate,
    licenses,
    lines,
    mixing,
    neighbours,
    packing,
    quality,
    secrets,
    shards,
    simhash,
    substrings,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    model = quality.train(docs, table(spark, folder, "labels"))
    scored = quality.with_score(docs, model)
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted")
    )


def op2_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.with_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "novel")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[count(kind) for kind in secrets.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op3_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    placed = shards.shuffle_to_shards(rows, 24)
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


def op4_fm_index_substrings(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.dedup_substrings(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents").select("doc_id", "text"))


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.with_leaks(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", F.inline("leaks"))


def op7_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op8_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest_vectors(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.with_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.inline("licenses"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_capped_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = mixing.with_sizes(table(spark, folder, "documents").select("doc_id", "text", "source"))
    mixed = mixing.mix_sources(docs.drop("text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op12_diagonal_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokenizers(table(spark, folder, "documents").select("doc_id", "text"))


def op13_block_table_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversations.repair_conversations(conversations.damage(rows))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    digest = F.sha2(F.array_join(F.coalesce(said, F.array().cast("array<string>")), "\n"), 256)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = repaired.withColumnRenamed("conv_id", "__id")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("__id")), "left")
    return every.select(
        "conv_id",
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        digest.alias("repaired_sha256"),
    )


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP10_SQL = f"""
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM parts
), keyed AS (
  SELECT doc_id, place, line,
    translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM numbered
), repeated AS (
  SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 40
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, r.line_key IS NOT NULL AND k.doc_id <> r.keeper AS dropped
  FROM keyed k LEFT JOIN repeated r USING (line_key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(dropped::INT)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP4_SQL = """
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 11)) AS place, words FROM words WHERE len(words) >= 13
), named AS (
  SELECT doc_id, place, array_to_string(words[place:place + 12], ' ') AS name FROM windows
), first_holder AS (
  SELECT name, min(doc_id) AS least FROM named GROUP BY name HAVING min(doc_id) < max(doc_id)
), lost AS (
  SELECT DISTINCT n.doc_id, unnest(range(n.place, n.place + 13)) AS place
  FROM named n JOIN first_holder f ON n.name = f.name AND f.least < n.doc_id
), gone AS (
  SELECT doc_id, list(place) AS places FROM lost GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, len(words) AS n_words, len(coalesce(places, [])) AS n_removed,
    CASE WHEN places IS NULL THEN words ELSE
      list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(places, i)), lambda i: words[i]) END AS words
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256
FROM kept
"""

OP11_SQL = f"""
WITH rows AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 15))::BIGINT AS draw
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM rows GROUP BY source
), ranked AS (
  SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place FROM sizes
), levels AS (
  SELECT *, (SELECT sum(source_size) FROM sizes) - coalesce(sum(cap) OVER before, 0) AS rest, sum(weight) OVER onward AS free
  FROM ranked
  WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    onward AS (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), open AS (
  SELECT rest, free, place FROM levels WHERE cap * free > rest * weight ORDER BY place LIMIT 1
), targets AS (
  SELECT r.source, r.source_size,
    CASE WHEN o.place IS NULL OR r.place < o.place THEN cap::DOUBLE ELSE (o.rest * weight)::DOUBLE / o.free::DOUBLE END AS target
  FROM ranked r LEFT JOIN open o ON true
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS whole FROM targets
), running AS (
  SELECT source, draw, sum(size)::DOUBLE AS amount, sum(sum(size)) OVER (PARTITION BY source ORDER BY draw)::DOUBLE AS after
  FROM rows GROUP BY source, draw
), cuts AS (
  SELECT p.source, min_by(draw, draw) AS cut,
    min_by((target - whole * source_size - (after - amount)) * 2 >= amount, draw) AS edge
  FROM parts p JOIN running r ON p.source IS NOT DISTINCT FROM r.source
  WHERE target - whole * source_size > 0 AND after >= target - whole * source_size
  GROUP BY p.source
)
SELECT doc_id, size, source_size, target,
  size * (whole + coalesce(draw < cut OR (edge AND draw = cut), false)::BIGINT) AS taken
FROM rows d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""

LLM_QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_secret_scans": op2_secret_scans,
    "op3_hypergeometric_shards": op3_hypergeometric_shards,
    "op4_fm_index_substrings": op4_fm_index_substrings,
    "op5_vector_packing": op5_vector_packing,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_collision_counting": op8_collision_counting,
    "op9_license_scans": op9_license_scans,
    "op10_line_dedup": op10_line_dedup,
    "op11_capped_mixing": op11_capped_mixing,
    "op12_diagonal_alignment": op12_diagonal_alignment,
    "op13_block_table_repair": op13_block_table_repair,
}
LLM_ORACLE = {"op4_fm_index_substrings": OP4_SQL, "op10_line_dedup": OP10_SQL, "op11_capped_mixing": OP11_SQL}
