"""One registered query for each training-data operator, on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, hnsw, langid, lines, maxscore, minhash, mixing, resample, rules, secrets, suffix, tokens

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op9_minhash_neardup")
def minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op10_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(table(spark, sf_dir, "documents"))


@query("op1_decontaminate")
def decontaminate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


@query("op2_embedding_neardup")
def embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.links(table(spark, sf_dir, "embeddings"))


#: Fixed value: the text of the conversation that is added to the table.
HARD_TURN = "\\### Assistant: </turn> ok"


@query(
    "op4_chat_format",
    r"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
      UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    written AS (
      SELECT *, replace(replace(replace(text, '\', '\0'), '### ', '\1'), '</turn>', '\2') AS safe FROM turns)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum(length('### ' || CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' ELSE '=' || role END
                 || ': ' || safe || '</turn>' || chr(10)))::BIGINT AS formatted_chars,
      regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, '' ORDER BY turn, role, text),
                        's?(ua)+') AS valid
    FROM written GROUP BY conv_id
    """,
)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_TURN).alias("text"))
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat.digest(given.unionByName(hard))


@query(
    "op3_mix_sources",
    """
    WITH RECURSIVE size AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS size FROM documents GROUP BY source),
    mean AS (
      SELECT source, pow(size, 0.5) / sum(pow(size, 0.5)) OVER () * sum(size) OVER () * 1.0 / size AS mean FROM size WHERE size > 0),
    part AS (SELECT source, greatest(1, ceil(mean / 256))::BIGINT AS parts, mean / greatest(1, ceil(mean / 256)) AS mean FROM mean),
    sums AS (
      SELECT source, parts, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM part
      UNION ALL
      SELECT source, parts, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM sums WHERE k < ceil(mean + 12 * sqrt(mean) + 24)),
    lists AS (SELECT source, parts, list(c ORDER BY k) AS cs FROM sums GROUP BY source, parts),
    drawn AS (
      SELECT d.doc_id, d.source, d.text, list_sum(list_transform(range(1, parts + 1), lambda part: len(list_filter(cs, lambda c:
               c < ('0x' || md5('0:copies:' || part || ':' || d.doc_id)[1:13])::BIGINT / 4503599627370496.0)))) AS n
      FROM documents d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source),
    copies AS (SELECT doc_id, source, text, unnest(range(1, n::BIGINT + 1)) AS copy FROM drawn WHERE n > 0)
    SELECT doc_id, source, copy, ('0x' || md5('0:order:' || copy || ':' || doc_id)[1:15])::BIGINT AS shuffle_key, md5(coalesce(text, '')) AS text_md5 FROM copies
    """,
)
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copy", "shuffle_key", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


@query("op7_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query("op6_token_rollup")
def token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.corpus_totals(table(spark, sf_dir, "documents"))


@query(
    "op13_importance_resample",
    r"""
    WITH RECURSIVE crc_step AS (
      SELECT range AS byte, range AS c, 0 AS k FROM range(256)
      UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_step WHERE k < 8),
    crc_table AS (SELECT list(c ORDER BY byte) AS steps FROM crc_step WHERE k = 8),
    texts AS (
      SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
    worded AS (
      SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
    feature AS (
      SELECT side, id, unnest(w) AS f FROM worded
      UNION ALL SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded),
    coded AS (
      SELECT f, xor(list_reduce(list_transform(range(1, len(h) // 2 + 1), lambda i: ('0x' || h[2 * i - 1:2 * i])::BIGINT),
                                lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
      FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feature)), crc_table),
    counted AS (
      SELECT bucket, count(*) FILTER (side = 'd')::DOUBLE AS s, count(*) FILTER (side = 'b')::DOUBLE AS t FROM feature JOIN coded USING (f) GROUP BY bucket),
    gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(t * 0 + s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM counted),
    summed AS (
      SELECT id, count(*) AS n, sum(gain)::BIGINT AS g FROM feature JOIN coded USING (f) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
    scored AS (
      SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce((g - (g % n + n) % n) // n, 0) AS weight,
        ('0x' || sha256('7:' || id)[1:8])::BIGINT AS h FROM worded LEFT JOIN summed USING (id) WHERE side = 'd'),
    noisy AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0)))::BIGINT AS score FROM scored),
    placed AS (
      SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 25 // 100 AS drawn FROM noisy WHERE n_words >= 20)
    SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM noisy LEFT JOIN placed USING (doc_id)
    """,
)
def importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op11_maxscore_search",
    r"""
    WITH worded AS (
      SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
    asked AS (
      SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    long AS (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id),
    total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM long),
    held AS (SELECT doc_id, term, count(*) AS tf FROM worded GROUP BY doc_id, term),
    weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, total GROUP BY term, docs),
    scored AS (
      SELECT item_id, doc_id, sum(w * times * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::BIGINT AS score
      FROM (SELECT item_id, term, count(*) AS times FROM asked GROUP BY item_id, term) JOIN weight USING (term) JOIN held USING (term) JOIN long USING (doc_id), total
      GROUP BY item_id, doc_id)
    SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
    WHERE rank <= 20
    """,
)
def maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
