"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import (
    chat_tools,
    common,
    decontaminate,
    hard_negatives,
    lang_id,
    ordinal_quality,
    packing,
    quality_rules,
    secret_ledger,
    simhash,
    spelling,
    token_shards,
    tokens,
    toxicity,
    word_bpe,
)
from tallyworks.sources import scratch

Query = Callable[[SparkSession, str], DataFrame]


# What the turns of the conversations must satisfy as calls: some words in every question.
TOOLS = {
    "user": (chat_tools.Field("text", "string", least=1), chat_tools.Field("words", "integer", least=5)),
    "system": (chat_tools.Field("text", "string", least=1),),
}
# Grades: 0 for poor text, 1 for good text that is toxic, 2 for the rest.
GRADE = "case when quality = 0 then 0 when quality = 1 and toxic = 1 then 1 when quality = 1 then 2 end"


def op1_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat_tools.from_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat_tools.link(calls, results, TOOLS)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~common.held_out(F.col("doc_id")))
    model = toxicity.letter_model(rows)
    lexicon, prior = toxicity.learn(rows, labels, model)
    scored = toxicity.score(rows, model, lexicon, prior)
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.documents(spark, sf_dir)
    profiles = lang_id.prototypes(rows.filter(~common.held_out(F.col("doc_id"))))
    found = lang_id.predict(rows, profiles)
    return found.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(common.documents(spark, sf_dir), tokens.public())


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record as it is read back from the shards."""
    folder = scratch.new_folder(spark, "shards")
    layout = token_shards.write(common.documents(spark, sf_dir), tokens.public(), folder)
    rows = token_shards.read(spark, layout)
    return rows.select("slot", "shard", F.octet_length("ids").alias("n_bytes"), F.crc32("ids").alias("ids_crc32"))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is a version whose path is its doc_id; the ledger starts empty."""
    rows = common.documents(spark, sf_dir).select(F.col("doc_id").alias("path"), F.col("text").alias("content"))
    ledger = secret_ledger.Ledger(spark, scratch.new_folder(spark, "ledger"))
    ledger.scan(rows)
    found = ledger.report(rows)
    base = [r.kind for r in secret_ledger.RULES if r.base]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    digest = F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256)
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(kind) for kind in base],
        digest.alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grades of the documents outside of the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~common.held_out(F.col("doc_id")))
    return labels.select("doc_id", F.expr(GRADE).alias("grade"))


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.documents(spark, sf_dir).select("doc_id", "text")
    model = ordinal_quality.learn(rows, ratings(spark, sf_dir))
    scored = ordinal_quality.score(rows, model).withColumn("held_out", common.held_out(F.col("doc_id")))
    return scored.select("doc_id", "held_out", "expected_grade", "tail", "kept")


def op8_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.documents(spark, sf_dir))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(common.documents(spark, sf_dir))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "distance")


def op11_pivotal_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word forms of all documents, after one run in 199 has lost a letter at a place its hash names."""
    runs = spelling.letter_runs(common.documents(spark, sf_dir))
    hashed = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % 199 == 0, shorter).otherwise(F.col("run"))
    return spelling.group_variants(spelling.count_words(runs.withColumn("h", hashed), word))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label in seven is moved on, so that near rows of another label exist; components become whole numbers."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(hard_negatives.is_finite(F.col("embedding")))
    label = F.col("label").cast("long")
    whole = F.transform("embedding", lambda x: hard_negatives.whole(x.cast("double") * 256))
    vectors = rows.select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        whole.alias("components"),
        (F.col("vec_id") % 100 == 0).alias("anchor"),
    )
    return hard_negatives.mine(vectors)


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = word_bpe.round_trip(common.documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return texts.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_chat_tools": op1_chat_tools,
        "op2_toxicity": op2_toxicity,
        "op3_language_id": op3_language_id,
        "op4_packing": op4_packing,
        "op5_token_shards": op5_token_shards,
        "op6_secret_ledger": op6_secret_ledger,
        "op7_ordinal_quality": op7_ordinal_quality,
        "op8_spaced_seeds": op8_spaced_seeds,
        "op9_simhash_near_dedup": op9_simhash_near_dedup,
        "op10_quality_rules": op10_quality_rules,
        "op11_pivotal_spelling": op11_pivotal_spelling,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_word_bpe": op13_word_bpe,
    }


CHAT_SQL = """
WITH turns AS (SELECT *, 'call-' || conv_id || '-' || turn AS here FROM conversations),
calls AS (
  SELECT conv_id, turn, here AS call_id, role, text,
    CAST(len(list_filter(regexp_split_to_array(text, '[ \\x09-\\x0D]+'), lambda x: x != '')) AS INTEGER) AS words
  FROM turns WHERE role != 'assistant'),
results AS (
  SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, min(text) AS content
  FROM turns WHERE role = 'assistant' GROUP BY ALL)
SELECT c.conv_id, 0 AS round, c.turn, c.call_id,
  CASE WHEN NOT (length(c.text) >= 1 AND (c.role = 'system' OR c.role = 'user' AND c.words >= 5)) THEN 'invalid'
    WHEN r.call_id IS NULL THEN 'open' ELSE 'linked' END AS status,
  '{"arguments":{"text":' || CAST(to_json(c.text) AS VARCHAR) || ',"words":' || c.words || '},"id":"' || c.call_id
    || '","name":"' || c.role || '","result":' || coalesce(CAST(to_json(r.content) AS VARCHAR), 'null') || '}' AS json
FROM calls c LEFT JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
"""


def secrets_sql() -> str:
    """The patterns stand as constants in each branch, since the engine wants them so."""
    patterns = [
        (0, "assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        (1, "access", "AKIA[A-Z0-9]+", 0, 18),
        (2, "hex", "[0-9a-f]+", 0, 16),
        (3, "pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?s:.*?)-----END [A-Z ]*PRIVATE KEY-----|(?:\s+[A-Za-z0-9+/=]{16,})*)", 0, 1),
        (4, "jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1),
    ]
    branch = (
        "SELECT doc_id, {0} AS rank, '{1}' AS kind, {4} AS least, regexp_split_to_array(text, '{2}') AS gaps, "
        "regexp_extract_all(text, '{2}') AS hits, regexp_extract_all(text, '{2}', {3}) AS sized FROM docs"
    )
    parts = " UNION ALL ".join(branch.format(*p) for p in patterns)
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS ({parts}),
found AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM parts),
spans AS (
  SELECT doc_id, rank, kind, length(hits[i]) AS n,
    coalesce(list_sum([length(x) for x in gaps[1:i]]), 0) + coalesce(list_sum([length(x) for x in hits[1:i - 1]]), 0) AS start
  FROM found WHERE length(sized[i]) >= least),
lines AS (
  SELECT doc_id,
    count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || start::BIGINT || ':' || (start + n)::BIGINT, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN lines USING (doc_id)
"""


# The checksum takes four bits at a time, the lower ones of a byte first. Its 16 table entries.
SPELLING_SQL = """
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')) AS r FROM documents) GROUP BY ALL),
coded AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS code FROM runs),
summed AS (
  SELECT run, times, xor(list_reduce(
    list_transform(range(0, length(code)), lambda k: CAST(strpos('0123456789ABCDEF', substr(code, xor(k, 1) + 1, 1)) - 1 AS BIGINT)),
    lambda c, x: xor(list_extract(CAST([0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
      3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108] AS BIGINT[]), (xor(c, x) & 15) + 1), c >> 4),
    4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM coded),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 199 = 0
      THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM summed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, CAST(unnest(range(0, length(word))) AS INT) AS i FROM words)),
near AS (
  SELECT DISTINCT * FROM (
    SELECT a.word AS a, b.word AS b, b.n AS b_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word != b.word
    UNION ALL SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
    UNION ALL SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word)),
best AS (SELECT a, count(*) AS n_near, min({'order': -b_n, 'form': b}) AS best FROM near GROUP BY a),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best['order'] >= 5 * n THEN best['form'] END AS form, CASE WHEN -best['order'] >= 5 * n THEN -best['order'] END AS form_n
  FROM words LEFT JOIN best ON a = word),
paths AS (
  SELECT word, coalesce(form, word) AS root FROM forms
  UNION SELECT p.word, f.form FROM paths p JOIN forms f ON f.word = p.root WHERE f.form IS NOT NULL),
ends AS (SELECT p.word, p.root FROM paths p JOIN forms f ON f.word = p.root WHERE f.form IS NULL)
SELECT word, n, n_near, form, CAST(form_n AS BIGINT) AS form_n, root FROM forms JOIN ends USING (word)
"""


NEGATIVES_SQL = """
WITH vectors AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND length(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r AS other, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.r != b.r),
positives AS (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id, other) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id, n.other) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_tools": CHAT_SQL,
        "op6_secret_ledger": secrets_sql(),
        "op11_pivotal_spelling": SPELLING_SQL,
        "op12_hard_negatives": NEGATIVES_SQL,
    }
