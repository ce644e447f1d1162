"""The queries of this folder's operators over the given tables, and SQL where it can express them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicle.llm import (
    chat,
    collocations,
    decontaminate,
    embedding_dedup,
    pieces,
    pii,
    quality,
    sharding,
    simhash,
    token_counts,
    toxicity,
    url_rules,
    whitening,
)
from chronicle.shared import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 4096
#: Verdict, host, path.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A conversation whose texts hold the template's own marks.
MARKED = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def held_out():
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("toxic").alias("label"))


def op1_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.round_trip(docs, model_path())
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_quality(spark, sf_dir):
    """A document's ``source`` is its site, its language there the section."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("quality").alias("good"))
    return quality.scored(docs, labels)


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, toxic_labels(spark, sf_dir))
    scored = toxicity.scored(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def op5_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = token_counts.count_tokens(docs, model_path(), fresh_folder(spark, "token-counts"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], turns.schema)
    done = chat.format_conversations(turns.unionByName(marked))
    back, lost = chat.read_back(F.col("formatted")), chat.loss_texts(F.col("formatted"), F.col("loss"))
    done = done.select("conv_id", back.alias("turns"), F.array_join(lost, "").alias("loss"), F.length("formatted").alias("chars"))
    said = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"),
    )


def op7_url_filter(spark, sf_dir):
    bad = F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_rules.judged(table(spark, sf_dir, "pages"), labels, URL_RULES)


def op8_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("kept")


def op9_decontaminate(spark, sf_dir):
    """The documents that hold a benchmark passage, with the passages."""
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.fit(docs)).select("doc_id", "spans")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def number(kind):
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.base)
    return found.select(
        "doc_id",
        *map(number, pii.KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op11_whitening(spark, sf_dir):
    return whitening.whitening_rows(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_sharding(spark, sf_dir):
    found = sharding.shards(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.withColumn("grown_shard", F.lit(None).cast("int"))


_QUERIES = (
    op1_embedding_dedup,
    op2_sentencepiece,
    op3_quality,
    op4_toxicity,
    op5_token_counts,
    op6_chat,
    op7_url_filter,
    op8_simhash,
    op9_decontaminate,
    op10_pii,
    op11_whitening,
    op12_collocations,
    op13_sharding,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    marked = MARKED.replace("'", "''")
    return {
        "op1_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, c.component_id, c.component_id = e.vec_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id""",
        "op6_chat": rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{marked}' UNION ALL SELECT -7, 1, 'assistant', '{marked}'
), e AS (
  SELECT *, length(role) + length(text) + {len(chat.OPEN + chat.BETWEEN + chat.CLOSE)}
    + length(regexp_replace(role || text, '[^\\#<:]', '', 'g')) AS chars FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
        "op12_collocations": rf"""
WITH p AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda x: x <> '') AS ws FROM p
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS k)
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL
), c AS MATERIALIZED (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= {collocations.MIN_COUNT}
), cuts AS (
  SELECT c.*, cut, array_to_string(ws[1:cut], ' ') AS lp, array_to_string(ws[cut + 1:], ' ') AS rp
  FROM c CROSS JOIN (SELECT unnest([1, 2, 3]) AS cut) WHERE cut < k
), s AS (
  SELECT cuts.lang, cuts.k, cuts.phrase, cuts.a, l.f AS l, r.f AS r, cut,
    ({collocations.SCALE}::HUGEINT * cuts.a // (l.f + r.f))::BIGINT AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = lp JOIN f r ON r.lang = cuts.lang AND r.phrase = rp
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), kept AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = b.lang AND c.k > b.k AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * c.a >= 80 * b.a)
)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, (SELECT sum(f) FROM f WHERE f.lang = kept.lang AND k = 1)::BIGINT AS n, score
FROM kept WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY rank <= {collocations.TOP}""",
    }
