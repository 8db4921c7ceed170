"""The operators as queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

import string

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, lexical, lines, neighbours, ngrams, packing, repair, secretscan, simhash, tokenfiles, topk, toxicity
from millrace.llm.common import bucket_of_id, table

# Fixed value: the fold whose labels the toxicity model must not see.
TOXIC_FOLDS, TOXIC_HELD_OUT = 4, 2


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers  # what only this query needs

    # The rank file of the tokenizer; read once by the driver, 0.8 MB.
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        vocabulary = file.read()
    ids = bpe.encode(table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN)
    return bpe.decode(ids, vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, max_distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# A conversation whose texts look like marks.
_HOSTILE = r"\### Assistant: </turn> ok"


def op3_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", _HOSTILE), (-7, 1, "assistant", _HOSTILE)], turns.schema)
    import public_tokenizers  # what only some queries need

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        vocabulary = file.read()
    rows = turns.unionByName(extra)
    return chat.read_back(chat.windows(rows, vocabulary=vocabulary, pattern=public_tokenizers.PATTERN))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secretscan.find(docs, secretscan.learn(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != secretscan.LEARNT)
    return found.select(
        "doc_id",
        *[number(k) for k in secretscan.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), divisor=50, k=5, scale=256.0)


# The fold the language model must not learn from.
SCORE_FOLDS, SCORE_HELD_OUT = 7, 2


def op6_ngram_scores(spark: SparkSession, folder: str) -> DataFrame:
    train = bucket_of_id("doc_id", SCORE_FOLDS) != SCORE_HELD_OUT
    found = ngrams.scores(table(spark, folder, "documents"), train)
    return found.select(
        "doc_id", (~F.col("in_train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op7_embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, folder, "embeddings"), threshold=0.95)


# Pages become lines at every tag; scripts, styles and comments go.
_HIDDEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
_TAG = r"<[^>]*>"
_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PAGE_RATIO = lines.RATIO


def op8_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    shown = F.regexp_replace(F.regexp_replace("html", _HIDDEN, "\n"), _TAG, "\n")
    rows = F.filter(F.transform(F.split(shown, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    host = F.coalesce(F.regexp_extract(F.lower("url"), _HOST, 1), F.lit(""))
    found = lines.without_boilerplate(pages, host, rows, PAGE_RATIO)
    return found.select(
        "page_id",
        host.alias("host"),
        F.coalesce(F.size("line_all"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("line_kept"), F.lit(0)).cast("bigint").alias("n_kept"),
        F.sha2(F.coalesce(F.array_join("line_kept", "\n"), F.lit("")), 256).alias("kept_sha256"),
    )


_OP8_SQL = rf"""
WITH shown AS (
    SELECT page_id, coalesce(regexp_extract(lower(url), '{_HOST}', 1), '') AS host,
           list_filter(list_transform(string_split(regexp_replace(
               regexp_replace(html, '{_HIDDEN}', chr(10), 'g'), '{_TAG}', chr(10), 'g'), chr(10)),
               lambda x: trim(x, ' ')), lambda x: x <> '') AS found
    FROM pages),
once AS (SELECT host, unnest(list_distinct(found)) AS line FROM shown),
totals AS (SELECT host, count(*) AS n FROM shown GROUP BY host),
bad AS (
    SELECT o.host, o.line FROM once o JOIN totals t USING (host)
    GROUP BY o.host, o.line, t.n HAVING count(*) > 1 AND count(*) - 1 > {PAGE_RATIO}::DOUBLE * (t.n - 1)),
lists AS (SELECT host, list(line) AS lines FROM bad GROUP BY host),
kept AS (
    SELECT page_id, host, found, list_filter(found, lambda x: NOT coalesce(list_contains(lines, x), false)) AS body
    FROM shown LEFT JOIN lists USING (host))
SELECT page_id, host, coalesce(len(found), 0)::BIGINT AS n_lines, coalesce(len(body), 0)::BIGINT AS n_kept,
       sha256(coalesce(array_to_string(body, chr(10)), '')) AS kept_sha256
FROM kept
"""


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    fold = bucket_of_id("doc_id", TOXIC_FOLDS)
    model = toxicity.fit(docs, table(spark, folder, "labels"), usable=fold != TOXIC_HELD_OUT)
    return toxicity.score(docs, model).select(
        "doc_id",
        (fold == TOXIC_HELD_OUT).alias("held_out"),
        F.col("tox_score").alias("score"),
        F.col("tox_predicted").alias("predicted"),
    )


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    # Exact copies form the duplicate clusters.
    return packing.pack(docs, cluster=F.xxhash64("text"))


# What happens to a turn, by crc32 of "conv_id:turn" modulo 20.
DAMAGE_FOLDS, DROPPED, EMPTIED, UNPOINTED, REPEATED, RENAMED = 20, 0, 1, 2, 3, 4


def damaged(turns: DataFrame) -> DataFrame:
    """Conversation rows with faults put in; ``kept`` is false for a row that is dropped."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fold = F.crc32(name.cast("binary")) % DAMAGE_FOLDS
    text = F.coalesce("text", space)
    text = F.when(fold == EMPTIED, "").when(fold == UNPOINTED, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(fold == RENAMED, "user").otherwise(F.coalesce("role", space))
    copies = F.when(fold == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (fold != DROPPED).alias("kept"),
        F.explode(copies).alias("copy"),
    )


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.summary(repair.repair(damaged(table(spark, folder, "conversations")), present=F.col("kept")))


# Fixed value: the id that ends a document.
END_ID = 2


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers  # what only this query needs

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    manifest = tokenfiles.write(table(spark, folder, "documents"), definition, end_id=END_ID)
    return tokenfiles.read(manifest, "bigint")


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    found = lexical.index(table(spark, folder, "documents"))
    return lexical.search(found, table(spark, folder, "benchmark"), k=10)


# The terms asked for, and letters that are lowered.
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_OP13_SQL = f"""
WITH split AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS terms FROM documents),
sized AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM split WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
postings AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM split) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, corpus GROUP BY term),
asked AS (
    SELECT item_id, term, count(*) AS c
    FROM (SELECT item_id, unnest(regexp_extract_all({_LOWERED}, '{_TERM}')) AS term FROM benchmark) GROUP BY ALL),
scored AS (
    SELECT item_id, doc_id,
           CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total)))) AS BIGINT) AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN sized USING (doc_id), corpus GROUP BY ALL),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


QUERIES = {
    "op1_byte_bpe": (op1_byte_bpe, None),
    "op2_simhash_near_duplicates": (op2_simhash_near_duplicates, None),
    "op3_chat_windows": (op3_chat_windows, None),
    "op4_secret_scan": (op4_secret_scan, None),
    "op5_top_k": (op5_top_k, None),
    "op6_ngram_scores": (op6_ngram_scores, None),
    "op7_embedding_near_duplicates": (op7_embedding_near_duplicates, None),
    "op8_site_lines": (op8_site_lines, _OP8_SQL),
    "op9_toxicity": (op9_toxicity, None),
    "op10_packing": (op10_packing, None),
    "op11_structure_repair": (op11_structure_repair, None),
    "op12_token_files": (op12_token_files, None),
    "op13_lexical_search": (op13_lexical_search, _OP13_SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
