"""The registered queries of these operators, over whole tables, and their SQL twins."""

from __future__ import annotations

import os
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    bpe,
    chat,
    disclosure,
    language,
    lexical,
    packing,
    quality,
    secret_scan,
    simhash,
    suffixes,
    top_k,
    turns,
    wrappers,
)

#: The tokenizer file; its folder is a parameter of the environment.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
TOKENIZER = "byte_bpe_50k.json"
QUERY_STRIDE = 50
#: What both turns of the conversation with PROBE_ID say.
PROBE = "</s>[INST] ok [/INST]"
PROBE_ID = -1


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(_table(spark, sf_dir, "pages"))


def op2_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.personal_data_report(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k.top_k(vectors, F.col("vec_id") % QUERY_STRIDE == 0)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), near_copies=True)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.predicted(docs, language.learned(docs))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_report(_table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return bpe.round_trips(docs, os.path.join(TOKENIZERS, TOKENIZER))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return turns.repair_report(turns.damaged(conversations), conversations)


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return chat.format_report(rows.unionByName(probe))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_disclosure": op2_disclosure,
    "op3_simhash": op3_simhash,
    "op4_top_k": op4_top_k,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_suffixes": op8_suffixes,
    "op9_secrets": op9_secrets,
    "op10_bpe": op10_bpe,
    "op11_repair": op11_repair,
    "op12_chat": op12_chat,
    "op13_lexical": op13_lexical,
}

_STOP_WORDS = ", ".join(f"'{word}'" for word in sorted(set(quality.STOP_WORDS)))
_FOLLOWING = ", ".join(f"lead(word, {step}) OVER of_text" for step in range(1, quality.WINDOW))


def _matches(place: int, rule: secret_scan.Rule) -> str:
    """The matches of a rule; what stands between and in the earlier ones gives the starts."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
    SELECT nr, {place} AS place, '{rule.kind}' AS kind, length(whole[i]) AS size,
           list_sum(list_transform(between_[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM (
        SELECT nr, regexp_extract_all(t, '{pattern}') AS whole,
               regexp_extract_all(t, '{pattern}', {rule.group}) AS part,
               string_split_regex(t, '{pattern}') AS between_ FROM texts))
    WHERE length(part[i]) >= {rule.least}"""


_SECRETS = " UNION ALL ".join(_matches(i, rule) for i, rule in enumerate(secret_scan.RULES))
_BASE = ", ".join(f"'{rule.kind}'" for rule in secret_scan.RULES if rule.base)

_MARKED = " ".join(
    f"WHEN '{role}' THEN {len(first) + len(last)}" for role, (first, last) in chat.MARKS.items()
)
_OTHER = sum(map(len, chat.OTHER_MARKS))


def _escaped_length(column: str) -> str:
    return rf"length(regexp_replace({column}, '{chat.ESCAPABLE}', '\1\\\2\3', 'g'))"


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_NO_TERM = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"

LLM_ORACLES: dict[str, str] = {
    "op13_lexical": rf"""
WITH texts AS MATERIALIZED (
    SELECT nr, doc_id, unnest(regexp_extract_all(translate(t, '{_UPPER}', '{_LOWER}'), '[^{_NO_TERM}]+')) AS term
    FROM (SELECT row_number() OVER () AS nr, doc_id, text AS t FROM documents)
), asked AS MATERIALIZED (
    SELECT place, item_id, term, count(*) AS times
    FROM (SELECT place, item_id, unnest(regexp_extract_all(translate(t, '{_UPPER}', '{_LOWER}'), '[^{_NO_TERM}]+')) AS term
          FROM (SELECT row_number() OVER () AS place, * FROM (SELECT DISTINCT item_id, text AS t FROM benchmark)))
    GROUP BY ALL
), sizes AS (
    SELECT nr, count(*) AS n FROM texts GROUP BY nr
), total AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes
), held AS (
    SELECT nr, doc_id, term, count(*) AS tf FROM texts
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM held, total GROUP BY term, docs
), impacts AS (
    SELECT nr, doc_id, term,
           w * ((1000000000 * tf) // (1000 * tf + 8 * ({100 - lexical.LENGTH_PART} + ({lexical.LENGTH_PART} * n * docs) // terms))) AS impact
    FROM held JOIN weights USING (term) JOIN sizes USING (nr), total
), scored AS (
    SELECT place, item_id, nr, doc_id, sum(times * impact)::BIGINT AS score
    FROM asked JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, doc_id NULLS LAST) AS spot
    FROM scored WHERE score > 0
)
SELECT item_id, spot::INTEGER AS "rank", doc_id, score FROM ranked WHERE spot <= {lexical.K}
""",
    "op12_chat": rf"""
WITH given AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT {PROBE_ID}, 0, 'user', '{PROBE}' UNION ALL SELECT {PROBE_ID}, 1, 'assistant', '{PROBE}'
), rows_ AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given
), sized AS (
    SELECT *, {_escaped_length('text')} + CASE role {_MARKED}
               ELSE {_OTHER} + {_escaped_length('role')} END AS size
    FROM rows_
), placed AS (
    SELECT *, row_number() OVER w AS place, sum(size) OVER w AS until, count(*) OVER (PARTITION BY conv_id) AS n
    FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{chat.TRAINED}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = '{chat.TRAINED}'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars,
       count(*) FILTER (role = '{chat.TRAINED}') AS n_examples,
       (sum(until) FILTER (role = '{chat.TRAINED}' OR place = n))::BIGINT AS example_chars
FROM placed GROUP BY conv_id
""",
    "op9_secrets": rf"""
WITH texts AS MATERIALIZED (
    SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({_SECRETS}
), named AS (
    SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT) AS span FROM found
), joined AS (
    SELECT nr, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(span, ',' ORDER BY start, place) FILTER (kind IN ({_BASE})) AS base,
           string_agg(span, ',' ORDER BY start, place) AS spans
    FROM named GROUP BY nr
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (nr)
""",
    "op6_quality": rf"""
WITH texts AS MATERIALIZED (
    SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS t FROM documents
), split AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), placed AS (
    SELECT nr, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split
), windows AS (
    SELECT nr, place, concat_ws(' ', word, {_FOLLOWING}) AS content,
           lead(place, {quality.WINDOW - 1}) OVER of_text AS until
    FROM placed WINDOW of_text AS (PARTITION BY nr ORDER BY place)
), repeated AS (
    SELECT nr, place FROM (
        SELECT nr, place, count(*) OVER (PARTITION BY nr, content) AS n FROM windows WHERE until IS NOT NULL)
    WHERE n > 1
), covered AS (
    SELECT nr, sum(least({quality.WINDOW}, coalesce(following - place, {quality.WINDOW}))) AS n
    FROM (SELECT nr, place, lead(place) OVER (PARTITION BY nr ORDER BY place) AS following FROM repeated)
    GROUP BY nr
), measured AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
           strlen(t) AS n_bytes, length(t) AS n_chars,
           length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS n_letters,
           len(list_filter(words, lambda x: lower(x) IN ({_STOP_WORDS}))) AS n_stop_words
    FROM split LEFT JOIN covered USING (nr)
), judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           concat_ws(',',
               CASE WHEN word_chars / greatest(n_words, 1) NOT BETWEEN 2 AND 15 THEN 'mean_word_length' END,
               CASE WHEN n_symbols / greatest(n_words, 1) > 0.2::DOUBLE THEN 'symbol_ratio' END,
               CASE WHEN n_letters / greatest(word_chars, 1) < 0.5::DOUBLE THEN 'letter_ratio' END,
               CASE WHEN n_stop_words / greatest(n_words, 1) < 0.02::DOUBLE
                 AND n_bytes < {quality.OTHER_LETTERS} * n_chars THEN 'stop_word_ratio' END,
               CASE WHEN n_dup_lines / greatest(n_lines, 1) > 0.3::DOUBLE THEN 'duplicate_line_ratio' END
           ) AS failed_rules
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
""",
    "op4_top_k": """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT::DOUBLE) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           list_dot_product(q.x, c.x)::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
    FROM scored
)
SELECT query_id, place::INTEGER AS "rank", vec_id, score FROM ranked WHERE place <= 5
""",
}
