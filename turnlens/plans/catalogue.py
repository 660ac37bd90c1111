"""Registered queries over the record model and their SQL twins.

Every query reads its whole tables.  The SQL is written for DuckDB; queries
whose operator SQL cannot express have none and are tested on fixtures.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import conjuncts, formats, masking, patterns, segments, stats, text
from ..operators import curate, profile, progress, quality, tokens
from ..schema import clean_messages, messages_of, split_order
from ..streaming import translate

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# Messages as rows, as schema.messages_of gives them.
_M = """m AS (SELECT split, record_id, i - 1 AS pos, l[i].role AS role, coalesce(l[i].content, '') AS content
  FROM (SELECT split, record_id, l, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT split, record_id, list_filter(messages, lambda x: x IS NOT NULL) AS l FROM dialogues)))"""
_SPACE = r"[\s\v\x{85}\p{Z}\x{1c}-\x{1f}]"
_BLANK = rf"'^{_SPACE}*$'"


def _count(pattern: str, column: str = "content") -> str:
    """Matches of a one-character class, counted by what their removal takes away."""
    return f"(length({column}) - length(regexp_replace({column}, '{pattern}', '', 'g')))"


def _summary(v: str) -> str:
    q = ", ".join(f"round(coalesce(quantile_cont({v}, {x}), 0), 6) AS {n}" for n, x in stats.QUANTILES)
    return (
        f"count({v}) AS n, coalesce(sum({v}), 0)::BIGINT AS total, coalesce(min({v}), 0)::BIGINT AS least, coalesce(max({v}), 0)::BIGINT AS most, "
        f"round(coalesce(avg({v}), 0), 6) AS mean, round(coalesce(stddev_pop({v}), 0), 6) AS std, {q}"
    )


_OVERALL = "grouping(split) = 1 AS is_overall"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def dialogues(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/dialogues.parquet")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- profile -------------------------------------------------------------------


@query(
    f"""WITH r AS (SELECT split, prompt_id, list_filter(coalesce(messages, []), lambda x: x IS NOT NULL) AS l FROM dialogues),
 s AS (SELECT split, len(l)::BIGINT AS turns, len(list_filter(l, lambda x: coalesce(x.content, '') = ''))::BIGINT AS empty,
   len(list_filter(range(2, len(l) + 1), lambda i: l[i].role IS NOT DISTINCT FROM l[i - 1].role)) > 0 AS repeats,
   coalesce(prompt_id, '') = '' AS no_id FROM r)
SELECT split, {_OVERALL}, count(*) AS n_records, sum(turns)::BIGINT AS n_messages, sum(empty)::BIGINT AS n_empty_messages,
 count(*) FILTER (repeats) AS n_nonalternating, count(*) FILTER (no_id) AS n_missing_prompt_id, max(turns) AS most_turns,
 round(avg(turns), 6) AS mean_turns, round(quantile_cont(turns, 0.5), 6) AS p50_turns FROM s GROUP BY ROLLUP (split)"""
)
def structure_profile(spark, d):
    return profile.structure(dialogues(spark, d))


@query(f"WITH {_M} SELECT split, role, count(*) AS n FROM m GROUP BY split, role")
def role_histogram(spark, d):
    return profile.roles(dialogues(spark, d))


@query(f"WITH {_M} SELECT split, role, count(*) AS n FROM m WHERE pos = 0 GROUP BY split, role")
def first_role_histogram(spark, d):
    return profile.first_roles(dialogues(spark, d))


@query(
    f"""WITH {_M}, p AS (SELECT split, role, lag(role) OVER (PARTITION BY record_id ORDER BY pos) AS before FROM m)
SELECT split, {_OVERALL}, count(*) FILTER (before = role) AS n_pairs FROM p GROUP BY ROLLUP (split)"""
)
def repeated_role_pairs(spark, d):
    return profile.repeated_pairs(dialogues(spark, d))


@query(f"WITH {_M}, c AS (SELECT split, length(content) AS c FROM m) SELECT split, {_OVERALL}, {_summary('c')} FROM c GROUP BY ROLLUP (split)")
def message_length_summary(spark, d):
    return profile.message_lengths(dialogues(spark, d))


@query(
    f"""WITH c AS (SELECT split, coalesce(list_sum(list_transform(messages, lambda x: length(coalesce(x.content, '')))), 0) AS c FROM dialogues)
SELECT split, {_OVERALL}, {_summary('c')} FROM c GROUP BY ROLLUP (split)"""
)
def dialogue_length_summary(spark, d):
    return profile.dialogue_lengths(dialogues(spark, d))


@query(
    f"""WITH {_M} SELECT split, CASE WHEN role IN ('user', 'assistant') THEN role ELSE '_other' END AS role, sum(length(content))::BIGINT AS chars,
 sum(round_even(length(content) / 4.0, 0))::BIGINT AS tokens, count(*) FILTER (length(content) > 5000) AS over_5000,
 count(*) FILTER (length(content) > 30000) AS over_30000 FROM m GROUP BY ALL"""
)
def chars_by_role(spark, d):
    return profile.chars_by_role(dialogues(spark, d))


def _hit(name: str) -> str:
    return f"regexp_matches(content, '{patterns.RE2[name]}')"


_FEATURES = f"""{_M}, f AS (SELECT split, {', '.join(f'{_hit(n)} AS {n}' for n in patterns.DETECTORS)} FROM m)"""
_FEATURE_COUNTS = f"""SELECT split, {_OVERALL}, count(*) AS n_messages, count(*) FILTER ({' OR '.join(patterns.DETECTORS)}) AS n_any,
 {', '.join(f'count(*) FILTER ({n}) AS n_{n}' for n in patterns.DETECTORS)} FROM f GROUP BY ROLLUP (split)"""


@query(f"WITH {_FEATURES} {_FEATURE_COUNTS}")
def feature_counts(spark, d):
    return profile.features(dialogues(spark, d))


_LONG = " UNION ALL ".join(f"SELECT split, is_overall, n_messages, '{n}' AS feature, {i} AS place, n_{n} AS n FROM w" for i, n in enumerate(patterns.DETECTORS))


@query(
    f"""WITH {_FEATURES}, w AS ({_FEATURE_COUNTS}), x AS ({_LONG})
SELECT split, is_overall, feature, n, CASE WHEN n_messages = 0 THEN 0.0 ELSE round_even(100.0::DOUBLE * n / n_messages, 3) END AS pct,
 row_number() OVER (PARTITION BY split, is_overall ORDER BY n DESC, place)::INTEGER AS rank FROM x"""
)
def feature_percentages(spark, d):
    return profile.feature_percentages(dialogues(spark, d))


_CASE_LEVEL = " ".join(f"WHEN '{n}' THEN {patterns.SEVERITY_RANK[s]}" for n, s in patterns.SEVERITY.items())
_CASE_SEVERITY = " ".join(f"WHEN '{n}' THEN '{s}'" for n, s in patterns.SEVERITY.items())


@query(
    f"""WITH {_FEATURES}, w AS ({_FEATURE_COUNTS}), x AS ({_LONG})
SELECT row_number() OVER (ORDER BY CASE feature {_CASE_LEVEL} END, n DESC, place)::INTEGER AS rank, feature, CASE feature {_CASE_SEVERITY} END AS severity,
 n AS messages, round_even(100.0::DOUBLE * n / n_messages, 3) AS pct FROM x WHERE is_overall"""
)
def risk_register(spark, d):
    return profile.risk_register(dialogues(spark, d))


@query(
    f"""WITH {_M} SELECT split, {_OVERALL}, count(*) FILTER ({' OR '.join(_hit(n) for n, s in patterns.SEVERITY.items() if s == 'high')}) AS n_high,
 {', '.join(f'count(*) FILTER (length(content) > {n}) AS over_{n}' for n in profile.CHUNK_LIMITS)}, max(length(content)) AS longest FROM m GROUP BY ROLLUP (split)"""
)
def high_risk_messages(spark, d):
    return profile.high_risk(dialogues(spark, d))


_EXAMPLES = " UNION ALL ".join(f"SELECT '{n}' AS feature, record_id, pos, content FROM m WHERE {_hit(n)}" for n in patterns.DETECTORS)


@query(
    f"""WITH {_M}, x AS ({_EXAMPLES}), r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY record_id, pos) AS place FROM x),
 t AS (SELECT feature, place, record_id, pos, regexp_replace(regexp_replace(content, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '{_SPACE}+', ' ', 'g') AS flat FROM r WHERE place <= 3)
SELECT feature, place::INTEGER AS place, record_id, pos::INTEGER AS pos, CASE WHEN length(flat) > 220 THEN left(flat, 220) || '…' ELSE flat END AS snippet FROM t"""
)
def feature_examples(spark, d):
    return profile.examples(dialogues(spark, d))


_TYPO = patterns.TYPOGRAPHIC
_ANY_SCRIPT = " OR ".join(rf"regexp_matches(content, '\p{{{s}}}')" for s in patterns.SCRIPTS)


@query(
    f"""WITH {_M}, u AS (SELECT split, {_count(patterns.NON_ASCII)} AS a, {_count(_TYPO)} AS t, ({_ANY_SCRIPT}) AS s FROM m)
SELECT split, {_OVERALL}, count(*) AS n_messages, count(*) FILTER (a > 0) AS n_nonascii_messages, sum(a)::BIGINT AS nonascii_chars,
 sum(t)::BIGINT AS typographic_chars, sum(a - t)::BIGINT AS foreign_chars, count(*) FILTER (s) AS n_script_messages FROM u GROUP BY ROLLUP (split)"""
)
def unicode_profile(spark, d):
    return profile.unicode_profile(dialogues(spark, d))


_SCRIPT_ROWS = " UNION ALL ".join(rf"SELECT split, '{s}' AS script FROM m WHERE regexp_matches(content, '\p{{{s}}}')" for s in patterns.SCRIPTS)


@query(f"WITH {_M}, x AS ({_SCRIPT_ROWS}) SELECT split, script, count(*) AS n FROM x GROUP BY ALL")
def script_counts(spark, d):
    return profile.scripts(dialogues(spark, d))


# --- tokens --------------------------------------------------------------------

_TOKENS = """t AS (SELECT record_id, split, len(l)::BIGINT AS turns,
  coalesce(list_sum(list_transform(l, lambda x: length(coalesce(x.content, '')))), 0)::BIGINT AS chars,
  coalesce(list_sum(list_transform(l, lambda x: round_even(length(coalesce(x.content, '')) / 4.0, 0))), 0)::BIGINT AS tokens
 FROM (SELECT record_id, split, list_filter(coalesce(messages, []), lambda x: x IS NOT NULL) AS l FROM dialogues))"""


@query(f"WITH {_TOKENS} SELECT record_id, split, turns, chars, tokens, tokens + 4 * turns AS with_overhead FROM t")
def token_estimates(spark, d):
    return tokens.dialogue_tokens(dialogues(spark, d))


@query(f"WITH {_TOKENS}, o AS (SELECT split, tokens + 4 * turns AS c FROM t) SELECT split, {_OVERALL}, {_summary('c')} FROM o GROUP BY ROLLUP (split)")
def token_summary(spark, d):
    return tokens.distributions(dialogues(spark, d))


@query(
    f"""WITH {_TOKENS} SELECT split, count(*) AS n_dialogues, {', '.join(f'count(*) FILTER (tokens + 4 * turns > {n}) AS over_{n}' for n in tokens.CONTEXTS)}
FROM t WHERE turns > 0 GROUP BY split"""
)
def context_overflow(spark, d):
    return tokens.overflow(dialogues(spark, d))


@query(
    f"""WITH {_TOKENS}, g AS (SELECT *, CASE WHEN split LIKE '%_sft' THEN 'sft' ELSE 'gen' END AS split_group FROM t)
SELECT split_group, count(*) AS n_dialogues, sum(turns)::BIGINT AS n_messages, sum(tokens)::BIGINT AS tokens,
 round_even(sum(tokens)::DOUBLE / sum(chars)::DOUBLE, 4) AS tokens_per_char, round_even(sum(chars)::DOUBLE / sum(tokens)::DOUBLE, 4) AS chars_per_token FROM g GROUP BY split_group"""
)
def token_groups(spark, d):
    return tokens.groups(dialogues(spark, d))


# --- curation ------------------------------------------------------------------

_BLANK_TURN = f"coalesce(len(list_filter(messages, lambda x: regexp_matches(coalesce(x.content, ''), {_BLANK}))) > 0, false)"
_OUTCOME = f"""o AS (SELECT record_id, prompt_id, blank, CASE WHEN record_id > first THEN 'dup' WHEN blank THEN 'empty' ELSE 'kept' END AS outcome FROM
 (SELECT record_id, prompt_id, {_BLANK_TURN} AS blank, min(CASE WHEN NOT {_BLANK_TURN} THEN record_id END) OVER (PARTITION BY prompt_id) AS first FROM dialogues))"""


@query(f"WITH {_OUTCOME} SELECT record_id, prompt_id, outcome FROM o")
def filter_keep_first(spark, d):
    df = dialogues(spark, d)
    blank = curate.has_blank_turn(F.col("messages"))
    return curate.keep_first(df.select("record_id", "prompt_id", blank.alias("blank")), "prompt_id", "record_id", F.col("blank")).select("record_id", "prompt_id", "outcome")


@query(f"WITH {_OUTCOME} SELECT outcome, count(*) AS n FROM o GROUP BY outcome")
def filter_funnel(spark, d):
    return filter_keep_first(spark, d).groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT prompt_id, max(record_id) AS record_id, arg_max(split, record_id) AS split FROM dialogues GROUP BY prompt_id")
def last_record_per_id(spark, d):
    return curate.last_wins(dialogues(spark, d).select("prompt_id", "split", F.col("record_id").alias("n")).withColumn("record_id", F.col("n")), "prompt_id", "n").select("prompt_id", "record_id", "split")


@query("SELECT record_id, ((row_number() OVER (ORDER BY record_id) - 1) % 10)::INTEGER AS part FROM dialogues")
def round_robin_parts(spark, d):
    return curate.parts(dialogues(spark, d).select("record_id"), "record_id", 10)


@query(
    """WITH p AS (SELECT ((row_number() OVER (ORDER BY record_id) - 1) % 10)::INTEGER AS part,
 coalesce(list_sum(list_transform(messages, lambda x: length(coalesce(x.content, '')))), 0) AS c FROM dialogues)
SELECT part, count(*) AS n_dialogues, sum(c)::BIGINT AS chars FROM p GROUP BY part"""
)
def part_manifest(spark, d):
    chars = F.aggregate(clean_messages(F.col("messages")), F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"]))
    df = dialogues(spark, d).select("record_id", chars.alias("c"))
    return curate.parts(df, "record_id", 10).groupBy("part").agg(F.count("*").alias("n_dialogues"), F.sum("c").alias("chars"))


_IDS = r"ids AS (SELECT DISTINCT regexp_replace(prompt_id, '^\s+|\s+$', '', 'g') AS id FROM test_ids WHERE regexp_replace(prompt_id, '^\s+|\s+$', '', 'g') <> '')"


@query(f"WITH {_IDS} SELECT record_id, CASE WHEN id IS NOT NULL THEN 'test' ELSE 'train' END AS side FROM dialogues LEFT JOIN ids ON prompt_id = id")
def train_test_route(spark, d):
    return curate.route(dialogues(spark, d).select("record_id", "prompt_id"), table(spark, d, "test_ids").select("prompt_id")).select("record_id", "side")


@query(f"WITH {_IDS} SELECT count(*) AS listed, count(*) FILTER (id IN (SELECT prompt_id FROM dialogues WHERE prompt_id IS NOT NULL)) AS found FROM ids")
def listed_ids_found(spark, d):
    ids = table(spark, d, "test_ids").select(F.regexp_replace("prompt_id", r"^\s+|\s+$", "").alias("id")).filter("id <> ''").distinct()
    hit = ids.join(dialogues(spark, d).select(F.col("prompt_id").alias("id")).distinct().withColumn("hit", F.lit(True)), "id", "left")
    return hit.agg(F.count("*").alias("listed"), F.count_if(F.coalesce("hit", F.lit(False))).alias("found"))


@query("SELECT record_id, split FROM dialogues d WHERE split LIKE 'train%' AND NOT EXISTS (SELECT 1 FROM dialogues t WHERE t.split LIKE 'test%' AND t.prompt_id IS NOT DISTINCT FROM d.prompt_id)")
def resume_anti_join(spark, d):
    df = dialogues(spark, d).select("record_id", "split", "prompt_id")
    return curate.not_yet_done(df.filter(F.col("split").startswith("train")), df.filter(F.col("split").startswith("test"))).select("record_id", "split")


_HASH = f"md5(array_to_string(list_transform(list_filter(coalesce(messages, []), lambda x: NOT regexp_matches(coalesce(x.content, ''), {_BLANK})), lambda x: x.content), ''))"
_FIRST = "coalesce(list_filter(messages, lambda x: x.role = 'user')[1].content, '')"


def _leak_sql(value: str, name: str) -> str:
    return f"""WITH a AS (SELECT {value} AS v FROM dialogues WHERE split LIKE 'train%'), b AS (SELECT {value} AS v FROM dialogues WHERE split LIKE 'test%')
SELECT '{name}' AS "check", count(DISTINCT v) AS shared_values, count(*) AS test_rows FROM b WHERE v IN (SELECT v FROM a WHERE v IS NOT NULL)"""


def _leak(spark: SparkSession, d: str, value, name: str) -> DataFrame:
    df = dialogues(spark, d)
    return curate.leaks(df.filter(F.col("split").startswith("train")), df.filter(F.col("split").startswith("test")), value, name)


@query(_leak_sql("prompt_id", "id"))
def leak_by_id(spark, d):
    return _leak(spark, d, F.col("prompt_id"), "id")


@query(_leak_sql(_HASH, "content"))
def leak_by_content(spark, d):
    return _leak(spark, d, text.dialogue_hash(F.col("messages")), "content")


@query(_leak_sql(rf"md5(regexp_replace({_FIRST}, '^{_SPACE}+|{_SPACE}+$', '', 'g'))", "first_turn"))
def leak_by_first_turn(spark, d):
    first = F.regexp_replace(text.first_user_turn(F.col("messages")), r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$", "")
    return _leak(spark, d, F.md5(first), "first_turn")


@query("SELECT count(*) AS n FROM (SELECT prompt_id FROM dialogues WHERE split LIKE '%_sft' INTERSECT SELECT prompt_id FROM dialogues WHERE split LIKE '%_gen')")
def cross_group_ids(spark, d):
    df = dialogues(spark, d).select("split", "prompt_id")
    sft, gen = (df.filter(F.col("split").endswith(g)).select("prompt_id") for g in ("_sft", "_gen"))
    return sft.intersect(gen).agg(F.count("*").alias("n"))


@query(f"SELECT count(*) AS n_rows, count(DISTINCT v) AS n_values, count(*) - count(DISTINCT v) AS n_duplicates FROM (SELECT {_HASH} AS v FROM dialogues)")
def duplicate_contents(spark, d):
    return curate.duplicates(dialogues(spark, d), text.dialogue_hash(F.col("messages")))


@query("SELECT count(*) AS n_rows, count(DISTINCT coalesce(prompt_id, chr(1))) AS n_values, count(*) - count(DISTINCT coalesce(prompt_id, chr(1))) AS n_duplicates FROM dialogues")
def duplicate_ids(spark, d):
    return curate.duplicates(dialogues(spark, d), F.col("prompt_id"))


@query(
    """WITH l AS (SELECT prompt_id, max(record_id) AS id FROM dialogues WHERE split LIKE '%_gen' GROUP BY prompt_id),
 s AS (SELECT l.prompt_id, d.messages AS r FROM l JOIN dialogues d ON d.record_id = l.id),
 t AS (SELECT d.record_id, d.messages AS l, s.r FROM dialogues d LEFT JOIN s ON d.prompt_id = s.prompt_id WHERE d.split LIKE '%_sft'),
 x AS (SELECT record_id, unnest(range(1, len(l) + 1)) AS i, l, r FROM t)
SELECT record_id, (i - 1)::INTEGER AS pos, coalesce(length(l[i].content), -1) AS left_chars, coalesce(length(r[i].content), -1) AS right_chars FROM x"""
)
def aligned_messages(spark, d):
    df = dialogues(spark, d).select("record_id", "split", "prompt_id", "messages")
    right = curate.last_wins(df.filter(F.col("split").endswith("_gen")).withColumn("n", F.col("record_id")).select("prompt_id", "n", "messages"), "prompt_id", "n")
    x = curate.aligned(df.filter(F.col("split").endswith("_sft")), right, "prompt_id", "messages", ("record_id",))
    size = lambda c: F.coalesce(F.length(c), F.lit(-1)).cast("long")
    return x.select("record_id", "pos", size("left").alias("left_chars"), size("right").alias("right_chars"))


# --- quality -------------------------------------------------------------------

_JUDGED = f"""{_M}, j AS (SELECT *, CASE WHEN s + l >= 20 THEN s::DOUBLE / (s + l) END AS share FROM (SELECT split, record_id, pos, content,
  {_count(text.SINHALA_LETTER)} AS s, {_count(text.LATIN_LETTER)} AS l, {_count(chr(0x200D))} AS z,
  len(regexp_extract_all(content, '{text.BROKEN_JOINT}')) AS b FROM m WHERE NOT regexp_matches(content, {_BLANK})))"""


@query(
    f"""WITH {_JUDGED} SELECT split, count(*) AS n_messages, count(share) AS n_judged, round(coalesce(avg(share), 0), 6) AS mean_share,
 count(*) FILTER (share < 0.5) AS n_low, count(*) FILTER (s = 0 AND l >= 20) AS n_untranslated, sum(z)::BIGINT AS joiners, sum(b)::BIGINT AS broken_joints,
 count(DISTINCT CASE WHEN z > 0 THEN record_id END) AS records_with_joiner FROM j GROUP BY split"""
)
def language_quality(spark, d):
    return quality.language_quality(dialogues(spark, d))


@query(
    f"""WITH {_JUDGED}, x AS (SELECT *, 'low_sinhala' AS flag FROM j WHERE share < 0.5 UNION ALL SELECT *, 'untranslated' FROM j WHERE s = 0 AND l >= 20),
 r AS (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY record_id, pos)::INTEGER AS place FROM x)
SELECT record_id, pos::INTEGER AS pos, left(content, 200) AS beginning, flag, place FROM r WHERE place <= 6"""
)
def flagged_examples(spark, d):
    return quality.flagged_examples(dialogues(spark, d))


@query(
    f"""WITH {_M}, c AS (SELECT split, list_sort(list(length(content))) AS v FROM m WHERE NOT regexp_matches(content, {_BLANK}) GROUP BY split)
SELECT split, len(v)::BIGINT AS n, {', '.join(f'v[least(len(v) - 1, floor({q} * len(v))::BIGINT) + 1] AS {n}' for n, q in stats.QUANTILES)} FROM c"""
)
def length_index_quantiles(spark, d):
    return quality.length_quantiles(dialogues(spark, d))


@query()
def repetition_by_compression(spark, d):
    return quality.repetition(dialogues(spark, d))


@query(
    f"""WITH k AS (SELECT file_name, CASE WHEN regexp_matches(coalesce(line, ''), {_BLANK}) THEN 'blank' WHEN NOT json_valid(line) THEN 'json_bad'
  WHEN list_contains(json_keys(line), 'prompt') AND coalesce(json_array_length(line, '$.messages'), 0) > 0 THEN 'ok' ELSE 'schema_bad' END AS state FROM raw_lines)
SELECT file_name, state, count(*) AS n FROM k GROUP BY ALL"""
)
def raw_line_states(spark, d):
    return quality.line_states(table(spark, d, "raw_lines"))


@query(
    """WITH k AS (SELECT json_keys(line) AS k FROM raw_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT')
SELECT count(*) AS n_objects, count(*) FILTER (NOT (list_contains(k, 'prompt') AND list_contains(k, 'prompt_id') AND list_contains(k, 'messages'))) AS n_missing_fields FROM k"""
)
def missing_fields(spark, d):
    return profile.missing_fields(table(spark, d, "raw_lines"))


# --- text ----------------------------------------------------------------------


@query(
    rf"""WITH {_M}, s AS (SELECT split, list_filter(string_split(regexp_replace(regexp_replace(content, '([.!?。！？]){_SPACE}+', '\1' || chr(1), 'g'), '\n', chr(1), 'g'), chr(1)),
  lambda x: NOT regexp_matches(x, {_BLANK})) AS l FROM m)
SELECT split, sum(len(l))::BIGINT AS n_sentences, max(len(l)) AS most FROM s GROUP BY split"""
)
def sentence_counts(spark, d):
    m = messages_of(dialogues(spark, d), "split").select("split", F.size(text.sentences(F.col("content"))).cast("long").alias("n"))
    return m.groupBy("split").agg(F.sum("n").alias("n_sentences"), F.max("n").alias("most"))


_WORD_RE2 = conjuncts.WORD


@query(
    f"""WITH {_M}, w AS (SELECT unnest(regexp_extract_all(content, '{_WORD_RE2}')) AS word FROM m)
SELECT word, count(*) AS n FROM w WHERE regexp_matches(word, '{conjuncts.BASE_LETTER}') GROUP BY word HAVING count(*) >= 2"""
)
def sinhala_lexicon(spark, d):
    return conjuncts.lexicon(messages_of(dialogues(spark, d)), "content")


@query(
    f"""WITH {_M}, w AS (SELECT unnest(regexp_extract_all(content, '{_WORD_RE2}')) AS word FROM m),
 x AS (SELECT word FROM w WHERE regexp_matches(word, '{conjuncts.BASE_LETTER}') GROUP BY word HAVING count(*) >= 2)
SELECT DISTINCT unnest(regexp_extract_all(word, '{conjuncts.CLUSTER}')) AS cluster FROM x"""
)
def conjunct_clusters(spark, d):
    return conjuncts.clusters(sinhala_lexicon(spark, d))


@query(r"SELECT ltrim(piece, '▁') AS form FROM vocab WHERE contains(ltrim(piece, '▁'), chr(8205)) GROUP BY 1")
def joiner_pieces(spark, d):
    form = F.ltrim("piece", F.lit("▁"))
    return table(spark, d, "vocab").select(form.alias("form")).filter(F.contains("form", F.lit(conjuncts.JOINER))).distinct()


@query()
def conjunct_repair(spark, d):
    """Every turn with broken conjuncts joined again, tested on contents whose joiners were replaced by spaces."""
    m = messages_of(dialogues(spark, d), "record_id")
    broken = m.withColumn("broken", F.replace("content", F.lit(conjuncts.JOINER), F.lit(" ")))
    out = conjuncts.repaired(broken, sinhala_lexicon(spark, d), "broken")
    return out.select("record_id", "pos", F.col("repair.text").alias("repaired"), F.size("repair.merges").alias("merges"), F.col("repair.kept").alias("kept"))


@query()
def masked_messages(spark, d):
    m = messages_of(dialogues(spark, d), "record_id").withColumn("x", masking.masked(F.col("content")))
    return m.select("record_id", "pos", F.col("x.masked").alias("masked"), F.size("x.originals").alias("spans"))


@query(f"WITH {_M} SELECT record_id, pos::INTEGER AS pos, content AS restored FROM m")
def mask_round_trip(spark, d):
    m = messages_of(dialogues(spark, d), "record_id").withColumn("x", masking.masked(F.col("content")))
    return m.select("record_id", "pos", masking.unmasked(F.col("x.masked"), F.col("x.originals")).alias("restored"))


@query(
    rf"""WITH l AS (SELECT prompt, prompt_id, list_filter(coalesce(messages, []), lambda x: x IS NOT NULL) AS l FROM dialogues),
 t AS (SELECT *, md5(regexp_replace(array_to_string(list_transform(l, lambda x: coalesce(x.role, '') || chr(1) || coalesce(x.content, '')), chr(2)) || chr(3) || coalesce(prompt, ''), '{_SPACE}+', '', 'g')) AS h FROM l)
SELECT prompt_id, count(*) AS n, sum(len(l))::BIGINT AS messages, count(prompt) AS prompts, min(h) AS first_text, max(h) AS last_text FROM t GROUP BY prompt_id"""
)
def translated_records(spark, d):
    """The whole translation chain with the identity for a translator; texts are compared without white space."""
    out = translate.translated(dialogues(spark, d))
    turns = F.transform("messages", lambda m: F.concat(F.coalesce(m["role"], F.lit("")), F.lit("\x01"), F.coalesce(m["content"], F.lit(""))))
    text_of = F.concat(F.array_join(turns, "\x02"), F.lit("\x03"), F.coalesce("prompt", F.lit("")))
    out = out.select("prompt_id", "prompt", F.size("messages").cast("long").alias("m"), F.md5(F.regexp_replace(text_of, r"(?U)[\s\p{Z}\x{1c}-\x{1f}]+", "")).alias("h"))
    return out.groupBy("prompt_id").agg(
        F.count("*").alias("n"), F.sum("m").alias("messages"), F.count("prompt").alias("prompts"), F.min("h").alias("first_text"), F.max("h").alias("last_text")
    )


@query()
def segmented_messages(spark, d):
    m = messages_of(dialogues(spark, d), "record_id").withColumn("x", segments.cut_to(F.col("content")))
    back = segments.rebuilt(F.col("x.segments"), F.col("x.lines"), F.col("x.per_line"))
    return m.select("record_id", "pos", F.size("x.segments").alias("segments"), back.alias("rebuilt"))


@query()
def mask_leak_repair(spark, d):
    """Turns to whose end their own masked spans were appended, put right again."""
    m = messages_of(dialogues(spark, d), "record_id").withColumn("x", masking.masked(F.col("content")))
    tail = F.array_join(F.col("x.originals"), " ")
    numbers = F.regexp_replace(F.col("x.masked"), "[⟦⟧]", "")
    leaked = m.withColumn("leaked", F.when(F.size("x.originals") > 0, F.concat(numbers, F.lit(" "), tail)).otherwise(F.col("content")))
    fixed = leaked.withColumn("y", masking.leak_repaired(F.col("leaked"), F.col("content")))
    return fixed.select("record_id", "pos", F.col("y.text").alias("text"), F.col("y.status").alias("status"))


@query(
    f"""WITH {_FEATURES}, w AS ({_FEATURE_COUNTS}), x AS ({_LONG}),
 g AS (SELECT row_number() OVER (ORDER BY CASE feature {_CASE_LEVEL} END, n DESC, place)::INTEGER AS rank, feature, CASE feature {_CASE_SEVERITY} END AS severity,
  n AS messages, round_even(100.0::DOUBLE * n / n_messages, 3) AS pct FROM x WHERE is_overall),
 e AS ({_EXAMPLES}), r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY record_id, pos) AS p FROM e),
 t AS (SELECT feature, p, regexp_replace(regexp_replace(content, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '{_SPACE}+', ' ', 'g') AS flat FROM r WHERE p <= 3),
 s AS (SELECT feature, string_agg(CASE WHEN length(flat) > 220 THEN left(flat, 220) || '…' ELSE flat END, chr(10) ORDER BY p) AS examples FROM t GROUP BY feature)
SELECT rank, g.feature, severity, messages, pct, CASE g.feature {' '.join(f"WHEN '{n}' THEN '{w}'" for n, w in patterns.RATIONALE.items())} END AS rationale,
 coalesce(examples, '') AS examples FROM g LEFT JOIN s ON g.feature = s.feature"""
)
def explained_register(spark, d):
    return profile.explained_register(dialogues(spark, d)).withColumn("examples", F.array_join("examples", "\n"))


_PLACES = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(patterns.SCRIPTS))


@query(
    f"""WITH {_M}, x AS ({_SCRIPT_ROWS}), c AS (SELECT split, script, count(*) AS n FROM x GROUP BY ALL)
SELECT split, script, n, row_number() OVER (PARTITION BY split ORDER BY n DESC, CASE script {_PLACES} END)::INTEGER AS rank FROM c QUALIFY rank <= 10"""
)
def top_scripts(spark, d):
    return profile.top_scripts(dialogues(spark, d))


@query(
    f"""WITH {_M}, {_TOKENS}, v AS (SELECT split, 'message' AS measure, round_even(length(content) / 4.0, 0)::BIGINT AS c FROM m
 UNION ALL SELECT split, 'dialogue', tokens FROM t UNION ALL SELECT split, 'with_overhead', tokens + 4 * turns FROM t)
SELECT measure, split, {_OVERALL}, {_summary('c')} FROM v GROUP BY GROUPING SETS ((measure, split), (measure))"""
)
def token_distributions(spark, d):
    return tokens.all_distributions(dialogues(spark, d))


_SERIAL = "md5(coalesce(array_to_string(list_transform(messages, lambda x: CASE WHEN x IS NULL THEN chr(3) ELSE coalesce(x.role, chr(3)) || chr(1) || coalesce(x.content, chr(3)) END), chr(2)), ''))"


@query(_leak_sql(_SERIAL, "messages"))
def leak_by_messages(spark, d):
    return _leak(spark, d, text.messages_hash(F.col("messages")), "messages")


@query(
    f"""SELECT side, count(*) AS n_rows, count(DISTINCT v) AS n_values, count(*) - count(DISTINCT v) AS n_duplicates
FROM (SELECT CASE WHEN split LIKE 'train%' THEN 'train' WHEN split LIKE 'test%' THEN 'test' END AS side, {_SERIAL} AS v FROM dialogues) WHERE side IS NOT NULL GROUP BY side"""
)
def duplicates_by_side(spark, d):
    side = F.when(F.col("split").startswith("train"), "train").when(F.col("split").startswith("test"), "test")
    return curate.duplicates_by_side(dialogues(spark, d), text.messages_hash(F.col("messages")), side)


@query("SELECT record_id, prompt_id FROM dialogues WHERE split = 'test_gen' ORDER BY record_id LIMIT 25")
def first_of_split(spark, d):
    """The first records of a split, as a trial run takes them."""
    return curate.first_rows(dialogues(spark, d).filter("split = 'test_gen'").select("record_id", "prompt_id"), "record_id", 25)


_PARTS = """c AS (SELECT file_name AS part, count(*) FILTER (json_valid(line)) AS done, count(*) AS total FROM raw_lines GROUP BY file_name),
 f AS (SELECT *, done = total AS finished FROM c)"""


@query(
    f"""WITH {_PARTS} SELECT part, CASE WHEN finished THEN total ELSE least(done, total) END AS done, total,
 round_even(100.0::DOUBLE * (CASE WHEN finished THEN total ELSE least(done, total) END) / total, 1) AS pct, CASE WHEN finished THEN 'done' WHEN done > 0 THEN 'partial' ELSE 'queued' END AS status,
 CASE WHEN NOT finished AND done > 0 THEN least(done, total) END AS resume_from FROM f"""
)
def progress_status(spark, d):
    """Lines of each file that parse, as the progress of parsing it."""
    per = table(spark, d, "raw_lines").groupBy(F.col("file_name").alias("part")).agg(F.count_if(F.try_parse_json("line").isNotNull()).alias("done"), F.count("*").alias("total"))
    return progress.parts_status(per.withColumn("finished", F.col("done") == F.col("total")))


@query(
    """WITH l AS (SELECT file_name AS job, date_trunc('day', ingested_at) AS ts, count(*) AS n FROM raw_lines WHERE ingested_at IS NOT NULL GROUP BY ALL),
 c AS (SELECT job, ts, sum(n) OVER (PARTITION BY job ORDER BY ts)::BIGINT AS done FROM l),
 g AS (SELECT *, done - lag(done) OVER (PARTITION BY job ORDER BY ts) AS made, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY job ORDER BY ts) AS took FROM c)
SELECT job, strftime(ts, '%Y-%m-%d') AS day, done, round(CASE WHEN made > 0 AND took > 0 THEN made * 3600000000.0::DOUBLE / took ELSE 11000.0 END, 6) AS per_hour FROM g"""
)
def progress_rates(spark, d):
    """Lines an hour of each file, day by day."""
    day = table(spark, d, "raw_lines").filter("ingested_at IS NOT NULL").groupBy(F.col("file_name").alias("job"), F.date_trunc("day", "ingested_at").alias("ts")).agg(F.count("*").alias("n"))
    log = day.select("job", "ts", F.sum("n").over(Window.partitionBy("job").orderBy("ts")).alias("done"))
    return progress.rates(log).select("job", F.date_format("ts", "yyyy-MM-dd").alias("day"), "done", F.round("per_hour", 6).alias("per_hour"))


@query(
    f"""WITH {_TOKENS}, g AS (SELECT split, count(*) AS n, sum(chars)::BIGINT AS c, sum(tokens)::BIGINT AS t, count(*) FILTER (turns = 0) AS none FROM t GROUP BY split)
SELECT split, format('{{:,}}', c) AS chars, CASE WHEN n = 0 THEN 'n/a' ELSE printf('%.3f%%', 100.0::DOUBLE * none / n) END AS without_turns, round(c::DOUBLE / t, 6) AS chars_per_token,
 CASE WHEN n < 60 THEN n || 's' WHEN n < 3600 THEN (n // 60) || 'm ' || (n % 60) || 's' WHEN n < 86400 THEN (n // 3600) || 'h ' || (n % 3600 // 60) || 'm'
  ELSE printf('%.1f', n / 86400.0::DOUBLE) || ' days' END AS at_one_a_second FROM g"""
)
def formatted_numbers(spark, d):
    """Sizes of the splits as reports write them."""
    g = tokens.dialogue_tokens(dialogues(spark, d)).groupBy("split").agg(
        F.count("*").alias("n"), F.sum("chars").alias("c"), F.sum("tokens").alias("t"), F.count_if(F.col("turns") == 0).alias("none")
    )
    return g.select(
        "split",
        formats.grouped(F.col("c")).alias("chars"),
        formats.percent_text(F.col("none"), F.col("n")).alias("without_turns"),
        F.round(formats.ratio(F.col("c"), F.col("t")), 6).alias("chars_per_token"),
        formats.human_time(F.col("n")).alias("at_one_a_second"),
    )


# --- operators SQL cannot express, on a few rows with results written down ----------


def _literal(rows: list[tuple], names: str) -> str:
    quote = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(quote, r)) + ')' for r in rows)}) AS t({names})"


# (text, masked, spans)
_MASKS = [
    ("Use `ls -l` or see https://ex.org/a now", "Use ⟦0⟧ or see ⟦1⟧ now", "`ls -l`|https://ex.org/a"), ("no spans", "no spans", ""), ("a <b>bold</b> word", "a ⟦0⟧bold⟦1⟧ word", "<b>|</b>"),
    ("mail me@ex.org, $$x^2$$", "mail ⟦0⟧, ⟦1⟧", "me@ex.org|$$x^2$$"), ("", "", ""), (None, None, None),
]


@query(_literal([(i, *r) for i, r in enumerate(_MASKS)], "id, text, masked, spans"))
def mask_cases(spark, d):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(_MASKS)], "id int, text string").withColumn("x", masking.masked(F.col("text")))
    return df.select("id", "text", F.col("x.masked").alias("masked"), F.array_join("x.originals", "|").alias("spans"))


# (text as it came back, spans, text with them)
_UNMASKS = [
    ("Siehe ⟦1⟧ und ⟦ 0 ⟧.", "`a`|`b`", "Siehe `b` und `a`."), ("Nimm 1 vor 0", "x|y", "Nimm y vor x"), ("Verloren", "x|y", "Verloren x y"), ("⟦0 und 10", "x", "xund 10"),
    ("⟦0⟧ ⟦0⟧", "x", "x x"), ("\x000\x00 bleibt", "x", "\x00x\x00 bleibt"), ("⟦5⟧ bleibt", "x", "⟦5⟧ bleibt x"), ("nichts", "", "nichts"),
]


@query(_literal([(i, r[2].replace("\x00", "~")) for i, r in enumerate(_UNMASKS)], "id, restored"))
def unmask_cases(spark, d):
    df = spark.createDataFrame([(i, r[0], r[1].split("|") if r[1] else []) for i, r in enumerate(_UNMASKS)], "id int, text string, spans array<string>")
    return df.select("id", F.translate(masking.unmasked(F.col("text"), F.col("spans")), "\x00", "~").alias("restored"))


# (kind of text, translated, source, repaired, status)
_LEAKS = [
    ("message", "Nimm 0 und 1 `a` https://ex.org", "Take `a` and https://ex.org", "Nimm `a` und https://ex.org", "reconstructed"), ("message", "Nimm es `a`", "Take `a`", "Nimm es\n\n`a`", "partial"),
    ("message", "ohne", "without", "ohne", "no_mask"), ("message", "anders", "Take `a`", "anders", "skipped_no_tail"), ("message", "eins 0\nzwei 1 `a` `b`", "one `a`\ntwo `b`", "eins `a`\nzwei `b`", "reconstructed"),
    ("message", "eins\nzwei 0 `a`", "one `a`", "eins\nzwei 0\n\n`a`", "partial"), ("prompt", "Nimm 0 `a`", "Take `a`", "Nimm `a`", "reconstructed"), ("prompt", "ohne", "without", "ohne", "no_mask"),
]


def _leak_cases(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(_LEAKS)], "id int, kind string, text string, source string")
    return df.select("id", "kind", masking.leak_repaired(F.col("text"), F.col("source")).alias("x")).select("id", "kind", F.col("x.text").alias("text"), F.col("x.status").alias("status"))


@query(_literal([(i, r[0], r[3], r[4]) for i, r in enumerate(_LEAKS)], "id, kind, text, status"))
def leak_repair_cases(spark, d):
    return _leak_cases(spark)


@query(
    f"""WITH c AS ({_literal([(i, r[0], r[4]) for i, r in enumerate(_LEAKS)], 'id, kind, status')}), s AS (SELECT CASE WHEN kind = 'prompt' THEN 'prompt_' ELSE '' END || status AS status, status AS bare FROM c)
SELECT status, count(*) AS n, CASE WHEN any_value(bare) = 'no_mask' THEN NULL ELSE round_even(100.0::DOUBLE * count(*) / sum(CASE WHEN any_value(bare) <> 'no_mask' THEN count(*) ELSE 0 END)
 OVER (PARTITION BY starts_with(status, 'prompt_')), 1) END AS pct_of_masked FROM s GROUP BY status"""
)
def leak_repair_statuses(spark, d):
    return masking.status_counts(_leak_cases(spark))


# (text, limit, segments, lines)
_CUTS = [
    ("One. Two! Three", 1000, "One.|Two!|Three", 1), ("a\n\nb. c", 1000, "a|b.|c", 3), ("aaa bbb ccc", 7, "aaa bbb|ccc", 1), ("abcdefgh ij", 3, "abc|def|gh|ij", 1), ("你好。 再见", 1000, "你好。|再见", 1), (" ", 1000, "", 1),
]


@query(_literal([(i, r[2], r[3]) for i, r in enumerate(_CUTS)], "id, segments, lines"))
def segment_cases(spark, d):
    parts = [
        spark.createDataFrame([(i, r[0])], "id int, text string").select("id", segments.cut_to(F.col("text"), r[1]).alias("x")) for i, r in enumerate(_CUTS)
    ]
    out = reduce(DataFrame.unionByName, parts)
    return out.select("id", F.array_join("x.segments", "|").alias("segments"), F.size("x.lines").alias("lines"))


def wrong_cases(spark: SparkSession) -> list[str]:
    """Names of cases with a written result that come out otherwise."""
    written = {
        "mask_cases": [(i, *r) for i, r in enumerate(_MASKS)],
        "unmask_cases": [(i, r[2].replace("\x00", "~")) for i, r in enumerate(_UNMASKS)],
        "leak_repair_cases": [(i, r[0], r[3], r[4]) for i, r in enumerate(_LEAKS)],
        "segment_cases": [(i, r[2], r[3]) for i, r in enumerate(_CUTS)],
        "conjunct_cases": [(i, *r[1:]) for i, r in enumerate(_CONJUNCTS)],
    }
    return [f"{name}: {got} instead of {want}" for name, rows in written.items() for got, want in zip(sorted(tuple(r) for r in _QUERIES[name](spark, "").collect()), rows) if got != want]


_LEXICON = [("ශ්‍රී", 40), ("මිත්‍රයා", 9), ("වාක්‍ය", 5), ("ක්‍රමය", 4), ("බස්", 90), ("රථය", 70)]
# (text, repaired, tiers, kept, residual)
_CONJUNCTS = [
    ("ශ් රී ලංකාව", "ශ්‍රී ලංකාව", "T1", 0, ""), ("මිත් රයා සහ වාක් ය", "මිත්‍රයා සහ වාක්‍ය", "T1,T1", 0, ""), ("බස් රථය", "බස් රථය", "", 1, ""), ("ක් රමය", "ක්‍රමය", "T3", 0, ""), ("ව් යාපාර", "ව්‍යාපාර", "T2", 0, ""),
    ("ග් රාමය", "ග් රාමය", "", 1, "ග් රාමය"), ("ශ්‍රී", "ශ්‍රී", "", 0, ""), ("plain", "plain", "", 0, ""),
]


@query(_literal([(i, *r[1:]) for i, r in enumerate(_CONJUNCTS)], "id, repaired, tiers, kept, residual"))
def conjunct_cases(spark, d):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(_CONJUNCTS)], "id int, text string")
    lex = spark.createDataFrame(_LEXICON, "word string, n long")
    out = conjuncts.repaired(df, lex, "text", frozenset(["ව්‍යාපාර"]))
    tiers = F.array_join(F.transform("repair.merges", lambda m: m["tier"]), ",")
    return out.select("id", F.col("repair.text").alias("repaired"), tiers.alias("tiers"), F.col("repair.kept").alias("kept"), F.array_join("repair.residual", ",").alias("residual"))


@query("SELECT split, CASE split WHEN 'train_sft' THEN 0 WHEN 'test_sft' THEN 1 WHEN 'train_gen' THEN 2 WHEN 'test_gen' THEN 3 ELSE 99 END AS place, count(*) AS n FROM dialogues GROUP BY split")
def ordered_splits(spark, d):
    return dialogues(spark, d).groupBy("split").agg(F.count("*").alias("n")).select("split", split_order(F.col("split")).alias("place"), "n")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
