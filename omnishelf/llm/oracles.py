"""DuckDB SQL for the queries that SQL can express, over the whole documents table."""

SUFFIX_ARRAY_DEDUP = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
listed AS (
    SELECT doc_id, list_transform(range(1, octet_length(b) - 398), lambda i: hash(b[i : i + 399])) AS hs
    FROM d),
strings AS (SELECT doc_id, unnest(hs) AS h, generate_subscripts(hs, 1) - 1 AS i FROM listed),
again AS (SELECT h FROM strings GROUP BY h HAVING count(*) > 1),
starts AS (
    SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, -1) AS fresh
    FROM strings JOIN again USING (h)),
numbered AS (SELECT *, sum(fresh::int) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts),
runs AS (SELECT doc_id, run, min(i) AS lo, max(i) + 400 AS hi FROM numbered GROUP BY ALL),
gaps AS (
    SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS prior
    FROM runs),
cut AS (
    SELECT doc_id, sum(hi - lo)::bigint AS n_removed, count(*) AS n_spans, max(hi) AS last,
           string_agg(hex(b[prior + 1 : lo]), '' ORDER BY lo) AS head
    FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || hex(b[coalesce(last, 0) + 1 :]))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""

NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
found AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::bigint AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN found ON a = doc_id"""

# The marks of the template are written out; a text's "<|" gets a backslash each.
CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
placed AS (
    SELECT *, row_number() OVER w - 1 AS place, lag(role) OVER w AS prior FROM turns
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
checked AS (
    SELECT *, coalesce(prior, 'start') || ' ' || role NOT IN ('start system', 'start user',
        'system user', 'user assistant', 'assistant user') AS wrong,
        length('<|im_start|>' || role || '<|im_end|>') + 2
            + length(regexp_replace(text, '<(\\*)\|', '<\1/|', 'g')) AS chars
    FROM placed)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::bigint AS formatted_chars,
    NOT bool_or(wrong) AND arg_max(role, place) = 'assistant' AS valid,
    min(place) FILTER (wrong) AS first_invalid
FROM checked GROUP BY conv_id"""

# Crc32 bit by bit. Inserts never pay: without an inserted turn and its neighbour the roles still
# alternate, for a deletion less. So scripts of one length compare as (cost, letters), row by row.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE hashed AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
            string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
            lambda c: ascii(c)::bigint)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))),
        4294967295::bigint) % 20 AS kind
    FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
            ELSE coalesce(text, ' ') END AS text,
        unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM hashed WHERE kind <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM damaged),
marked AS (
    SELECT *, left(role, 1) AS c,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS prior,
        CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' END AS fault
    FROM placed),
counted AS (
    SELECT conv_id, count(*) AS n,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (prior IS NOT NULL AND prior || c NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id),
steps(state, c, next) AS (
    VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
edits AS (
    SELECT conv_id, place, state, 2 AS cost, 'D' AS letter, state AS next, '' AS said
    FROM marked, (VALUES (''), ('s'), ('u'), ('a')) AS t(state)
    UNION ALL
    SELECT conv_id, place, state, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K', next,
        chr(10) || role || ':' || text
    FROM marked JOIN steps USING (c) WHERE fault IS NULL OR fault = 'truncated'
    UNION ALL
    SELECT conv_id, place, state, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R', next,
        chr(10) || CASE steps.c WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text
    FROM marked, steps WHERE steps.c IN ('u', 'a') AND (fault IS NULL OR fault = 'truncated')),
paths AS (
    SELECT conv_id, 0::bigint AS place, '' AS state, {'cost': 0, 'audit': '', 'said': ''} AS best
    FROM counted
    UNION ALL
    SELECT conv_id, e.place, e.next, min({'cost': best.cost + e.cost, 'audit': best.audit || letter,
        'said': best.said || e.said})
    FROM paths p JOIN edits e USING (conv_id, state) WHERE e.place = p.place + 1
    GROUP BY conv_id, e.place, e.next),
ended AS (
    SELECT conv_id, min(best) AS best FROM paths JOIN counted USING (conv_id)
    WHERE place = n AND state IN ('', 'a') GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
    coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::bigint AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(best.said[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations)
LEFT JOIN counted USING (conv_id) LEFT JOIN ended USING (conv_id)"""
