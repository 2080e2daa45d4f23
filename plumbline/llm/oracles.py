"""DuckDB SQL for the queries that SQL can express, and for the parts of others that it can (registered as queries of their own)."""

#: A word is a run of characters other than these.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
#: Base 32 of a hexadecimal digest of 160 bits: its bits, then five at a time as places in the alphabet.
_BITS = "list_reduce(list_transform(range(1, 41), lambda i: right('000' || bin(strpos('0123456789abcdef', substr({0}, i, 1)) - 1), 4)), lambda a, b: a || b)"
_BASE32 = (
    "list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda j: CASE WHEN substr({0}, 5 * i + j + 1, 1) = '1' THEN 16 >> j ELSE 0 END))::INT, 1)), lambda a, b: a || b)"
)
_ESCAPED = r"replace(replace({0}, '\', '\b'), '<', '\l')"

ORACLES: dict[str, str] = {
    "op6_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        f AS (SELECT payload, min(page_id) AS first, {_BITS.format("sha1(payload)")} AS bits FROM p GROUP BY payload)
        SELECT page_id, CAST(strlen(p.payload) AS BIGINT) AS payload_bytes, {_BASE32.format("bits")} AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p JOIN f ON p.payload = f.payload""",
    "op7_chat": f"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
        SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<turn ' || replace({_ESCAPED.format("role")}, '>', '\\g') || '>' || chr(10) || {_ESCAPED.format("text")} || chr(10) || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op9_jaccard": f"""
        WITH RECURSIVE w AS (SELECT doc_id, {_LOWER} AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
        e AS (SELECT md5(array_to_string(list_sort(s), chr(10))) AS e, min(doc_id) AS rep, count(*) AS copies, len(any_value(s)) AS n, any_value(s) AS s FROM s WHERE len(s) > 0 GROUP BY 1),
        x AS (SELECT rep, n, copies, unnest(s) AS g FROM e),
        shared AS (SELECT a.rep AS a, b.rep AS b, a.n AS n, b.n AS m, b.copies AS copies, count(*) AS same FROM x a JOIN x b ON a.g = b.g AND a.rep <> b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
        l AS (SELECT a, b, copies FROM shared WHERE 100 * same >= 80 * (n + m - same)),
        r(a, b) AS (SELECT rep, rep FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS root FROM r GROUP BY a),
        k AS (SELECT a, sum(copies) AS others FROM l GROUP BY a)
        SELECT s.doc_id AS doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id,
               CAST(CASE WHEN len(s.s) = 0 THEN 0 ELSE e.copies - 1 + coalesce(k.others, 0) END AS BIGINT) AS n_links
        FROM s LEFT JOIN e ON len(s.s) > 0 AND e.e = md5(array_to_string(list_sort(s.s), chr(10))) LEFT JOIN c ON c.a = e.rep LEFT JOIN k ON k.a = e.rep""",
    # Passages lie in one place of a text, so that the share of a question's shingles in its whole text is that in a window.
    "op8_decontamination": f"""
        WITH t AS (SELECT 'd' AS k, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
        w AS (SELECT k, id, list_filter(list_transform({_WORDS.replace("coalesce(text, '')", "lower(coalesce(text, ''))")}, lambda x: trim(x, '.,;:!?"''()[]{{}}«»“”„‘’…-')), lambda x: x <> '') AS w FROM t),
        g AS (SELECT k, id, unnest(list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM w WHERE len(w) > 0),
        n AS (SELECT id, count(*) AS n FROM g WHERE k = 'i' GROUP BY id),
        m AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS same FROM g d JOIN g i ON d.g = i.g AND d.k = 'd' AND i.k = 'i' GROUP BY ALL)
        SELECT doc_id, item_id, same / n AS question_overlap, CAST(NULL AS DOUBLE) AS answer_overlap FROM m JOIN n ON n.id = item_id WHERE same >= 0.8 * n""",
    "llm_sharding_sizes": "SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size, 'bytes' AS law FROM documents",
    "llm_mixing_targets": f"""
        WITH d AS (SELECT source, sum(len({_WORDS})) AS size FROM documents GROUP BY source),
        o AS (SELECT source, size, [3, 1, 2][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT)] AS weight, 1.5 * sum(size) OVER () AS total FROM d),
        -- A source is at its bound if its size is small for its weight: bounds are taken in that order until the rest has room.
        q AS (SELECT *, coalesce(sum(2.0 * size) OVER w, 0) AS bounded, sum(weight) OVER (ORDER BY 1.0 * size / weight DESC, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING) AS free FROM o
              WINDOW w AS (ORDER BY 1.0 * size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        b AS (SELECT *, (total - bounded) * weight / free > 2 * size AS filled FROM q),
        t AS (SELECT max(total) - coalesce(sum(2.0 * size) FILTER (WHERE filled), 0) AS rest, sum(weight) FILTER (WHERE NOT filled) AS free FROM b)
        SELECT source, CAST(size AS BIGINT) AS source_size, round(CAST(CASE WHEN filled THEN 2.0 * size ELSE t.rest * weight / t.free END AS DOUBLE), 3) AS target FROM b, t""",
    "llm_quality_base": f"""
        WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
        g AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, array_to_string(w[i:i + 7], ' ') AS g FROM w WHERE len(w) >= 8),
        twice AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest(range(0, 8)) AS p FROM g SEMI JOIN twice USING (doc_id, g)) x GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
               CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
               len(w) < 20 OR 100 * coalesce(n, 0) > 30 * len(w) AS base_failed
        FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM w) w LEFT JOIN covered USING (doc_id)""",
    "llm_lm_counts": f"""
        WITH w AS (SELECT doc_id, {_LOWER} AS w FROM documents)
        SELECT doc_id, CAST(len(w) + 1 AS BIGINT) AS n_tokens FROM w""",
}
