"""DuckDB SQL for the queries that SQL can express on whole tables."""

ORACLE: dict[str, str] = {
    # every window as a list of words, found by an equality join
    "op9_decontamination": r"""
        WITH doc AS (SELECT doc_id, regexp_extract_all(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             item AS (SELECT item_id, regexp_extract_all(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
             win AS (SELECT item_id, least(len(w), 10) AS n,
                            unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
                                   lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS key
                     FROM item WHERE len(w) > 0),
             sizes AS (SELECT DISTINCT n FROM win),
             place AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM doc, sizes WHERE len(w) >= n),
             found AS (SELECT doc_id, i, n, item_id FROM
                       (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS key FROM place)
                       JOIN win USING (n, key)),
             hit AS (SELECT doc_id, count(*) AS n_hit FROM
                     (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS word FROM (SELECT DISTINCT doc_id, i, n FROM found))
                     GROUP BY doc_id),
             items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM
                       (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    # all windows of 50 words as strings
    "op8_substring_dedup": r"""
        WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS key FROM
                     (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)),
             marked AS (SELECT doc_id, i FROM
                        (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY key) AS earliest FROM win)
                        WHERE doc_id > earliest),
             gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM marked),
             word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM doc),
             kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS text
                      FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM doc LEFT JOIN kept USING (doc_id)""",
    "op10_chat_perspectives": """
        WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
                              coalesce(turn // 1024, -1) AS part FROM conversations),
             speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role <> 'system'),
             segments AS (SELECT conv_id, perspective, part, turn, role, text, role = perspective AS mine,
                                 '<|' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant'
                                         ELSE 'user name=' || role END || '|>' || chr(10) || text || '<|end|>' || chr(10)
                                 AS segment
                          FROM turns JOIN speakers USING (conv_id)),
             placed AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective, part
                                                             ORDER BY turn NULLS FIRST, role, text) AS stop
                        FROM segments)
        SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, count(*) AS n_turns,
               string_agg(segment, '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
               coalesce(string_agg(CASE WHEN mine THEN CAST(stop - length(text) - 8 AS VARCHAR) || ':' ||
                                        CAST(stop - 1 AS VARCHAR) END, ',' ORDER BY turn NULLS FIRST, role, text), '') AS spans,
               CAST(sum(CASE WHEN mine THEN length(text) + 7 ELSE 0 END) AS BIGINT) AS n_trained,
               CAST(coalesce(sum(sum(length(segment))) OVER (PARTITION BY conv_id, perspective ORDER BY part
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
        FROM placed GROUP BY conv_id, perspective, part""",
}
