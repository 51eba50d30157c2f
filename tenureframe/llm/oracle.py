"""SQL of the longer corpus operators, to compare their queries with."""

CONVERSATIONS_SQL = r"""
    WITH RECURSIVE source AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
        FROM conversations
    ),
    checked AS (
        SELECT *, xor(list_reduce(
                   list_prepend(4294967295::BIGINT,
                                list_transform(range(strlen(k)), lambda i: ord(substr(k, i + 1, 1))::BIGINT)),
                   lambda c, b: list_reduce(
                       list_prepend(xor(c, b), range(8)),
                       lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))),
               4294967295::BIGINT) % 20 AS h
        FROM source
    ),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
               CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM checked
    ),
    placed AS (
        SELECT *, row_number() OVER (
                   PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n
        FROM damaged
    ),
    trimmed AS (
        SELECT *, rtrim(text, E'\x20\t\n\x0b\x0c\r') AS bare,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS former
        FROM placed
    ),
    faulty AS (
        SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd'
                       WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
               left(role, 1) AS initial
        FROM trimmed
    ),
    counts AS (
        SELECT conv_id, count(*) AS rows_left,
               coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'b') AS blank,
               count(*) FILTER (fault = 'd') AS duplicate,
               count(*) FILTER (fault = 't') AS truncated,
               count(*) FILTER (n > 1 AND former || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faulty GROUP BY conv_id
    ),
    inserted(state, middle, inserts) AS (
        VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0),
               (2, 3, 1), (3, 3, 0), (3, 2, 1)
    ),
    allowed(middle, role, next) AS (
        VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
    ),
    steps AS (
        SELECT state, middle AS next, 'D' AS edit, '' AS needs, 3 AS cost, inserts FROM inserted
        UNION ALL
        SELECT state, next, 'K', role, 0, inserts FROM inserted JOIN allowed USING (middle)
        UNION ALL
        SELECT state, next, 'R', '', 2, inserts FROM inserted JOIN allowed USING (middle)
        WHERE role <> 's'
    ),
    walk(conv_id, n, state, best) AS (
        SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': ''} FROM counts
        UNION ALL
        SELECT w.conv_id, f.n, s.next,
               min({'cost': w.best.cost + s.cost + 2 * s.inserts
                            + CASE WHEN f.fault = 't' AND s.edit <> 'D' THEN 1 ELSE 0 END,
                    'audit': w.best.audit || repeat('I', s.inserts) || s.edit})
        FROM walk w
        JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
        JOIN steps s ON s.state = w.state
                    AND (s.edit = 'D' OR f.fault NOT IN ('b', 'd'))
                    AND (s.edit <> 'K' OR s.needs = f.initial)
        GROUP BY w.conv_id, f.n, s.next
    ),
    repairs AS (
        SELECT w.conv_id,
               min({'cost': w.best.cost + 2 * e.inserts,
                    'audit': w.best.audit || repeat('I', e.inserts)}) AS best
        FROM walk w
        JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.rows_left = w.n
        JOIN (VALUES (0, 0), (1, 2), (2, 1), (3, 0)) e(state, inserts) ON e.state = w.state
        GROUP BY w.conv_id
    ),
    edits AS (
        SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS i
        FROM repairs
    ),
    consumed AS (
        SELECT conv_id, audit[i] AS edit,
               CASE WHEN audit[i] <> 'I' THEN length(replace(audit[1:i], 'I', '')) END AS n,
               length(replace(audit[1:i], 'D', '')) AS place
        FROM edits
    ),
    turns AS (
        SELECT c.conv_id, c.edit, c.place, f.role, coalesce(f.text, '') AS text,
               max(CASE WHEN c.place = 1 AND c.edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END)
                   OVER (PARTITION BY c.conv_id) AS led
        FROM consumed c
        LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.n = c.n
        WHERE c.edit <> 'D'
    ),
    hashes AS (
        SELECT conv_id, sha256(string_agg(
                   CASE WHEN edit = 'K' THEN role
                        WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                   chr(10) ORDER BY place)) AS repaired_sha256
        FROM turns GROUP BY conv_id
    )
    SELECT c.conv_id, coalesce(k.gaps, 0) AS gaps, coalesce(k.blank, 0) AS blank,
           coalesce(k.duplicate, 0) AS duplicate, coalesce(k.truncated, 0) AS truncated,
           coalesce(k.illegal, 0) AS illegal, coalesce(r.best.cost, 0) AS cost,
           coalesce(r.best.audit, '') AS audit,
           coalesce(h.repaired_sha256, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN repairs r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN hashes h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""

DIVERGENCE_SQL = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang,
               coalesce(source, '') AS source, coalesce(text, '') AS text
        FROM documents
    ),
    words AS (
        SELECT row, lang, source,
               unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS word
        FROM docs
    ),
    terms AS (
        SELECT row, lang, source, translate(
                   word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM words
    ),
    kept AS (
        SELECT lang, term, count(*)::HUGEINT AS n FROM terms
        GROUP BY lang, term HAVING count(DISTINCT row) >= 30
    ),
    langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (
        SELECT lang, source, term, count(*)::HUGEINT AS n
        FROM terms SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
    ),
    totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY lang, source),
    shares AS (
        SELECT lang, source, term, coalesce(c.n, 0) AS n,
               (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5))
                    // (coalesce(t.total, 0) + 5 * l.v))::BIGINT AS p,
               (1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v))::BIGINT AS q
        FROM groups JOIN kept k USING (lang) JOIN langs l USING (lang)
        LEFT JOIN totals t USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
    ),
    apart AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source
    ),
    rows AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
    ),
    ranked AS (
        SELECT *, row_number() OVER (
                   PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
        FROM rows
    )
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
