"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LINES = "string_split(coalesce(text, ''), chr(10))"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = {
    "op2_substring_dedup": f"""
        WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w),
        runs AS (SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS run FROM starts),
        again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY run) AS n FROM runs) WHERE n > 1),
        gone AS (SELECT DISTINCT doc_id, i + k AS i FROM again, range(35) AS r(k)),
        each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
        marked AS (SELECT e.doc_id, e.i, e.word, g.i IS NOT NULL AS removed FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i),
        counted AS (SELECT doc_id, count_if(removed) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS kept
                    FROM marked GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM w LEFT JOIN counted c ON w.doc_id = c.doc_id""",
    "op4_quality_ledger": rf"""
        WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
                          list_filter({_LINES}, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
        starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w),
        runs AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS run FROM starts),
        again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE n > 1),
        covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(5) AS r(k) GROUP BY doc_id),
        m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
                     CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                     CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                     CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_full_lines,
                     CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
              FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id),
        f AS (SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
                     + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (10 * n_dup_lines > 4 * n_full_lines)::INT
                     + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 20 * n_words)::INT AS BIGINT) AS failures FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed,
               failures = 0 AS kept, failures FROM f""",
    "op5_line_runs": f"""
        WITH l AS (SELECT doc_id, unnest({_LINES}) AS line, generate_subscripts({_LINES}, 1) AS i FROM documents),
        k AS (SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        shared AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        m AS (SELECT k.*, coalesce(doc_id <> last, false) AS dropped FROM k LEFT JOIN shared s ON k.key = s.key)
        SELECT doc_id, count(*) AS n_lines, CAST(count_if(dropped) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op7_benchmark_passages": f"""
        WITH b AS (SELECT item_id, {_ITEM_WORDS} AS words FROM benchmark),
        s AS (SELECT item_id, words, least(10, len(words)) AS n FROM b WHERE len(words) > 0),
        items AS (SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS run
                  FROM (SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM s)),
        w AS (SELECT doc_id, {_ITEM_WORDS} AS words FROM documents),
        starts AS (SELECT doc_id, words, n, unnest(range(1, greatest(1, len(words) - n + 2))) AS i
                   FROM w, (SELECT DISTINCT n FROM items)),
        found AS (SELECT r.doc_id, r.i, r.n, t.item_id FROM (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS run FROM starts) r
                  JOIN items t ON r.n = t.n AND r.run = t.run),
        hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(n)) AS k FROM found) GROUP BY doc_id),
        listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN hit h ON w.doc_id = h.doc_id LEFT JOIN listed x ON w.doc_id = x.doc_id""",
}


def _clusters(rounds: int = 10) -> str:
    """Ten rounds of assignment and floored means, one after another."""
    apart = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = []
    for r in range(1, rounds + 2):
        steps.append(f"""
        a{r} AS MATERIALIZED (
            SELECT v.n, any_value(v.vec_id) AS vec_id, any_value(v.x) AS x, min({{'d': {apart}, 'c': c.c}}) AS best
            FROM v, c{r - 1} c GROUP BY v.n)""")
        if r <= rounds:
            steps.append(f"""
        s{r} AS (SELECT best['c'] AS c, i, CAST(sum(x[i]) AS HUGEINT) AS total, count(*) AS n
                 FROM (SELECT best, x, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY 1, 2),
        m{r} AS (SELECT c, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{r} GROUP BY c),
        c{r} AS MATERIALIZED (SELECT o.c, coalesce(m{r}.x, o.x) AS x FROM c{r - 1} o LEFT JOIN m{r} ON o.c = m{r}.c)""")
    return f"""
        WITH fit AS (
            SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
        v AS MATERIALIZED (
            SELECT *, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS n FROM fit),
        c0 AS MATERIALIZED (SELECT n AS c, x FROM v WHERE n < 8),{",".join(steps)}
        SELECT a.vec_id, CAST(a.best['c'] AS INTEGER) AS cluster, CAST(a.best['d'] AS BIGINT) AS distance,
               CAST(sum(a.best['d']) OVER (PARTITION BY a.best['c']) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.best['d']) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM a{rounds + 1} a JOIN c{rounds} c ON a.best['c'] = c.c"""


SQL["op12_bisector_clusters"] = _clusters()


_STEP = "CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END"
_CRC_TABLE = f"""
        crc_table AS (SELECT list(v ORDER BY b) AS rest FROM (
            SELECT b, list_reduce(range(8), lambda c, k: {_STEP}, b) AS v FROM range(256) r(b)))"""


def _crc(text: str) -> str:
    """crc32 of ASCII text, byte by byte, with ``crc_table`` among the tables read."""
    codes = f"list_transform(range(1, len({text}) + 1), lambda i: CAST(ord(({text})[i]) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, rest[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def _repairs() -> str:
    """Cheapest edits by a recursion over rows that keeps the least (cost, edits) of every state."""
    return r"""
        WITH RECURSIVE""" + _CRC_TABLE + r""",
        hit AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, """ + _crc(
        "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
    ) + r""" % 20 AS pmod FROM conversations, crc_table),
        hurt AS (
            SELECT conv_id, turn, CASE WHEN pmod = 4 THEN 'user' ELSE role END AS role,
                   CASE pmod WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN pmod = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit WHERE pmod <> 0),
        seen AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS k,
                   regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS t FROM hurt),
        judged AS (
            SELECT *, t = '' AS blank, t <> '' AND k > 1 AS dup, t <> '' AND k = 1 AND right(t, 1) NOT IN ('.', '!', '?') AS trunc,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM seen),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
                   count_if(dup) AS duplicate, count_if(trunc) AS truncated, count_if(odd) AS illegal, count(*) AS n
            FROM (SELECT *, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS odd
                  FROM judged) GROUP BY conv_id),
        convs AS (
            SELECT a.conv_id, coalesce(c.gaps, 0) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank, CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate,
                   CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, coalesce(c.n, 0) AS n
            FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts c ON a.conv_id IS NOT DISTINCT FROM c.conv_id),
        put(p, q, cost, e, t) AS (VALUES
            ('-', '-', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
            ('-', 'u', 2, 'I', 'user:;'), ('s', 'u', 2, 'I', 'user:;'), ('a', 'u', 2, 'I', 'user:;'), ('u', 'a', 2, 'I', 'assistant:;'),
            ('-', 'a', 4, 'II', 'user:;assistant:;'), ('s', 'a', 4, 'II', 'user:;assistant:;')),
        turn_to(q, r, name) AS (VALUES ('-', 's', 'system'), ('-', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
        act AS (
            SELECT conv_id, i, q, r, w.cost, w.e, w.t FROM (
                SELECT j.*, m.q, m.r, unnest([
                    CASE WHEN left(role, 1) = m.r THEN {'cost': CAST(trunc AS INT), 'e': 'K', 't': role || ':' || text || chr(10)} END,
                    CASE WHEN m.r <> 's' THEN {'cost': 2 + CAST(trunc AS INT), 'e': 'R', 't': m.name || ':' || text || chr(10)} END]) AS w
                FROM judged j, turn_to m WHERE NOT (blank OR dup)) WHERE w IS NOT NULL
            UNION ALL SELECT conv_id, i, p, p, 3, 'D', '' FROM judged, put WHERE p = q),
        path AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS i, '-' AS st, {'cost': 0, 'e': '', 't': ''} AS best FROM convs
            UNION ALL
            SELECT path.conv_id, path.i + 1, act.r,
                   min({'cost': best['cost'] + put.cost + act.cost, 'e': best['e'] || put.e || act.e,
                        't': best['t'] || replace(put.t, ';', chr(10)) || act.t})
            FROM path JOIN put ON put.p = path.st
            JOIN act ON act.conv_id IS NOT DISTINCT FROM path.conv_id AND act.i = path.i + 1 AND act.q = put.q
            GROUP BY path.conv_id, path.i, act.r),
        ended AS (
            SELECT c.conv_id, min({'cost': best['cost'] + put.cost, 'e': best['e'] || put.e, 't': best['t'] || replace(put.t, ';', chr(10))}) AS best
            FROM convs c JOIN path ON c.conv_id IS NOT DISTINCT FROM path.conv_id AND c.n = path.i
            JOIN put ON put.p = path.st AND put.q IN ('-', 'a') GROUP BY c.conv_id)
        SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(best['cost'] AS BIGINT) AS cost, best['e'] AS audit,
               sha256(CASE WHEN best['t'] = '' THEN '' ELSE left(best['t'], -1) END) AS repaired_sha256
        FROM convs c JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""


SQL["op11_survivor_repair"] = _repairs()
