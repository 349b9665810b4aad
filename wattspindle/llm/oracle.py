"""SQL equivalents of the operators that SQL can express.

Fingerprints, profiles, tokens, trained models and hashed samples have no SQL form, and
byte windows of whole texts are too slow in it; those queries are tested against plain
Python.
"""

from __future__ import annotations

#: CRC-32 of the identifier's decimal digits, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                                         lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

ORACLE_SQL = {
    "op8_embedding_dedup": r"""
        WITH RECURSIVE v AS (
            SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm
            FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
                  ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN least ON vec_id = least.a LEFT JOIN counts ON vec_id = counts.a""",
    "op10_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        windows AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS k
                    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d WHERE len(ws) >= 20)),
        placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS place FROM windows),
        gone AS (SELECT DISTINCT doc_id, p
                 FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM placed WHERE place > 1)),
        words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
                 FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_merkle": f"""
        WITH RECURSIVE d AS (
            SELECT *, {_CRC} AS h,
                   concat_ws('', coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-'),
                             coalesce(octet_length(encode(source)) || ':' || source, '-'),
                             coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
                             coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-')) AS head
            FROM documents),
        hashed AS (
            SELECT doc_id, source,
                   sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(octet_length(encode(text)) || ':' || CASE WHEN h % 5 = 0
                       THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS found
            FROM d),
        leaves AS MATERIALIZED (
            SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx,
                   count(*) OVER (PARTITION BY source) AS n
            FROM hashed),
        low AS (
            SELECT tree, 0 AS lvl, idx, n, leaf AS h FROM leaves
            UNION ALL
            SELECT tree, lvl + 1, idx // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY idx))
            FROM low WHERE n > 1 GROUP BY tree, lvl, idx // 16),
        subroots AS MATERIALIZED (SELECT tree, lvl, h, count(*) OVER () AS n FROM low WHERE n = 1),
        high AS (
            SELECT 0 AS lvl, tree AS idx, n, h FROM subroots
            UNION ALL
            SELECT lvl + 1, idx // 16, (max(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY idx))
            FROM high WHERE n > 1 GROUP BY lvl, idx // 16),
        nodes AS MATERIALIZED (
            SELECT tree, lvl, idx, h FROM low
            UNION ALL SELECT -1, lvl, idx, h FROM high),
        sides AS MATERIALIZED (
            SELECT tree, lvl, idx,
                   coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM nodes WINDOW run AS (PARTITION BY tree, lvl, idx // 16 ORDER BY idx)),
        tops AS MATERIALIZED (
            SELECT tree, lvl AS top, h FROM subroots
            UNION ALL SELECT -1, max(lvl), arg_max(h, lvl) FROM high),
        way AS (
            SELECT doc_id, tree AS own, tree, 0 AS lvl, idx, '' AS proof, found AS node FROM leaves
            UNION ALL
            SELECT w.doc_id, w.own, CASE WHEN w.lvl = t.top THEN -1 ELSE w.tree END,
                   CASE WHEN w.lvl = t.top THEN 0 ELSE w.lvl + 1 END,
                   CASE WHEN w.lvl = t.top THEN w.tree ELSE w.idx // 16 END,
                   CASE WHEN w.lvl = t.top THEN w.proof ELSE w.proof || s.l || s.r END,
                   CASE WHEN w.lvl = t.top THEN w.node ELSE sha256(s.l || w.node || s.r) END
            FROM way w JOIN tops t ON t.tree = w.tree JOIN sides s ON s.tree = w.tree AND s.lvl = w.lvl AND s.idx = w.idx
            WHERE NOT (w.tree = -1 AND w.lvl = t.top))
        SELECT w.doc_id, leaves.leaf, u.h AS subroot, t.h AS root, sha256(w.proof) AS proof_sha256,
               w.node AS folded_root, w.node = t.h AS verified
        FROM way w JOIN tops t ON t.tree = -1 AND w.tree = -1 AND w.lvl = t.top
        JOIN tops u ON u.tree = w.own JOIN leaves USING (doc_id)""",
    "op12_periodic_runs": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {_CRC} AS h
            FROM documents),
        shape AS (SELECT *, len(ws) AS n, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a, 3 + (h // 10) % 8 AS k FROM d),
        words AS MATERIALIZED (
            SELECT doc_id, n, i,
                   ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % (1 + (n - a) // k) ELSE i END] AS w
            FROM (SELECT *, unnest(range(n)) AS i FROM shape)),
        pairs AS (
            SELECT x.doc_id, y.i - x.i AS q, x.i
            FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        stretches AS (
            SELECT doc_id, q, min(i) AS s, count(*) + q AS len
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
            GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
        runs AS MATERIALIZED (SELECT doc_id, s, len, min(q) AS q FROM stretches GROUP BY doc_id, s, len),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
        kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
        listed AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines
            FROM runs GROUP BY doc_id),
        ranked AS (
            SELECT a.*, row_number() OVER (PARTITION BY a.doc_id ORDER BY a.ahead, a.s, a.q) AS place
            FROM (SELECT a.doc_id, a.s, a.len, a.q, count(b.s) AS ahead FROM runs a
                  LEFT JOIN runs b ON a.doc_id = b.doc_id AND b.len * a.q > a.len * b.q GROUP BY ALL) a)
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, r.s AS start, CAST(r.len AS BIGINT) AS length, r.q AS period,
               CAST(1000 * r.len // r.q AS BIGINT) AS exponent_milli,
               sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
        LEFT JOIN ranked r ON r.doc_id = d.doc_id AND r.place = 1""",
    "op13_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        lines AS MATERIALIZED (
            SELECT doc_id, p, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM d)),
        crowded AS (SELECT k FROM lines WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
        kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text, count(*) AS n
                 FROM lines ANTI JOIN crowded USING (k) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(ls) AS BIGINT) AS n_lines, len(ls) - coalesce(n, 0) AS n_dropped,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
}
