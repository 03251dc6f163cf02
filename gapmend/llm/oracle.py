"""The same answers in SQL for DuckDB, where SQL can give them.

The others train models, tokenise, follow links or search; tests hold them
against brute force, exact round trips, or held-out rows.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_UNSPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER_UNSPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_FIELD = "(CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END)"
_FIELDS = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": r"""
        WITH split AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
        ),
        full_lines AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS q
            FROM split WHERE regexp_matches(line, '\S')
        ),
        pairs AS (
            SELECT doc_id, q, line, lead(line) OVER (PARTITION BY doc_id ORDER BY q) AS following
            FROM full_lines
        ),
        copies AS (
            SELECT doc_id, q FROM (
                SELECT *, row_number() OVER (PARTITION BY line, following ORDER BY doc_id, q) AS n
                FROM pairs WHERE following IS NOT NULL
            )
            WHERE n > 1
        ),
        gone AS (
            SELECT 1 AS m, doc_id, q FROM (
                SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, q) AS n FROM full_lines
            )
            WHERE n > 1
            UNION ALL
            SELECT DISTINCT 2 AS m, doc_id, q + step AS q FROM copies, (VALUES (0), (1)) s(step)
        ),
        runs AS (
            SELECT m, doc_id, count(*) AS n FROM (
                SELECT m, doc_id, q - row_number() OVER (PARTITION BY m, doc_id ORDER BY q) AS island FROM gone
            )
            GROUP BY m, doc_id, island
        ),
        found AS (
            SELECT m, doc_id, count(*) AS n, CAST(sum(n) AS BIGINT) AS removed, max(n) AS longest
            FROM runs GROUP BY m, doc_id
        ),
        kept AS (
            SELECT v.m, s.doc_id, string_agg(s.line, chr(10) ORDER BY s.p) AS text
            FROM split s CROSS JOIN (VALUES (1), (2)) v(m)
            LEFT JOIN full_lines f ON f.doc_id = s.doc_id AND f.p = s.p
            LEFT JOIN gone g ON g.m = v.m AND g.doc_id = f.doc_id AND g.q = f.q
            WHERE g.q IS NULL
            GROUP BY v.m, s.doc_id
        )
        SELECT d.doc_id, coalesce(l.n, 0) AS n_lines, coalesce(r.removed, 0) AS n_removed,
               coalesce(r.n, 0) AS n_runs, coalesce(r.longest, 0) AS longest_run,
               CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS kept_sha256,
               coalesce(r2.removed, 0) AS n_long_removed, coalesce(r2.n, 0) AS n_long_runs,
               coalesce(r2.longest, 0) AS longest_long_run,
               CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k2.text, '')) END AS long_kept_sha256
        FROM documents d
        LEFT JOIN (SELECT doc_id, count(*) AS n FROM full_lines GROUP BY doc_id) l USING (doc_id)
        LEFT JOIN found r ON r.m = 1 AND r.doc_id = d.doc_id
        LEFT JOIN found r2 ON r2.m = 2 AND r2.doc_id = d.doc_id
        LEFT JOIN kept k ON k.m = 1 AND k.doc_id = d.doc_id
        LEFT JOIN kept k2 ON k2.m = 2 AND k2.doc_id = d.doc_id
    """,
    "op2_decontamination": f"""
        WITH items AS (
            SELECT item_id, words, least(13, len(words)) AS n
            FROM (SELECT item_id, {_ITEM_WORDS} AS words FROM benchmark) WHERE len(words) > 0
        ),
        item_windows AS (
            SELECT DISTINCT item_id, n, array_to_string(words[s : s + n - 1], ' ') AS window_text
            FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS s FROM items)
        ),
        docs AS (SELECT doc_id, {_ITEM_WORDS} AS words FROM documents),
        doc_windows AS (
            SELECT doc_id, s, n, array_to_string(words[s : s + n - 1], ' ') AS window_text
            FROM (
                SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
                FROM docs, (SELECT DISTINCT n FROM item_windows)
            )
        ),
        hits AS (SELECT doc_id, s, n, item_id FROM doc_windows JOIN item_windows USING (n, window_text)),
        hit_words AS (
            SELECT doc_id, count(DISTINCT w) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS w FROM hits) GROUP BY doc_id
        ),
        hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
    "op3_substring_dedup": f"""
        WITH docs AS (SELECT doc_id, {_UNSPACED} AS words FROM documents),
        windows AS (
            SELECT doc_id, s, array_to_string(words[s : s + 34], ' ') AS window_text
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS s FROM docs)
        ),
        repeated AS (
            SELECT doc_id, s FROM windows
            WHERE window_text IN (SELECT window_text FROM windows GROUP BY window_text HAVING count(*) > 1)
        ),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS w FROM repeated),
        kept AS (
            SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.w) AS text
            FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS w FROM docs) e
            LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.w = e.w
            WHERE g.w IS NULL
            GROUP BY e.doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM docs LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
        LEFT JOIN kept USING (doc_id)
    """,
    "op11_minhash": f"""
        WITH RECURSIVE docs AS (SELECT doc_id, {_LOWER_UNSPACED} AS words FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(words[s : s + 3], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, least(len(words) + 1, 2)))) AS s FROM docs)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS both_have
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
            WHERE 100 * both_have >= 80 * (x.n + y.n - both_have)
        ),
        reach AS (
            SELECT doc_id, doc_id AS root FROM docs
            UNION
            SELECT v, root FROM reach JOIN links ON u = doc_id
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
    """,
    # A CRC-32 goes bit by bit, the lowest first.
    "op12_merkle_manifest": f"""
        WITH RECURSIVE docs AS (
            SELECT *, list_reduce(
                [4294967295::BIGINT] || flatten(list_transform(
                    string_split(CAST(doc_id AS VARCHAR), ''),
                    lambda ch: list_transform(range(8), lambda i: (ascii(ch) >> i) & 1))),
                lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))
            ) & 1 = 1 AS hit
            FROM documents
        ),
        leaves AS (
            SELECT doc_id, source, sha256({_FIELDS} || {_FIELD.format('text')}) AS leaf,
                   sha256({_FIELDS} || {_FIELD.format("CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END")}) AS found
            FROM docs
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY source) AS n
            FROM leaves
        ),
        nodes AS (
            SELECT source, 0 AS level, place, leaf AS digest, n FROM placed
            UNION ALL
            SELECT source, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
            FROM nodes WHERE n > 1 GROUP BY source, level, place // 3
        ),
        subroots AS (
            SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
                   count(*) OVER () AS n
            FROM nodes WHERE n = 1
        ),
        tops AS (
            SELECT 0 AS level, place, subroot AS digest, n FROM subroots
            UNION ALL
            SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
            FROM tops WHERE n > 1 GROUP BY level, place // 3
        ),
        runs AS (
            SELECT source, level, place // 3 AS place, list(digest ORDER BY place) AS run
            FROM nodes WHERE n > 1 GROUP BY source, level, place // 3
        ),
        top_runs AS (
            SELECT level, place // 3 AS place, list(digest ORDER BY place) AS run FROM tops WHERE n > 1 GROUP BY level, place // 3
        ),
        climb AS (
            SELECT doc_id, source, leaf, 0 AS level, place, place AS spot, n, '' AS proof, found AS folded FROM placed
            UNION ALL
            SELECT doc_id, c.source, leaf, c.level + 1, c.place, spot // 3, (n + 2) // 3,
                   proof || array_to_string(run[: spot % 3] || run[spot % 3 + 2 :], ''),
                   sha256(array_to_string(run[: spot % 3] || [folded] || run[spot % 3 + 2 :], ''))
            FROM climb c JOIN runs r ON r.source IS NOT DISTINCT FROM c.source AND r.level = c.level AND r.place = spot // 3
            WHERE n > 1
        ),
        climb_top AS (
            SELECT doc_id, leaf, subroot, 0 AS level, s.place AS spot, s.n, proof, folded
            FROM climb c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source
            WHERE c.n = 1
            UNION ALL
            SELECT doc_id, leaf, subroot, c.level + 1, spot // 3, (n + 2) // 3,
                   proof || array_to_string(run[: spot % 3] || run[spot % 3 + 2 :], ''),
                   sha256(array_to_string(run[: spot % 3] || [folded] || run[spot % 3 + 2 :], ''))
            FROM climb_top c JOIN top_runs r ON r.level = c.level AND r.place = spot // 3
            WHERE n > 1
        )
        SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
        FROM climb_top, (SELECT digest FROM tops WHERE n = 1) WHERE climb_top.n = 1
    """,
}
