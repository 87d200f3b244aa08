"""SQL for DuckDB that gives the same rows, for the queries that SQL can express.

The others learn a model or iterate to a solution; tests hold them against brute force
or held-out labels.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

SQL: dict[str, str] = {
    "op2_secret_ledger": r"""
        WITH rules(o, kind, re, grp, least) AS (VALUES
          (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1, 6),
          (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
          (2, 'hex', '[0-9a-f]+', 0, 24),
          (3, 'private_key', '-----BEGIN (?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY-----', 0, 1),
          (4, 'jwt', '(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})', 1, 1),
          (5, 'prefixed', '(?:gh[pousr]_|github_pat_|xox[abprs]-|sk_live_|glpat-)[A-Za-z0-9_-]{16,}', 0, 1),
          (6, 'url_login', '[a-z][a-z0-9+.-]{1,9}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{6,256}@', 0, 1)),
        found AS (
          SELECT doc_id, o, kind, least, regexp_extract_all(text, re) AS m,
            CASE grp WHEN 1 THEN regexp_extract_all(text, re, 1) ELSE regexp_extract_all(text, re) END AS v,
            string_split_regex(text, re) AS b
          FROM documents, rules WHERE regexp_matches(text, re)),
        numbered AS (
          SELECT *, list_transform(b, lambda x: length(x)) AS bl, list_transform(m, lambda x: length(x)) AS ml,
            unnest(range(1, len(m) + 1)) AS k FROM found),
        spans AS (
          SELECT doc_id, o, kind, (list_sum(bl[1:k]) + coalesce(list_sum(ml[1:k - 1]), 0))::BIGINT AS p, ml[k] AS size,
            CASE kind WHEN 'jwt' THEN ml[k] - length(v[k]) ELSE 0 END AS skipped
          FROM numbered WHERE length(v[k]) >= least),
        said AS (SELECT *, p + skipped AS s, concat(kind, ':', p + skipped, ':', p + size) AS span FROM spans)
        SELECT d.doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access,
          count(*) FILTER (o = 2) AS n_hex,
          sha256(coalesce(string_agg(span, ',' ORDER BY s, o) FILTER (o < 3), '')) AS base_sha256,
          coalesce(string_agg(span, ',' ORDER BY s, o), '') AS spans
        FROM documents d LEFT JOIN said USING (doc_id) GROUP BY d.doc_id""",
    "op5_decontamination": rf"""
        WITH items AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
        wanted AS (
          SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k, least(10, len(w)) AS size
          FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM wanted),
        docs AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
        places AS (
          SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS k
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                FROM docs, sizes WHERE len(w) >= size)),
        hits AS (SELECT doc_id, size, i, item_id FROM places JOIN wanted USING (k, size)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
          sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op7_jaccard_orders": rf"""
        WITH RECURSIVE docs AS (SELECT doc_id, {_SPACED} AS w FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS k
          FROM (SELECT *, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM docs WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
          SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b USING (k)
          JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
          WHERE a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, s.n, t.n
          HAVING 100 * count(*) >= 85 * (s.n + t.n - count(*))),
        reached(doc_id, r) AS (
          SELECT doc_id, doc_id FROM documents
          UNION SELECT reached.doc_id, b FROM reached JOIN links ON a = r)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(r) AS component_id
        FROM documents d JOIN reached USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id, n""",
    "op10_sparse_suffixes": rf"""
        WITH docs AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
        places AS (
          SELECT doc_id, i, array_to_string(w[i + 1:i + 50], ' ') AS k
          FROM (SELECT *, unnest(range(0, len(w) - 49)) AS i FROM docs WHERE len(w) >= 50)),
        again AS (SELECT k FROM places GROUP BY k HAVING count(*) > 1),
        hits AS (SELECT doc_id, i, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -51) > 50 AS fresh
          FROM places SEMI JOIN again USING (k)),
        runs AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits),
        spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
        said AS (SELECT doc_id, sum(b - a)::BIGINT AS n, string_agg(concat(a, ':', b), ',' ORDER BY a) AS spans
          FROM spans GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_repeated, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN said USING (doc_id)""",
    "op11_ranked_search": rf"""
        WITH docs AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
        corpus AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs),
        tfs AS (
          SELECT doc_id, n, term, count(*) AS tf
          FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM docs) GROUP BY ALL),
        weights AS (
          SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
          FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), corpus),
        impacts AS (
          SELECT doc_id, term,
            w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS adds
          FROM tfs JOIN weights USING (term), corpus),
        terms AS (SELECT DISTINCT item_id, unnest({_ALNUM}) AS term FROM benchmark),
        scores AS (
          SELECT item_id, doc_id, sum(adds)::BIGINT AS score
          FROM terms JOIN impacts USING (term) GROUP BY item_id, doc_id),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
          FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_filter_audit": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        first AS (SELECT t, min(doc_id) AS f FROM words GROUP BY t),
        failed AS (
          SELECT part,
            concat(
              CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
              CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
              CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END,
              CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
              CASE WHEN d.doc_id > f THEN 'E' ELSE '' END) AS fails,
            coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
          FROM words d JOIN first USING (t) LEFT JOIN labels l ON l.doc_id = d.doc_id),
        sets AS (
          SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
          FROM failed GROUP BY part, fails),
        orders(o) AS (
          SELECT '' UNION ALL
          SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) letters(f)
          WHERE NOT contains(o, f)),
        steps AS (
          SELECT o, s::INT AS step, o[s] AS f, o[1:s - 1] AS earlier
          FROM (SELECT o, unnest(range(1, 6)) AS s FROM orders WHERE length(o) = 5)),
        marked AS (
          SELECT part, o, step, f, fails, n, good, bad, contains(fails, f) AS fails_it,
            earlier <> '' AND regexp_matches(fails, '[' || earlier || '.]') AS gone
          FROM sets, steps),
        counted AS (
          SELECT part, o AS filter_order, step, f,
            coalesce(sum(n) FILTER (NOT fails_it AND NOT gone), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (fails_it AND NOT gone), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (fails_it AND gone), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
            coalesce(sum(good) FILTER (fails_it AND NOT gone), 0)::BIGINT AS good_lost,
            coalesce(sum(bad) FILTER (fails_it AND NOT gone), 0)::BIGINT AS toxic_lost
          FROM marked GROUP BY part, o, step, f)
        SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM counted""",
}
