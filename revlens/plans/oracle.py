"""The registered queries in plain SQL, for another engine to check them by."""

from __future__ import annotations

from revlens import fixed_values as fixed
from revlens.functions.text import WHITESPACE
from revlens.plans.driver_tables import REPLIES


def _text(value: str) -> str:
    """A SQL string literal; line feeds are spelled as chr(10)."""
    return "(" + " || chr(10) || ".join(f"'{p}'" for p in value.replace("'", "''").split("\n")) + ")"


def _strip(x: str, how: str = "trim") -> str:
    chars = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
    return f"{how}({x}, {chars})"


def _joined(title: str, body: str) -> str:
    return _strip(f"({title} || chr(10) || chr(10) || {body})")


def _filled(template: str, **values: str) -> str:
    out = _text(template)
    for name, value in values.items():
        out = out.replace("{" + name + "}", f"' || {value} || '")
    return out


def _product_id(key: str) -> str:
    return f"'prod-' || lpad(({key})::VARCHAR, greatest(3, length(({key})::VARCHAR))::INT, '0')"


TABLES = {
    "reviews": """
        SELECT d.doc_id AS seq,
               'rev-' || lpad(d.doc_id::VARCHAR, greatest(4, length(d.doc_id::VARCHAR))::INT, '0')
                   AS review_id,
               {product_id} AS product_id,
               p.p_name AS product_name, d.lang AS source_language,
               (1 + (d.doc_id * 7 + d.n_chars) % 7)::INT AS rating,
               split_part(d.text, chr(10), 1) AS title, d.text AS body
        FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 101
                             ELSE doc_id % (SELECT count(*) FROM part) END AS key FROM documents) d
        LEFT JOIN part p ON p.p_partkey = d.key""".replace("{product_id}", _product_id("d.key")),
    "violations": """
        SELECT seq, review_id, u.path, u.message, u.ord FROM reviews, LATERAL (
            SELECT 1 AS ord, 'body' AS path, 'is shorter than 1 character' AS message
                WHERE length(body) < 1
            UNION ALL SELECT 2, 'body', 'is longer than 2000 characters' WHERE length(body) > 2000
            UNION ALL SELECT 3, 'rating', 'is below 1' WHERE rating < 1
            UNION ALL SELECT 4, 'rating', 'is above 5' WHERE rating > 5
            UNION ALL SELECT 5, 'source_language', 'is not one of en, fr, de, es, it, pt'
                WHERE source_language NOT IN ('en', 'fr', 'de', 'es', 'it', 'pt')
            UNION ALL SELECT 6, 'title', 'is shorter than 1 character' WHERE length(title) < 1
            UNION ALL SELECT 7, 'title', 'is longer than 120 characters' WHERE length(title) > 120
        ) u""",
    "valid": "SELECT * FROM reviews WHERE seq NOT IN (SELECT seq FROM violations)",
    "fan": """
        SELECT r.*, lang_pos::INT AS lang_pos, (['fr', 'de'])[lang_pos + 1] AS language
        FROM reviews r, (SELECT unnest([0, 1]) AS lang_pos) WHERE source_language <> 'en'""",
    "attempts": """
        SELECT *,
               CASE WHEN (length(title) + ascii(language)) % 11 <> 0
                    THEN '[' || language || '] ' || title END AS t_title,
               CASE WHEN (length(body) + ascii(language)) % 11 <> 0
                    THEN '[' || language || '] ' || body END AS t_body
        FROM fan""",
    "pairs": "SELECT * FROM attempts WHERE t_title IS NOT NULL AND t_body IS NOT NULL",
    "texts": f"""
        SELECT *, {_joined("title", "body")} AS source_text,
               {_joined("t_title", "t_body")} AS translated_text FROM pairs""",
    "prompted": "SELECT *, "
    + _filled(
        fixed.JUDGE_PROMPT,
        source_language="source_language",
        target_language="language",
        source_text="source_text",
        translated_text="translated_text",
        scale_min="'1'",
        scale_max="'5'",
    )
    + " AS prompt FROM texts",
    "scored": """
        SELECT *, score >= 3.0 AS kept FROM (
            SELECT *, length(translated_text) % 17 = 0 AS failed,
                   CASE WHEN length(translated_text) % 17 = 0 THEN 1.0::DOUBLE
                        ELSE (1.0 + (length(translated_text) % 9) * 0.5)::DOUBLE END AS score
            FROM texts)""",
    "entries": """
        SELECT seq, product_id, review_id, source_language AS language, title, body, rating,
               0 AS lang_pos
        FROM reviews WHERE source_language = 'en'
        UNION ALL
        SELECT seq, product_id, review_id, language, t_title, t_body, rating, lang_pos
        FROM scored WHERE kept""",
    "latest": """
        SELECT product_id, s.product_name, s.review_count, s.summary FROM (
            SELECT product_id, arg_max({'product_name': product_name,
                       'review_count': rating::BIGINT, 'summary': title}, seq) AS s
            FROM (SELECT {product_id} AS product_id, product_name, rating, title, seq
                  FROM (SELECT *, 2 * (seq % (SELECT count(*) FROM part)) AS key FROM reviews))
            GROUP BY product_id)""".replace("{product_id}", _product_id("key")),
    "headers": """
        SELECT coalesce(r.product_id, l.product_id) AS product_id, coalesce(reviews, 0) AS reviews,
               l.product_name, l.review_count, coalesce(l.summary, '') AS summary,
               l.product_id IS NOT NULL AS has_summary
        FROM (SELECT product_id, count(*) AS reviews FROM reviews GROUP BY 1) r
        FULL JOIN latest l ON r.product_id = l.product_id""",
    "requests": """
        SELECT l_orderkey AS request_id, l_linenumber::INT AS request_line,
               {product_id} AS product_id
        FROM (SELECT *, l_partkey + CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN 0
                                         ELSE (SELECT count(*) FROM part) // 4 END AS key
              FROM lineitem)""".replace("{product_id}", _product_id("key")),
    "trips": """
        SELECT *, CASE WHEN NOT title_failed THEN
                      CASE WHEN length(t_title) % 2 = 0 THEN substr(t_title, 6) ELSE t_title END
                  END AS back_title,
               CASE WHEN NOT title_failed AND NOT body_failed THEN
                      CASE WHEN length(t_body) % 2 = 0 THEN substr(t_body, 6) ELSE t_body END
                  END AS back_body
        FROM (SELECT *, length(t_title) % 13 = 0 AS title_failed,
                     length(t_body) % 13 = 0 AS body_failed FROM scored)""",
    "trip_tokens": f"""
        SELECT *, {_joined("coalesce(back_title, '')", "coalesce(back_body, '')")} AS back_text,
               regexp_extract_all(lower(source_text), '[\\p{{L}}\\p{{N}}_]+') AS a
        FROM trips""",
    "judged": """
        SELECT *, CASE WHEN title_failed OR body_failed THEN 0.0::DOUBLE
                       ELSE {similarity} END AS similarity
        FROM (SELECT *, regexp_extract_all(lower(back_text), '[\\p{L}\\p{N}_]+') AS b
              FROM trip_tokens)""",
    "repeated": """
        SELECT * REPLACE ('rev-' || (seq // 3)::VARCHAR AS review_id) FROM judged""",
    "lines": "SELECT product_id, product_name, seq, "
    "row_number() OVER (PARTITION BY product_id ORDER BY seq) AS position, "
    "count(*) OVER (PARTITION BY product_id) AS review_count, "
    "rating, title, body FROM reviews",
    "line_texts": "SELECT product_id, product_name, review_count, position, "
    + _strip(
        "(position::VARCHAR || '. (rating: ' || rating::VARCHAR || ') ' || title || ': ' || body)",
        "rtrim",
    )
    + " AS line FROM lines",
    "phrase_rows": """
        SELECT doc_id // 144 AS library_id,
               (['en', 'fr', 'de', 'es', 'it', 'pt'])[n_chars % 6 + 1] AS lang,
               (['titles', 'sentences'])[doc_id % 2 + 1] AS kind,
               (['positive', 'neutral', 'negative'])[(doc_id // 2) % 3 + 1] AS sentiment,
               doc_id, line, words || ' {product}' AS phrase
        FROM (SELECT doc_id, n_chars, unnest(string_split(text, chr(10))) AS words,
                     unnest(range(len(string_split(text, chr(10))))) AS line FROM documents)""",
}

_SIMILARITY = """CASE WHEN len(a) = 0 AND len(b) = 0 THEN 1.0::DOUBLE
    WHEN len(a) = 0 OR len(b) = 0 THEN 0.0::DOUBLE
    ELSE round_even(
        0.75::DOUBLE * (len(list_intersect(list_distinct(a), list_distinct(b)))::DOUBLE
            / len(list_distinct(list_concat(a, b))))
        + 0.25::DOUBLE * (least(len(a), len(b))::DOUBLE / greatest(len(a), len(b))), 4) END"""
TABLES["judged"] = TABLES["judged"].replace("{similarity}", _SIMILARITY)

_NEEDS = {
    "reviews": [],
    "violations": ["reviews"],
    "valid": ["reviews", "violations"],
    "fan": ["reviews"],
    "attempts": ["fan"],
    "pairs": ["attempts"],
    "texts": ["pairs"],
    "prompted": ["texts"],
    "scored": ["texts"],
    "entries": ["reviews", "scored"],
    "latest": ["reviews"],
    "headers": ["reviews", "latest"],
    "requests": [],
    "trips": ["scored"],
    "trip_tokens": ["trips"],
    "judged": ["trip_tokens"],
    "repeated": ["judged"],
    "lines": ["reviews"],
    "line_texts": ["lines"],
    "phrase_rows": [],
}


def _sql(tables: str, select: str) -> str:
    """``select`` under the definitions of ``tables`` and all they rest on."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS[name]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in tables.split():
        add(name)
    defined = ",\n".join(f"{name} AS ({TABLES[name]})" for name in order)
    return f"WITH {defined}\n{select}" if defined else select


def _percent(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} = 0 THEN 0.0::DOUBLE "
        f"ELSE round_even(100.0::DOUBLE * ({part}) / {whole}, 1) END"
    )


def _parsed(reply: str) -> str:
    number = f"try_cast(nullif(regexp_extract({reply}, '-?\\d+(?:\\.\\d+)?', 0), '') AS DOUBLE)"
    return f"CASE WHEN {number} IS NULL THEN 1.0::DOUBLE ELSE greatest(1.0::DOUBLE, least(5.0::DOUBLE, {number})) END"


def _metrics(judged: str, targets: list[str]) -> str:
    listed = ", ".join(f"({i}, '{t}')" for i, t in enumerate(targets))
    return f"""
        last AS (SELECT review_id, language, arg_max(similarity, seq) AS similarity
                 FROM {judged} GROUP BY 1, 2),
        found AS (SELECT j.language, count(*) AS n, count(*) FILTER (j.kept) AS k,
                         sum(j.score) AS scores,
                         sum(l.similarity::DECIMAL(9, 4))::DOUBLE AS similarities
                  FROM {judged} j JOIN last l USING (review_id, language) GROUP BY 1),
        metrics AS (
            SELECT t.lang_pos::INT AS lang_pos, coalesce(t.language, f.language) AS language,
                   coalesce(n, 0) AS translation_count, coalesce(k, 0) AS kept_count,
                   coalesce(n, 0) - coalesce(k, 0) AS filtered_count,
                   round_even(scores / n, 3) AS mean_judge_score,
                   round_even(similarities / n, 3) AS mean_similarity,
                   {_percent("coalesce(k, 0)", "coalesce(n, 0)")} AS kept_pct,
                   {_percent("coalesce(n, 0) - coalesce(k, 0)", "coalesce(n, 0)")} AS filtered_pct
            FROM (VALUES {listed}) t(lang_pos, language) FULL JOIN found f ON t.language = f.language)
    """


def _prompts(width: int) -> str:
    head = _filled(
        fixed.SUMMARY_PROMPT_HEAD, product_name="n.product_name", review_count="review_count::VARCHAR"
    )
    return f"""
        named AS (SELECT product_id, product_name FROM lines WHERE position = 1),
        prompts AS (
            SELECT t.product_id, n.product_name, review_count, (position - 1) // {width} AS part,
                   {head} || chr(10) || string_agg(line, chr(10) ORDER BY position) AS prompt
            FROM line_texts t JOIN named n USING (product_id) GROUP BY 1, 2, 3, 4)"""


def _packed(chars: int) -> str:
    piece = chars // 8
    step = piece - 34
    head = _filled(
        fixed.SUMMARY_PROMPT_HEAD,
        product_name=f"left(n.product_name, {chars // 4})",
        review_count="review_count::VARCHAR",
    )
    return f"""
        named AS (SELECT product_id, product_name FROM lines WHERE position = 1),
        pieces AS (
            SELECT product_id, n.product_name, review_count, position, piece, {head} AS head,
                   CASE WHEN piece = 0 THEN '' ELSE position::VARCHAR || '. (continued) ' END
                       || substr(line, piece * {step} + 1, {step}) AS text
            FROM (SELECT *, unnest(range(greatest(1, (length(line) + {step - 1}) // {step}))) AS piece
                  FROM line_texts) JOIN named n USING (product_id)),
        placed AS (
            SELECT *, coalesce(sum(length(text) + 1) OVER (
                PARTITION BY product_id ORDER BY position, piece
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
            FROM pieces),
        prompts AS (
            SELECT product_id, product_name, review_count, ahead // ({chars - piece} - length(head)) AS part,
                   head || chr(10) || string_agg(text, chr(10) ORDER BY position, piece) AS prompt
            FROM placed GROUP BY product_id, product_name, review_count, part, head)"""


def _with_more(tables: str, more: str, select: str) -> str:
    return _sql(tables, f", {more}\n{select}")


def _reply(text: str) -> str:
    return "([" + ", ".join(f"'{r}'" for r in REPLIES) + f"])[length({text}) % {len(REPLIES)} + 1]"


_ENVELOPE = """
    SELECT ((seq // 16) << 32) + row_number() OVER (PARTITION BY seq // 16 ORDER BY seq) - 1 AS seq,
           review_id, rating, md5(body) AS body_md5,
           (SELECT count(*) FROM violations v WHERE v.seq = r.seq)::INT AS error_count
    FROM reviews r"""

_ODD = """
    SELECT seq, CASE WHEN seq % 8 = 7 THEN NULL ELSE review_id END AS review_id,
           CASE WHEN seq % 8 = 7 THEN '<root>: is not an object'
                WHEN seq % 8 = 6 THEN '<root>: rating is required'
                WHEN b > 2000 THEN 'body: is longer than 2000 characters'
                WHEN seq % 8 IN (1, 2, 3) THEN 'rating: is not an integer'
                WHEN rating > 5 THEN 'rating: is above 5'
                WHEN seq % 8 = 5 THEN 'source_language: is not a string'
                ELSE 'title: is longer than 120 characters' END AS first_error,
           CASE WHEN seq % 8 = 7 THEN 1 ELSE errors END::INT AS error_count
    FROM (SELECT seq, review_id, rating, length(body) AS b,
                 (length(body) > 2000)::INT + (length(title) > 120)::INT
                 + CASE seq % 8 WHEN 1 THEN 1 WHEN 2 THEN 1
                        WHEN 3 THEN 1 + (rating + 0.5 > 5)::INT
                        WHEN 6 THEN 2 ELSE (rating > 5)::INT END
                 + CASE WHEN seq % 8 = 5 THEN 2 ELSE 0 END AS errors
          FROM reviews)
    WHERE seq % 8 = 7 OR errors > 0"""

_ATTEMPTS = """
    SELECT seq, lang_pos, language AS target_language, md5(t_title) AS title_md5,
           md5(t_body) AS body_md5, (t_title IS NULL OR t_body IS NULL) AS failed FROM attempts"""

_ENTRY = "seq, product_id, review_id, language, md5(title) AS title_md5, md5(body) AS body_md5, rating"

_SUMMARIZED = """
    SELECT product_id, product_name, review_count,
           CASE WHEN length(prompt) % 7 = 0 THEN '' ELSE md5(prompt) END AS summary"""

_ROUNDS = """
    first_round AS (SELECT *, length(prompt) % 7 = 0 AS failed, md5(prompt) AS answer FROM prompts),
    second_round AS (
        SELECT product_id, product_name, review_count, bool_or(failed) AS failed,
               {head} || chr(10) || string_agg((part + 1)::VARCHAR || '. ' || answer, chr(10) ORDER BY part)
                   AS prompt,
               any_value(answer) AS only_answer
        FROM first_round n GROUP BY 1, 2, 3)"""


def _draw(seed: int, key: str, salt: str, i: int) -> str:
    return f"('0x' || substr(md5('{seed}|' || ({key})::VARCHAR || '|{salt}'), {1 + 8 * i}, 8))::BIGINT"


def _draw60(seed: int, key: str) -> str:
    return f"('0x' || substr(md5('{seed}|' || ({key})::VARCHAR), 1, 15))::BIGINT"


def _rating(draw: str) -> str:
    reached, cases = 0.0, ""
    for rating, weight in list(fixed.RATING_WEIGHTS.items())[:-1]:
        reached += weight
        cases += f" WHEN {draw} / 4294967296.0::DOUBLE < {reached!r}::DOUBLE THEN {rating}"
    return f"(CASE{cases} ELSE {list(fixed.RATING_WEIGHTS)[-1]} END)::INT"


_WEIGHTS = ", ".join(
    f"({i}, '{lang}', {w}::DOUBLE)" for i, (lang, w) in enumerate(fixed.LANGUAGE_WEIGHTS.items())
)


def _quotas(totals: str) -> str:
    return f"""
        raw_quota AS (SELECT plan, total, ord, lang, total * weight AS raw, floor(total * weight) AS base
                      FROM ({totals}), (VALUES {_WEIGHTS}) w(ord, lang, weight)),
        quota AS (
            SELECT plan, ord::INT AS ord, lang, (base + (place <= spare)::INT)::BIGINT AS quota FROM (
                SELECT *, total - sum(base) OVER (PARTITION BY plan) AS spare,
                       row_number() OVER (PARTITION BY plan ORDER BY raw - base DESC, ord) AS place
                FROM raw_quota))"""


def _synth() -> str:
    d = lambda salt, i: _draw(42, "seq", salt, i)
    name = lambda place: f"replace({place}.phrase, '{{product}}', p_name)"
    side = lambda place, kind, idx: (
        f"LEFT JOIN numbered {place} ON {place}.kind = '{kind}' AND {place}.lang = c.lang "
        f"AND {place}.sentiment = c.sentiment AND {place}.idx = {idx}"
    )
    return f"""
        numbered AS (SELECT *, row_number() OVER (PARTITION BY lang, kind, sentiment ORDER BY doc_id, line) - 1
                         AS idx FROM phrase_rows),
        pools AS (SELECT lang, sentiment, count(*) FILTER (kind = 'titles') AS nt,
                         count(*) FILTER (kind = 'sentences') AS ns FROM phrase_rows GROUP BY 1, 2),
        {_quotas("SELECT 0 AS plan, count(*) AS total FROM lineitem")},
        bounds AS (SELECT lang, sum(quota) OVER (ORDER BY ord) AS upto, quota FROM quota),
        ids AS (SELECT unnest(range(1, (SELECT count(*) FROM lineitem) + 1)) AS seq),
        drawn AS (SELECT seq, lang, {d("a", 0)} % (SELECT count(*) FROM part) AS product,
                         {_rating(d("a", 1))} AS rating
                  FROM ids JOIN bounds ON seq <= upto AND seq > upto - quota),
        felt AS (SELECT *, CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral'
                                ELSE 'negative' END AS sentiment FROM drawn),
        chosen AS (
            SELECT f.*, {d("a", 2)} % nt AS t, 1 + {d("a", 3)} % least(3, ns) AS n,
                   {d("b", 0)} % ns AS s1, {d("b", 1)} % greatest(ns - 1, 1) AS x2,
                   {d("b", 2)} % greatest(ns - 2, 1) AS x3
            FROM felt f JOIN pools USING (lang, sentiment)),
        two AS (SELECT *, x2 + (x2 >= s1)::INT AS s2 FROM chosen),
        three AS (SELECT *, x3 + (x3 >= least(s1, s2))::INT AS y3 FROM two),
        c AS (SELECT *, y3 + (y3 >= greatest(s1, s2))::INT AS s3 FROM three)
        SELECT 'rev-' || lpad(seq::VARCHAR, greatest(4, length(seq::VARCHAR))::INT, '0') AS review_id,
               'prod-' || product::VARCHAR AS product_id, c.lang AS source_language, rating,
               md5(substr({name("pt")}, 1, 120)) AS title_md5,
               md5(substr(concat_ws(' ', {name("p1")}, {name("p2")}, {name("p3")}), 1, 2000)) AS body_md5
        FROM c JOIN part ON p_partkey = product
        {side("pt", "titles", "t")}
        {side("p1", "sentences", "s1")}
        {side("p2", "sentences", "CASE WHEN n >= 2 THEN s2 END")}
        {side("p3", "sentences", "CASE WHEN n >= 3 THEN s3 END")}"""


_RUN_SCORED = f"""
    run_scored AS (SELECT *, {_reply("prompt")} AS reply, length(prompt) % 17 = 0 AS failed
                   FROM prompted WHERE seq IN (SELECT seq FROM valid)),
    run_kept AS (SELECT *, CASE WHEN failed THEN 1.0 ELSE {_parsed("reply")} END >= 3.0 AS kept
                 FROM run_scored)"""


def oracle_sql() -> dict[str, str]:
    head = _filled(
        fixed.SUMMARY_PROMPT_HEAD, product_name="product_name", review_count="review_count::VARCHAR"
    )
    return {
        "read_envelope": _sql(
            "violations",
            """SELECT row_number() OVER (ORDER BY seq) - 1 AS seq, review_id, rating, md5(body) AS body_md5,
                   coalesce(n, 0)::INT AS error_count
               FROM reviews LEFT JOIN (SELECT seq, count(*) AS n FROM violations GROUP BY 1) v USING (seq)""",
        ),
        "read_bare_array": _sql("violations", _ENVELOPE),
        "read_json_lines": _sql(
            "violations",
            """SELECT seq, review_id, rating, md5(body) AS body_md5, coalesce(n, 0)::INT AS error_count
               FROM reviews LEFT JOIN (SELECT seq, count(*) AS n FROM violations GROUP BY 1) v USING (seq)""",
        ),
        "phrases_flatten": _sql(
            "phrase_rows",
            "SELECT library_id, lang, kind, sentiment, (row_number() OVER (PARTITION BY library_id,"
            " lang, kind, sentiment ORDER BY doc_id, line) - 1)::INT AS idx, phrase FROM phrase_rows",
        ),
        "phrase_bank_gaps": _sql(
            "phrase_rows",
            """SELECT w.*, coalesce(n, 0)::INT AS found FROM (
                   SELECT DISTINCT l.library_id, a.lang, k.kind, s.sentiment FROM phrase_rows l,
                   (SELECT unnest(['en', 'fr', 'de', 'es', 'it', 'pt']) AS lang) a,
                   (SELECT unnest(['titles', 'sentences']) AS kind) k,
                   (SELECT unnest(['positive', 'neutral', 'negative']) AS sentiment) s) w
               LEFT JOIN (SELECT library_id, lang, kind, sentiment, count(*) AS n
                          FROM phrase_rows GROUP BY 1, 2, 3, 4) f
               USING (library_id, lang, kind, sentiment) WHERE coalesce(n, 0) < 3""",
        ),
        "validation_violations": _sql("violations", "SELECT seq, path, message FROM violations"),
        "json_violations": _sql("reviews", _ODD),
        "valid_reviews": _sql(
            "valid",
            "SELECT seq, review_id, product_id, product_name, source_language, rating, title,"
            " md5(body) AS body_md5 FROM valid",
        ),
        "rejected_reviews": _sql(
            "violations",
            "SELECT seq, any_value(review_id) AS review_id,"
            " arg_min(path || ': ' || message, ord) AS first_error,"
            " count(*)::INT AS error_count FROM violations GROUP BY seq",
        ),
        "ingest_counts": _sql(
            "valid",
            "SELECT count(*) AS loaded, (SELECT count(*) FROM valid) AS valid,"
            " count(*) - (SELECT count(*) FROM valid) AS dropped FROM reviews",
        ),
        "route_counts": _sql(
            "reviews",
            "SELECT count(*) AS reviews_in, count(*) FILTER (source_language <> 'en')"
            " AS translated_reviews, count(*) FILTER (source_language = 'en')"
            " AS passthrough_reviews FROM reviews",
        ),
        "translation_fanout": _sql(
            "fan",
            "SELECT seq, review_id, source_language, lang_pos, language AS target_language FROM fan",
        ),
        "translate_batch_udf": _sql("attempts", _ATTEMPTS),
        "translate_dedup": _sql("attempts", _ATTEMPTS),
        "translate_memory": _sql(
            "attempts",
            """SELECT md5(text) AS text_md5, source_language AS source, language AS target,
                   md5(any_value(answer)) AS value_md5, bool_or(answer IS NULL) AS failed,
                   bool_or(answer IS NOT NULL AND seq % 2 = 0) AS remembered
               FROM (SELECT seq, source_language, language, title AS text, t_title AS answer FROM attempts
                     UNION ALL SELECT seq, source_language, language, body, t_body FROM attempts)
               GROUP BY text, source_language, language""",
        ),
        "translation_failures": _sql(
            "attempts",
            "SELECT seq, review_id, source_language, lang_pos, language AS target_language,"
            " 'ConnectionError' AS error FROM attempts WHERE t_title IS NULL OR t_body IS NULL",
        ),
        "translation_pairs_ok": _sql(
            "pairs",
            "SELECT seq, language, md5(t_title) AS title_md5, md5(t_body) AS body_md5,"
            " 'echo' AS engine FROM pairs",
        ),
        "translations_wide": _sql(
            "pairs",
            """SELECT r.seq, r.review_id, count(p.seq)::INT AS languages,
                   coalesce(string_agg(p.language, ',' ORDER BY p.lang_pos), '') AS language_list,
                   md5(max(p.t_title) FILTER (p.language = 'fr')) AS fr_title_md5,
                   md5(max(p.t_body) FILTER (p.language = 'de')) AS de_body_md5
               FROM reviews r LEFT JOIN pairs p ON r.seq = p.seq GROUP BY 1, 2""",
        ),
        "product_review_count": _sql(
            "reviews", "SELECT product_id, count(*) AS review_count FROM reviews GROUP BY 1"
        ),
        "product_first_name": _sql(
            "reviews",
            """SELECT product_id, coalesce(nullif(arg_min(name, seq), ''), product_id) AS product_name
               FROM (SELECT *, CASE WHEN seq % 5 = 0 THEN ''
                     ELSE product_name || ' ' || (seq % 3)::VARCHAR END AS name FROM reviews)
               GROUP BY product_id""",
        ),
        "summary_prompt_digest": _with_more(
            "line_texts",
            _prompts(1000),
            "SELECT product_id, product_name, review_count, part, md5(prompt) AS prompt_md5 FROM prompts",
        ),
        "summary_prompt_parts": _with_more(
            "line_texts",
            _prompts(20),
            "SELECT product_id, product_name, review_count, part, md5(prompt) AS prompt_md5 FROM prompts",
        ),
        "summary_prompt_packed": _with_more("line_texts", _packed(4000), """
            SELECT product_id, product_name, review_count, part, length(prompt)::INT AS chars,
                   md5(prompt) AS prompt_md5 FROM prompts"""),
        "summarize_batch_udf": _with_more(
            "line_texts",
            _prompts(1000),
            _SUMMARIZED
            + ", (CASE WHEN length(prompt) % 7 = 0 THEN 0 ELSE 32 END)::INT AS summary_length FROM prompts",
        ),
        "summarize_rounds": _with_more(
            "line_texts",
            _prompts(50) + "," + _ROUNDS.replace("{head}", head),
            """SELECT product_id, product_name, review_count,
                      CASE WHEN failed THEN '' WHEN review_count <= 50 THEN only_answer
                           WHEN length(prompt) % 7 = 0 THEN '' ELSE md5(prompt) END AS summary
               FROM second_round""",
        ),
        "judge_text": _sql(
            "texts",
            "SELECT seq, language, md5(source_text) AS source_md5,"
            " md5(translated_text) AS translated_md5 FROM texts",
        ),
        "judge_prompt_digest": _sql(
            "prompted", "SELECT seq, language, md5(prompt) AS prompt_md5 FROM prompted"
        ),
        "judge_batch_udf": _sql(
            "prompted",
            f"""SELECT seq, language, score, score >= 3.0 AS kept, failed FROM (
                    SELECT seq, language, length(prompt) % 17 = 0 AS failed,
                           CASE WHEN length(prompt) % 17 = 0 THEN 1.0::DOUBLE
                                ELSE {_parsed(_reply("prompt"))} END AS score FROM prompted)""",
        ),
        "parse_judge_reply": _sql(
            "reviews", f"SELECT seq, {_parsed(_reply('body'))} AS score FROM reviews"
        ),
        "parse_text_numbers": _sql("reviews", f"SELECT seq, {_parsed('body')} AS score FROM reviews"),
        "judge_error_floor": _sql(
            "scored", "SELECT seq, language, score, kept, failed FROM scored WHERE failed"
        ),
        "kept_flag": """
            SELECT event_id, event_id % 10 <> 0 AND 1 + value - 5 * floor(value / 5) >= 3.0 AS kept
            FROM events""",
        "quality_wide": _sql(
            "scored",
            """SELECT r.seq, r.review_id, count(s.seq) OVER (PARTITION BY r.seq)::INT AS judged,
                      s.language, s.score, s.kept
               FROM reviews r LEFT JOIN scored s ON r.seq = s.seq""",
        ),
        "filter_kept": _sql(
            "scored",
            """SELECT r.seq, r.review_id, count(s.seq)::INT AS verdicts,
                      coalesce(string_agg(s.language, ',' ORDER BY s.lang_pos), '') AS language_list
               FROM reviews r LEFT JOIN scored s ON r.seq = s.seq AND s.kept GROUP BY 1, 2""",
        ),
        "quality_counts": _sql(
            "scored",
            """SELECT (SELECT count(*) FROM reviews) AS reviews, count(*) AS translations,
                      count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS filtered,
                      count(*) FILTER (failed) AS errors FROM scored""",
        ),
        "served_passthrough": _sql(
            "reviews",
            f"SELECT {_ENTRY} FROM (SELECT *, source_language AS language FROM reviews)"
            " WHERE source_language = 'en'",
        ),
        "served_translated": _sql(
            "entries", f"SELECT {_ENTRY} FROM entries WHERE seq NOT IN"
            " (SELECT seq FROM reviews WHERE source_language = 'en')",
        ),
        "served_entries": _sql("entries", f"SELECT {_ENTRY} FROM entries"),
        "summary_last_wins": _sql("latest", "SELECT * FROM latest"),
        "product_page": _sql(
            "entries headers",
            """SELECT product_id, 0::BIGINT AS page_no, 0::BIGINT AS position, '' AS review_id,
                      '' AS language, NULL::INT AS rating, md5(summary) AS text_md5 FROM headers
               UNION ALL
               SELECT product_id, (position - 1) // 25, position, review_id, language, rating, md5(body)
               FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq, lang_pos)
                         AS position FROM entries)""",
        ),
        "summary_lookup": _sql(
            "headers requests",
            """SELECT r.*, h.product_name, h.review_count, h.summary,
                      h.product_id IS NOT NULL AS found,
                      CASE WHEN h.product_id IS NULL THEN 'not_found' END AS error
               FROM requests r LEFT JOIN headers h ON r.product_id = h.product_id AND h.has_summary""",
        ),
        "lookup_not_found": _sql(
            "headers requests",
            """SELECT r.*, h.product_id IS NOT NULL AS found,
                      CASE WHEN h.product_id IS NULL THEN 'not_found' END AS error, h.reviews
               FROM requests r LEFT JOIN headers h ON r.product_id = h.product_id""",
        ),
        "page_lookup": _sql(
            "entries headers requests",
            """SELECT r.*, h.product_id IS NOT NULL AS found,
                      CASE WHEN h.product_id IS NULL THEN 'not_found' END AS error,
                      md5(h.summary) AS summary_md5, e.position, e.review_id, e.language, e.rating,
                      md5(e.body) AS body_md5
               FROM requests r LEFT JOIN headers h ON r.product_id = h.product_id
               LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq, lang_pos)
                              AS position FROM entries) e ON r.product_id = e.product_id""",
        ),
        "back_translate_batch": _sql(
            "judged",
            """SELECT seq, review_id, product_id, source_language, language,
                      md5(back_title) AS title_md5, md5(back_body) AS body_md5,
                      CASE WHEN title_failed OR body_failed THEN 'TimeoutError' END AS error,
                      similarity FROM judged""",
        ),
        "tokenize_counts": """
            SELECT doc_id, len(t)::INT AS tokens, len(list_distinct(t))::INT AS vocabulary
            FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS t
                  FROM documents)""",
        "roundtrip_similarity": f"""
            SELECT doc_id, {_SIMILARITY} AS similarity FROM (
                SELECT x.doc_id, regexp_extract_all(lower(x.text), '[\\p{{L}}\\p{{N}}_]+') AS a,
                       regexp_extract_all(lower(y.text), '[\\p{{L}}\\p{{N}}_]+') AS b
                FROM documents x JOIN documents y ON y.doc_id = x.doc_id + 1)""",
        "detail_rows": _sql(
            "repeated",
            """SELECT seq, review_id, product_id, language, score AS judge_score, kept, l.similarity
               FROM repeated JOIN (SELECT review_id, language, arg_max(similarity, seq) AS similarity
                                   FROM repeated GROUP BY 1, 2) l USING (review_id, language)""",
        ),
        "language_metrics": _with_more(
            "valid",
            f"""
            echo AS (SELECT r.seq, r.review_id, r.source_language,
                            (['fr', 'de'])[p + 1] AS language, title, body,
                            '[' || (['fr', 'de'])[p + 1] || '] ' || title AS t_title,
                            '[' || (['fr', 'de'])[p + 1] || '] ' || body AS t_body
                     FROM valid r, (SELECT unnest([0, 1]) AS p) WHERE source_language <> 'en'),
            echo_texts AS (SELECT *, {_joined("title", "body")} AS source_text,
                                  length({_joined("t_title", "t_body")}) AS n,
                                  {_joined("'[' || source_language || '] ' || t_title",
                                           "'[' || source_language || '] ' || t_body")} AS back_text
                           FROM echo),
            echo_tokens AS (
                SELECT *, CASE WHEN n % 17 = 0 THEN 1.0::DOUBLE ELSE (1.0 + (n % 9) * 0.5)::DOUBLE END
                              AS score,
                       regexp_extract_all(lower(source_text), '[\\p{{L}}\\p{{N}}_]+') AS a,
                       regexp_extract_all(lower(back_text), '[\\p{{L}}\\p{{N}}_]+') AS b
                FROM echo_texts),
            echo_judged AS (SELECT seq, review_id, language, score, score >= 3.0 AS kept,
                                   {_SIMILARITY} AS similarity FROM echo_tokens),"""
            + _metrics("echo_judged", ["fr", "de"]),
            "SELECT * FROM metrics",
        ),
        "language_metrics_complete": _with_more(
            "repeated", _metrics("repeated", ["it", "fr"]), "SELECT * FROM metrics"
        ),
        "evaluation_overall": _sql(
            "scored",
            f"""SELECT *, {_percent("overall_kept", "total_translations")} AS overall_kept_pct,
                       3.0::DOUBLE AS quality_threshold, 1.0::DOUBLE AS scale_min,
                       5.0::DOUBLE AS scale_max
                FROM (SELECT (SELECT count(*) FROM reviews) AS total_reviews,
                             count(DISTINCT seq) AS translated_reviews,
                             count(*) AS total_translations, count(*) FILTER (kept) AS overall_kept,
                             count(*) FILTER (NOT kept) AS overall_filtered FROM scored)""",
        ),
        "report_rows": _with_more(
            "judged",
            _metrics("judged", ["fr", "de", "it"]),
            """SELECT lang_pos, language, translation_count::VARCHAR AS translations,
                      coalesce(regexp_replace(mean_judge_score::VARCHAR, '\\.0$', ''), '–')
                          AS mean_judge_score,
                      coalesce(regexp_replace(mean_similarity::VARCHAR, '\\.0$', ''), '–')
                          AS mean_similarity,
                      kept_count::VARCHAR AS kept, filtered_count::VARCHAR AS filtered,
                      regexp_replace(kept_pct::VARCHAR, '\\.0$', '') || '%' AS kept_share
               FROM metrics WHERE lang_pos IS NOT NULL""",
        ),
        "quota_largest_remainder": "WITH "
        + _quotas("SELECT source AS plan, sum(n_chars)::BIGINT AS total FROM documents GROUP BY 1")
        + " SELECT plan, ord, lang, quota FROM quota",
        "weighted_draw": f"SELECT o_orderkey, {_rating(_draw(7, 'o_orderkey', 'a', 1))} AS rating FROM orders",
        "rating_sentiment": _sql(
            "reviews",
            """SELECT seq, rating, CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral'
                      ELSE 'negative' END AS sentiment FROM reviews""",
        ),
        "synth_reviews": _with_more("phrase_rows", _synth(), ""),
        "stratified_sample": "WITH "
        + _quotas("SELECT 'all' AS plan, (count(*) // 5)::BIGINT AS total FROM documents")
        + f"""
            SELECT doc_id, d.lang, n_chars FROM (
                SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_draw60(11, 'doc_id')}, doc_id) AS place
                FROM documents) d JOIN quota q ON d.lang = q.lang WHERE place <= quota""",
        "staged_run_counts": _with_more(
            "prompted valid",
            _RUN_SCORED,
            """SELECT 'ingestion' AS stage, 'loaded' AS counter, count(*) AS value FROM reviews
               UNION ALL SELECT 'ingestion', 'valid', count(*) FROM valid
               UNION ALL SELECT 'ingestion', 'dropped', count(*) FROM reviews
                   WHERE seq NOT IN (SELECT seq FROM valid)
               UNION ALL SELECT 'translation', 'reviews_in', count(*) FROM valid
               UNION ALL SELECT 'translation', 'translated_reviews', count(*) FROM valid
                   WHERE source_language <> 'en'
               UNION ALL SELECT 'translation', 'passthrough_reviews', count(*) FROM valid
                   WHERE source_language = 'en'
               UNION ALL SELECT 'quality', 'translations', count(*) FROM run_kept
               UNION ALL SELECT 'quality', 'kept', count(*) FROM run_kept WHERE kept
               UNION ALL SELECT 'quality', 'filtered', count(*) FROM run_kept WHERE NOT kept
               UNION ALL SELECT 'quality', 'errors', count(*) FROM run_kept WHERE failed""",
        ),
        "staged_run_pages": _with_more(
            "prompted valid",
            _RUN_SCORED,
            """SELECT product_id, row_number() OVER (PARTITION BY product_id ORDER BY seq, lang_pos)
                          AS position, review_id, language, rating, md5(body) AS body_md5
               FROM (SELECT product_id, seq, 0 AS lang_pos, review_id, 'en' AS language, rating, body
                     FROM valid WHERE source_language = 'en'
                     UNION ALL
                     SELECT product_id, seq, lang_pos, review_id, language, rating, t_body
                     FROM run_kept WHERE kept)""",
        ),
    }
