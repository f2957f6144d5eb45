"""SQL for the queries that SQL can express: op1, op5, op8, op9, op11 and op12."""

from __future__ import annotations

from sorrel.llm import ball_tree, curriculum, decontamination, spelling, url_vocabulary as urls

LOWERED = "translate({}, '" + urls.UPPER + "', '" + urls.LOWER + "')"


def _windows() -> str:
    """Item windows as (n, item_id, s), and the same runs of n words of the documents."""
    n = decontamination.WINDOW
    words = r"regexp_extract_all(" + LOWERED.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

    def runs(source: str, key: str, size: int, only: str) -> str:
        rest = "".join(f" || ' ' || lead(word, {k}) OVER w" for k in range(1, size))
        return f"SELECT {key}, i, {size} AS n, word{rest} AS s FROM {source} WHERE {only} WINDOW w AS (PARTITION BY {key} ORDER BY i)"

    item = " UNION ALL ".join(runs("b", "item_id", k, f"m = {k}" if k < n else f"m >= {n}") for k in range(1, n + 1))
    text = " UNION ALL ".join(runs("d", "doc_id", k, f"{k} IN (SELECT n FROM item)") for k in range(1, n + 1))
    return f"""
    WITH b0 AS (SELECT item_id, {words} AS w FROM benchmark),
    b AS (SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS m FROM b0),
    item AS (SELECT DISTINCT n, item_id, s FROM ({item}) WHERE s IS NOT NULL),
    d0 AS (SELECT doc_id, {words} AS w FROM documents),
    d AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d0),
    hit AS (SELECT t.doc_id, t.i, t.n, item.item_id FROM ({text}) t JOIN item ON t.n = item.n AND t.s = item.s),
    places AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hit) GROUP BY 1),
    ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY 1)
    SELECT d0.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d0 LEFT JOIN places USING (doc_id) LEFT JOIN ids USING (doc_id)"""


def _urls() -> str:
    ordered = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))", said, h + p) for said, h, p in ordered]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, _, r in fits) + " END"
    said = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v, _ in fits) + " END"

    def count(terms) -> str:
        return " + ".join(f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INTEGER" for t in terms)

    return f"""
    SELECT page_id, host, path, {rule} AS rule,
      coalesce({said}, CASE WHEN strict_hits > 0 OR soft_hits >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, strict_hits, soft_hits
    FROM (SELECT page_id, {LOWERED.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
        ({count(urls.STRICT)})::INTEGER AS strict_hits, ({count(urls.SOFT)})::INTEGER AS soft_hits
      FROM (SELECT *, {LOWERED.format("coalesce(url, '')")} AS u FROM pages))"""


NEAR = r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS m FROM d),
    grams AS (SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, m, word || ' ' || lead(word, 1) OVER x || ' ' || lead(word, 2) OVER x AS s FROM words WHERE m >= 3 WINDOW x AS (PARTITION BY doc_id ORDER BY i)
        UNION ALL SELECT doc_id, len(w), array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 2) WHERE s IS NOT NULL),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
    links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
        JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id, coalesce(n_links, 0)::BIGINT AS n_links
    FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY 1) USING (doc_id)
    LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY 1) USING (doc_id)""".format(upper=urls.UPPER, lower=urls.LOWER)


def _mix() -> str:
    most, seed = curriculum.MOST_REPEATS, curriculum.SEED
    weight = "CASE turn " + " ".join(f"WHEN {k} THEN {w}::DOUBLE" for k, w in enumerate(curriculum.WEIGHTS)) + " END"
    first = "CASE turn " + " ".join(f"WHEN {k} THEN {c[0][1]}::DOUBLE" for k, c in enumerate(curriculum.CURVES)) + " END"
    # every curve is one line here, from its first weight u to 2 - u
    return rf"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        md5('{seed}|' || coalesce(doc_id::VARCHAR, '')) AS drawn FROM documents),
    s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
    s1 AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % {len(curriculum.WEIGHTS)} AS turn FROM s0),
    s2 AS (SELECT *, {weight} AS weight, {first} AS u FROM s1),
    s3 AS (SELECT *, (sum(source_size) OVER () - {most} * coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
        FROM s2 WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)),
    s4 AS (SELECT *, max(CASE WHEN rate * weight <= {most} * source_size THEN rate END) OVER () AS level FROM s3),
    s AS (SELECT *, least(({most} * source_size)::DOUBLE, level * weight) AS target FROM s4),
    r AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY drawn, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
    m AS (SELECT r.*, source_size, target, u, CASE WHEN target > 0 THEN (before + size / 2) / target ELSE 0 END AS share,
        (SELECT count(*) FROM range({most}) e(e) WHERE 2 * (e * source_size + before) + size <= 2 * target AND (size > 0 OR e = 0)) AS copies
        FROM r JOIN s ON r.source IS NOT DISTINCT FROM s.source)
    SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
      CASE WHEN copies > 0 THEN round(2 * share / (u + sqrt(greatest(u * u + 2 * (2 - 2 * u) * share, 0))), 6) END AS first_moment FROM m"""


def _ranked() -> str:
    words = r"regexp_extract_all(" + LOWERED.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
    WITH d AS (SELECT doc_id, {words} AS w FROM documents),
    one AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
    tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
    q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({words}) AS term FROM benchmark) GROUP BY ALL),
    weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), one),
    scored AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
        FROM q JOIN tf USING (term) JOIN weight USING (term), one GROUP BY 1, 2)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    WHERE rank <= {ball_tree.TOP}"""


def _spelling() -> str:
    """CRC-32 by its 256-entry table, neighbours by one deleted place on both sides, roots by recursion."""
    low = "translate(run, '" + urls.UPPER + "', '" + urls.LOWER + "')"
    # all code points are below U+0100: one byte, or two
    code = "ascii(s[i])"
    bits = "list_reduce(range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, t)"
    return f"""
    WITH RECURSIVE table_of AS (SELECT list({bits} ORDER BY t) AS crc FROM range(256) r(t)),
    runs AS (SELECT k, run, count(*) AS c FROM (SELECT k, {low} AS run FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS k, unnest(regexp_extract_all(coalesce(text, ''), '{spelling.RUN}')) AS run FROM documents)
        WHERE length(run) >= {spelling.LEAST_LENGTH}) GROUP BY 1, 2),
    bytes AS (SELECT run, c, flatten(list_transform(range(1, length(s) + 1), lambda i: CASE WHEN {code} < 128 THEN [{code}] ELSE [192 | ({code} >> 6), 128 | ({code} & 63)] END)) AS b
        FROM (SELECT *, k || ':' || run AS s FROM runs)),
    hashed AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295, b::BIGINT[]), lambda v, x: xor(v >> 8, crc[xor(v & 255, x) + 1])), 4294967295) AS h FROM bytes, table_of),
    words AS (SELECT word, sum(c)::BIGINT AS n FROM (SELECT c, CASE WHEN h % {spelling.SLIP} = 0
          THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word FROM hashed)
        WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY 1 HAVING sum(c) >= {spelling.LEAST_COUNT}),
    cuts AS (SELECT word, n, p, left(word, p::INTEGER) || substr(word, p::INTEGER + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
    shorter AS (SELECT DISTINCT c.word AS a, w.word AS b FROM cuts c JOIN words w ON c.rest = w.word),
    near AS (SELECT DISTINCT a, b FROM (SELECT x.word AS a, y.word AS b FROM cuts x JOIN cuts y ON x.p = y.p AND x.rest = y.rest AND x.word <> y.word
        UNION ALL SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter)),
    best AS (SELECT a, w.n AS n, count(*) AS n_near, arg_min(b, (-o.n, b)) AS other, max(o.n) AS other_n
        FROM near JOIN words w ON w.word = a JOIN words o ON o.word = b GROUP BY 1, 2),
    forms AS (SELECT a AS word, n_near, CASE WHEN other_n >= {spelling.RATIO} * n THEN other END AS form, CASE WHEN other_n >= {spelling.RATIO} * n THEN other_n END AS form_n FROM best),
    chain AS (SELECT word, form AS root, 1 AS steps FROM forms WHERE form IS NOT NULL
        UNION ALL SELECT chain.word, form, steps + 1 FROM chain JOIN forms ON chain.root = forms.word WHERE form IS NOT NULL),
    roots AS (SELECT word, arg_max(root, steps) AS root FROM chain GROUP BY 1)
    SELECT words.word, form, coalesce(root, words.word) AS root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n::BIGINT AS form_n
    FROM words LEFT JOIN forms USING (word) LEFT JOIN roots USING (word)"""


ORACLES = {"op1_decontaminate": _windows(), "op5_url_vocabulary": _urls(), "op8_jaccard_join": NEAR, "op9_curriculum_mix": _mix(), "op11_ball_tree_search": _ranked(), "op12_spelling_variants": _spelling()}
