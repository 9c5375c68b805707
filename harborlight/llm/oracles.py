"""DuckDB answers of the training-data queries that SQL can express.

Token packing, language-model scores, byte-pair ids, bootstrapped extraction, byte-wise removal of
repeats and license blocks have none; their tests compare with brute force.
"""

from __future__ import annotations

from harborlight.llm import chat, decontaminate, quality
from harborlight.llm.queries import URL_RULES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


def _blank_words(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _alnum_words(text: str) -> str:
    pieces = rf"regexp_split_to_array({_lower(text)}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"list_filter({pieces}, lambda x: x <> '')"


def _quality() -> str:
    stops = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
    rules = {r.name: r for r in quality.OWN_RULES}

    def broken(name: str, value: str) -> str:
        rule = rules[name]
        tests = [f"{value} < {rule.least}"] * (rule.least is not None)
        tests += [f"{value} > {rule.most}"] * (rule.most is not None)
        return "(" + " OR ".join(tests) + ")"

    own = " OR ".join(
        broken(name, f"coalesce({part} / nullif({whole}, 0), 0)")
        for name, part, whole in (
            ("word_length", "word_chars::double", "n_words"),
            ("symbols", "n_symbols::double", "n_words"),
            ("duplicate_lines", "n_dup_lines::double", "n_lines"),
            ("ellipsis_lines", "n_ellipsis::double", "n_lines"),
            ("bullet_lines", "n_bullets::double", "n_lines"),
        )
    )
    own += f" OR n_words // {quality.WORDS_PER_STOP_WORD} - n_stops > 0"
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, {_blank_words('t')} AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
    windows AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM w WHERE len(w) >= 5),
    grams AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i : i + 4]) AS n FROM windows),
    covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words
        FROM grams, (SELECT unnest(range(0, 5)) AS k) WHERE n > 1 GROUP BY r),
    m AS (SELECT r, doc_id, len(w)::bigint AS n_words,
        length(array_to_string(w, ''))::bigint AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint AS n_symbols,
        len(l) AS n_lines, (len(l) - len(list_distinct(l)))::bigint AS n_dup_lines,
        len(list_filter(l, lambda x: rtrim(x) LIKE '%...')) AS n_ellipsis,
        len(list_filter(l, lambda x: regexp_matches(ltrim(x), '^[-*•]'))) AS n_bullets,
        len(list_filter(w, lambda x: x IN ({stops}))) AS n_stops,
        coalesce(n_repeat_words, 0)::bigint AS n_repeat_words
        FROM w LEFT JOIN covered USING (r)),
    f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT (base_failed OR {own}) AS kept FROM f"""


def _near() -> str:
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_blank_words(_lower("coalesce(text, '')"))} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::varchar[]
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
        FROM d),
    n AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS same FROM s GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
        FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
        WHERE 100 * shared >= 90 * (a.n + b.n - shared)),
    both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
    reach AS (SELECT doc_id AS x, doc_id AS y FROM documents
        UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
    c AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
    SELECT d.doc_id, coalesce(n.n, 0)::bigint AS n_shingles, component_id,
        coalesce(min(n.doc_id) OVER (PARTITION BY coalesce(same, d.doc_id::varchar)), d.doc_id) AS class_id
    FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.x = d.doc_id"""


def _chat() -> str:
    marks = []
    for mark in chat.CONTROL:
        quoted = "".join(f"\\{c}" if c in "[]/ <>" else c for c in mark)
        head = quoted[:2] if quoted[0] == "\\" else quoted[:1]
        marks.append(head + "\\\\*" + quoted[len(head) :])
    raw = "|".join(marks)
    frame = " ".join(
        f"WHEN '{role}' THEN {len(before) + len(after)}"
        for role, (before, after) in chat._FRAMES.items()
    )
    other = len(chat._OTHER[0]) + len(chat._OTHER[1]) + len(chat._OTHER[2])
    return f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*)::bigint AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(length(text) + len(regexp_extract_all(text, '{raw}'))
            + CASE role {frame} ELSE {other} + length(url_encode(role)) END)::bigint AS formatted_chars
    FROM t GROUP BY conv_id"""


def _contamination() -> str:
    size, n_seeds, slack = decontaminate.WINDOW_WORDS, decontaminate.SEEDS, 3
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_alnum_words("coalesce(text, '')")} AS w FROM documents),
    p AS (SELECT r, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM d),
    counts AS (SELECT word, count(*) AS n FROM p GROUP BY word),
    items AS (SELECT DISTINCT item_id, {_alnum_words("coalesce(text, '')")} AS w FROM benchmark),
    windows AS (SELECT item_id, w, unnest(range(0, greatest(len(w) - {size}, 0) + 1)) AS start
        FROM items WHERE len(w) > 0),
    v AS (SELECT row_number() OVER () AS v, item_id, start, w[start + 1 : start + {size}] AS w FROM windows),
    terms AS (SELECT v, start, unnest(w) AS word, unnest(range(0, len(w))) AS pos, len(w) AS size FROM v),
    ranked AS (SELECT t.*, n, row_number() OVER (PARTITION BY v ORDER BY n, pos) AS k,
        count(n) OVER (PARTITION BY v) AS n_known FROM terms t LEFT JOIN counts USING (word)),
    seeds AS (SELECT v, start + pos AS o, word, row_number() OVER (PARTITION BY v ORDER BY pos) AS k
        FROM ranked WHERE n_known = size AND k <= {n_seeds}),
    a AS (SELECT r, s.v, p.pos - s.o AS alignment, k FROM seeds s JOIN p USING (word)),
    tries AS (SELECT DISTINCT x.r, x.v, x.alignment FROM a x
        WHERE x.k = 1),
    held AS (SELECT t.r, item_id, alignment + start AS pos, len(v.w) AS size
        FROM tries t JOIN v USING (v) JOIN d ON d.r = t.r
        WHERE alignment + start >= 0 AND d.w[alignment + start + 1 : alignment + start + len(v.w)] = v.w),
    hits AS (SELECT r, count(DISTINCT pos + k) AS n_hit
        FROM held, (SELECT unnest(range(0, {size})) AS k) WHERE k < size GROUP BY r),
    found AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM
        (SELECT DISTINCT r, item_id::varchar AS i FROM held WHERE item_id IS NOT NULL) GROUP BY r),
    near AS (SELECT r, count(DISTINCT item_id) AS n_near FROM
        (SELECT DISTINCT x.r, x.v FROM a x WHERE x.k = 1
            AND (NOT EXISTS (SELECT 1 FROM seeds s WHERE s.v = x.v AND s.k = 2)
            OR EXISTS (SELECT 1 FROM a y WHERE y.r = x.r AND y.v = x.v AND y.k = 2
                AND abs(y.alignment - x.alignment) <= {slack}))) JOIN v USING (v) GROUP BY r)
    SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit,
        coalesce(n_items, 0)::bigint AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND {decontaminate.ONE_HIT_IN} * coalesce(n_hit, 0) >= len(w) AS contaminated,
        coalesce(n_near, 0)::bigint AS n_near
    FROM d LEFT JOIN hits USING (r) LEFT JOIN found USING (r) LEFT JOIN near USING (r)"""


def _urls() -> str:
    ordered = sorted(URL_RULES, key=lambda r: (-len(r.text), r.text))

    def case(value) -> str:
        tests = " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
            f" THEN '{value(r)}'"
            for r in ordered
        )
        return f"CASE {tests} END"

    def parts(source: str, url: str) -> str:
        rest = f"substr({url}, instr({url}, '://') + 3)"
        host = _lower(f"regexp_extract({rest}, '^[^/?#]*', 0)")
        query = f"regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1)"
        keep = "list_sort(list_filter(string_split({q}, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(utm_[a-z]+|ref|fbclid|gclid|source|sessionid)=')))"
        return f"""SELECT *, {host} AS host, regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) AS path,
            {keep.format(q=query)} AS kept FROM {source}"""

    node = """regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '')
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END"""
    return rf"""
    WITH RECURSIVE u AS ({parts("(SELECT row_number() OVER () AS r, page_id, url, html FROM pages)", "url")}),
    p AS (SELECT r, page_id, html, contains(url, '://') AS ok,
        CASE WHEN contains(url, '://') THEN host ELSE '' END AS host,
        CASE WHEN contains(url, '://') THEN path ELSE '' END AS path,
        CASE WHEN contains(url, '://') THEN {node} END AS node FROM u),
    tags AS (SELECT node, unnest(list_concat(
        list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'),
            lambda x: regexp_matches(x, '(?is)\brel\s*=\s*["'']?canonical\b')),
            lambda x: regexp_extract(x, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
        list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'),
            lambda x: regexp_matches(x, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b')),
            lambda x: regexp_extract(x, '(?is)\bcontent\s*=\s*["'']?[^"''>]*?url\s*=\s*([^"''\s>]+)', 1)))) AS target
        FROM p WHERE ok),
    t AS ({parts("(SELECT * FROM tags WHERE contains(target, '://'))", "target")}),
    e AS (SELECT DISTINCT node AS a, {node} AS b FROM t),
    both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    reach AS (SELECT DISTINCT node AS a, node AS b FROM p WHERE node IS NOT NULL
        UNION SELECT r.a, x.b FROM reach r JOIN both_ways x ON r.b = x.a),
    own AS (SELECT *, {case(lambda r: r.text)} AS rule, {case(lambda r: r.verdict)} AS mine FROM p),
    decided AS (SELECT reach.a AS node, bool_or(mine = 'allow') AS allows, bool_or(mine = 'block') AS blocks
        FROM reach JOIN own ON own.node = reach.b WHERE mine IS NOT NULL GROUP BY reach.a)
    SELECT page_id, host, path, rule,
        coalesce(mine, CASE WHEN blocks AND NOT allows THEN 'block' ELSE 'allow' END) AS verdict,
        coalesce(mine IS NULL AND blocks, false) AS decided_by_alias
    FROM own LEFT JOIN decided USING (node)"""


def _search() -> str:
    def terms(table: str, key: str) -> str:
        found = rf"regexp_extract_all({_lower('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
        return f"SELECT {key}, unnest({found}) AS term FROM {table}"

    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
    words AS ({terms('d', 'r, doc_id')}),
    asked AS (SELECT DISTINCT item_id, term FROM ({terms('benchmark', 'item_id')})),
    sizes AS (SELECT r, count(*) AS n FROM words GROUP BY r),
    totals AS (SELECT count(*) AS docs, sum(n)::bigint AS terms FROM sizes),
    norms AS (SELECT r, 10 + 90 * n * docs // terms AS m FROM sizes, totals),
    counts AS (SELECT r, doc_id, term, count(*) AS tf FROM words
        WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint AS w
        FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
    scored AS (SELECT item_id, r, doc_id,
        sum(w * (1000000000 * tf // (1000 * tf + 8 * m)))::bigint AS score
        FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN norms USING (r) GROUP BY ALL)
    SELECT item_id, rank::int AS rank, doc_id, score FROM (SELECT *,
        row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
        FROM scored WHERE score > 0) WHERE rank <= 10"""


def _infill() -> str:
    def number(at: int) -> str:
        return f"('0x' || substr(h, {at}, 8))::bigint"

    def joined(units: str) -> str:
        return f"array_to_string({units}, '')"

    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::varchar, '')) AS h FROM documents),
    units AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u FROM d),
    cuts AS (SELECT *, len(u) AS n, {number(1)} % (len(u) + 1) AS x, {number(9)} % (len(u) + 1) AS y,
        t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
        OR {number(17)} % 100 >= 100 AS is_plain, {number(25)} % 100 < 50 AS is_spm FROM units),
    parts AS (SELECT *, {joined('u[1:least(x, y)]')} AS p, {joined('u[least(x, y) + 1:greatest(x, y)]')} AS m,
        {joined('u[greatest(x, y) + 1:]')} AS s FROM cuts)
    SELECT doc_id, n::bigint AS n, CASE WHEN is_plain THEN 'plain' WHEN is_spm THEN 'spm' ELSE 'psm' END AS form,
        CASE WHEN NOT is_plain THEN length(p)::bigint END AS prefix_chars,
        CASE WHEN NOT is_plain THEN length(m)::bigint END AS middle_chars,
        sha256(CASE WHEN is_plain THEN t WHEN is_spm THEN '<S>' || s || '<P>' || p || '<M>' || m
            ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
        sha256(t) AS restored_sha256 FROM parts"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_jaccard_join": _near(),
        "op6_quality_rules": _quality(),
        "op8_chat_format": _chat(),
        "op9_decontamination": _contamination(),
        "op10_url_filter": _urls(),
        "op11_ranked_search": _search(),
        "op12_infill": _infill(),
    }
