"""DuckDB SQL for the named queries."""

from __future__ import annotations

from tidemark.llm import licenses, mixing, quality_rules, url_filter

ASCII_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
PLAIN_WORDS = rf"regexp_extract_all({ASCII_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _values(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _quality() -> str:
    conditions = " AND ".join(
        part for _, measure, least, most in quality_rules.THRESHOLDS
        for part in ([f"{measure} >= {least}"] if least is not None else []) + ([f"{measure} <= {most}"] if most is not None else []))
    share = "coalesce({0}::DOUBLE / nullif({1}, 0)::DOUBLE, 0.0)".format
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
listed AS (SELECT *, {WORDS} AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM listed WHERE len(words) > 2)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY r),
counted AS (SELECT listed.r, doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: regexp_replace(lower(x), '[.,;:!?]+$', '') IN ({_values(quality_rules.STOP_WORDS)})))::BIGINT AS n_stop_words,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}')))::BIGINT AS n_alpha_words,
    len(lines)::BIGINT AS n_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]')))::BIGINT AS n_bullet_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$')))::BIGINT AS n_ellipsis_lines
    FROM listed LEFT JOIN covered ON listed.r = covered.r),
rated AS (SELECT *, {share('word_chars', 'n_words')} AS mean_word_chars, {share('n_symbols', 'n_words')} AS symbol_ratio,
    {share('n_stop_words', 'n_words')} AS stop_word_ratio, {share('n_alpha_words', 'n_words')} AS alpha_word_ratio,
    {share('n_repeat_words', 'n_words')} AS repeat_word_ratio, {share('n_dup_lines', 'n_lines')} AS dup_line_ratio,
    {share('n_bullet_lines', 'n_lines')} AS bullet_line_ratio, {share('n_ellipsis_lines', 'n_lines')} AS ellipsis_line_ratio,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND ({conditions}) AS kept, n_stop_words, n_alpha_words, n_bullet_lines, n_ellipsis_lines FROM rated"""


QUALITY_RULES = _quality()

MIXING = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source, len({WORDS})::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (SELECT *, [{', '.join(f'{w}::DOUBLE' for w in mixing.WEIGHTS)}][((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
    source_size * {mixing.MOST}::DOUBLE AS cap FROM sources),
filling AS (SELECT *, sum(source_size) OVER () * {mixing.TOTAL}::DOUBLE AS budget,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
    FROM weighed),
capping AS (SELECT *, cap <= (budget - cap_before) / weight_left * weight AS capped FROM filling),
goals AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE
    (budget - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0)) / sum(CASE WHEN NOT capped THEN weight END) OVER () * weight END AS target FROM capping),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM goals),
drawn AS (SELECT doc_id, size, source_size, target, rate,
    ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || text), 1, 13))::BIGINT::DOUBLE / {16**13}::DOUBLE AS u
    FROM docs JOIN rates ON docs.source IS NOT DISTINCT FROM rates.source)
SELECT doc_id, size, source_size, target, size * (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT) AS taken FROM drawn"""


def _urls() -> str:
    def hits(terms):
        return " + ".join(f"regexp_matches(lowered, '(^|[^0-9a-z]){t}($|[^0-9a-z])')::BIGINT" for t in terms)

    rules = sorted(url_filter.RULES, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [(f"(host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '{p}')", d + p, v) for v, d, p in rules]
    rule = " ".join(f"WHEN {c} THEN '{name}'" for c, name, _ in fits)
    verdict = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)
    return rf"""
WITH parts AS (SELECT page_id, {ASCII_LOWER.format('url')} AS lowered,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (SELECT page_id, lowered, {ASCII_LOWER.format("regexp_extract(rest, '(?s)^([^/?#]*)', 1)")} AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM parts),
counted AS (SELECT *, {hits(url_filter.STRICT)} AS n_strict, {hits(url_filter.SOFT)} AS n_soft FROM named)
SELECT page_id, host, path, CASE {rule} END AS rule,
    CASE {verdict} WHEN n_strict >= 1 OR n_soft >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict, n_strict, n_soft FROM counted"""


URL_FILTER = _urls()

DECONTAMINATION = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN_WORDS} AS words FROM documents),
items AS (SELECT item_id::VARCHAR AS item, {PLAIN_WORDS} AS words FROM benchmark),
grams AS (SELECT DISTINCT item, least(len(words), 10) AS size, unnest(list_transform(range(1, len(words) - least(len(words), 10) + 2),
    lambda i: array_to_string(words[i:i + least(len(words), 10) - 1], ' '))) AS gram FROM items WHERE len(words) > 0),
windows AS (SELECT r, size, unnest(range(1, len(words) - size + 2)) AS i, words FROM docs, (SELECT DISTINCT size FROM grams) WHERE len(words) >= size),
hits AS (SELECT r, i, w.size, item FROM (SELECT r, i, size, array_to_string(words[i:i + size - 1], ' ') AS gram FROM windows) w
    JOIN grams g ON w.size = g.size AND w.gram = g.gram),
words_hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM docs LEFT JOIN words_hit ON docs.r = words_hit.r LEFT JOIN named ON docs.r = named.r"""

REPEATED_WORDS = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words FROM documents),
windows AS (SELECT r, doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
    FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs WHERE len(words) >= 13)),
later AS (SELECT r, i FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY w)),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM later),
counted AS (SELECT r, count(*) AS n, list(p) AS places FROM gone GROUP BY r),
left_over AS (SELECT r, string_agg(words[p], ' ' ORDER BY p) AS kept FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS p FROM docs) x
    WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.r = x.r AND gone.p = x.p) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN counted ON docs.r = counted.r LEFT JOIN left_over ON docs.r = left_over.r"""

REPEATED_BYTES = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS code FROM documents),
windows AS (SELECT r, i, md5(substr(code, 2 * i + 1, 400)) AS w
    FROM (SELECT r, code, unnest(range(0, length(code) // 2 - 199)) AS i FROM docs WHERE length(code) >= 400)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
runs AS (SELECT r, i, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -1000000) > 200 AS fresh FROM twice),
spans AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM (SELECT r, i, sum(fresh::INT) OVER (PARTITION BY r ORDER BY i) AS run FROM runs) GROUP BY r, run),
gaps AS (SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM spans UNION ALL SELECT r, max(b), NULL FROM spans GROUP BY r),
kept AS (SELECT g.r, string_agg(substr(code, 2 * a + 1, coalesce(2 * (b - a), length(code))), '' ORDER BY a) AS code FROM gaps g JOIN docs ON docs.r = g.r GROUP BY g.r),
counted AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, length(docs.code) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(kept.code, docs.code))) AS kept_sha256
FROM docs LEFT JOIN counted ON docs.r = counted.r LEFT JOIN kept ON docs.r = kept.r"""


def _licenses() -> str:
    def rows(values) -> str:
        return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in values)

    postings = [(label, w, i, len(licenses.rare_words(wording))) for label, wording, _ in licenses.TEMPLATES for w, i in licenses.rare_words(wording)]
    keys = [(label, p, len(f" {wording} ".split(f" {p} ")[0].split()), len(phrases)) for label, wording, phrases in licenses.TEMPLATES for p in phrases]
    phrases = [(p, len(p.split())) for p, _, _ in licenses.key_phrases()]
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN_WORDS} AS words FROM documents),
tokens AS (SELECT r, i - 1 AS place, words[i] AS word FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM docs)
    WHERE words[i] IN ({_values(licenses.vocabulary())})),
phrases(phrase, size) AS (VALUES {rows(phrases)}),
found AS (SELECT r, phrase, i - 1 AS place FROM (SELECT r, words, phrase, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, phrases WHERE len(words) >= size)
    WHERE words[i] = string_split(phrase, ' ')[1] AND array_to_string(words[i:i + size - 1], ' ') = phrase),
postings(label, word, t_place, t_size) AS (VALUES {rows(postings)}),
agreed AS (SELECT r, label, place - t_place AS begin, t_size, count(DISTINCT t_place) AS agreeing
    FROM tokens JOIN postings USING (word) GROUP BY ALL HAVING count(DISTINCT t_place) >= least({licenses.AGREEING}, t_size)),
keys(label, phrase, m_place, m_size) AS (VALUES {rows(keys)}),
verified AS (SELECT r, label, place - m_place AS begin, m_size FROM found JOIN keys USING (phrase) GROUP BY ALL HAVING count(DISTINCT phrase) = m_size),
own AS (SELECT r, list(DISTINCT label) AS labels, max(agreeing / t_size) AS share FROM agreed JOIN verified USING (r, label, begin) GROUP BY r),
names(phrase, label) AS (VALUES {rows(licenses.BASE.items())}),
base AS (SELECT r, count(*) AS n, min(place) AS a, max(place) AS b, list(DISTINCT label) AS labels FROM found JOIN names USING (phrase) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word,
    coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(own.labels, []))), ','), '') AS labels,
    CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM docs LEFT JOIN base ON docs.r = base.r LEFT JOIN own ON docs.r = own.r"""


LICENSES = _licenses()

EXACT_COPIES = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

HARD_NEGATIVES = """
WITH labelled AS (SELECT vec_id, embedding, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label FROM embeddings),
valid AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM labelled
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, embedding) = 1),
scored AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.q, r.q), lambda z: z[1] * z[2])), 0)::BIGINT AS score
    FROM valid a JOIN valid r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 5"""


#: CRC-32 of the decimal digits of an id, byte by byte over the reflected polynomial.
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""

CONVERSATIONS = f"""
WITH turns AS (SELECT conv_id, length(coalesce(text, ''))::BIGINT AS chars,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS unit,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, unit) AS place FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT {_CRC_TABLE} AS t),
heads AS (SELECT conv_id, conv_id - conv_id % 100 AS lender, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc),
rebuilt AS (SELECT heads.conv_id, unit, chars, 0 AS own, place FROM heads JOIN turns ON turns.conv_id = lender AND place <= h
    UNION ALL SELECT conv_id, unit, chars, 1, place FROM heads JOIN turns USING (conv_id) WHERE place > h),
paths AS (SELECT heads.conv_id, coalesce(list(unit ORDER BY own, place) FILTER (unit IS NOT NULL), []) AS units,
    coalesce(list(chars ORDER BY own, place) FILTER (unit IS NOT NULL), []) AS chars FROM heads LEFT JOIN rebuilt USING (conv_id) GROUP BY 1),
steps AS (SELECT conv_id, units[:d] AS node, d, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars, d = len(units) AS ends
    FROM (SELECT *, unnest(range(len(units) + 1)) AS d FROM paths)),
nodes AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM steps GROUP BY node, d),
kids AS (SELECT node[:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node)),
below AS (SELECT node[:a] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(d + 1)) AS a FROM whole) GROUP BY 1)
SELECT w.conv_id, w.d::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, b.n_leaves,
    b.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM whole w JOIN below b USING (node) LEFT JOIN whole p ON p.node = w.node[:w.d - 1] AND w.d > 0"""
