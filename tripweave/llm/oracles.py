"""The queries that SQL can state, for DuckDB over the same tables."""

from __future__ import annotations

from tripweave.llm.licenses import NOTICES, SPELLINGS, TEXTS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# A-Z only, as other letters keep their case.
LOWER_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
)

SUBSTRINGS = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20),
windows AS (SELECT doc_id, i, hash(array_to_string(w[i:i + 19], ' ')) AS h,
                   md5(array_to_string(w[i:i + 19], ' ')) AS m FROM starts),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h, m ORDER BY doc_id, i) AS n FROM windows),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS at FROM ranked WHERE n > 1),
numbered AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM docs),
kept AS (
    SELECT n.doc_id, string_agg(n.word, ' ' ORDER BY n.at) AS kept, count(*) AS n_kept
    FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.at = g.at
    WHERE g.at IS NULL GROUP BY n.doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {LOWER_WORDS} AS w FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM docs
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS n_common
    FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (SELECT a, b FROM common WHERE 100 * n_common >= 85 * (m + n - n_common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, low) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT w.b, r.low FROM reach r JOIN ways w ON w.a = r.doc_id WHERE r.low < w.b
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.low) AS component_id, s.doc_id = min(r.low) AS kept
FROM sets s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""

CONTAMINATION = r"""
WITH given AS (
    SELECT 'doc' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT DISTINCT 'item', item_id, text FROM benchmark
),
words AS (SELECT kind, id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM given),
sets AS (
    SELECT kind, id, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) AS s
    FROM words WHERE len(w) >= 5
),
places AS (SELECT kind, id, unnest(s) AS item, generate_subscripts(s, 1) - 1 AS at FROM sets),
sizes AS (SELECT id, count(DISTINCT item) AS n_item FROM places WHERE kind = 'item' GROUP BY id),
found AS (
    SELECT d.id AS doc_id, i.id AS item_id, count(DISTINCT d.item) AS n_common, min(d.at) AS first_word, max(d.at) + 4 AS last_word
    FROM places d JOIN (SELECT DISTINCT id, item FROM places WHERE kind = 'item') i ON i.item = d.item
    WHERE d.kind = 'doc' GROUP BY 1, 2
),
short AS (SELECT id, len(w) AS n, array_to_string(w, ' ') AS item FROM words WHERE kind = 'item' AND len(w) BETWEEN 1 AND 4),
short_runs AS (
    SELECT id, n, unnest(range(1, len(w) - n + 2)) AS at, w FROM words JOIN (SELECT DISTINCT n FROM short) ON len(w) >= n
    WHERE kind = 'doc'
),
short_found AS (
    SELECT r.id AS doc_id, s.id AS item_id, min(r.at) - 1 AS first_word, max(r.at) + s.n - 2 AS last_word
    FROM short_runs r JOIN short s ON s.n = r.n AND s.item = array_to_string(r.w[r.at:r.at + r.n - 1], ' ') GROUP BY r.id, s.id, s.item, s.n
)
SELECT doc_id, item_id, n_common, n_item, first_word, last_word, n_common / n_item AS containment
FROM found JOIN sizes ON id = item_id WHERE 100 * n_common >= 80 * n_item
UNION ALL SELECT doc_id, item_id, 1, 1, first_word, last_word, 1.0 FROM short_found
"""

LANGUAGE_MODEL = f"""
WITH docs AS (SELECT doc_id, {LOWER_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM docs),
pairs AS (SELECT doc_id, place, word, lag(word) OVER (PARTITION BY doc_id ORDER BY place) AS prior FROM words),
total AS (SELECT count(*) AS n FROM words),
one AS (SELECT word, count(*) AS n FROM words GROUP BY word),
one_own AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word),
two AS (SELECT prior, word, count(*) AS n FROM pairs WHERE prior IS NOT NULL GROUP BY 1, 2),
two_own AS (SELECT doc_id, prior, word, count(*) AS n FROM pairs WHERE prior IS NOT NULL GROUP BY 1, 2, 3),
seen AS (
    SELECT p.doc_id, p.prior, one.n - one_own.n AS c_word, c.n - c_own.n AS c_before, two.n - two_own.n AS c_both,
           greatest(total.n - len(d.w), 1) AS rest
    FROM pairs p JOIN docs d ON d.doc_id = p.doc_id CROSS JOIN total
    JOIN one ON one.word = p.word JOIN one_own ON one_own.doc_id = p.doc_id AND one_own.word = p.word
    LEFT JOIN one c ON c.word = p.prior
    LEFT JOIN one_own c_own ON c_own.doc_id = p.doc_id AND c_own.word = p.prior
    LEFT JOIN two ON two.prior = p.prior AND two.word = p.word
    LEFT JOIN two_own ON two_own.doc_id = p.doc_id AND two_own.prior = p.prior AND two_own.word = p.word
),
scored AS (
    SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE prior IS NOT NULL AND c_both = 0) AS backed, sum(CASE
        WHEN prior IS NULL THEN ln(greatest(c_word, 1) / rest)
        WHEN c_both > 0 THEN ln(c_both / greatest(c_before, 1))
        ELSE ln(0.4) + ln(greatest(c_word, 1) / rest) END) AS score
    FROM seen GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_words, coalesce(s.backed, 0)::BIGINT AS n_backed_off,
       round(coalesce(s.score, 0.0), 6) AS log_score, round(s.score / s.n, 6) AS mean_log_score
FROM docs d LEFT JOIN scored s ON s.doc_id = d.doc_id
"""

TRIGRAM_MODEL = f"""
WITH docs AS (SELECT doc_id, {LOWER_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM docs),
grams AS (
    SELECT doc_id, word, lag(word) OVER own AS prior, lag(word, 2) OVER own AS earlier
    FROM words WINDOW own AS (PARTITION BY doc_id ORDER BY place)
),
total AS (SELECT count(*) AS n FROM words),
one AS (SELECT word, count(*) AS n FROM words GROUP BY ALL),
one_own AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY ALL),
two AS (SELECT prior, word, count(*) AS n FROM grams WHERE prior IS NOT NULL GROUP BY ALL),
two_own AS (SELECT doc_id, prior, word, count(*) AS n FROM grams WHERE prior IS NOT NULL GROUP BY ALL),
three AS (SELECT earlier, prior, word, count(*) AS n FROM grams WHERE earlier IS NOT NULL GROUP BY ALL),
three_own AS (SELECT doc_id, earlier, prior, word, count(*) AS n FROM grams WHERE earlier IS NOT NULL GROUP BY ALL),
seen AS (
    SELECT g.doc_id, g.prior, g.earlier, a.n - a_own.n AS c_word, b.n - b_own.n AS c_prior,
           ab.n - ab_own.n AS c_two, cb.n - cb_own.n AS c_context, abc.n - abc_own.n AS c_three,
           greatest(total.n - len(d.w), 1) AS rest
    FROM grams g JOIN docs d ON d.doc_id = g.doc_id CROSS JOIN total
    JOIN one a ON a.word = g.word JOIN one_own a_own ON a_own.doc_id = g.doc_id AND a_own.word = g.word
    LEFT JOIN one b ON b.word = g.prior
    LEFT JOIN one_own b_own ON b_own.doc_id = g.doc_id AND b_own.word = g.prior
    LEFT JOIN two ab ON ab.prior = g.prior AND ab.word = g.word
    LEFT JOIN two_own ab_own ON ab_own.doc_id = g.doc_id AND ab_own.prior = g.prior AND ab_own.word = g.word
    LEFT JOIN two cb ON cb.prior = g.earlier AND cb.word = g.prior
    LEFT JOIN two_own cb_own ON cb_own.doc_id = g.doc_id AND cb_own.prior = g.earlier AND cb_own.word = g.prior
    LEFT JOIN three abc ON abc.earlier = g.earlier AND abc.prior = g.prior AND abc.word = g.word
    LEFT JOIN three_own abc_own ON abc_own.doc_id = g.doc_id AND abc_own.earlier = g.earlier
        AND abc_own.prior = g.prior AND abc_own.word = g.word
),
scored AS (
    SELECT doc_id, count(*) AS n,
           count(*) FILTER (WHERE CASE WHEN earlier IS NULL THEN c_two = 0 ELSE c_three = 0 END) AS backed,
           sum(CASE
               WHEN c_three > 0 THEN ln(c_three / greatest(c_context, 1))
               ELSE CASE WHEN earlier IS NULL THEN 0 ELSE ln(0.4) END + CASE
                   WHEN prior IS NULL THEN ln(greatest(c_word, 1) / rest)
                   WHEN c_two > 0 THEN ln(c_two / greatest(c_prior, 1))
                   ELSE ln(0.4) + ln(greatest(c_word, 1) / rest) END END) AS score
    FROM seen GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_words, coalesce(s.backed, 0)::BIGINT AS n_backed_off,
       round(coalesce(s.score, 0.0), 6) AS log_score, round(s.score / s.n, 6) AS mean_log_score
FROM docs d LEFT JOIN scored s ON s.doc_id = d.doc_id
"""

FILTER_AUDIT = rf"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
found AS (
    SELECT doc_id, part, list_filter([
        CASE WHEN len(w) < 50 THEN 'A' END,
        CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
        CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' END,
        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
        CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' END], lambda x: x IS NOT NULL) AS failed
    FROM docs
),
said AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
classes AS (
    SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
    FROM found LEFT JOIN said USING (doc_id) GROUP BY part, failed
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
fates AS (
    SELECT *, coalesce(list_min(list_transform(failed, lambda x: strpos(filter_order, x))), 9) AS fell
    FROM classes CROSS JOIN orders
),
steps AS (
    SELECT part, filter_order, step, substr(filter_order, step, 1) AS own,
           sum(n) FILTER (WHERE fell > step) AS kept, sum(n) FILTER (WHERE fell = step) AS removed,
           sum(n) FILTER (WHERE fell < step AND list_contains(failed, substr(filter_order, step, 1))) AS redundant,
           sum(n) FILTER (WHERE failed = [substr(filter_order, step, 1)]) AS unique_fails,
           sum(n_good) FILTER (WHERE fell = step) AS good_lost, sum(n_toxic) FILTER (WHERE fell = step) AS toxic_lost
    FROM fates CROSS JOIN (SELECT unnest(range(1, 6)) AS step) GROUP BY part, filter_order, step
)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM steps
"""

# crc32 byte by byte and bit by bit, as there is no function for it.
_CRC = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: list_reduce(range(8), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(c, b)),
    4294967295::BIGINT), 4294967295)"""

RUNS = f"""
WITH given AS (SELECT doc_id, {WORDS} AS w, {_CRC} AS h FROM documents),
ways AS (SELECT *, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM given),
periods AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM ways),
docs AS (
    SELECT doc_id, CASE WHEN planted
        THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
    FROM periods
),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM docs),
equal AS (
    SELECT a.doc_id, a.i, b.i - a.i AS q FROM words a JOIN words b
    ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND 2 * (b.i - a.i) <= a.n
),
numbered AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (
    SELECT doc_id, min(i) AS start, count(*) + q AS length, q FROM numbered GROUP BY doc_id, q, island
    HAVING count(*) >= q AND count(*) + q >= 12
),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
said AS (
    SELECT doc_id, count(*) AS n_runs, min((-length, start, period)) AS best,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text
    FROM runs GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[2]::BIGINT AS start, (-best[1])::BIGINT AS length,
       best[3]::BIGINT AS period, (1000 * -best[1] // best[3])::BIGINT AS exponent_milli,
       sha256(coalesce(s.text, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN said s ON s.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    """SQL for the canonical form of a text expression, line by line."""
    begin = r"^[^\p{L}\p{N}]*"
    names_holder = (
        rf"regexp_matches(x, '{begin}(copyright$|copyright[^\p{{L}}\p{{N}}_])') AND NOT "
        rf"regexp_matches(x, '{begin}copyright\s+(notice|holder|owner|law|license|licence)') "
        rf"OR regexp_matches(x, '{begin}\(c\).*[0-9][0-9][0-9][0-9]') OR regexp_matches(x, '{begin}©')"
    )
    lines = f"list_filter(string_split(lower({text}), chr(10)), lambda x: NOT ({names_holder}))"
    words = rf"list_transform({lines}, lambda x: trim(regexp_replace(x, '[^\p{{L}}\p{{N}}]+', ' ', 'g')))"
    full = f"list_filter({words}, lambda x: x <> '')"
    first = f"string_split({full}[1], ' ')"
    titled = f"len({full}) > 1 AND len({first}) <= 4 AND (list_contains({first}, 'license') OR list_contains({first}, 'licence'))"
    plain = f"array_to_string(CASE WHEN {titled} THEN {full}[2:] ELSE {full} END, ' ')"
    spellings = ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in SPELLINGS.items())
    return (
        f"array_to_string(list_transform(string_split({plain}, ' '), "
        f"lambda x: coalesce(element_at(MAP {{{spellings}}}, x)[1], x)), ' ')"
    )


_KNOWN = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in [*NOTICES, *TEXTS])

LICENSES = rf"""
WITH known AS (
    SELECT DISTINCT license_id, {_canonical("text")} AS form FROM (VALUES {_KNOWN}) AS k(license_id, text)
),
lines AS (SELECT doc_id, text, trim(unnest(string_split(text, chr(10)))) AS line FROM documents),
units AS (
    SELECT doc_id, 'text' AS unit, text FROM documents
    UNION ALL SELECT doc_id, 'line', line FROM lines WHERE contains(text, chr(10))
    UNION ALL SELECT doc_id, 'sentence', unnest(string_split(
        regexp_replace(line, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) FROM lines WHERE regexp_matches(line, '[.!?]\s')
)
SELECT doc_id, unit, license_id, count(*) AS n_found
FROM (SELECT doc_id, unit, {_canonical("text")} AS form FROM units) u JOIN known USING (form)
WHERE form <> '' GROUP BY doc_id, unit, license_id
"""

ORACLES: dict[str, str] = {
    "op3_substrings": SUBSTRINGS,
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op6_contamination": CONTAMINATION,
    "op8_licenses": LICENSES,
    "op10_trigram_model": TRIGRAM_MODEL,
    "op10_language_model": LANGUAGE_MODEL,
    "op11_runs": RUNS,
    "op13_filter_audit": FILTER_AUDIT,
}
