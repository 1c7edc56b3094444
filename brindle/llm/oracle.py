"""DuckDB SQL of the queries that SQL can express."""

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

#: When a source has had the share x of its words. The fading schedule falls from 5/4 over 1 to 3/4, the rising one climbs from 1/2
#: over 1 to 3/2, both in straight lines with a knot at 1/2; the share is the schedule's integral up to that time.
TIME = """(CASE kind
         WHEN 0 THEN CASE WHEN {x} <= 0.5625::DOUBLE THEN 2 * {x} / (1.25::DOUBLE + sqrt(greatest(1.5625::DOUBLE - {x}, 0)))
                          ELSE least(0.5::DOUBLE + 2 * greatest({x} - 0.5625::DOUBLE, 0) / (1 + sqrt(greatest(1 - ({x} - 0.5625::DOUBLE), 0))), 1) END
         WHEN 1 THEN {x}
         ELSE CASE WHEN {x} <= 0.375::DOUBLE THEN 2 * {x} / (0.5::DOUBLE + sqrt(greatest(0.25::DOUBLE + 2 * {x}, 0)))
                   ELSE least(0.5::DOUBLE + 2 * greatest({x} - 0.375::DOUBLE, 0) / (1 + sqrt(greatest(1 + 2 * ({x} - 0.375::DOUBLE), 0))), 1) END END)"""

OP3 = rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (ARRAY[5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
runs AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE AS total, 3.0::DOUBLE * source_size AS lim,
         coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS reached
  FROM sources),
levels AS (
  SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS kind, arg_min((total - capped) / rest, CASE WHEN (total - capped) / rest <= lim / weight THEN reached END) OVER () AS level FROM runs),
targets AS (SELECT source, kind, source_size, least(level * weight, lim) AS target, round(least(level * weight, lim))::BIGINT AS wanted FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.wanted, t.kind,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at_word
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *, (CASE WHEN source_size > 0 THEN (wanted // source_size) * size
         + least(greatest(wanted - (wanted // source_size) * source_size - at_word, 0), size) ELSE 0 END)::BIGINT AS taken FROM placed),
shares AS (
  SELECT *, CASE WHEN taken > 0 THEN ceil((wanted - at_word)::DOUBLE / source_size) ELSE 0 END::INT AS passes,
         at_word::DOUBLE / wanted AS first_share,
         (at_word + (ceil((wanted - at_word)::DOUBLE / source_size)::BIGINT - 1) * source_size)::DOUBLE / wanted AS last_share FROM mixed)
SELECT doc_id, size, source_size, target, taken, passes,
       CASE WHEN taken > 0 THEN {TIME.format(x="first_share")} END AS position,
       CASE WHEN taken > 0 THEN {TIME.format(x="last_share")} END AS last_position
FROM shares
"""

OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
grams AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
again AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1) GROUP BY rid),
lines AS (
  SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
stats AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals, length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS letters,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS letter_words
  FROM d JOIN lines USING (rid) LEFT JOIN covered c USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 30 * n_words OR 2 * capitals > letters
            OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words OR word_chars > 40 * n_words
            OR 2 * letter_words < n_words) AS kept
FROM stats
"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS rid, doc_id, {WORDS} AS words FROM documents),
windows AS (
  SELECT rid, i, array_to_string(words[i : i + 19], ' ') AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 18)) AS i FROM d)),
later AS (SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY w ORDER BY rid, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(i, i + 20)) AS p FROM later)),
words AS (SELECT rid, words[p] AS word, p FROM (SELECT rid, words, unnest(range(1, len(words) + 1)) AS p FROM d)),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

#: Smallest id reachable over links(x, y) of rows d(rid, id): every row's whole group, then its least id.
REACH = """
sides AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT rid, rid AS other FROM d UNION SELECT r.rid, b.y FROM reach r JOIN sides b ON b.x = r.other),
least_id AS (SELECT r.rid, min(o.id) AS c FROM reach r JOIN d o ON o.rid = r.other GROUP BY r.rid)
"""

OP5 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, vec_id AS id,
         CASE WHEN vec_id IS NOT NULL AND list_bool_and(list_transform(embedding, lambda v: v IS NOT NULL AND isfinite(v))) AND list_bool_or(list_transform(embedding, lambda v: v <> 0)) THEN embedding::DOUBLE[] END AS v FROM embeddings),
links AS (SELECT a.rid AS x, b.rid AS y FROM d a JOIN d b ON a.rid < b.rid AND a.v IS NOT NULL AND b.v IS NOT NULL AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
{REACH}
SELECT d.id AS vec_id, (SELECT count(*) FROM sides WHERE sides.x = d.rid) AS n_links, coalesce(c, d.id) AS component_id, coalesce(c, d.id) IS NOT DISTINCT FROM d.id AS kept
FROM d JOIN least_id USING (rid)
"""

OP6 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id AS id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
shingles AS (
  SELECT DISTINCT rid, CASE WHEN len(words) = 1 THEN words[1] ELSE words[i] || ' ' || words[i + 1] END AS g
  FROM (SELECT rid, words, unnest(range(1, greatest(len(words), 2))) AS i FROM d WHERE len(words) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
common AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.rid < b.rid GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes p ON p.rid = x JOIN sizes q ON q.rid = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
{REACH}
SELECT d.id AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, c IS NOT DISTINCT FROM d.id AS kept
FROM d JOIN least_id USING (rid) LEFT JOIN sizes USING (rid)
"""

OP11 = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY 1),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, w, i, unnest(range(1, 6)) AS k FROM starts),
counts AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS a FROM grams WHERE i + k - 1 <= len(w) GROUP BY ALL),
frequent AS (SELECT * FROM counts WHERE a >= 100),
found AS (SELECT * FROM frequent WHERE k > 1),
cuts AS (SELECT lang, phrase, a, j, array_to_string(w[1 : j], ' ') AS p, array_to_string(w[j + 1 :], ' ') AS q FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM found)),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, c.j, ((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = c.p JOIN frequent y ON y.lang = c.lang AND y.phrase = c.q JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (SELECT b.* FROM best b WHERE NOT EXISTS (SELECT 1 FROM found o WHERE o.lang = b.lang AND length(o.phrase) > length(b.phrase) AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * o.a >= 100 * b.a))
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score FROM kept WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000
"""

#: crc32 of an ASCII text, a fold over its bytes and, for each, eight shifts.
CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length({x}) + 1), lambda i: [ascii(substr({x}, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, c: CASE WHEN c >= 0 THEN xor(a, c) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"


def _option(state: int, cost: str, edit: str, when: str = "true") -> str:
    return f"CASE WHEN {when} THEN {{'cost': (a[{state}]).cost + {cost}, 'audit': (a[{state}]).audit || '{edit}'}} ELSE {{'cost': 1000000000000::BIGINT, 'audit': ''}} END"


def _step() -> str:
    """One turn {role, bad, cut} for the four states: nothing yet, after system, user, assistant."""
    fine, keep = "NOT c.bad", "NOT c.bad AND c.role = '{}'"
    after = [
        [_option(1, "3", "D")],
        [_option(2, "3", "D"), _option(1, "c.cut", "K", keep.format("s"))],
        [_option(3, "3", "D"), *[x for s in (1, 2, 4) for x in (_option(s, "c.cut", "K", keep.format("u")), _option(s, "2 + c.cut", "R", fine))]],
        [_option(4, "3", "D"), _option(3, "c.cut", "K", keep.format("a")), _option(3, "2 + c.cut", "R", fine)],
    ]
    return "[" + ", ".join(f"list_min([{', '.join(x)}])" for x in after) + "]"


_INSERTS = f"[a[1], a[2], list_min([a[3], {', '.join(_option(s, '2', 'I') for s in (1, 2, 4))}]), list_min([a[4], {_option(3, '2', 'I')}])]"

OP12 = rf"""
WITH filled AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hit AS (SELECT *, {CRC.format(x="name")} % 20 AS kind FROM filled),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END))
  FROM hit),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS ending, lag(role) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM placed),
faults AS (SELECT *, ending = '' AS blank, ending <> '' AND again AS duplicate, ending NOT IN ('', '.', '!', '?') AND NOT again AS truncated, before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM seen),
grouped AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal,
         list({{'role': left(role, 1), 'bad': blank OR duplicate, 'cut': truncated::BIGINT, 'kind': 'turn'}} ORDER BY p) AS turns, list({{'role': role, 'text': text}} ORDER BY p) AS texts
  FROM faults GROUP BY conv_id),
pushed AS (SELECT *, {{'role': '', 'bad': true, 'cut': 0::BIGINT, 'kind': 'insert'}} AS ins FROM grouped),
solved AS (
  SELECT *, list_reduce(list_concat(flatten(list_transform(turns, lambda t: [ins, ins, t])), [ins, ins]),
    lambda a, c: CASE WHEN c.kind = 'insert' THEN {_INSERTS} ELSE {_step()} END,
    [{{'cost': 0::BIGINT, 'audit': ''}}, {{'cost': 1000000000000::BIGINT, 'audit': ''}}, {{'cost': 1000000000000::BIGINT, 'audit': ''}}, {{'cost': 1000000000000::BIGINT, 'audit': ''}}]) AS states
  FROM pushed),
chosen AS (SELECT *, list_min([states[1], states[4]]) AS best FROM solved),
replayed AS (
  SELECT *, list_reduce(list_transform(range(1, length(best.audit) + 1), lambda i: substr(best.audit, i, 1)),
    lambda a, e: CASE WHEN e = 'D' THEN {{'at': a.at + 1, 'user': a."user", 'any': a."any", 'said': a.said}}
      ELSE {{'at': a.at + (e <> 'I')::BIGINT, 'user': CASE WHEN e = 'K' THEN left((texts[a.at]).role, 1) = 'u' ELSE NOT a."user" END, 'any': true,
             'said': a.said || CASE WHEN a."any" THEN chr(10) ELSE '' END || CASE WHEN e = 'K' THEN (texts[a.at]).role WHEN a."user" THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN e = 'I' THEN '' ELSE (texts[a.at]).text END}} END,
    {{'at': 1::BIGINT, 'user': false, 'any': false, 'said': ''}}) AS told
  FROM chosen)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(told.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN replayed r ON i.conv_id IS NOT DISTINCT FROM r.conv_id
"""

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, i, lines[i] AS line, translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)),
frequent AS (SELECT key, max(doc_id) AS top FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT rid) >= 3),
marked AS (SELECT l.*, top IS NOT NULL AND top <> coalesce(doc_id, top - 1) AS gone FROM l LEFT JOIN frequent USING (key)),
kept AS (SELECT rid, doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS t FROM marked GROUP BY 1, 2)
SELECT doc_id, n_lines, n_dropped, sha256(t) AS kept_sha256 FROM kept
"""

ORACLE_SQL = {"op11_phrases": OP11, "op12_conversations": OP12, "op13_lines": OP13, "op3_mixing": OP3, "op4_substrings": OP4, "op5_embeddings": OP5, "op6_minhash": OP6, "op7_quality": OP7}
