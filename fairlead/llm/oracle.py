"""The same results as plain DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from fairlead.llm.quality_rules import STOP_WORDS

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, (r.key IS NOT NULL AND k.doc_id <> r.keeper) AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

MIXING = r"""
WITH digests AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place, md5(coalesce(text, '')) AS row
  FROM documents),
sized AS (
  SELECT *, CAST('0x' || substr(md5('9|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || row), 1, 8) AS BIGINT)
            % greatest(1, CAST(ceil((SELECT count(*) FROM documents) / 20000) AS BIGINT)) AS shard
  FROM digests),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) * 2 AS BIGINT) AS cap,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level,
         row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS cap_rank
  FROM sources
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(cap::DOUBLE, (SELECT arg_min(level, cap_rank) FROM levels WHERE level * weight <= cap) * weight) AS target
  FROM levels),
seats AS (SELECT CAST(floor(sum(target) / 32) AS BIGINT) AS n FROM targets),
quotients AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS place
  FROM targets, (SELECT unnest(generate_series(0, (SELECT n FROM seats))) AS k)
  WHERE k <= target / 32 + 20 AND target > 0),
source_blocks AS (
  SELECT source, count(*) AS blocks FROM quotients WHERE place <= (SELECT n FROM seats) GROUP BY source),
shards AS (SELECT source, shard, CAST(sum(size) AS BIGINT) AS shard_size FROM sized GROUP BY source, shard),
shard_quotients AS (
  SELECT s.source, shard, shard_size,
         row_number() OVER (PARTITION BY s.source ORDER BY shard_size / (2 * k + 1) DESC, shard, k) AS place, blocks
  FROM shards s JOIN source_blocks b ON s.source IS NOT DISTINCT FROM b.source,
       (SELECT unnest(generate_series(0, (SELECT n FROM seats))) AS k)
  WHERE shard_size > 0 AND k <= blocks),
shard_blocks AS (
  SELECT source, shard, count(*) FILTER (WHERE place <= blocks) AS quota
  FROM shard_quotients GROUP BY source, shard),
given AS (
  SELECT s.*, coalesce(q.quota, 0) * 32 AS words, s.shard_size * 2 - least(coalesce(q.quota, 0) * 32, s.shard_size * 2) AS room
  FROM shards s LEFT JOIN shard_blocks q ON s.source IS NOT DISTINCT FROM q.source AND s.shard = q.shard),
shared AS (  -- words that a shard cannot take go to the others of its source by their room
  SELECT source, shard, shard_size, words, room, sum(room) OVER (PARTITION BY source) AS all_room,
         sum(room) OVER (PARTITION BY source ORDER BY shard) AS room_to,
         sum(words - least(words, shard_size * 2)) OVER (PARTITION BY source) AS over_limit
  FROM given),
budgets AS (
  SELECT s.source, s.shard, s.shard_size, t.source_size, t.target,
         CAST(least(words, s.shard_size * 2) + CASE WHEN least(over_limit, all_room) > 0
           THEN least(over_limit, all_room) * room_to // all_room - least(over_limit, all_room) * (room_to - room) // all_room
           ELSE 0 END AS BIGINT) AS budget,
         CAST('0x' || substr(md5('8|' || coalesce(s.source, '') || '|' || s.shard), 1, 8) AS BIGINT)
           % greatest(1, s.shard_size // 32) * 32 AS start
  FROM shared s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
placed AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source, shard ORDER BY place, doc_id, row, size
                            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop
  FROM sized)
SELECT p.doc_id, p.source, p.size, b.source_size, b.target,
       CASE WHEN b.shard_size = 0 THEN 0 ELSE
       (b.budget // b.shard_size) * p.size
       + greatest(0, least(p.stop, least(b.start + b.budget % b.shard_size, b.shard_size)) - greatest(p.stop - p.size, b.start))
       + greatest(0, least(p.stop, b.start + b.budget % b.shard_size - b.shard_size) - (p.stop - p.size)) END AS taken
FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source AND p.shard = b.shard
"""


QUALITY_RULES = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM split)),
repeats AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM windows JOIN repeats USING (doc_id, g), (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: list_contains({STOP}, x))) AS n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '(?:\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets
  FROM split LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2 AND 12 AND n_symbols / n_words <= 0.1
       AND n_stop_words / n_words >= 0.05 AND n_dup_lines / n_lines <= 0.5
       AND n_ellipsis / n_lines <= 0.3 AND n_bullets / n_lines <= 0.9 AS kept
FROM judged
""".replace("{STOP}", str(" ".join(STOP_WORDS.values()).split()))


SUBSTRING_DEDUP = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM split)),
earliest AS (SELECT g, min(doc_id) AS first_doc FROM windows GROUP BY g HAVING count(DISTINCT doc_id) > 1),
covered AS (
  SELECT DISTINCT w.doc_id, i + k AS pos
  FROM windows w JOIN earliest e ON w.g = e.g AND e.first_doc < w.doc_id,
       (SELECT unnest(generate_series(0, 12)) AS k)),
tokens AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
kept AS (
  SELECT t.doc_id, count(*) FILTER (WHERE c.pos IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY t.pos) FILTER (WHERE c.pos IS NULL) AS text
  FROM tokens t LEFT JOIN covered c ON t.doc_id = c.doc_id AND t.pos = c.pos GROUP BY t.doc_id)
SELECT s.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)
"""


NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
linked AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reached r JOIN linked l ON r.other = l.a),
components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""

LM_SCORING = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
tokens AS (SELECT doc_id, unnest(w) AS b, generate_subscripts(w, 1) AS pos, w FROM split),
placed AS (SELECT doc_id, pos, b, CASE WHEN pos > 1 THEN w[pos - 1] END AS a FROM tokens),
word_counts AS (SELECT b AS w, count(*) AS c FROM placed GROUP BY b),
pair_counts AS (
  SELECT a, b, count(*) AS c FROM placed WHERE a IS NOT NULL GROUP BY a, b),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM placed),
scored AS (
  SELECT p.doc_id,
         CASE WHEN p.a IS NULL THEN ln(cb.c / n)
              WHEN pc.c IS NOT NULL THEN ln(pc.c / ca.c)
              ELSE ln(0.4::DOUBLE * cb.c / n) END AS s
  FROM placed p CROSS JOIN total JOIN word_counts cb ON p.b = cb.w
  LEFT JOIN word_counts ca ON p.a = ca.w
  LEFT JOIN pair_counts pc ON p.a = pc.a AND p.b = pc.b),
sums AS (SELECT doc_id, count(*) AS n_words, sum(s) AS s FROM scored GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(s, 0), 6) AS log_score,
       round(s / n_words, 9) AS mean_log_score
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN sums USING (doc_id)
"""

CONVERSATION_REPAIR = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
drawn AS (  -- CRC-32 bit by bit
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(k) + 1),
               lambda i: list_transform(range(0, 8), lambda j: CAST((ascii(k[i]) >> j) & 1 AS BIGINT))))),
             lambda c, b: xor(c >> 1, xor(c & 1, b) * 3988292384)), 4294967295) % 20 AS fault
  FROM keyed),
turns AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, (SELECT unnest([1, 2]) AS copy) WHERE fault <> 0 AND (copy = 1 OR fault = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
  FROM turns),
repeated AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed),
faulty AS (
  SELECT *, substr(role, 1, 1) AS x, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev_x,
         CASE WHEN body = '' THEN 1 WHEN again THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS f
  FROM repeated),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE f = 1) AS blank, count(*) FILTER (WHERE f = 2) AS duplicate,
         count(*) FILTER (WHERE f = 3) AS truncated,
         count(*) FILTER (WHERE i > 1 AND prev_x || x NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faulty GROUP BY conv_id),
walk AS (  -- cheapest (cost, audit, result) by last role: none, system, user, assistant
  SELECT conv_id, 0 AS i, {'c': 0, 'a': '', 'r': ''} AS z, {'c': 999999, 'a': '', 'r': ''} AS s,
         {'c': 999999, 'a': '', 'r': ''} AS u, {'c': 999999, 'a': '', 'r': ''} AS a
  FROM counts
  UNION ALL
  SELECT conv_id, i,
         {DELETE z},
         list_min([{DELETE s}, CASE WHEN f IN (0, 3) AND x = 's' THEN {KEEP z} END]),
         list_min([{DELETE u}, CASE WHEN f IN (0, 3) AND x = 'u' THEN {KEEP e} END,
                   CASE WHEN f IN (0, 3) THEN {REROLE e user} END]),
         list_min([{DELETE a}, CASE WHEN f IN (0, 3) AND x = 'a' THEN {KEEP u} END,
                   CASE WHEN f IN (0, 3) THEN {REROLE u assistant} END])
  FROM (
    SELECT *, list_min([z, s, a]) AS e FROM (
      SELECT conv_id, i, x, f, role, text, more, z, s, u, list_min([a, {INSERT u assistant}]) AS a FROM (
        SELECT w.conv_id, f.i, f.x, f.f, f.role, f.text, CASE WHEN f.f = 3 THEN 1 ELSE 0 END AS more, z, s, a,
               list_min([u, {INSERT z user}, {INSERT s user}, {INSERT a user}]) AS u
        FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1)))),
ended AS (
  SELECT w.conv_id, list_min([z, a, {INSERT u assistant}, {INSERT2 s}]) AS best
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(substr(best.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM d.conv_id
"""


def _spelled(template: str) -> str:
    """Fills in the edits: ``{KEEP z}`` is the state ``z`` after its turn was kept."""

    def state(of: str, cost: str, letters: str, line: str) -> str:
        return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{letters}', 'r': {of}.r{line}}}"

    for of in "zsuae":
        inserted = {"user": " || chr(10) || 'user:'", "assistant": " || chr(10) || 'assistant:'"}
        template = template.replace(f"{{DELETE {of}}}", state(of, "3", "D", ""))
        template = template.replace(f"{{KEEP {of}}}", state(of, "more", "K", " || chr(10) || role || ':' || text"))
        template = template.replace(f"{{INSERT2 {of}}}", state(of, "4", "II", "".join(inserted.values())))
        for role, line in inserted.items():
            template = template.replace(f"{{INSERT {of} {role}}}", state(of, "2", "I", line))
            rerole = state(of, "2 + more", "R", f"{line} || text")
            template = template.replace(f"{{REROLE {of} {role}}}", rerole)
    return template


EMBEDDING_DEDUP = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT * FROM vectors
  WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
   AND CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.93 ELSE false END),
reached AS (
  SELECT vec_id, vec_id AS other FROM vectors
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a),
components AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)
"""


FILTER_AUDIT = r"""
WITH split AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
failures AS (
  SELECT doc_id, part,
         [len(w) < 50,
          100 * len(list_distinct(w)) < 65 * len(w),
          100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM split),
flagged AS (
  SELECT f.*, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND l.quality = 1) AS good,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND l.toxic = 1) AS toxic
  FROM failures f),
patterns AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM flagged GROUP BY part, fails),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS seq
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT array_to_string(list_transform(seq, lambda i: 'ABCDE'[i]), '') AS filter_order,
         step, seq[step] AS f, seq[1:step - 1] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, fails[f] AS fails_here,
         len(list_filter(before, lambda i: fails[i])) > 0 AS went,
         len(list_filter(fails, lambda x: x)) AS n_fails
  FROM patterns, steps),
counted AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (WHERE NOT went AND NOT fails_here), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE NOT went AND fails_here), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE went AND fails_here), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE fails_here AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT went AND fails_here), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT went AND fails_here), 0) AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": QUALITY_RULES,
        "op3_lm_scoring": LM_SCORING,
        "op3_lm_all_pairs": LM_SCORING,
        "op4_source_mixing": MIXING,
        "op6_substring_dedup": SUBSTRING_DEDUP,
        "op7_minhash_dedup": NEAR_DEDUP,
        "op10_line_dedup": LINE_DEDUP,
        "op11_conversation_repair": _spelled(CONVERSATION_REPAIR),
        "op12_embedding_dedup": EMBEDDING_DEDUP,
        "op13_filter_audit": FILTER_AUDIT,
    }
