"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from stratamill.llm.hard_negatives import ANCHOR_EVERY, HIGH_PERCENT, LOW_PERCENT, NEGATIVES, POSITIVES, SCALE
from stratamill.llm.licenses import (
    NOT_WORD,
    PHRASES,
    TEMPLATES,
    least_common,
    template_words,
    window_lengths,
    words_of,
)
from stratamill.llm.parameters import SOURCE_WEIGHTS
from stratamill.llm.prefix_trie import FAMILY, HEAD
from stratamill.llm.quality import BASE_MEASURES, MAX_REPEAT_PERCENT, MEASURES, MIN_WORDS, RULES, STOP_WORDS
from stratamill.llm.reputation import (
    BLOCK_ABOVE,
    BOUND_SIGMAS,
    DOUBLE_SUFFIXES,
    MAX_STRENGTH,
    MIN_STRENGTH,
    URL_RULES,
)

BREAK = r"[\x20\x09-\x0D]"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _failed(rule) -> str:
    ratio = f"({rule.numerator}::DOUBLE / nullif({rule.denominator}, 0)::DOUBLE)"
    low = [f"{ratio} < {rule.low}"] if rule.low is not None else []
    high = [f"{ratio} > {rule.high}"] if rule.high is not None else []
    return f"CASE WHEN {' OR '.join(low + high)} THEN '{rule.name}' END"


QUALITY = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{BREAK}+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), starts AS (
  SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split
), repeated AS (
  SELECT rid, i FROM starts
  QUALIFY count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM repeated, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda w: w IN ({_quoted(STOP_WORDS)})))::BIGINT AS n_stop_words,
         len(lines)::BIGINT AS n_lines,
         len(list_filter(lines, lambda l: regexp_matches(l, '^{BREAK}*[-*•–]')))::BIGINT AS n_bullet_lines,
         len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…){BREAK}*$')))::BIGINT AS n_open_lines
  FROM split LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed,
         concat_ws(',', {", ".join(_failed(rule) for rule in RULES)}) AS failed_rules
  FROM measured
)
SELECT doc_id, {", ".join(BASE_MEASURES)}, base_failed, NOT base_failed AND failed_rules = '' AS kept,
       failed_rules, {", ".join(name for name in MEASURES if name not in BASE_MEASURES)}
FROM judged
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLACES = " UNION ALL ".join(
    f"SELECT rid, '{label}' AS label, i - 1 AS pos FROM starts WHERE "
    + " AND ".join(f"words[i + {k}] = '{word}'" for k, word in enumerate(phrase.split()))
    for phrase, label in PHRASES.items()
)


def _template(label: str, notice: str) -> str:
    words = sorted(template_words(notice))
    near, far = window_lengths(len(words_of(notice)))
    return f"('{label}', [{_quoted(words)}], {least_common(len(words))}, {near}, {far})"


_TEMPLATES = ", ".join(_template(*t) for t in TEMPLATES)

LICENSES = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text
  FROM documents
), split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{NOT_WORD}'), lambda w: w <> '') AS words
  FROM texts
), starts AS (
  SELECT rid, words, unnest(range(1, len(words) + 1)) AS i FROM split
), places AS (
  {_PLACES}
), based AS (
  SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS base
  FROM places GROUP BY rid
), templates(label, wanted, least, near, far) AS (
  VALUES {_TEMPLATES}
), near_templates AS (
  SELECT * FROM (SELECT rid, words, list_distinct(words) AS vocabulary FROM split), templates
  WHERE len(list_intersect(wanted, vocabulary)) >= least
), windows AS (
  SELECT *, unnest(range(1, greatest(len(words) - near + 1, 1) + 1)) AS i FROM near_templates
), counted AS (
  SELECT rid, label, wanted, least, len(list_intersect(wanted, words[i:i + near - 1])) AS n_near,
         len(list_intersect(wanted, words[i:i + far - 1])) AS n_far
  FROM windows
), matched AS (
  SELECT rid, label, CASE WHEN n_far = len(wanted) THEN n_far ELSE n_near END::DOUBLE / len(wanted)::DOUBLE AS score
  FROM counted WHERE n_near >= least OR n_far = len(wanted)
), found AS (
  SELECT rid, max(score) AS score, list(DISTINCT label) AS labels FROM matched GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(labels, [])))), ',') AS labels,
       greatest(coalesce(score, 0), CASE WHEN n_base > 0 THEN 1 ELSE 0 END)::DOUBLE AS score
FROM split LEFT JOIN based USING (rid) LEFT JOIN found USING (rid)
"""

_WEIGHTS = ", ".join([*[f"('{k}', {w}::DOUBLE)" for k, w in SOURCE_WEIGHTS.items()], "(NULL, 1.0::DOUBLE)"])


def _uniform(*parts: str) -> str:
    text = "concat_ws(':', " + ", ".join(f"coalesce(({p})::VARCHAR, 'null')" for p in parts) + ")"
    return f"((('0x' || substring(md5({text}), 1, 13))::BIGINT::DOUBLE + 0.5) / {16**13}::DOUBLE)"


MIXING = f"""
WITH weights(source, weight) AS (
  VALUES {_WEIGHTS}
), rows AS (
  SELECT *, CASE WHEN source IN ({_quoted(SOURCE_WEIGHTS)}) THEN source END AS grp, {_uniform("0", "doc_id")} AS u
  FROM documents
), sizes AS (
  SELECT grp, sum(coalesce(length(text), 0))::DOUBLE AS size FROM rows GROUP BY grp
), rates AS (
  SELECT grp, coalesce(weight / sum(weight) OVER () * sum(size) OVER () / nullif(size, 0), 1.0) AS rate
  FROM sizes JOIN weights ON grp IS NOT DISTINCT FROM source
), points AS (
  SELECT grp, rate, unnest(range(0, ceil(rate + 9 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM rates
), masses AS (
  SELECT grp, k, CASE WHEN rate = 0 THEN CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END
         ELSE exp(k * ln(rate) - rate - sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END) OVER w) END AS mass
  FROM points WINDOW w AS (PARTITION BY grp ORDER BY k)
), steps AS (
  SELECT grp, list(step) AS steps FROM (
    SELECT grp, sum(mass) OVER (PARTITION BY grp ORDER BY k) AS step FROM masses
  ) GROUP BY grp
), drawn AS (
  SELECT rows.*, unnest(range(0, len(list_filter(steps, lambda s: s < u)))) AS copy
  FROM rows JOIN steps ON rows.grp IS NOT DISTINCT FROM steps.grp
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, {_uniform("0", "doc_id", "copy", "'place'")} AS place
FROM drawn
"""


def _rules(column: str) -> str:
    when = ""
    for rule in sorted(URL_RULES, key=lambda r: (-len(r.name), r.name)):
        host = f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}'))"
        when += f" WHEN {host} AND starts_with(path, '{rule.path}') THEN '{getattr(rule, column)}'"
    return f"CASE{when} END"


def _shrink(name: str, children: str, parents: str, parent: str) -> str:
    """SQL of a level: its rates shrunk to the parent's mean, as ``name``."""
    return f"""{name}_placed AS (
  SELECT c.*, p.shrunk AS mean FROM {children} c JOIN {parents} p USING ({parent})
), {name}_fit AS (
  SELECT {parent}, (sum(n * (bad / n - mean) * (bad / n - mean)) / nullif(max(mean * (1 - mean)), 0) - count(*))
         / nullif(sum(n) - count(*), 0) AS r, greatest({MIN_STRENGTH}, least({MAX_STRENGTH}, sum(n))) AS most
  FROM {name}_placed WHERE n > 0 GROUP BY {parent}
), {name}_strong AS (
  SELECT p.*, CASE WHEN r > 0 THEN least(most, greatest({MIN_STRENGTH}, 1 / r - 1))
         ELSE coalesce(most, {MIN_STRENGTH}) END AS strength
  FROM {name}_placed p LEFT JOIN {name}_fit USING ({parent})
), {name} AS (
  SELECT *, (bad + strength * mean) / (n + strength) AS shrunk FROM {name}_strong
)"""


_DOUBLES = _quoted(DOUBLE_SUFFIXES)

REPUTATION = rf"""
WITH urls AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM urls
), outcomes AS (
  SELECT doc_id AS page_id, max((coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1)::INT) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id
), counted AS (
  SELECT host, coalesce(sum(bad), 0)::DOUBLE AS bad, count(bad)::DOUBLE AS n, string_split(host, '.') AS l
  FROM parts LEFT JOIN outcomes USING (page_id) GROUP BY host
), depths AS (
  SELECT *, CASE WHEN array_to_string(l[-2:], '.') IN ({_DOUBLES}) THEN 2 ELSE 1 END AS d FROM counted
), hosts AS (
  SELECT host, bad, n, array_to_string(l[-(d + 1):], '.') AS domain, array_to_string(l[-d:], '.') AS suffix, '' AS root
  FROM depths
), domains AS (
  SELECT domain, suffix, root, sum(bad) AS bad, sum(n) AS n FROM hosts GROUP BY ALL
), suffixes AS (
  SELECT suffix, root, sum(bad) AS bad, sum(n) AS n FROM domains GROUP BY ALL
), roots AS (
  SELECT root, sum(bad) / nullif(sum(n), 0) AS shrunk FROM suffixes GROUP BY root
), {_shrink("s", "suffixes", "roots", "root")}, {_shrink("d", "domains", "s", "suffix")},
{_shrink("h", "hosts", "d", "domain")}, judged AS (
  SELECT host, n::BIGINT AS n_labelled, shrunk AS posterior_mean,
         shrunk - {BOUND_SIGMAS} * sqrt(greatest(shrunk * (1 - shrunk), 0) / (n + strength + 1)) AS lower_bound
  FROM h
)
SELECT page_id, host, path, {_rules("name")} AS rule,
       coalesce({_rules("verdict")}, CASE WHEN lower_bound > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict,
       n_labelled, round(posterior_mean, 6) AS posterior_mean, round(lower_bound, 6) AS lower_bound
FROM parts LEFT JOIN judged USING (host)
"""

_CRC_POLYNOMIAL = 0xEDB88320
TRIE = rf"""
WITH table_of_crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_CRC_POLYNOMIAL}) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))
), turns AS (
  SELECT conv_id AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         dense_rank() OVER (ORDER BY coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL
), words AS (
  SELECT DISTINCT t, len(list_filter(regexp_split_to_array(text, '{BREAK}+'), lambda w: w <> '')) AS n_words FROM turns
), own AS (
  SELECT conv, list(t ORDER BY turn NULLS FIRST, role, text) AS ts FROM turns GROUP BY conv
), hashed AS (
  SELECT conv, ts, xor(list_reduce(list_concat([4294967295::BIGINT],
           list_transform(string_split(conv::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {HEAD + 1} AS h
  FROM own, table_of_crc
), rebuilt AS (
  SELECT o.conv, list_concat(coalesce(list_slice(f.ts, 1, o.h), []), list_slice(o.ts, o.h + 1, len(o.ts))) AS ts
  FROM hashed AS o LEFT JOIN own AS f ON f.conv = o.conv - o.conv % {FAMILY}
), prefixes AS (
  SELECT conv, list_slice(ts, 1, d) AS node, d, d = len(ts) AS ended
  FROM (SELECT conv, ts, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, d AS depth, min(conv) AS conv, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (ended), '')) AS ends_sha256
  FROM prefixes GROUP BY node, d
), children AS (
  SELECT list_slice(node, 1, depth - 1) AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), measured AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(n_words, 0) AS saving
  FROM nodes AS n LEFT JOIN children AS c ON c.node = n.node LEFT JOIN words AS w ON w.t = n.node[n.depth]
), subtrees AS (
  SELECT list_slice(node, 1, d) AS node, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saving) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM measured) GROUP BY 1
)
SELECT m.conv AS conv_id, m.depth::BIGINT AS depth, p.conv AS parent_conv_id, m.n_convs::BIGINT AS n_convs,
       m.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       m.ends_sha256
FROM measured AS m JOIN subtrees AS s ON s.node = m.node
LEFT JOIN nodes AS p ON m.depth > 0 AND p.node = list_slice(m.node, 1, m.depth - 1)
"""

HARD_NEGATIVES = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id AS id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite({SCALE} * x::DOUBLE))) = 0
), scored AS (
  SELECT a.r AS anchor, a.id AS anchor_id, a.label = b.label AS same, b.id, b.r,
         coalesce(list_inner_product(a.v, b.v), 0)::BIGINT AS score
  FROM rows AS a JOIN rows AS b ON a.id % {ANCHOR_EVERY} = 0 AND a.r <> b.r AND len(a.v) = len(b.v)
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, r) AS place FROM scored WHERE same
  QUALIFY place <= {POSITIVES}
), ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.id, n.r) AS rank
  FROM positives AS p JOIN scored AS n ON n.anchor = p.anchor AND NOT n.same
    AND n.score * 100 BETWEEN p.score * {LOW_PERCENT} AND p.score * {HIGH_PERCENT}
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= {NEGATIVES}
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op2_mixing": MIXING,
    "op8_license_scans": LICENSES,
    "op10_url_filters": REPUTATION,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_prefix_trie": TRIE,
}
