"""DuckDB SQL for the operators' queries, over whole tables."""

from __future__ import annotations

from . import mixing, quality

#: Words of a text, and those of the lower-cased text.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SIZED = f"SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k, len({WORDS})::BIGINT AS size FROM documents"

OP1 = f"""
WITH sized AS ({SIZED}),
per AS (SELECT k, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM sized GROUP BY k),
w AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
             source_size * {mixing.MAX_REPEAT} AS cap, (sum(source_size) OVER ())::BIGINT AS total FROM per),
l AS (SELECT *, row_number() OVER o AS place,
             (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, k)),
f AS (SELECT arg_min(level, place) AS level FROM l WHERE level * weight <= cap),
t AS (SELECT k, source_size, least(cap::DOUBLE, coalesce(f.level * weight, 'inf'::DOUBLE)) AS target FROM l LEFT JOIN f ON true),
r AS (SELECT s.*, source_size, target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('{mixing.SEED}' || k), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u,
             row_number() OVER (PARTITION BY k ORDER BY lpad(length(bin(size))::VARCHAR, 2, '0') || rpad(substr(bin(size), 1, 4), 4, '0') DESC,
                                md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST) AS pos
      FROM sized s JOIN t USING (k))
SELECT doc_id, size, source_size, target,
       least(floor(pos * rate + u)::BIGINT - floor((pos - 1) * rate + u)::BIGINT, {mixing.MAX_REPEAT})::BIGINT * size AS taken,
       least(floor(pos * rate + u)::BIGINT - floor((pos - 1) * rate + u)::BIGINT, {mixing.MAX_REPEAT})::BIGINT AS copies
FROM r
"""


def op3(shards: int) -> str:
    from .sharding import table_size

    m = table_size(shards)
    return f"""
WITH RECURSIVE shard AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 5, '0') AS name FROM range({shards}) r(i)),
pref AS (
  SELECT list(('0x' || substr(md5(name), 1, 8))::BIGINT % {m} ORDER BY i) AS start,
         list(('0x' || substr(md5(name), 9, 8))::BIGINT % ({m} - 1) + 1 ORDER BY i) AS skip FROM shard),
fill AS (
  SELECT 0 AS step, list_transform(range({m}), lambda x: -1) AS tab, 0::BIGINT AS slot FROM pref
  UNION ALL
  SELECT step + 1, list_concat(list_concat(tab[1:p], [step % {shards}]), tab[p + 2:]), p
  FROM (SELECT step, tab, (start[step % {shards} + 1] + skip[step % {shards} + 1]
               * list_position(list_transform(range({m}), lambda j: tab[(start[step % {shards} + 1] + skip[step % {shards} + 1] * j) % {m} + 1] < 0), true) - skip[step % {shards} + 1]) % {m} AS p
        FROM fill, pref WHERE step < {m}))
SELECT doc_id, slot AS shard_slot, name AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {m} AS s FROM documents) d
JOIN (SELECT slot, (step - 1) % {shards} AS i FROM fill WHERE step > 0) f ON f.slot = d.s JOIN shard USING (i)
"""


_RULES = " + ".join(f"(CASE WHEN {r.fails} THEN {quality.BIT[r.name]} ELSE 0 END)" for r in quality.RULES)

LEDGER = f"""
WITH base AS (
  SELECT row_number() OVER () AS row, doc_id, {WORDS} AS w, coalesce(text, '') AS t FROM documents),
lined AS (
  SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM base),
windows AS (
  SELECT row, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS x
  FROM (SELECT row, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5)),
found AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, x) > 1),
covered AS (SELECT row, count(DISTINCT i + k) AS n FROM found, range(5) r(k) GROUP BY row),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM lined LEFT JOIN covered c USING (row)),
ledger AS (SELECT *, ({_RULES})::BIGINT AS failed_rules FROM m)
"""

OP4 = f"""{LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_rules & {quality.BASE}) <> 0 AS base_failed,
       (failed_rules & {quality.POLICIES[quality.LATEST]}) = 0 AS kept, failed_rules
FROM ledger
"""

OP7 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words WHERE len(w) >= 5)
    UNION ALL SELECT doc_id, list_aggregate(w, 'string_agg', ' ') FROM words WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS u, a AS v FROM both_ways UNION SELECT u, b FROM reach JOIN both_ways ON v = a),
root AS (SELECT u, min(v) AS r FROM reach GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(r, d.doc_id) AS component_id, coalesce(r, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN root ON u = d.doc_id
"""

OP9 = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
both_ways AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.9),
reach AS (SELECT DISTINCT a AS u, a AS v FROM both_ways UNION SELECT u, b FROM reach JOIN both_ways ON v = a),
root AS (SELECT u, min(v) AS r FROM reach GROUP BY u),
links AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(r, vec_id) AS component_id, coalesce(r, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN links ON a = vec_id LEFT JOIN root ON u = vec_id
"""

OP8 = r"""
WITH rules(rule, action) AS (VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')),
listed AS (SELECT rule, action, split_part(rule, '/', 1) AS h, substr(rule, length(split_part(rule, '/', 1)) + 1) AS p FROM rules),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT row_number() OVER () AS row, page_id, regexp_extract(rest, '^[^/?#]*') AS host,
                 regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
low AS (SELECT row, page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
fit AS (SELECT row, arg_max(rule, (length(rule), length(h), rule)) AS rule, arg_max(action, (length(rule), length(h), rule)) AS action
        FROM low JOIN listed ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY row)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM low LEFT JOIN fit USING (row)
"""

ORACLES = {"op1_mixing": OP1, "op3_sharding": op3(64), "op4_quality_rules": OP4, "op7_minhash_near_dedup": OP7, "op8_url_filters": OP8, "op9_embedding_near_dedup": OP9}

_BITS = ", ".join(f"('{r.name}', {quality.BIT[r.name]})" for r in quality.RULES if quality.BIT[r.name] & quality.POLICIES[quality.LATEST])
ORACLES["quality_ablation"] = f"""
WITH marked AS ({ORACLES["op4_quality_rules"]}), rules(rule, bit) AS (VALUES {_BITS})
SELECT rule, count(*) FILTER (WHERE failed_rules & bit <> 0) AS failing, count(*) FILTER (WHERE failed_rules & {quality.POLICIES[quality.LATEST]} = bit) AS only_failing
FROM marked, rules GROUP BY rule"""

#: The CRC-32 of a text, from the table of its polynomial.
ORACLES["op11_spelling_variants"] = r"""
WITH RECURSIVE step(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM step WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM step WHERE k = 8),
run AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents) WHERE length(r) >= 7),
hashed AS (
  SELECT run, xor(list_reduce(list_transform(range(0, octet_length(encode(id || ':' || run)) * 2, 2), lambda k: ('0x' || substr(hex(encode(id || ':' || run)), k + 1, 2))::BIGINT),
                              lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h FROM run, crc),
struck AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
w AS MATERIALIZED (SELECT word, count(*) AS n FROM struck WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS MATERIALIZED (SELECT DISTINCT word, n, length(word) AS l, k, substr(word, 1, k - 1) AS a, substr(word, k + 1) AS z FROM w, range(1, 200) r(k) WHERE k <= length(word)),
pair AS (
  SELECT x.word AS u, y.word AS v FROM cut x JOIN cut y ON x.l = y.l AND x.k = y.k AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT c.word, w.word FROM cut c JOIN w ON w.word = c.a || c.z
  UNION SELECT w.word, c.word FROM cut c JOIN w ON w.word = c.a || c.z),
near AS (SELECT u, count(*) AS n_near, arg_min(v, (-n, v)) AS form, max(n) AS most FROM pair JOIN w ON v = word GROUP BY u),
judged AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN form END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n FROM w LEFT JOIN near ON u = word),
walk AS (SELECT word, word AS onto, 0 AS d FROM w UNION ALL SELECT walk.word, j.form, d + 1 FROM walk JOIN judged j ON j.word = walk.onto WHERE j.form IS NOT NULL),
ends AS (SELECT word, arg_max(onto, d) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN ends USING (word)
"""

ORACLES["op12_source_divergence"] = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
word AS MATERIALIZED (SELECT r, lang, source, unnest(t) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY lang, source, term),
cell AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(n, 0)::HUGEINT AS n FROM grp g JOIN kept k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
p AS MATERIALIZED (
  SELECT lang, source, term, n, (1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang, source)::HUGEINT + 2 * v))::HUGEINT AS p,
         (1 + 1000000000 * (sum(n) OVER (PARTITION BY lang, term)::HUGEINT + 2) // (sum(n) OVER (PARTITION BY lang)::HUGEINT + 2 * v))::HUGEINT AS q
  FROM cell JOIN v USING (lang)),
far AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p))::BIGINT AS value FROM p x JOIN p y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL),
part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM part QUALIFY part = 'pair' OR rank <= 10
"""
