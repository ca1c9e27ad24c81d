"""The queries of this subpackage as SQL over the tables, where SQL can express them."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"



def _near_duplicates(percent: int) -> str:
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words('text', '[^ \\t-\\r]+')} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (SELECT doc_id, doc_id AS far FROM s UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.far = l.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.far) AS component_id
FROM s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.s)"""


# CRC-32 of a decimal id: each byte is mixed in with the first of its eight bit steps.
_CRC = """xor(list_reduce(
  list_concat([CAST(4294967295 AS UBIGINT)], flatten([[CAST(ascii(c) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0]
    FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
  lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * CAST(3988292384 AS UBIGINT))), 4294967295)"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, rows: str) -> str:
    """Nodes (g, level, i, hash) over rows (g, i, hash, n): each level while several nodes remain."""
    return f"""{name} AS (
  SELECT g, 0 AS level, i, hash, n FROM {rows}
  UNION ALL
  SELECT g, max(level) + 1, i // 3, sha256(string_agg(hash, '' ORDER BY i)), (max(n) + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY g, i // 3)"""


def _needs_larger(exponent: str) -> str:
    """Are the weights of an exponent too even, or do they repeat a source too often? An aggregate over shares."""
    z, low, high = f"sum(pow(share, {exponent}))", f"pow(min(share), {exponent} - 1)", f"pow(max(share), {exponent} - 1)"
    entropy = f"ln({z}) - {exponent} * sum(pow(share, {exponent}) * ln(share)) / {z}"
    return f"({entropy} > 0.95 * ln(count(*)) OR ({exponent} < 1 AND greatest({low}, {high}) / {z} > 4.0))"


ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": _near_duplicates(80),
    "op3_substring_dedup": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
line AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY doc_id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low
  FROM (
    SELECT doc_id, j, line, length(line) + CASE WHEN j < n THEN 1 ELSE 0 END AS size
    FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS j, len(l) AS n
      FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM d)))),
piece AS (
  SELECT doc_id, j, p, low + sum(length(p)) OVER (PARTITION BY doc_id, j ORDER BY k) AS stop
  FROM (SELECT *, unnest(pieces) AS p, unnest(range(len(pieces))) AS k
    FROM (SELECT doc_id, j, low, regexp_extract_all(line, '[^ \\t-\\r]+|[ \\t-\\r]+') AS pieces FROM line))),
word AS (
  SELECT doc_id, j, translate(p, '{_UPPER}', '{_LOWER}') AS w, stop - length(p) AS start, stop,
    row_number() OVER (PARTITION BY doc_id ORDER BY stop) - 1 AS g,
    row_number() OVER (PARTITION BY doc_id, j ORDER BY stop) AS i
  FROM piece WHERE NOT regexp_matches(p, '^[ \\t-\\r]')),
words AS (
  SELECT doc_id, j, list(w ORDER BY i) AS w, list(start ORDER BY i) AS starts, max(stop) AS stop, min(g) AS g
  FROM word GROUP BY doc_id, j),
opens AS (
  SELECT doc_id, j, 1 AS i FROM words
  UNION
  SELECT doc_id, j, i + 1 FROM word WHERE right(w, 1) IN ('.', '!', '?')),
ends AS (SELECT * FROM opens UNION SELECT doc_id, j, len(w) + 1 FROM words),
sentence AS (
  SELECT o.doc_id, o.j, o.i, min(e.i) AS e
  FROM opens o JOIN ends e ON o.doc_id = e.doc_id AND o.j = e.j AND e.i >= o.i + 10 GROUP BY ALL),
unit AS (
  SELECT doc_id, array_to_string(w, ' ') AS key, low, low + size AS high, g AS first, g + len(w) AS behind
  FROM words JOIN line USING (doc_id, j) WHERE len(w) >= 3
  UNION ALL
  SELECT doc_id, array_to_string(w[i:e - 1], ' '), starts[i], CASE WHEN e <= len(w) THEN starts[e] ELSE stop END,
    g + i - 1, g + e - 1
  FROM sentence JOIN words USING (doc_id, j) WHERE NOT (i = 1 AND e = len(w) + 1)),
leader AS (SELECT key, min((doc_id, first, behind)) AS holder FROM unit GROUP BY key),
gone AS (
  SELECT DISTINCT doc_id, low, high FROM unit JOIN leader USING (key)
  WHERE doc_id > struct_extract(holder, 1) OR first >= struct_extract(holder, 3)),
marked AS (
  SELECT *, coalesce(low >= max(high) OVER (
    PARTITION BY doc_id ORDER BY low, high DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS opens FROM gone),
numbered AS (
  SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY low, high DESC ROWS UNBOUNDED PRECEDING) AS island
  FROM marked),
removed AS (SELECT doc_id, CAST(min(low) AS BIGINT) AS low, CAST(max(high) AS BIGINT) AS high FROM numbered GROUP BY doc_id, island),
edge AS (
  SELECT doc_id, low, high FROM removed UNION ALL SELECT doc_id, length(text), NULL FROM d),
gaps AS (
  SELECT doc_id, low AS stop, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low, high NULLS LAST), 0) AS start FROM edge),
kept AS (
  SELECT doc_id, string_agg(substr(text, start + 1, stop - start), '' ORDER BY start) AS text,
    string_agg(start || ':' || stop, ',' ORDER BY start) AS spans
  FROM gaps JOIN d USING (doc_id) WHERE stop > start GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n, string_agg(low || ':' || high, ',' ORDER BY low) AS spans FROM removed GROUP BY doc_id)
SELECT d.doc_id, coalesce(kept.text, '') AS text, CAST(length(coalesce(kept.text, '')) AS BIGINT) AS n_chars,
  coalesce(cut.n, 0) AS n_removed, coalesce(cut.spans, '') AS removed, coalesce(kept.spans, '') AS kept
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)""",
    "op5_mix_sources": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, '-') AS s, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS n,
    md5(coalesce(text, '')) AS text_key FROM documents),
source_words AS (SELECT s, CAST(sum(n) AS BIGINT) AS tokens FROM d GROUP BY s HAVING sum(n) > 0),
shares AS (SELECT s, tokens, tokens / (SELECT sum(tokens) FROM source_words) AS share FROM source_words),
halved AS (
  SELECT 0 AS k, CAST(0 AS DOUBLE) AS low, CAST(16 AS DOUBLE) AS high
  UNION ALL
  SELECT k + 1, CASE WHEN larger THEN middle ELSE low END, CASE WHEN larger THEN high ELSE middle END
  FROM (
    SELECT k, low, high, middle, {_needs_larger('middle')} AS larger
    FROM (SELECT *, (low + high) / 2 AS middle FROM halved), shares GROUP BY k, low, high, middle)
  WHERE k < 40),
exponent AS (
  SELECT CASE WHEN (SELECT {_needs_larger('0.0')} FROM shares) THEN round(high, 9) ELSE 0 END AS a FROM halved WHERE k = 40),
weights AS (
  SELECT s, tokens, round(pow(share, a) / (SELECT sum(pow(share, a)) FROM shares, exponent), 12) AS weight FROM shares, exponent),
plan AS (SELECT *, weight * (SELECT CAST(sum(tokens) AS DOUBLE) FROM source_words) AS quota FROM weights),
picks AS (
  SELECT *, md5(concat_ws(':', 'mix', block, doc_id, text_key)) AS key
  FROM (SELECT *, unnest(range(CAST(floor(quota / tokens) AS BIGINT) + 1)) AS block FROM d JOIN plan USING (s))),
placed AS (
  SELECT *, block * tokens - n + sum(n) OVER (
    PARTITION BY s, block ORDER BY key, doc_id, text_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done
  FROM picks)
SELECT doc_id, source, n AS n_tokens, CAST(block AS INTEGER) AS block, round(CAST(done AS DOUBLE) / quota, 9) AS position, weight
FROM placed WHERE done < quota""",
    "op6_decontamination": f"""
WITH d AS (SELECT doc_id, {_words('text', _WORD)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text', _WORD)} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, m, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS g
  FROM (SELECT *, least(10, len(w)) AS m FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i,
    unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS g
  FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m),
hits AS (SELECT p.doc_id, p.i, p.m, win.item FROM places AS p JOIN win ON p.m = win.m AND p.g = win.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.names, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS size FROM pages),
h AS (SELECT html, max(page_id) AS holder FROM p WHERE size >= 1000 GROUP BY html)
SELECT page_id, size AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN holder > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN holder > page_id THEN holder END AS refers_to
FROM p LEFT JOIN h ON p.html = h.html""",
    "op11_periodic_runs": f"""
WITH t AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, h // 10 AS g
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') AS w, CAST({_CRC} AS BIGINT) AS h FROM documents)),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a, 1 + (n - (CASE WHEN n > 0 THEN g % n END)) // (3 + g % 8) AS p FROM t),
d AS (
  SELECT doc_id, n, CASE WHEN planted THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)] ELSE w END AS w
  FROM a),
e AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS w FROM d),
eq AS (
  SELECT x.doc_id, x.i, y.i - x.i AS p FROM e x JOIN e y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i
  WHERE 3 * (y.i - x.i) <= x.n),
r AS (
  SELECT doc_id, p, min(i) AS s, max(i) + 1 + p AS e
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM eq)
  GROUP BY doc_id, p, island HAVING count(*) + p >= greatest(24, 3 * p)),
runs AS (
  SELECT doc_id, s, e - s AS m, p FROM r WHERE NOT EXISTS (
    SELECT 1 FROM r AS o WHERE o.doc_id = r.doc_id AND o.p < r.p AND o.s <= r.s AND o.e >= r.e)),
best AS (
  SELECT * FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(m AS DOUBLE) / p DESC, s, p) = 1),
said AS (SELECT doc_id, count(*) AS n, string_agg(s || ',' || m || ',' || p || chr(10), '' ORDER BY s, p) AS runs FROM runs GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + p, s + m)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS words FROM (FROM e ANTI JOIN gone USING (doc_id, i)) GROUP BY 1)
SELECT d.doc_id, coalesce(said.n, 0) AS n_runs, best.s AS start, best.m AS length, best.p AS period,
  1000 * best.m // best.p AS exponent_milli, sha256(coalesce(said.runs, '')) AS runs_sha256,
  sha256(coalesce(kept.words, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN said USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE l AS (
  SELECT doc_id, coalesce('=' || source, '-') AS g, {_leaf('text')} AS leaf,
    {_leaf("(CASE WHEN " + _CRC + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS changed
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY g) AS n, leaf AS hash FROM l),
{_tree('low', 'ranked')},
subroots AS (SELECT g AS name, '' AS g, hash, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
{_tree('high', 'subroots')},
nodes AS (SELECT '/' || g AS g, level, i, hash FROM low UNION ALL SELECT g, level, i, hash FROM high),
height AS (SELECT g, max(level) AS top FROM nodes GROUP BY g),
path AS (
  SELECT r.doc_id, h.g, level, r.i // CAST(pow(3, level) AS BIGINT) AS i, level AS step
  FROM ranked r JOIN height h ON h.g = '/' || r.g, range(h.top) AS t(level)
  UNION ALL
  SELECT r.doc_id, h.g, level, s.i // CAST(pow(3, level) AS BIGINT), 1000 + level
  FROM ranked r JOIN subroots s ON s.name = r.g JOIN height h ON h.g = '', range(h.top) AS t(level)),
steps AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY step) AS k,
    coalesce(string_agg(hash, '' ORDER BY n.i) FILTER (n.i < p.i), '') AS before,
    coalesce(string_agg(hash, '' ORDER BY n.i) FILTER (n.i > p.i), '') AS behind
  FROM path p JOIN nodes n ON n.g = p.g AND n.level = p.level AND n.i // 3 = p.i // 3
  GROUP BY doc_id, step),
fold AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS k, changed AS hash FROM l
  UNION ALL
  SELECT f.doc_id, f.k + 1, sha256(s.before || f.hash || s.behind) FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.k = f.k + 1),
folded AS (SELECT doc_id, arg_max(hash, k) AS folded_root FROM fold GROUP BY doc_id),
proofs AS (SELECT doc_id, string_agg(before || behind, '' ORDER BY k) AS proof FROM steps GROUP BY doc_id),
root AS (SELECT hash AS root FROM high WHERE n = 1)
SELECT r.doc_id, r.leaf, s.hash AS subroot, root.root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.folded_root,
  f.folded_root = root.root AS verified
FROM ranked r JOIN subroots s ON s.name = r.g JOIN folded f ON f.doc_id = r.doc_id LEFT JOIN proofs p ON p.doc_id = r.doc_id, root""",
    "op13_minhash_dedup": f"SELECT *, doc_id = component_id AS kept FROM ({_near_duplicates(85)})",
}
