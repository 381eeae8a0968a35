"""DuckDB SQL of the registered queries, where SQL can express them.

Learned operators (rotations, lexicon weights, latent space), HTML and the
tokenizers' files have none; tests/llm hold those against brute force.
"""

from __future__ import annotations

from vartab.llm import jaccard, secrets, sharding, spelling, substrings


def _feistel(source: str, key: str) -> str:
    """SQL for (id, x, a, b, n) with x sent through the network once."""
    out = f"SELECT id, x % a AS l, x // a AS r, a, b, n FROM ({source})"
    for r in range(sharding.ROUNDS):
        side, other, size = ("l", "r", "a") if r % 2 == 0 else ("r", "l", "b")
        mixed = f"('0x' || substr(md5('{key}:{r}:' || {other}::VARCHAR), 1, 15))::BIGINT"
        sides = {other: other, side: f"({side} + {mixed} % {size}) % {size} AS {side}"}
        out = f"SELECT id, {sides['l']}, {sides['r']}, a, b, n FROM ({out})"
    return f"SELECT id, l + r * a AS x, a, b, n FROM ({out})"


def _sharding(shards: int = 24, key: str = "shard-1") -> str:
    """Checksums from their bitwise rule, row numbers as one global sort, and
    walks as a recursion."""
    return f"""
WITH RECURSIVE crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
sized AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
rows AS (
    SELECT doc_id, size::BIGINT AS size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32
    FROM sized, crc_table),
bucketed AS (
    SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || '|' || size || '|' || text_crc32), 1, 8))::BIGINT
        % {sharding.BUCKETS} AS bucket FROM rows),
numbered AS (
    SELECT *, row_number() OVER (ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1 AS id FROM bucketed),
sides AS (
    SELECT n, a, greatest(1, (n + a - 1) // a) AS b FROM (
        SELECT count(*) AS n, floor(sqrt(greatest(count(*) - 1, 0)::DOUBLE))::BIGINT + 1 AS a FROM documents)),
walk AS (
    {_feistel("SELECT id, id AS x, a, b, n FROM numbered, sides", key)}
    UNION ALL
    {_feistel("SELECT * FROM walk WHERE x >= n", key)})
SELECT doc_id, size, text_crc32, 'rows' AS law, id AS row_number, (x % {shards})::INT AS shard, x // {shards} AS slot,
       NULL::INT AS grown_shard
FROM numbered JOIN walk USING (id) WHERE x < n
"""


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _positions(name: str, pattern: str, extra: str = "") -> str:
    p = pattern.replace("'", "''")
    return f"""
{name}_lists AS (
    SELECT rid, regexp_extract_all(t, '{p}', 0) AS m, string_split_regex(t, '{p}') AS g{extra.replace('PATTERN', p)}
    FROM texts WHERE regexp_matches(t, '{p}')),
{name} AS (
    SELECT rid, i, m[i] AS v, s, s + length(m[i]) AS e{', x[i] AS x' if extra else ''} FROM (
        SELECT *, list_sum(list_transform(g[1:i], lambda y: length(y)))
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) AS s
        FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM {name}_lists)))"""


def _secret_scan() -> str:
    """Positions from split pieces, entropies of all windows by DuckDB's own aggregate."""
    names = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
    assign = secrets.ASSIGN.replace("(?i:password|passwd|secret|token|api_?key)", f"(?:{names})")
    w = secrets.WINDOW
    allow = " AND ".join(f"NOT regexp_matches(v, '{a}')" for a in secrets.ALLOW)
    allow += f" AND NOT (regexp_matches(v, '{secrets.WORDS}') AND NOT regexp_matches(v, '{secrets.RANDOM_CASE}'))"
    bits = " ".join(f"WHEN regexp_matches(v, '{c.pattern}') THEN {c.bits}" for c in secrets.CLASSES)
    return f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{_positions("assigned", assign, ", regexp_extract_all(t, 'PATTERN', 1) AS x")},
{_positions("access", secrets.ACCESS)},
{_positions("hexes", secrets.HEX)},
{_positions("candidates", secrets.CANDIDATE)},
tokens AS (
    SELECT rid, i, s, m, unnest(range(1, len(m) + 1)) AS k
    FROM (SELECT *, regexp_extract_all(v, '[A-Za-z0-9]+|[+/_=-]+') AS m FROM candidates)),
cuts AS (
    SELECT *, regexp_full_match(m[k], '{secrets.PLACEHOLDER}') AS cut,
           s + coalesce(list_sum(list_transform(m[1:k - 1], lambda y: length(y))), 0) AS pos FROM tokens),
segments AS (
    SELECT rid, i * 1000000 + part AS i, min(pos) AS s, string_agg(m[k], '' ORDER BY k) AS v
    FROM (SELECT *, sum(cut::INT) OVER (PARTITION BY rid, i ORDER BY k) AS part FROM cuts) WHERE NOT cut GROUP BY rid, i, part),
base AS (
    SELECT rid, 0 AS k, 'assign' AS kind, s, e FROM assigned WHERE length(x) >= {secrets.ASSIGN_LEAST}
    UNION ALL SELECT rid, 1, 'access', s, e FROM access UNION ALL SELECT rid, 2, 'hex', s, e FROM hexes),
windows AS (
    SELECT rid, i, s, j, list_aggregate(string_split(substr(v, j + 1, {w}), ''), 'entropy') AS h, CASE {bits} END AS least
    FROM (SELECT *, unnest(range(0, length(v) - {w} + 1)) AS j FROM segments WHERE {allow})),
marked AS (
    SELECT *, coalesce(j - lag(j) OVER (PARTITION BY rid, i ORDER BY j) > {w}, true)::INT AS opens
    FROM windows WHERE h >= least - 1e-9),
runs AS (
    SELECT rid, min(s + j) AS s, max(s + j) + {w} AS e
    FROM (SELECT *, sum(opens) OVER (PARTITION BY rid, i ORDER BY j) AS run FROM marked) GROUP BY rid, i, run),
added AS (
    SELECT * FROM base UNION ALL
    SELECT rid, 3, 'entropy', s, e FROM runs r
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = r.rid AND b.s <= r.s AND b.e >= r.e)),
listed AS (
    SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
           count(*) FILTER (k = 3) AS n_entropy,
           string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k, e) FILTER (k < 3) AS base,
           string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, k, e) AS spans
    FROM added GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM texts LEFT JOIN listed USING (rid)
"""


def _substrings() -> str:
    """All windows grouped exactly, without any prefilter."""
    w = substrings.WINDOW
    return f"""
WITH texts AS (
    SELECT row_number() OVER () AS rid, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
    SELECT rid, doc_id, j, array_to_string(w[j:j + {w - 1}], ' ') AS v
    FROM (SELECT *, unnest(range(1, len(w) - {w} + 2)) AS j FROM texts)),
judged AS (
    SELECT rid, j, coalesce(doc_id, -9223372036854775808) > min(coalesce(doc_id, -9223372036854775808)) OVER (PARTITION BY v)
        OR row_number() OVER (PARTITION BY v, rid ORDER BY j) > 1 AS again FROM windows),
gone AS (SELECT DISTINCT rid, unnest(range(j, j + {w})) AS p FROM judged WHERE again),
lost AS (SELECT rid, list(p) AS ps FROM gone GROUP BY rid),
kept AS (
    SELECT doc_id, w, coalesce(len(ps), 0) AS n,
           CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END AS k
    FROM texts LEFT JOIN lost USING (rid))
SELECT doc_id, len(w)::BIGINT AS n_words, n::BIGINT AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""


def _jaccard() -> str:
    """All pairs that share a shingle, counted exactly, and the closure of the links."""
    k = jaccard.SHINGLE
    return f"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(regexp_replace(
        lower(coalesce(text, '')), '[\x01-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]', ' ', 'g'), ' +'), lambda x: x <> '') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT rid, array_to_string(w[j:j + {k - 1}], ' ') AS v
    FROM (SELECT *, unnest(range(1, greatest(len(w) - {k - 1}, 1) + 1)) AS j FROM texts WHERE len(w) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
shared AS (
    SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.v = b.v AND a.rid < b.rid GROUP BY ALL),
links AS (
    SELECT x, y FROM shared JOIN sizes a ON a.rid = x JOIN sizes b ON b.rid = y
    WHERE c >= {jaccard.THRESHOLD} * (a.n + b.n - c) - 1e-9),
ends AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT x, y FROM ends
    UNION
    SELECT r.x, b.y FROM reach r JOIN ends b ON b.x = r.y)
SELECT doc_id, CASE WHEN bool_or(nobody) THEN NULL ELSE least(doc_id, min(least_id)) END AS class_id, max(n_links) AS n_links
FROM (
    SELECT t.rid, t.doc_id, o.doc_id AS least_id, t.doc_id IS NULL OR (r.y IS NOT NULL AND o.doc_id IS NULL) AS nobody,
           (SELECT count(*) FROM ends b WHERE b.x = t.rid) AS n_links
    FROM texts t LEFT JOIN reach r ON r.x = t.rid LEFT JOIN texts o ON o.rid = r.y)
GROUP BY rid, doc_id
"""


def _spelling() -> str:
    """Near words by what is left when one code point goes, forms and chains by recursion."""
    letters, least = spelling.LETTERS, spelling.LEAST_LENGTH
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE crc_table AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(run, '{upper}', '{lower}') AS w, count(*) AS c
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[{letters}]{{{least},}}')) AS run FROM documents) GROUP BY ALL),
hashed AS (
    SELECT w, c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
        lambda y, b: xor(y >> 8, t[(xor(y, b) & 255) + 1]))) AS h
    FROM (SELECT *, hex(encode(d || ':' || w)) AS x FROM runs), crc_table),
words AS (
    SELECT word, sum(c)::BIGINT AS n FROM (
        SELECT c, CASE WHEN h % {spelling.DELETE_EVERY} = 0
            THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM hashed)
    WHERE length(word) >= {least} GROUP BY word HAVING sum(c) >= {spelling.LEAST_COUNT}),
less AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT *, unnest(range(0, length(word))) AS i FROM words)),
pairs AS (
    SELECT a.word AS x, b.word AS y, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
    UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
near AS (SELECT x, count(*) AS n_near, max(n) AS most, first(y ORDER BY n DESC, y) AS best FROM pairs GROUP BY x),
judged AS (
    SELECT word, CASE WHEN most >= {spelling.FORM_FACTOR} * n THEN best END AS form, n, coalesce(n_near, 0) AS n_near,
           CASE WHEN most >= {spelling.FORM_FACTOR} * n THEN most END AS form_n
    FROM words LEFT JOIN near ON x = word),
chain AS (
    SELECT word, word AS at FROM words
    UNION ALL
    SELECT c.word, j.form FROM chain c JOIN judged j ON j.word = c.at WHERE j.form IS NOT NULL)
SELECT j.word, j.form, c.at AS root, j.n, j.n_near, j.form_n
FROM judged j JOIN chain c ON c.word = j.word JOIN judged e ON e.word = c.at AND e.form IS NULL
"""


ORACLES: dict[str, str] = {
    "op4_substring_dedup": _substrings(),
    "op7_bayes_jaccard": _jaccard(),
    "op8_secret_scan": _secret_scan(),
    "op10_feistel_sharding": _sharding(),
    "op13_spelling_variants": _spelling(),
}
