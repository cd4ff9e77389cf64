"""DuckDB SQL for the training-data queries that SQL can express: the contract of
each, by plain relational means (all pairs over shingles, all windows, all lines)."""

from __future__ import annotations

from cartflow.llm import digest
from cartflow.llm.urlfilter import SUFFIXES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

MINHASH = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORD}') AS w FROM documents
),
sets AS (
    SELECT doc_id,
           CASE WHEN len(w) >= 4
                THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
                ELSE [] END AS shingles
    FROM texts
),
items AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
shared AS (
    SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS n
    FROM items AS a JOIN items AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY ALL
),
links AS (
    SELECT i, j FROM shared JOIN sets AS a ON a.doc_id = i JOIN sets AS b ON b.doc_id = j
    WHERE 100 * n >= 80 * (len(a.shingles) + len(b.shingles) - n)
),
edges AS (SELECT i, j FROM links UNION ALL SELECT j, i FROM links),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sets
    UNION
    SELECT r.doc_id, e.j FROM reach AS r JOIN edges AS e ON e.i = r.other
)
SELECT doc_id, len(shingles) AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept
FROM sets JOIN reach USING (doc_id)
GROUP BY doc_id, shingles
"""

LINES = f"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS n
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
),
keyed AS (
    SELECT *, translate(regexp_replace(line, '^{_BLANK}|{_BLANK}$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM lines
),
held AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
judged AS (
    SELECT k.*, coalesce(k.doc_id <> h.last_doc, false) AS gone FROM keyed AS k LEFT JOIN held AS h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

SUBSTRINGS = f"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS content
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts WHERE len(w) >= 20)
),
repeats AS (
    SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, i) > 1
),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM repeats, range(20) AS r(k)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts),
judged AS (
    SELECT w.*, g.i IS NOT NULL AS gone FROM words AS w LEFT JOIN gone AS g ON g.doc_id = w.doc_id AND g.i = w.i
),
kept AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
    FROM judged GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


def _rates(name: str, level: str, source: str) -> str:
    """Mean and prior strength of a level, from the spread of its rates."""
    return f"""
{name} AS (
    SELECT CASE WHEN n IS NULL OR n <= rows_cnt OR mean IN (0, 1) THEN 1.0
                ELSE 1 / least(greatest((spread - noise * rows_cnt / n) / (noise * (1 - rows_cnt / n)), 0.0001), 0.5) - 1
           END AS strength, coalesce(mean, 0) AS mean
    FROM (
        SELECT *, bad / n AS mean, (bad / n) * (1 - bad / n) AS noise, square / n - (bad / n) * (bad / n) AS spread
        FROM (
            SELECT CAST(sum(n) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS bad, CAST(count(*) AS DOUBLE) AS rows_cnt,
                   sum(CAST(bad AS DOUBLE) * bad / n) AS square
            FROM (SELECT sum(n) AS n, sum(bad) AS bad FROM {source} GROUP BY {level}) WHERE n > 0
        )
    )
)"""


_TWO_LABELS = ", ".join(f"'{s}'" for s in SUFFIXES)

URLS = rf"""
WITH addressed AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
),
marked AS (
    SELECT doc_id, max(greatest(toxic, 1 - quality)) AS bad FROM labels
    WHERE doc_id IS NOT NULL AND toxic IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
),
outcomes AS (
    SELECT host, bad FROM addressed
    JOIN marked ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})(?:\.[a-z]+)?/?$', 1) AS BIGINT)
),
counted AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM outcomes GROUP BY host),
hosts AS (
    SELECT host, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad,
           CASE WHEN regexp_full_match(plain, '[0-9.]+|\[.*') THEN plain
                WHEN array_to_string(parts[-2:], '.') IN ({_TWO_LABELS}) THEN array_to_string(parts[-3:], '.')
                ELSE array_to_string(parts[-2:], '.') END AS domain,
           CASE WHEN regexp_full_match(plain, '[0-9.]+|\[.*') THEN ''
                WHEN array_to_string(parts[-2:], '.') IN ({_TWO_LABELS}) THEN array_to_string(parts[-2:], '.')
                ELSE coalesce(parts[-1], '') END AS suffix
    FROM (
        SELECT host, plain, string_split(plain, '.') AS parts
        FROM (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS plain
              FROM (SELECT DISTINCT host FROM addressed))
    ) LEFT JOIN counted USING (host)
),{_rates('s', 'suffix', 'hosts')},{_rates('d', 'suffix, domain', 'hosts')},{_rates('h', 'host', 'hosts')},
by_suffix AS (
    SELECT suffix, (sum(bad) + (SELECT strength * mean FROM s)) / (sum(n) + (SELECT strength FROM s)) AS above
    FROM hosts GROUP BY suffix
),
by_domain AS (
    SELECT suffix, domain, (sum(bad) + (SELECT strength FROM d) * above) / (sum(n) + (SELECT strength FROM d)) AS prior
    FROM hosts JOIN by_suffix USING (suffix) GROUP BY suffix, domain, above
),
posterior AS (
    SELECT host, n, bad, n + (SELECT strength FROM h) AS weight,
           (bad + (SELECT strength FROM h) * prior) / (n + (SELECT strength FROM h)) AS rate
    FROM hosts JOIN by_domain USING (suffix, domain)
),
rules(says, rule_host, rule_path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
),
ruled AS (
    SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(says, length(rule_host || rule_path)) AS says
    FROM addressed LEFT JOIN rules
        ON (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path)
    GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN bound > (SELECT mean FROM s) THEN 'block' ELSE 'allow' END) AS verdict,
       n, CAST(bad AS BIGINT) AS bad, round(rate, 6) AS rate, round(bound, 6) AS bound
FROM ruled JOIN (SELECT *, rate - 1.645 * sqrt(rate * (1 - rate) / (weight + 1)) AS bound FROM posterior) USING (host)
"""

def _told(count: str) -> str:
    """Length-prefixed fields of a document, with ``count`` as its n_chars."""
    names = ("doc_id", "source", "lang", count, "text")
    return " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in names)


def _levels(name: str, start: str) -> str:
    """All levels of pairwise trees over (grp, pos, digest, n)."""
    return f"""
{name}(grp, lvl, pos, digest, n) AS (
    SELECT grp, 0, pos, digest, n FROM {start}
    UNION ALL
    SELECT grp, lvl + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
    FROM {name} WHERE n > 1 GROUP BY grp, lvl, pos // 2, n
)"""


def _siblings(levels: str, start: str) -> str:
    """The steps from every lowest node, as 'before|after' in a list."""
    return f"""
    SELECT a.grp, a.pos, list(CASE WHEN s.digest IS NULL THEN '|' WHEN s.pos < (a.pos >> l.lvl) THEN s.digest || '|'
                              ELSE '|' || s.digest END ORDER BY l.lvl) AS steps
    FROM {start} AS a
    JOIN (SELECT DISTINCT grp, lvl FROM {levels} WHERE n > 1) AS l USING (grp)
    LEFT JOIN {levels} AS s ON s.grp = a.grp AND s.lvl = l.lvl AND s.pos = xor(a.pos >> l.lvl, 1)
    GROUP BY a.grp, a.pos"""


MERKLE = f"""
WITH RECURSIVE told AS (
    SELECT doc_id, coalesce('=' || lang, '') AS grp, sha256({_told('n_chars')}) AS leaf, sha256({_told('(n_chars + 1)')}) AS other,
           xor(list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                  lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
                           lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384)
                                          ELSE crc >> 1 END, CAST(4294967295 AS BIGINT)), 4294967295) AS crc
    FROM documents
),
leaves AS (
    SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos, leaf AS digest,
           count(*) OVER (PARTITION BY grp) AS n, doc_id, CASE WHEN crc % 7 = 0 THEN other ELSE leaf END AS told
    FROM told
),{_levels('levels', 'leaves')},
tops AS (
    SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, digest, count(*) OVER () AS n, grp AS own FROM levels WHERE n = 1
),{_levels('forest', 'tops')},
low AS ({_siblings('levels', 'leaves')}
),
high AS ({_siblings('forest', 'tops')}
),
paths AS (
    SELECT doc_id, l.digest AS leaf, told, t.digest AS subroot, (SELECT digest FROM forest WHERE n = 1) AS root,
           list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps
    FROM leaves AS l JOIN tops AS t ON t.own = l.grp
    LEFT JOIN low ON low.grp = l.grp AND low.pos = l.pos LEFT JOIN high ON high.pos = t.pos
),
folded AS (
    SELECT *, list_reduce(steps, lambda d, s: sha256(split_part(s, '|', 1) || d || split_part(s, '|', 2)), told) AS folded_root FROM paths
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '|', '')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM folded
"""

def _assigned(n: int) -> str:
    """Nearest entry of every part among the entries of round n, with its squared distance."""
    return f"""
near{n} AS MATERIALIZED (
    SELECT vec_id, p, min(d * 16 + e) % 16 AS e, min(d) AS d
    FROM (SELECT x.vec_id, x.p, b.e, CAST(sum((x.x - b.c) * (x.x - b.c)) AS BIGINT) AS d
          FROM parts AS x JOIN book{n} AS b ON b.p = x.p AND b.i = x.i GROUP BY ALL)
    GROUP BY vec_id, p
)"""


def _moved(n: int) -> str:
    """The entries after one more round: floors of means, unused ones unchanged."""
    return f"""
book{n + 1} AS MATERIALIZED (
    SELECT b.p, b.e, b.i, coalesce((s - ((s % n) + n) % n) // n, c) AS c
    FROM book{n} AS b LEFT JOIN (
        SELECT x.p, a.e, x.i, CAST(sum(x.x) AS BIGINT) AS s, count(*) AS n
        FROM parts AS x JOIN near{n} AS a ON a.vec_id = x.vec_id AND a.p = x.p GROUP BY ALL
    ) AS m ON m.p = b.p AND m.e = b.e AND m.i = b.i
)"""


_ROUNDS = 6

VECTOR_CODES = f"""
WITH kept AS (
    SELECT vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
    SELECT vec_id, i // (n // 8) AS p, i % (n // 8) AS i, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS i, len(embedding) AS n FROM kept)
),
book0 AS MATERIALIZED (
    SELECT p, e, i, x AS c FROM parts
    JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 16) USING (vec_id)
),{",".join(_assigned(n) + "," + _moved(n) for n in range(_ROUNDS))},{_assigned(_ROUNDS)},
coded AS (
    SELECT vec_id, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM near{_ROUNDS} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) FROM book{_ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC = f"""
WITH told AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digits FROM pages
),
coded AS (
    SELECT page_id, payload, list_transform(range(8), lambda j: CAST('0x' || substr(digits, 5 * j + 1, 5) AS BIGINT)) AS chunks FROM told
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(chunks, lambda v: array_to_string(list_transform([15, 10, 5, 0],
           lambda s: substr('{_BASE32}', CAST((v >> s) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = least_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = least_id THEN NULL ELSE least_id END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload) AS least_id FROM coded)
"""

def _triplets() -> str:
    """Every hashed byte triplet of every text, by bucket."""
    names = ("b", "b1", "b2", "b3", "b4")
    hop = lambda x: f"hop[1 + {x}]"
    return " UNION ALL ".join(
        f"SELECT doc_id, kind, {hop(f'xor({hop(f"xor({hop(f'xor({names[a]}, {salt})')}, {names[b]})")}, {names[c]})')} % 128 AS bucket "
        f"FROM neighbours, hops WHERE {names[c]} IS NOT NULL"
        for salt, (a, b, c) in zip(digest._SALTS, digest._PICKS, strict=True)
    )


def _likeness(one: str, two: str) -> str:
    """1 minus the bounded difference of two digests (code, length, r1, r2 with a prefix)."""
    ring = lambda r: f"least(({one}.{r} - {two}.{r} + 16) % 16, ({two}.{r} - {one}.{r} + 16) % 16)"
    codes = f"list_sum(list_transform(range(1, 129), lambda k: [0, 1, 2, 6][1 + abs({one}.code[k] - {two}.code[k])]))"
    return (
        f"1 - CAST({codes} + least(32, abs({one}.size - {two}.size)) + least(24, 2 * ({ring('r1')} + {ring('r2')})) AS DOUBLE) / {digest.WORST}"
    )


FINGERPRINTS = f"""
WITH ordered AS (
    SELECT doc_id, coalesce(text, '') AS text,
           coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS after,
           coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id
    FROM documents
),
edits AS (
    SELECT *, length(text) AS n_chars, left(text, CAST(length(text) - length(text) // 2 AS BIGINT)) || left(after, CAST(length(text) // 2 AS BIGINT)) AS edited
    FROM ordered
),
texts AS (SELECT doc_id, 0 AS kind, text FROM edits UNION ALL SELECT doc_id, 1, edited FROM edits),
raws AS (
    SELECT doc_id, kind, strlen(text) AS n, hex(encode(text)) || CASE strlen(text) WHEN 1 THEN '0000' WHEN 2 THEN '00' ELSE '' END AS digits FROM texts
),
bytes AS (
    SELECT doc_id, kind, i, CAST('0x' || substr(digits, 2 * i + 1, 2) AS INTEGER) AS b
    FROM (SELECT *, unnest(range(CAST(len(digits) // 2 AS BIGINT))) AS i FROM raws)
),
neighbours AS (
    SELECT doc_id, kind, b, lead(b, 1) OVER w AS b1, lead(b, 2) OVER w AS b2, lead(b, 3) OVER w AS b3, lead(b, 4) OVER w AS b4
    FROM bytes WINDOW w AS (PARTITION BY doc_id, kind ORDER BY i)
),
hops AS (SELECT {digest._permutation().tolist()} AS hop),
counts AS (SELECT doc_id, kind, bucket, count(*) AS n FROM ({_triplets()}) GROUP BY ALL),
lists AS (
    SELECT r.doc_id, r.kind, r.n, list(coalesce(c.n, 0) ORDER BY k) AS counts, list_sort(list(coalesce(c.n, 0))) AS sorted
    FROM raws AS r CROSS JOIN range(128) AS b(k) LEFT JOIN counts AS c ON c.doc_id = r.doc_id AND c.kind = r.kind AND c.bucket = k
    GROUP BY r.doc_id, r.kind, r.n
),
digests AS (
    SELECT doc_id, kind, CAST(least(255, floor(ln(greatest(n, 1)) / ln(1.1))) AS INTEGER) AS size,
           CAST((16 * sorted[32] // greatest(sorted[96], 1)) % 16 AS INTEGER) AS r1,
           CAST((16 * sorted[64] // greatest(sorted[96], 1)) % 16 AS INTEGER) AS r2,
           list_transform(counts, lambda c: CAST(c > sorted[32] AS INTEGER) + CAST(c > sorted[64] AS INTEGER) + CAST(c > sorted[96] AS INTEGER)) AS code
    FROM lists
),
marks AS (
    SELECT *, printf('%02x%02x', size, r1 * 16 + r2) || array_to_string(list_transform(range(32),
               lambda k: printf('%02x', code[4 * k + 1] * 64 + code[4 * k + 2] * 16 + code[4 * k + 3] * 4 + code[4 * k + 4])), '') AS mark
    FROM digests
)
SELECT e.doc_id, CAST(e.n_chars AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256, a.mark AS fingerprint, b.mark AS edited_fingerprint,
       round({_likeness('a', 'b')}, 9) AS near_edited, round({_likeness('a', 'c')}, 9) AS near_next
FROM edits AS e JOIN marks AS a ON a.doc_id = e.doc_id AND a.kind = 0 JOIN marks AS b ON b.doc_id = e.doc_id AND b.kind = 1
JOIN marks AS c ON c.doc_id = e.next_id AND c.kind = 0
"""

MIXING = f"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
           CAST('0x' || substr(md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS ord
    FROM documents
),
per AS (
    SELECT source, source_size, sid, CAST([3, 1, 2][(sid - 1) % 3 + 1] AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS most
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sized GROUP BY source)
),
rates AS (
    SELECT *, (1.5 * CAST(sum(source_size) OVER () AS DOUBLE)
               - coalesce(sum(most) OVER (ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY most / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
    FROM per
),
targets AS (SELECT source, source_size, sid, least(most, max(rate) OVER () * weight) AS target FROM rates),
placed AS (
    SELECT s.*, t.sid, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS most_words,
           CAST(sum(size) OVER (PARTITION BY t.sid ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS place
    FROM sized AS s JOIN targets AS t ON s.source IS NOT DISTINCT FROM t.source
),
points AS (
    SELECT t, CAST((CAST(t + 1 AS DECIMAL(18, 0)) * CAST(0.618033988749894848 AS DECIMAL(18, 18))) % 1 AS DOUBLE) AS point
    FROM range(CAST((SELECT ceil(sum(target) / 1024) FROM targets) AS BIGINT)) AS r(t)
),
spans AS (
    SELECT sid, coalesce(lag(high) OVER (ORDER BY sid), 0) AS low, CASE WHEN lead(sid) OVER (ORDER BY sid) IS NULL THEN 1.5 ELSE high END AS high
    FROM (SELECT sid, sum(target) OVER (ORDER BY sid) / (SELECT sum(target) FROM targets) AS high FROM targets WHERE target > 0)
),
hits AS (SELECT t, sid FROM points JOIN spans ON point >= low AND point < high),
slots AS (
    SELECT t, sid, row_number() OVER (PARTITION BY sid ORDER BY t) - 1 AS rank, count(*) OVER (PARTITION BY sid) AS blocks
    FROM (SELECT * FROM hits UNION ALL SELECT (SELECT count(*) FROM points), sid FROM targets WHERE target > 0 AND sid NOT IN (SELECT sid FROM hits))
),
runs AS (
    SELECT doc_id, sid, place, size, most_words, p * source_size + place AS low, least(p * source_size + place + size, most_words) AS high
    FROM placed, range(2) AS r(p) WHERE size > 0
),
used AS (
    SELECT r.sid, r.place, r.doc_id, r.size, min(s.t) AS first_slot
    FROM runs AS r JOIN slots AS s ON s.sid = r.sid
        AND floor(s.rank * (CAST(most_words AS DOUBLE) / blocks)) < high
        AND (s.rank + 1 = blocks OR floor((s.rank + 1) * (CAST(most_words AS DOUBLE) / blocks)) > low)
    WHERE low < high GROUP BY ALL
),
words AS (SELECT sid, place, doc_id, size, CAST(sum(greatest(0, high - low)) AS BIGINT) AS taken FROM runs GROUP BY ALL)
SELECT p.doc_id, p.size, p.source_size, round(p.target, 6) AS target, coalesce(w.taken, 0) AS taken, u.first_slot
FROM placed AS p
LEFT JOIN words AS w ON w.sid = p.sid AND w.place = p.place AND w.doc_id = p.doc_id AND w.size = p.size
LEFT JOIN used AS u ON u.sid = p.sid AND u.place = p.place AND u.doc_id = p.doc_id AND u.size = p.size
"""

SQL: dict[str, str] = {
    "op1_minhash_dedup": MINHASH,
    "op4_line_dedup": LINES,
    "op5_substring_dedup": SUBSTRINGS,
    "op6_fingerprint": FINGERPRINTS,
    "op7_mix_sources": MIXING,
    "op10_url_filter": URLS,
    "op11_warc_packages": WARC,
    "op12_vector_codes": VECTOR_CODES,
    "op13_merkle_manifest": MERKLE,
}
