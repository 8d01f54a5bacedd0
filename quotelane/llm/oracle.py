"""SQL for the operators that it can express."""

WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5(COALESCE(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents
), sources AS (
  SELECT source, SUM(size)::BIGINT AS source_size, SUM(size)::BIGINT * 3 AS cap,
         [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT cap, weight, cap / weight AS ratio,
         ((SELECT SUM(source_size) FROM sources)
          - COALESCE(SUM(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / SUM(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM sources
), level AS (
  SELECT arg_min(level, ratio) AS level FROM levels WHERE level * weight <= cap
), targets AS (
  SELECT source, source_size, LEAST(cap::DOUBLE, weight * level) AS target FROM sources, level
), placed AS (
  SELECT s.*, t.source_size, t.target,
         COALESCE(SUM(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), epochs AS (
  SELECT *, floor(target)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs
  FROM placed
)
SELECT doc_id, size, source_size, target,
       (epochs * size + GREATEST(0, LEAST(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM epochs
"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_KINDS = (
    ("assign", 0, rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", 2, r"[0-9a-f]+", 0, 32),
    ("jwt", 3, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 20),
    ("pem", 4, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----", 0, 40),
    ("forge", 5, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
)


def _kind_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    measured = f"regexp_extract_all(t, '{pattern}', {group})"
    return f"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, e - length(m) AS s, e, length(g) AS measured, {least} AS least FROM (
    SELECT doc_id, m, g, SUM(length(p) + length(m)) OVER (PARTITION BY row ORDER BY i) AS e FROM (
      SELECT doc_id, row, unnest(ps) AS p, unnest(ms) AS m, unnest(gs) AS g, unnest(range(len(ms))) AS i FROM (
        SELECT doc_id, row, list_slice(string_split_regex(t, '{pattern.replace("(", "(?:") if group else pattern}'), 1, len(regexp_extract_all(t, '{pattern}'))) AS ps,
               regexp_extract_all(t, '{pattern}') AS ms, {measured} AS gs
        FROM texts WHERE regexp_matches(t, '{pattern}'))))"""


SECRETS = f"""
WITH texts AS (SELECT doc_id, COALESCE(text, '') AS t, row_number() OVER () AS row FROM documents),
found AS ({" UNION ALL ".join(_kind_sql(*k) for k in _KINDS)}),
kept AS (SELECT doc_id, kind, rank, s::BIGINT AS s, e::BIGINT AS e FROM found WHERE measured >= least),
per AS (
  SELECT doc_id, SUM((kind = 'assign')::INT) AS n_assign, SUM((kind = 'access')::INT) AS n_access,
         SUM((kind = 'hex')::INT) AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (WHERE rank < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_assign, 0)::BIGINT AS n_assign, COALESCE(n_access, 0)::BIGINT AS n_access,
       COALESCE(n_hex, 0)::BIGINT AS n_hex, sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id
"""

QUALITY_STOPS = (
    "the be to of and that have with in is it for on was as at by from or "
    "der die das und ist nicht mit von zu ein eine auch im den "
    "le la les de des et est un une du que dans pour "
    "el los las y en es una del por con para"
).split()

QUALITY = rf"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, COALESCE(text, '') AS t,
         regexp_extract_all(COALESCE(text, ''), '{WORD}') AS w,
         list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM documents
), positions AS (
  SELECT row, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts
), windows AS (
  SELECT row, i, [word, lead(word) OVER p, lead(word, 2) OVER p] AS gram, lead(word, 2) OVER p IS NOT NULL AS whole
  FROM positions WINDOW p AS (PARTITION BY row ORDER BY i)
), often AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS c FROM windows WHERE whole) WHERE c > 1
), covered AS (
  SELECT row, count(DISTINCT j) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS j FROM often) GROUP BY row
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(translate(t, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13), ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
         COALESCE(n, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(' ' || regexp_replace(lower(t), '[ \t-\r.,]+', '  ', 'g') || ' ',
             ' (?:{"|".join(dict.fromkeys(QUALITY_STOPS))}) '))::BIGINT AS n_stop_words
  FROM texts LEFT JOIN covered USING (row)
), tested AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND n_symbols <= 0.3 * n_words
       AND n_stop_words >= 0.02 * n_words AND (n_lines = 0 OR n_dup_lines <= 0.5 * n_lines) AS kept
FROM tested
"""

ARC = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS payload, row_number() OVER () AS row FROM pages),
d AS (SELECT page_id, row, octet_length(encode(payload))::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, first_value(row) OVER w AS first_row, first_value(page_id) OVER w AS first_id FROM d
      WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, row))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND row <> first_row THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND row <> first_row THEN first_id END AS refers_to
FROM f
"""

MTREE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""



def _crc_table() -> str:
    """The table of the usual CRC-32, from its polynomial."""
    rows = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        rows.append(str(value))
    return f"([{', '.join(rows)}]::BIGINT[])"


def _crc(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes."""
    code = f"hex(encode({text}))"
    digits = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr({code}, 2 * i + 1, 2))::BIGINT)"
    step = f"lambda c, b: xor(c >> 8, {_crc_table()}[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), {step}), 4294967295::BIGINT)"


SPELLING = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT COALESCE(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents) WHERE length(run) >= 5 GROUP BY doc_id, run
), hashed AS (
  SELECT run, c, {_crc("doc_id || ':' || run")}::BIGINT AS h FROM runs
), words AS (
  SELECT word, SUM(c)::BIGINT AS n FROM (
    SELECT c, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING SUM(c) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*)::BIGINT AS n_near, first(other ORDER BY m DESC, other COLLATE "binary") AS form, max(m) AS form_n FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, n, COALESCE(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
         CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON f.word = w.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk w ON w.word = f.word JOIN formed e ON e.word = w.at AND e.form IS NULL
""".replace(' COLLATE "binary"', "")


def _leaf(n_chars: str) -> str:
    values = ("doc_id::VARCHAR", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"COALESCE(octet_length(encode({v})) || ':' || ({v}), '-')" for v in values) + ")"


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER () AS row
  FROM (SELECT doc_id, lang, {_leaf("n_chars::VARCHAR")} AS leaf,
               CASE WHEN {_crc("COALESCE(doc_id::VARCHAR, '')")} % 7 = 0 AND doc_id IS NOT NULL
                    THEN {_leaf("(n_chars::HUGEINT + 1)::VARCHAR")} END AS changed FROM documents)
), nodes AS (
  SELECT lang, 0 AS level, i, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)), (max(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, level, i // 2
), subroots AS (
  SELECT lang, level AS top, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), uppers AS (
  SELECT 0 AS level, i, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(digest, '' ORDER BY i)), (max(n) + 1) // 2
  FROM uppers WHERE n > 1 GROUP BY level, i // 2
), climb AS (
  SELECT l.row, 0 AS level, s.top, false AS above, l.i, COALESCE(l.changed, l.leaf) AS acc, '' AS proof, s.i AS group_i
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT c.row, c.level + 1, c.top, c.level + 1 > c.top, CASE WHEN c.level = c.top THEN c.group_i ELSE c.i // 2 END,
         CASE WHEN c.level = c.top THEN c.acc
              WHEN c.i % 2 = 0 THEN sha256(c.acc || COALESCE(c.other, '')) ELSE sha256(c.other || c.acc) END,
         CASE WHEN c.level = c.top THEN c.proof ELSE c.proof || COALESCE(c.other, '') END, c.group_i
  FROM (
    SELECT c.*, CASE WHEN c.above THEN u.digest ELSE o.digest END AS other
    FROM climb c JOIN leaves l ON l.row = c.row
    LEFT JOIN nodes o ON NOT c.above AND o.lang IS NOT DISTINCT FROM l.lang AND o.level = c.level AND o.i = xor(c.i, 1)
    LEFT JOIN uppers u ON c.above AND u.level = c.level - c.top - 1 AND u.i = xor(c.i, 1)
    WHERE c.level <= c.top + (SELECT max(level) FROM uppers)
  ) c
)
SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, c.acc AS folded_root, c.acc = r.digest AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
JOIN climb c ON c.row = l.row AND c.level = c.top + 1 + (SELECT max(level) FROM uppers)
CROSS JOIN (SELECT digest FROM uppers WHERE n = 1) r
"""

REPEATS = """
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, encode(COALESCE(text, '')) AS b, octet_length(encode(COALESCE(text, ''))) AS n FROM documents
), strings AS (
  SELECT row, doc_id, i, array_slice(b, i + 1, i + 50) AS s FROM (SELECT *, unnest(range(n - 49)) AS i FROM texts WHERE n >= 50)
), least AS (
  SELECT s, min(doc_id) AS low FROM strings GROUP BY s
), fallen AS (
  SELECT row, i, CASE WHEN i - lag(i) OVER (PARTITION BY row ORDER BY i) <= 50 THEN 0 ELSE 1 END AS starts
  FROM strings JOIN least USING (s) WHERE low < doc_id
), runs AS (
  SELECT row, min(i) AS a, max(i) + 50 AS e FROM (
    SELECT row, i, SUM(starts) OVER (PARTITION BY row ORDER BY i) AS run FROM fallen) GROUP BY row, run
), gaps AS (
  SELECT row, a, COALESCE(lag(e) OVER (PARTITION BY row ORDER BY a), 0) AS from_, a AS to_ FROM runs
  UNION ALL SELECT t.row, t.n, COALESCE((SELECT max(e) FROM runs r WHERE r.row = t.row), 0), t.n FROM texts t
), kept AS (
  SELECT row, string_agg(hex(array_slice(b, from_ + 1, to_)), '' ORDER BY a, to_) AS h
  FROM gaps JOIN texts USING (row) GROUP BY row
), removed AS (
  SELECT row, SUM(e - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans FROM runs GROUP BY row
)
SELECT doc_id, n::BIGINT AS n_bytes, COALESCE(n_removed, 0)::BIGINT AS n_removed, COALESCE(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(h)) AS kept_sha256
FROM texts JOIN kept USING (row) LEFT JOIN removed USING (row)
"""

LINKS = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT row, doc_id, CASE WHEN len(w) < 3 THEN w ELSE list_slice(w, i, i + 2) END AS s
  FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM words WHERE len(w) > 0)
), sized AS (
  SELECT row, doc_id, count(*) AS n FROM shingles GROUP BY row, doc_id
), shared AS (
  SELECT a.row AS x, b.row AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.row < b.row GROUP BY a.row, b.row
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shared JOIN sized x ON x.row = shared.x JOIN sized y ON y.row = shared.y
  WHERE 100 * c >= 90 * (x.n + y.n - c)
), edges AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen
), least AS (
  SELECT node, min(seen) AS component_id FROM reach GROUP BY node
)
SELECT w.doc_id, COALESCE(n, 0)::BIGINT AS n_shingles, CASE WHEN n IS NULL THEN w.doc_id ELSE component_id END AS component_id
FROM words w LEFT JOIN sized USING (row) LEFT JOIN least l ON l.node = w.doc_id
"""

SQL = {"op1_mixing": MIX, "op2_secrets": SECRETS, "op3_quality": QUALITY, "op4_arc": ARC, "op5_suffixes": REPEATS, "op6_jaccard": LINKS, "op10_mtree": MTREE,
    "op11_permuterm": SPELLING, "op12_merkle": MERKLE}
