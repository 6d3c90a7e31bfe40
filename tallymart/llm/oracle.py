"""DuckDB SQL for the queries that SQL can express.

Missing are those that need XXH64 (fingerprints), a tokenizer, a trained model, an
alignment, or the word boundaries of Java's patterns (linked secrets); their tests
hold them against brute force, libraries or held-out labels.
"""

_BLANK = r"[\x20\x09-\x0D]"

# Windows of a text are told apart by the text and the row, so repeated rows stay apart.
_QUALITY = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT r, doc_id, text,
    list_filter(regexp_split_to_array(text, '{_BLANK}+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
places AS (
  SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM split),
windows AS (
  SELECT r, i, list_aggregate(words[i : i + 7], 'string_agg', ' ') AS gram FROM places),
twice AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS following
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT r, sum(least(8, coalesce(following - i, 8))) AS n FROM twice GROUP BY r),
measured AS (
  SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutters
  FROM split s LEFT JOIN covered c ON c.r = s.r),
based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
    OR 5 * n_stutters > n_words OR word_chars < 2 * n_words OR word_chars > 40 * n_words) AS kept
FROM based"""


def _bid(salt: str) -> str:
    return f"CAST('0x' || substr(md5({salt} || ':' || key), 1, 13) AS BIGINT)"


def _crc_of_byte(value: int) -> int:
    """Eight shifts, each with the polynomial where a bit falls out."""
    for _ in range(8):
        value = value >> 1 ^ 3988292384 * (value & 1)
    return value


# CRC-32 byte by byte.
_CRC = f"""xor(list_reduce(list_transform(regexp_extract_all(hexed, '..'),
  lambda pair: CAST('0x' || pair AS BIGINT)),
  lambda c, b: xor(c >> 8, {[_crc_of_byte(b) for b in range(256)]}[(xor(c, b) & 255) + 1]),
  4294967295::BIGINT), 4294967295)"""


def _winner(shards: int) -> str:
    return f"""list_min(list_transform(range({shards}), lambda s:
  {{'bid': -ln((CAST({_bid('s')} AS DOUBLE) + 0.5) / 4503599627370496), 'shard': s}})).shard"""


_SHARDS = f"""
WITH texts AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key,
    hex(encode(coalesce(text, ''))) AS hexed FROM documents),
rows_ AS (
  SELECT doc_id, CAST(length(hexed) // 2 + 16 AS BIGINT) AS size, {_CRC} AS text_crc32,
    CAST({_winner(40)} AS INTEGER) AS shard, CAST({_winner(41)} AS INTEGER) AS grown_shard, key
  FROM texts),
bucketed AS (
  SELECT *, CAST('0x' || substr(md5('bucket:' || key || ':' || text_crc32 || ':' || size), 1, 13)
    AS BIGINT) % 256 AS bucket FROM rows_)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot,
  grown_shard
FROM bucketed"""

_ARCHIVES = """
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
firsts AS (
  SELECT page_id, body, CASE WHEN strlen(body) >= 1000
    THEN max(page_id) OVER (PARTITION BY body) END AS first FROM bodies)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts"""


def _sized(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return f"sha256({' || '.join(map(_sized, fields))})"


_ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _levels(name: str, tree: str, leaves: str) -> str:
    """All nodes of trees with runs of eight: (tree, level, i, n, digest), n nodes on the level."""
    return f"""{name} AS (
  SELECT {tree} AS tree, 0 AS level, i, n, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY tree, level, i // 8, n)"""


def _siblings(nodes: str, items: str, tree: str, first: int) -> str:
    """Per item and level with several nodes, the siblings left and right."""
    return f"""SELECT r, {first} + l.level AS step,
    coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i < x.i // l.size), '') AS before,
    coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i > x.i // l.size), '') AS behind
  FROM {items} x
  JOIN (SELECT DISTINCT tree, level, CAST(8 ** level AS BIGINT) AS size FROM {nodes} WHERE n > 1) l
    ON l.tree IS NOT DISTINCT FROM {tree}
  JOIN {nodes} s ON s.tree IS NOT DISTINCT FROM l.tree AND s.level = l.level
    AND s.i // 8 = x.i // l.size // 8
  GROUP BY r, l.level"""


_MANIFEST = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_leaf('text')} AS digest, {_leaf(_ASCII_LOWER)} AS lowered,
    hex(encode(CAST(doc_id AS VARCHAR))) AS hexed FROM documents),
leaves AS (
  SELECT doc_id, lang, digest, row_number() OVER () AS r,
    CASE WHEN {_CRC} % 3 = 0 THEN lowered ELSE digest END AS shown,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
{_levels('nodes', 'lang', 'leaves')},
subroots AS (
  SELECT tree AS lang, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i,
    count(*) OVER () AS n
  FROM nodes WHERE n = 1),
{_levels('tops', '0', 'subroots')},
placed AS (
  SELECT l.r, s.i, 0 AS top FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang),
siblings AS (
  {_siblings('nodes', 'leaves', 'x.lang', 0)}
  UNION ALL
  {_siblings('tops', 'placed', 'x.top', 100)}),
steps AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY step) AS s FROM siblings),
proofs AS (
  SELECT r, count(*) AS n, sha256(string_agg(before || behind, '' ORDER BY s)) AS proof
  FROM steps GROUP BY r),
folds AS (
  SELECT r, CAST(0 AS BIGINT) AS s, shown AS digest FROM leaves
  UNION ALL
  SELECT f.r, f.s + 1, sha256(before || f.digest || behind)
  FROM folds f JOIN steps t ON t.r = f.r AND t.s = f.s + 1)
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, t.digest AS root,
  coalesce(p.proof, sha256('')) AS proof_sha256, f.digest AS folded_root,
  f.digest = t.digest AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
JOIN tops t ON t.n = 1
LEFT JOIN proofs p ON p.r = l.r
JOIN folds f ON f.r = l.r AND f.s = coalesce(p.n, 0)"""

# A turn is a digest of 32 characters, so a prefix is a text and a node below begins with it.
_TRIE = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, turn, length(text) AS chars,
    substr(sha256(strlen(role) || ':' || role || text), 1, 32) AS tid FROM said),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) - 1 AS pos
  FROM turns),
sizes AS (
  SELECT conv_id, count(*) AS n, hex(encode(CAST(conv_id AS VARCHAR))) AS hexed
  FROM placed GROUP BY conv_id),
cut AS (
  SELECT conv_id, n, {_CRC} % 6 AS h FROM sizes),
convs AS (
  SELECT c.conv_id, c.n, c.h, c.conv_id - c.conv_id % 100 AS donor, least(c.h, coalesce(d.n, 0)) AS k
  FROM cut c LEFT JOIN cut d ON d.conv_id = c.conv_id - c.conv_id % 100),
rebuilt AS (
  SELECT c.conv_id, p.pos, p.tid, p.chars FROM convs c JOIN placed p ON p.conv_id = c.donor
  WHERE p.pos < c.k
  UNION ALL
  SELECT c.conv_id, p.pos - c.h + c.k, p.tid, p.chars FROM convs c
  JOIN placed p ON p.conv_id = c.conv_id WHERE p.pos >= c.h),
whole AS (
  SELECT c.conv_id, coalesce(string_agg(r.tid, '' ORDER BY r.pos), '') AS path
  FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
visits AS (
  SELECT conv_id, path, 0 AS depth, CAST(0 AS BIGINT) AS chars, '' AS prefix FROM whole
  UNION ALL
  SELECT w.conv_id, w.path, r.pos + 1, r.chars, substr(w.path, 1, 32 * (r.pos + 1))
  FROM whole w JOIN rebuilt r ON r.conv_id = w.conv_id),
nodes AS (
  SELECT prefix, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
    (count(*) - 1) * any_value(chars) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
      FILTER (prefix = path), '')) AS ends_sha256
  FROM visits GROUP BY prefix),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
    (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1
      AND substr(k.prefix, 1, 32 * n.depth) = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = substr(n.prefix, 1, 32 * (n.depth - 1)))
SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, a.parent_conv_id, a.n_convs, a.n_children,
  count(*) FILTER (b.n_children = 0) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens,
  a.ends_sha256
FROM linked a JOIN linked b ON starts_with(b.prefix, a.prefix)
GROUP BY a.prefix, a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, a.ends_sha256"""

ORACLE: dict[str, str] = {
    "op2_quality_rules": _QUALITY,
    "op6_sharding": _SHARDS,
    "op11_warc_archives": _ARCHIVES,
    "op12_merkle_manifest": _MANIFEST,
    "op13_conversation_trie": _TRIE,
}
