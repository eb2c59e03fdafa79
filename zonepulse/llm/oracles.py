"""What the numbered queries return, in DuckDB SQL, where SQL can say it.

Learned, searched and seeded results (op1, op2, op5, op8, op9, op10) have none; the tests
hold them against plain versions.
"""

from __future__ import annotations

_WORDS = r"'[^\x20\x09-\x0D]+'"

OP3 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
),
coded AS (
  SELECT *, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * i + 1, 5))::INTEGER >> s) & 31)::INTEGER + 1, 1)), '')), '') AS payload_digest
  FROM p
),
firsts AS (SELECT h, min(page_id) AS low FROM p GROUP BY h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN low < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN low < page_id THEN low END AS refers_to
FROM coded JOIN firsts USING (h)
"""

OP4 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
runs AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM w, unnest(range(1, len(ws) - 11)) AS t(i)),
firsts AS (SELECT g, min(doc_id) AS low FROM runs GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM runs JOIN firsts USING (g), unnest(range(0, 13)) AS u(j) WHERE low < doc_id),
each AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body, count(*) AS n
  FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP7 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) AS ws
  FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
  FROM w, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1)) + 1)) AS t(i)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * s >= 85 * (x.n + y.n - s)
),
reach AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
)
SELECT w.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM w JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY w.doc_id
"""


def _spans(kind: str, place: int, pattern: str, passes: str) -> str:
    """Matches of one kind: texts between matches, and matches, in turn; then running lengths."""
    return f"""
  SELECT doc_id, '{kind}' AS kind, {place} AS place, start, start + length(m) AS stop FROM (
    SELECT doc_id, m,
      coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (
      SELECT doc_id, gaps, hits, i, hits[i] AS m FROM (
        SELECT doc_id, regexp_split_to_array(t, {pattern}) AS gaps, regexp_extract_all(t, {pattern}) AS hits FROM t
      ), unnest(range(1, len(hits) + 1)) AS u(i)
    )
  ) WHERE {passes}"""


_ASSIGN = (
    "'(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
)
_PARTS = [
    _spans("assign", 0, _ASSIGN, f"length(regexp_extract(m, {_ASSIGN}, 1)) >= 6"),
    _spans("access", 1, "'AKIA[A-Z0-9]+'", "length(m) >= 20"),
    _spans("hex", 2, "'[0-9a-f]+'", "length(m) >= 24"),
    _spans("token", 3, "'(?:gh[pousr]|xox[abprs]|sk|pk|rk)[_-][A-Za-z0-9_-]{20,}'", "length(m) >= 24"),
    _spans("jwt", 4, r"'eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}'", "true"),
    _spans("key", 5, "'-----BEGIN [A-Z ]*PRIVATE KEY-----'", "true"),
]
OP6 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_PARTS)}),
named AS (SELECT *, kind || ':' || start::BIGINT || ':' || stop::BIGINT AS name FROM s)
SELECT t.doc_id,
  count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(name, ',' ORDER BY start, place) FILTER (place < 3), '')) AS base_sha256,
  coalesce(string_agg(name, ',' ORDER BY start, place), '') AS spans
FROM t LEFT JOIN named USING (doc_id) GROUP BY t.doc_id
"""

def _levels(name: str, key: str, first: str, levels: int) -> list[str]:
    """Nodes (key, i, d, n) of every level of a 16-ary tree, and their runs."""
    out = [f"{name}0 AS ({first})"]
    for k in range(levels):
        out.append(f"{name}r{k} AS (SELECT {key}, i // 16 AS run, any_value(n) AS n, list(d ORDER BY i) AS ds FROM {name}{k} GROUP BY {key}, run)")
        digest = "CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END"
        out.append(f"{name}{k + 1} AS (SELECT {key}, run AS i, {digest} AS d, (n + 15) // 16 AS n FROM {name}r{k})")
    return out


def _walk(name: str, join: str, first: str, levels: int, steps: str) -> list[str]:
    """Rows (doc_id, t, i, proof, f) led up through the runs of all levels."""
    out = [f"{steps}0 AS ({first})"]
    for k in range(levels):
        left, right = "array_to_string(ds[1:(i % 16)::INT], '')", "array_to_string(ds[(i % 16)::INT + 2:], '')"
        out.append(
            f"{steps}{k + 1} AS (SELECT doc_id, leaf, t, i // 16 AS i, CASE WHEN n = 1 THEN proof ELSE proof || {left} || {right} END AS proof, "
            f"CASE WHEN n = 1 THEN f ELSE sha256({left} || f || {right}) END AS f FROM {steps}{k} JOIN {name}r{k} {join} WHERE run = i // 16)"
        )
    return out


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


_CRC32 = (
    "xor(4294967295, list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])), "
    "lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, 4294967295::BIGINT))"
)
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
# 16^6 documents to a source and 16^4 sources.
OP12 = "WITH " + ",\n".join(
    [
        f"""d AS (
  SELECT doc_id, sha256({_HEAD} || {_field("text")}) AS leaf,
    CASE WHEN {_CRC32} % 5 = 0 THEN sha256({_HEAD} || {_field(_LOWER)}) END AS changed,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
  FROM documents)""",
        *_levels("s", "t", "SELECT t, i, leaf AS d, n FROM d", 6),
        *_levels("r", "z", "SELECT 0 AS z, t AS i, d, count(*) OVER () AS n FROM s6", 4),
        *_walk("s", "USING (t)", "SELECT doc_id, leaf, t, i, '' AS proof, coalesce(changed, leaf) AS f FROM d", 6, "p"),
        *_walk("r", "ON true", "SELECT doc_id, leaf, t, t AS i, proof, f FROM p6", 4, "q"),
    ]
) + """
SELECT doc_id, leaf, s6.d AS subroot, r4.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = r4.d AS verified
FROM q4 JOIN s6 USING (t), r4
"""

SQL = {"op3_warc": OP3, "op4_relative_lz": OP4, "op6_blob_ledger": OP6, "op7_jaccard_join": OP7, "op12_merkle_manifest": OP12}
