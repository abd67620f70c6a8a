"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import pii
from .chat_format import END, ESCAPES, SAY, TURN


def _escaped(x: str) -> str:
    for plain, coded in ESCAPES:
        x = f"replace({x}, '{plain}', '{coded}')"
    return x


VECTORS = """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings), n AS (SELECT *, sqrt(list_dot_product(x, x)) AS len FROM v WHERE label IS NOT NULL),
  l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_dot_product(a.x, b.x) / (a.len * b.len) >= 0.93),
  r AS (SELECT vec_id AS node, vec_id AS root FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
  c AS (SELECT node, min(root) AS component_id FROM r GROUP BY 1), d AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
SELECT vec_id, coalesce(d.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON c.node = vec_id LEFT JOIN d ON d.a = vec_id"""

CHATS = f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(TURN + SAY + END)} + length({_escaped("role")}) + length({_escaped("text")}))::BIGINT AS formatted_chars FROM t GROUP BY conv_id"""


def _places(kind: str, rank: int, pattern: str, base: bool, keep: str, group: int = 0) -> str:
    """One row for each match in documents: doc_id, s, e, rank, kind, base. keep tests h (the match) and g (the group)."""
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, s, s + length(h) AS e, {rank} AS rank, '{kind}' AS kind, {base} AS base FROM (SELECT doc_id, hits[i] AS h, grps[i] AS g,
  list_sum(list_transform(pieces[:i], lambda q: length(q))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda q: length(q))), 0) AS s
  FROM (SELECT doc_id, hits, grps, pieces, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS hits, regexp_extract_all(text, '{p}', {group}) AS grps, regexp_split_to_array(text, '{p}') AS pieces FROM d WHERE regexp_matches(text, '{p}')))) WHERE {keep}"""


def _scanned(parts: list[str], counted: list[str], kept: str = "SELECT * FROM p", more: str = "") -> str:
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in counted)
    listed = lambda only: f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e){only}, '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), p AS ({" UNION ALL ".join(parts)}), f AS ({kept})
SELECT doc_id, {counts}, sha256({listed(" FILTER (base)")}) AS base_sha256, {listed(" FILTER (kind IS NOT NULL)")} AS spans{more} FROM d LEFT JOIN f USING (doc_id) GROUP BY doc_id"""


#: RE2 has neither possessive repeats nor look-behind; these are the patterns without them, whose matches are the same.
SECRETS = _scanned(
    [
        _places("assign", 0, r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, "length(g) >= 6", 1),
        _places("access", 1, r"AKIA[A-Z0-9]+", True, "length(h) >= 20"),
        _places("hex", 2, r"[0-9a-f]+", True, "length(h) >= 24"),
        _places("private_key", 3, r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", False, "true"),
        _places("forge_token", 4, r"gh[pousr]_[A-Za-z0-9]{36}", False, "true"),
        _places("chat_token", 5, r"xox[abprs]-[A-Za-z0-9-]{10,}", False, "true"),
        _places("web_token", 6, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", False, "true"),
    ],
    ["assign", "access", "hex"],
)

_DIGITS = "regexp_replace(h, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN reverse({_DIGITS})[i]::INT WHEN reverse({_DIGITS})[i]::INT > 4 THEN reverse({_DIGITS})[i]::INT * 2 - 9 ELSE reverse({_DIGITS})[i]::INT * 2 END)) % 10 = 0"
#: The number that the check divides, as two digits for a letter, taken digit by digit by the fold.
_MOD97 = "list_reduce(list_prepend(0::BIGINT, list_transform(string_split(bare[5:] || bare[:4], ''), lambda c: CASE WHEN c >= 'A' THEN 1000 + ascii(c) - 55 ELSE ascii(c) - 48 END::BIGINT)), lambda a, c: CASE WHEN c >= 1000 THEN (a * 100 + c - 1000) % 97 ELSE (a * 10 + c) % 97 END) = 1"
_USUAL = "CASE " + " ".join(f"WHEN bare[:2] IN ({', '.join(repr(c) for c in cs.split())}) THEN {n}" for n, cs in pii.REGISTERED.items()) + " END"
#: Account numbers: from each place p where one may begin to each word's end n within reach that the check confirms; the
#: end of the country's usual length, else the last; none that lies within an earlier one.
_ACCOUNTS = f"""SELECT doc_id, s, e, 4 AS rank, 'iban' AS kind, false AS base FROM (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered FROM (
  SELECT doc_id, p - 1 AS s, p - 1 + coalesce(min(n) FILTER (length(bare) = {_USUAL}), max(n)) AS e FROM (
    SELECT doc_id, p, n, replace(whole[:n], ' ', '') AS bare FROM (SELECT doc_id, p, whole, unnest(range(15, length(whole) + 1)) AS n FROM (
      SELECT doc_id, p, regexp_extract(text[p:], '^[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}[A-Za-z0-9]?') AS whole FROM (SELECT doc_id, text, unnest(range(1, length(text) + 1)) AS p FROM d WHERE regexp_matches(text, '[A-Z]{{2}}[0-9]{{2}}'))
      WHERE regexp_matches(text[p:p + 3], '^[A-Z]{{2}}[0-9]{{2}}') AND (p = 1 OR NOT regexp_matches(text[p - 1:p - 1], '[A-Za-z0-9]'))))
    WHERE regexp_full_match(whole[n:n + 1], '[A-Z0-9] ?'))
  WHERE length(bare) BETWEEN 15 AND 34 AND {_MOD97} GROUP BY doc_id, p)) WHERE e > coalesce(covered, 0)"""
_AROUND = f"translate(text[greatest(s - {pii.BEFORE} + 1, 1):s] || chr(10) || text[e + 1:e + {pii.BEHIND}], '{pii.UPPER}', '{pii.UPPER.lower()}')"
_SCORE = "CASE kind " + " ".join(f"WHEN '{k}' THEN {pii.PRIOR[k]} + CASE WHEN regexp_matches(around, '{pii.near(pii.CONTEXT[k])}') THEN {pii.SUPPORT} ELSE 0 END + CASE WHEN regexp_matches(around, '{pii.near(pii.AGAINST[k])}') THEN {pii.CONTRARY} ELSE 0 END" for k in pii.KINDS) + " END"
PRIVATE = _scanned(
    [
        _places("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", True, "true"),
        _places("ip", 1, r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", True, "list_max(list_transform(string_split(h, '.'), lambda q: coalesce(try_cast(q AS BIGINT), 999))) <= 255"),
        _places("card", 2, r"[0-9](?:[\x20-]?[0-9])+", True, f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}"),
        _places("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", True, f"length({_DIGITS}) BETWEEN 10 AND 15"),
        _ACCOUNTS,
        _places("ssn", 5, r"[0-9-]+", False, "regexp_full_match(h, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND h[:3] NOT IN ('000', '666') AND h[:1] <> '9' AND h[5:6] <> '00' AND h[8:] <> '0000'"),
    ],
    list(pii.BASE),
    f"SELECT * FROM (SELECT *, {_SCORE} AS score FROM (SELECT p.*, {_AROUND} AS around FROM p JOIN d USING (doc_id))) WHERE base OR score >= {pii.LEAST}",
    ", coalesce(string_agg(score::VARCHAR, ',' ORDER BY s, rank, e), '') AS scores",
)


_INNER = "regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1)"
_SPOKEN = f"regexp_replace(regexp_replace({_INNER}, '</?(p|br|h1)>', ' ', 'g'), '<[^>]*>', '', 'g')"
for _name, _char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("amp", "&")):
    _SPOKEN = f"replace({_SPOKEN}, '&{_name};', '{_char}')"
#: The tables' pages mark their article and put nothing else into it, so that its text is what two passes over blocks have to find.
ARTICLES = f"""SELECT page_id, url, text, length(text) AS n_chars FROM (SELECT page_id, url, trim(regexp_replace({_SPOKEN}, '\\s+', ' ', 'g')) AS text FROM pages)"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
RANKED = f"""WITH d AS MATERIALIZED (SELECT doc_id, t, len(t) AS n FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0), s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
  q AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark), p AS MATERIALIZED (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
  w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, docs),
  r AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::BIGINT AS score FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 10"""


def _centroids(k: int = 40, rounds: int = 5) -> str:
    """Rounds written out one after another. A vector's nearest centroid is the smallest distance * k + number."""
    parts = [
        f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))))""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, q) - 1 AS c, q FROM v ORDER BY sha256('2:' || vec_id) NULLS LAST, q LIMIT {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, any_value(v.q) AS q, min(list_sum(list_transform(list_zip(v.q, c{r}.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {k} + c) AS best FROM v, c{r} GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""s{r} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT best % {k} AS c, unnest(range(1, 65)) AS i, unnest(q) AS x FROM a{r}) GROUP BY c, i)""")
            parts.append(f"""m{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM s{r} GROUP BY c)""")
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.q, c{r}.q) AS q FROM c{r} LEFT JOIN m{r} USING (c))""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, (best % {k})::INT AS cluster, best // {k} AS distance, (sum(best // {k}) OVER (PARTITION BY best % {k}))::BIGINT AS cluster_inertia, (sum(best // {k}) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c = best % {k}"""


ORACLES = {"op1_embedding_near_dedup": VECTORS, "op5_chat_formatting": CHATS, "op7_pii": PRIVATE, "op8_secret_scan": SECRETS, "op11_centroid_clustering": _centroids(), "op12_html_extraction": ARTICLES, "op13_lexical_search": RANKED}
