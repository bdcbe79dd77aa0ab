"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _lower(c: str) -> str:
    return f"translate({c}, '{UPPER}', '{LOWER}')"


#: All pairs that share a shingle are counted; links are closed by a recursive union.
JACCARD = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lower('text')}, '{WORD}') AS w FROM documents),
sh AS MATERIALIZED (
  SELECT rid, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
one AS MATERIALIZED (SELECT DISTINCT rid, s FROM sh),
n AS MATERIALIZED (SELECT rid, count(*) AS n FROM one GROUP BY rid),
common AS (SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM one a JOIN one b ON a.s = b.s AND a.rid < b.rid GROUP BY 1, 2),
link AS MATERIALIZED (
  SELECT a, b FROM common JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
both_ways AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
comp AS (SELECT r.a AS rid, min(d.doc_id) AS component_id FROM reach r JOIN d ON d.rid = r.b GROUP BY r.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id
FROM d JOIN comp USING (rid) LEFT JOIN n USING (rid)
"""

_RULES = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
}


def _prior(r: str) -> str:
    """Moments of the hosts' rates of rule r, and the host's shrunk rate."""
    return f"""
p_{r} AS (
  SELECT sum(k_{r}) / sum(n_docs) AS m,
         greatest(sum(k_{r} * k_{r} / n_docs) / sum(n_docs) - m * m - m * (1 - m) * count(*) / sum(n_docs), 1e-12) AS tau,
         CASE WHEN m <= 0 OR m >= 1 THEN 1.0::DOUBLE ELSE least(greatest(m * (1 - m) / tau - 1, 1.0), 1e6) END AS strength,
         CASE WHEN m <= 0 OR m >= 1 THEN greatest(m, 1e-6) ELSE m * strength END AS alpha,
         CASE WHEN m <= 0 OR m >= 1 THEN greatest(1 - m, 1e-6) ELSE (1 - m) * strength END AS beta
  FROM host)"""


HOST_RULES = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS MATERIALIZED (
  SELECT rid, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM d WHERE len(w) >= 5),
again AS (SELECT rid, i FROM win JOIN (SELECT rid, s FROM win GROUP BY rid, s HAVING count(*) > 1) USING (rid, s)),
rep AS (SELECT rid, count(DISTINCT place) AS k FROM (SELECT rid, unnest(range(i, i + 5)) AS place FROM again) GROUP BY rid),
lines AS (SELECT rid, count(*) AS n, count(DISTINCT x) AS u FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d)
          WHERE regexp_matches(x, '{WORD}') GROUP BY rid),
f AS MATERIALIZED (
  SELECT doc_id, source AS host, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(lines.n, 0) AS n_lines, coalesce(lines.n - lines.u, 0) AS n_dup_lines, coalesce(rep.k, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid)),
host AS MATERIALIZED (
  SELECT host, count(*) AS n_docs, {', '.join(f'count(*) FILTER ({c}) AS k_{r}' for r, c in _RULES.items())} FROM f GROUP BY host),
{','.join(_prior(r) for r in _RULES)},
verdict AS (
  SELECT host, {' AND '.join(f'(SELECT (k_{r} + alpha) / (n_docs + alpha + beta) <= 0.5 FROM p_{r})' for r in _RULES)} AS host_kept FROM host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND host_kept AS kept, f.host, host_kept
FROM f JOIN verdict ON f.host IS NOT DISTINCT FROM verdict.host
"""

RANKED = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_lower('text')}, '{TERM}') AS w FROM documents),
held AS MATERIALIZED (SELECT rid, doc_id, w, len(w) AS n FROM d WHERE len(w) > 0),
whole AS MATERIALIZED (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM held),
post AS MATERIALIZED (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM held) GROUP BY ALL),
asked AS MATERIALIZED (
  SELECT qid, item_id, term, count(*) AS often FROM (
    SELECT row_number() OVER () AS qid, item_id, unnest(regexp_extract_all({_lower('text')}, '{TERM}')) AS term FROM benchmark) GROUP BY ALL),
weight AS MATERIALIZED (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM post, whole
  WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
scored AS (
  SELECT qid, item_id, rid, doc_id,
         sum(often * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN post USING (term) JOIN held USING (rid), whole GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""


def _caseless(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_BITS = "flatten(list_transform(string_split({s}, ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k) & 1)))"


def _crc32(s: str) -> str:
    """CRC-32 of an ASCII string that is not empty, bit by bit."""
    step = "CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_transform({_BITS.format(s=s)}, lambda b: b::BIGINT), lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


def _number(s: str, digits: str) -> str:
    return f"list_reduce(list_transform(string_split({s}, ''), lambda c: (strpos('{digits}', c) - 1)::BIGINT), lambda v, c: v * {len(digits)} + c, 0::BIGINT)"


def _crc_ok(tail: str) -> str:
    digits = "0123456789" + UPPER + LOWER
    return (f"regexp_full_match({tail}, '[0-9A-Za-z]{{36}}') AND {_crc32(f'substr({tail}, 1, 30)')} = {_number(f'substr({tail}, 31, 6)', digits)}")


def _bech32_ok(whole: str, size: int) -> str:
    """``size``: characters of the prefix, before the separating 1."""
    code = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
    prefix, data = f"string_split(lower(substr({whole}, 1, {size})), '')", f"string_split(lower(substr({whole}, {size + 2})), '')"
    values = (f"list_concat(list_concat(list_transform({prefix}, lambda c: (ascii(c) >> 5)::BIGINT), [0::BIGINT]), "
              f"list_concat(list_transform({prefix}, lambda c: (ascii(c) & 31)::BIGINT), list_transform({data}, lambda c: (strpos('{code}', c) - 1)::BIGINT)))")
    gens = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
    step = "xor((c & 33554431) << 5, v)"
    for i, g in enumerate(gens):
        step = f"xor({step}, CASE WHEN (c >> {25 + i}) & 1 = 1 THEN {g} ELSE 0 END)"
    return (f"regexp_full_match(lower(substr({whole}, {size + 2})), '[{code}]{{58}}') AND "
            f"list_reduce({values}, lambda c, v: {step}, 1::BIGINT) = 1")


_ASSIGN = (f"({'|'.join(map(_caseless, ('password', 'passwd', 'secret', 'token')))}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
           r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
#: kind -> pattern, and the test of a match m.
_KINDS = {
    "assign": (_ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= 6"),
    "access": ("AKIA[A-Z0-9]+", "length(m) >= 20"),
    "hex": ("[0-9a-f]+", "length(m) >= 24"),
    "github": ("gh[pousr]_[0-9A-Za-z_]+", _crc_ok("substr(m, 5)")),
    "npm": ("npm_[0-9A-Za-z_]+", _crc_ok("substr(m, 5)")),
    "age": ("AGE-SECRET-KEY-1[0-9A-Z]+", _bech32_ok("m", 15)),
    "nostr": ("nsec1[0-9a-z]+", _bech32_ok("m", 4)),
}


def _found(no: int, kind: str) -> str:
    """Matches of a kind with their starts: the gaps and matches before them, summed."""
    pattern, test = _KINDS[kind]
    return f"""
SELECT rid, {no} AS no, '{kind}' AS kind, s, s + length(m) AS e FROM (
  SELECT rid, m, (sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m))::BIGINT AS s FROM (
    SELECT rid, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g FROM (
      SELECT rid, regexp_extract_all(t, '{pattern}', 0) AS ms, string_split_regex(t, '{pattern}') AS gs FROM d
      WHERE regexp_matches(t, '{pattern}')))) WHERE {test}"""


_SPAN = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no)"
SECRETS = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS MATERIALIZED ({' UNION ALL '.join(_found(i, k) for i, k in enumerate(_KINDS))}),
by_doc AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, {_SPAN} FILTER (no < 3) AS base, {_SPAN} AS spans, count(*) FILTER (no >= 3) AS n_added
  FROM found GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_added, 0) AS n_added
FROM d LEFT JOIN by_doc USING (rid)
"""


def _field(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _levels(name: str, levels: int) -> str:
    """Tables <name>0 (given) to <name><levels>: tree, idx, size, digest, and the siblings left and right."""
    out = []
    for k in range(levels + 1):
        if k:
            out.append(f"""
{name}_{k} AS (SELECT tree, idx // 3 AS idx, (size + 2) // 3 AS size,
  CASE WHEN any_value(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
  FROM {name}{k - 1} GROUP BY tree, idx // 3, (size + 2) // 3)""")
        run = "OVER (PARTITION BY tree, idx // 3 ORDER BY idx ROWS BETWEEN"
        out.append(f"""
{name}{k} AS MATERIALIZED (SELECT *, coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lhs,
  coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rhs FROM {name}_{k})""")
    return ",".join(out)


def _climb(out: str, start: str, name: str, levels: int) -> str:
    """From ``start`` (rid, tree, idx, path, folded) up the levels."""
    steps, last = [], start
    for k in range(levels):
        steps.append(f"""
{out}{k} AS (SELECT c.rid, c.tree, c.idx // 3 AS idx, c.path || lhs || rhs AS path,
  CASE WHEN t.size = 1 THEN c.folded ELSE sha256(lhs || c.folded || rhs) END AS folded
  FROM {last} c JOIN {name}{k} t ON t.tree = c.tree AND t.idx = c.idx)""")
        last = f"{out}{k}"
    return ",".join(steps)


def merkle(levels: int = 16) -> str:
    """Trees of up to 3 ** levels leaves."""
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, {_leaf('text')} AS leaf,
         {_leaf(f"(CASE WHEN {_crc32('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS changed FROM documents),
s AS MATERIALIZED (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM d GROUP BY source),
placed AS MATERIALIZED (
  SELECT d.*, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
sub_0 AS (SELECT tree, idx, n AS size, leaf AS digest FROM placed),
{_levels('sub', levels)},
top_0 AS (SELECT 0 AS tree, tree AS idx, (SELECT count(*) FROM s) AS size, digest FROM sub{levels}),
{_levels('top', levels)},
low AS (SELECT rid, tree, idx, '' AS path, changed AS folded FROM placed),
{_climb('low', 'low', 'sub', levels)},
high AS (SELECT rid, 0 AS tree, tree AS idx, path, folded FROM low{levels - 1}),
{_climb('high', 'high', 'top', levels)}
SELECT p.doc_id, p.leaf, sub{levels}.digest AS subroot, r.digest AS root, sha256(h.path) AS proof_sha256,
       h.folded AS folded_root, h.folded = r.digest AS verified
FROM placed p JOIN high{levels - 1} h USING (rid) JOIN sub{levels} ON sub{levels}.tree = p.tree, top{levels} r
"""


ORACLE = {
    "op1_jaccard_join": JACCARD,
    "op2_host_rules": HOST_RULES,
    "op11_ranked_search": RANKED,
    "op12_secret_scan": SECRETS,
    "op13_merkle_manifest": merkle(),
}
