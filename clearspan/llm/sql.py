"""SQL for DuckDB with the same rows as the registered queries."""

from __future__ import annotations

from clearspan.llm import rules

WORDS = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op7_url_filters"] = r"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting AS (
  SELECT u.host, u.path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    max_by(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM u) u JOIN r ON starts_with(u.path, rule_path)
    AND (u.host = rule_host OR ends_with(u.host, '.' || rule_host))
  GROUP BY ALL
)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN fitting f ON u.host = f.host AND u.path = f.path
"""

#: CRC-32 of the UTF-8 bytes: the table follows from the polynomial, the sum runs over the bytes as hex pairs.
_CRC = """
crc_table AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i::UBIGINT] || range(8)::UBIGINT[], lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)) AS c
    FROM range(256) t(i))
)"""

_SHARD = "list_aggregate(list_transform(range({n}), lambda i: {{'score': -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || i::VARCHAR), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0), 'shard': i::INTEGER}}), 'min').shard"

ORACLES["op6_sharding"] = f"""
WITH {_CRC}, hexed AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), summed AS (
  SELECT doc_id, length(h) // 2 + 1 AS size,
    xor(list_reduce([4294967295::UBIGINT] || list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::UBIGINT),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM hexed, crc_table
), placed AS (
  SELECT *, {_SHARD.format(n=8)} AS shard, {_SHARD.format(n=9)} AS grown_shard,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS o
  FROM summed
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY o, doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM placed
"""


ORACLES["op5_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS o
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][1 + rank % 3]::DOUBLE AS w, 3.0::DOUBLE * source_size AS lim FROM sources
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER earlier, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER earlier, 0)) AS level
  FROM weighed WINDOW earlier AS (ORDER BY lim / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(lim, w * (SELECT level FROM levels WHERE level * w <= lim ORDER BY lim / w, rank LIMIT 1)) AS target FROM levels
), placed AS (
  SELECT s.*, source_size, target, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY o, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (least(greatest(round(target) - first, 0), size) + least(greatest(round(target) - first - source_size, 0), size)
  + least(greatest(round(target) - first - 2 * source_size, 0), size))::BIGINT AS taken
FROM placed
"""


def _rules() -> str:
    """The base values by windows over exploded words, and the estimation unrolled round by round."""
    names = list(rules.RULES)
    vote_list = ", ".join(
        f"CASE WHEN {bad} THEN {rules.BAD} WHEN {good} THEN {rules.GOOD} ELSE {rules.ABSTAIN} END AS vote_{name}"
        for name, (bad, good) in rules.RULES.items()
    )
    ctes = [rf"""
w AS (
  SELECT rid, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words
  FROM (SELECT *, row_number() OVER () AS rid FROM documents)
), grams AS (
  SELECT rid, i, word || ' ' || lead(word) OVER later || ' ' || lead(word, 2) OVER later AS g
  FROM (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w) WINDOW later AS (PARTITION BY rid ORDER BY i)
), repeated AS (
  SELECT rid, i FROM grams WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM repeated, range(3) t(k) GROUP BY rid
), base AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(list_aggregate(words, 'string_agg', ''))::BIGINT AS word_chars0,
    (length(text) - length(translate(text, '{rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (rid)
), asked AS (
  SELECT doc_id, n_words, coalesce(word_chars0, 0) AS word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words,
    (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.REPEATED_PER_CENT} * n_words) AS base_failed
  FROM base
), voted AS MATERIALIZED (SELECT *, {vote_list} FROM asked),
p AS MATERIALIZED (SELECT {', '.join(f'vote_{n}' for n in names)}, count(*)::DOUBLE AS n FROM voted WHERE NOT base_failed GROUP BY ALL)"""]
    classes, vote_values = ("good", "bad"), (rules.GOOD, rules.BAD, rules.ABSTAIN)

    def column(kind: str, name: str, vote: int) -> str:
        return f"{kind}_{name}_{vote + 1}"

    first = [f"{rules.PRIOR_GOOD}::DOUBLE AS good"]
    first += [f"{rules.PRIOR_VOTES[k][v]}::DOUBLE AS {column(k, n, v)}" for k in classes for n in names for v in vote_values]
    ctes.append(f"m0 AS MATERIALIZED (SELECT {', '.join(first)})")
    steps = " + ".join(
        "CASE vote_{n} {whens} END".format(
            n=n, whens=" ".join(f"WHEN {v} THEN ln({column('good', n, v)} / {column('bad', n, v)})" for v in vote_values)
        )
        for n in names
    )
    chance = f"1 / (1 + exp(-(ln(good / (1 - good)) + {steps})))"
    weight = f"{rules.PRIOR_WEIGHT} * sum(n)"
    for t in range(rules.ROUNDS):
        mass = {"good": "sum(n * q)", "bad": "sum(n * (1 - q))"}
        share = {"good": rules.PRIOR_GOOD, "bad": 1 - rules.PRIOR_GOOD}
        out = [f"(sum(n * q) + {weight} * {rules.PRIOR_GOOD}) / (sum(n) + {weight}) AS good"]
        for k in classes:
            for n in names:
                for v in vote_values:
                    seen = mass[k].replace("sum(", f"sum((vote_{n} = {v})::INT * ")
                    out.append(
                        f"({seen} + {weight} * {share[k]} * {rules.PRIOR_VOTES[k][v]}) / ({mass[k]} + {weight} * {share[k]}) AS {column(k, n, v)}"
                    )
        ctes.append(f"m{t + 1} AS MATERIALIZED (SELECT {', '.join(out)} FROM (SELECT p.*, {chance} AS q FROM p, m{t}))")
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
        f"NOT base_failed AND {chance} >= {rules.THRESHOLD} AS kept FROM voted, m{rules.ROUNDS}"
    )


ORACLES["op3_quality_rules"] = _rules()


ORACLES["op11_ranked_search"] = r"""
WITH occurrences AS (
  SELECT d.rowid AS d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents) d
), sizes AS (
  SELECT d, doc_id, count(*)::BIGINT AS n FROM occurrences GROUP BY d, doc_id
), whole AS (
  SELECT count(*)::BIGINT AS texts, sum(n)::BIGINT AS terms FROM sizes
), items AS (
  SELECT DISTINCT i, item_id, term FROM (
    SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark))
), counts AS (
  SELECT d, term, count(*)::BIGINT AS tf FROM occurrences WHERE term IN (SELECT term FROM items) GROUP BY d, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * (SELECT texts FROM whole) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts GROUP BY term
), parts AS (
  SELECT c.d, c.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * texts) // whole.terms))) AS part
  FROM counts c JOIN sizes USING (d) JOIN weights w ON w.term = c.term, whole
), scores AS (
  SELECT i, item_id, d, sum(part)::BIGINT AS score FROM items JOIN parts USING (term) GROUP BY i, item_id, d HAVING sum(part) > 0
)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scores JOIN sizes USING (d)
QUALIFY rank <= 10
"""


def _edit(value: str, initial: str, cost: str) -> str:
    """A weight ``ccccccccc:audit`` with an edit put before it; the smaller text is the lighter weight."""
    return f"lpad((substr({value}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || ':{initial}' || substr({value}, 11)"


def _kept(initial: str, value: str) -> str:
    return f"CASE WHEN NOT must_go AND initial = '{initial}' THEN {_edit(value, 'K', 'more')} END"


def _given(value: str) -> str:
    return f"CASE WHEN NOT must_go THEN {_edit(value, 'R', '2 + more')} END"


ORACLES["op12_conversation_repair"] = rf"""
WITH RECURSIVE {_CRC}, hexed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    lower(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')))) AS h
  FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text, (xor(list_reduce([4294967295::UBIGINT] || list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::UBIGINT),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 20)::INTEGER AS kind
  FROM hexed, crc_table
), turns AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(text), role) AS i FROM turns
), ordered AS (
  SELECT *, coalesce(conv_id::VARCHAR, 'null') AS c, count(*) OVER (PARTITION BY conv_id) AS n, substr(role, 1, 1) AS initial,
    NOT regexp_matches(text, '[^ 	-
]') AS blank, NOT regexp_matches(text, '[.!?][ 	-
]*$') AS open,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    coalesce(lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM numbered
), marked AS (
  SELECT c, i, n, initial, role, text, blank OR seen AS must_go, open::INTEGER AS more FROM ordered
), suffixes AS (
  SELECT c, max(n) AS i, '000000000:' AS v0, '000000004:II' AS v1, '000000002:I' AS v2, '000000000:' AS v3 FROM marked GROUP BY c
  UNION ALL
  SELECT c, i, least(b0, {_edit("b2", "I", "2")}, {_edit("b3", "II", "4")}), least(b1, {_edit("b2", "I", "2")}, {_edit("b3", "II", "4")}),
    least(b2, {_edit("b3", "I", "2")}), least(b3, {_edit("b2", "I", "2")})
  FROM (
    SELECT s.c, s.i - 1 AS i, least({_edit("v0", "D", "3")}, {_kept("s", "v1")}, {_kept("u", "v2")}, {_given("v2")}) AS b0,
      least({_edit("v1", "D", "3")}, {_kept("u", "v2")}, {_given("v2")}) AS b1, least({_edit("v2", "D", "3")}, {_kept("a", "v3")}, {_given("v3")}) AS b2,
      least({_edit("v3", "D", "3")}, {_kept("u", "v2")}, {_given("v2")}) AS b3
    FROM suffixes s JOIN marked m ON s.c = m.c AND s.i = m.i
  )
), lightest AS (
  SELECT c, substr(v0, 1, 9)::BIGINT AS cost, substr(v0, 11) AS audit FROM suffixes WHERE i = 0
), applied AS (
  SELECT c, audit, 1 AS k, 1 AS i, '' AS last, '' AS out FROM lightest
  UNION ALL
  SELECT c, audit, k + 1, CASE edit WHEN 'I' THEN i ELSE i + 1 END, CASE edit WHEN 'D' THEN last ELSE substr(to_role, 1, 1) END,
    CASE edit WHEN 'D' THEN out ELSE out || chr(10) || to_role || ':' || CASE edit WHEN 'I' THEN '' ELSE text END END
  FROM (
    SELECT a.*, substr(audit, k, 1) AS edit, m.text, CASE substr(audit, k, 1) WHEN 'K' THEN m.role ELSE CASE last WHEN 'u' THEN 'assistant' ELSE 'user' END END AS to_role
    FROM applied a LEFT JOIN marked m ON a.c = m.c AND a.i = m.i WHERE k <= length(audit)
  )
), counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (NOT blank AND seen) AS duplicate, count(*) FILTER (NOT blank AND NOT seen AND open) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM ordered GROUP BY c
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(l.audit, '') AS audit,
  sha256(substr(coalesce(out, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, 'null') AS c FROM conversations) o
LEFT JOIN counted USING (c) LEFT JOIN lightest l ON l.c = o.c LEFT JOIN applied a ON a.c = o.c AND a.k > length(a.audit)
"""
