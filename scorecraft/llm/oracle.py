"""DuckDB SQL that recomputes the queries' results from the raw tables."""

ORACLE: dict[str, str] = {}

_SPACE = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

ORACLE["op1_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, u.line, u.pos,
         translate(trim(u.line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS pos) u),
common AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.*, c.k IS NOT NULL AND l.doc_id <> c.keeper AS gone FROM lines l LEFT JOIN common c ON l.k = c.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_BACK = "chr(92)"
ORACLE["op5_chat"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, n, r, {_BACK} || '### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
shown AS (
  SELECT *, replace(replace(role, {_BACK}, {_BACK}||{_BACK}), '<|', {_BACK}||'<|') AS er,
            replace(replace(text, {_BACK}, {_BACK}||{_BACK}), '<|', {_BACK}||'<|') AS et FROM turns),
whole AS (
  SELECT conv_id, count(*) AS n,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('<|turn|>' || er || '<|says|>' || et || '<|end|>')) AS chars
  FROM shown GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM whole
"""

ORACLE["op7_topk"] = """
WITH parts AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
  WHERE len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
v AS (SELECT vec_id, i, floor(1024 * x::DOUBLE)::BIGINT AS x FROM parts),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.i = c.i AND q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id GROUP BY 1, 2)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""


# crc32 in SQL. A text is cut into blocks of BLOCK bytes, each block's remainder is
# found byte by byte, and the remainders are shifted together block by block. Four
# bytes whose remainder is all ones stand before the text in place of the start value.
POLYNOMIAL = 0xEDB88320
BLOCK = 128


def _after_zero_bits(state: int, bits: int) -> int:
    for _ in range(bits):
        state = state >> 1 ^ (POLYNOMIAL if state & 1 else 0)
    return state


def _numbers(values) -> str:
    return "[" + ",".join(f"{v}::UINTEGER" for v in values) + "]"


def crc32_ctes(source: str, key: str, text: str) -> str:
    """CTEs that end in ``crcs`` (key, crc): the unsigned crc32 of each row's UTF-8 bytes."""
    byte = _numbers(_after_zero_bits(b, 8) for b in range(256))
    block = [_numbers(_after_zero_bits(b << 8 * i, 8 * BLOCK) for b in range(256)) for i in range(4)]
    shifted = "xor(" * 3 + f"{block[0]}[(c & 255) + 1]" + "".join(
        f", {block[i]}[((c >> {8 * i}) & 255) + 1])" for i in (1, 2, 3))
    digit = "strpos('0123456789ABCDEF', h[2 * k + {}])"
    return f"""
  digits AS (SELECT {key}, '62F52692' || hex(encode(coalesce({text}, ''))) AS h FROM {source}),
  padded AS (SELECT {key}, repeat('0', {2 * BLOCK} - length(h) % {2 * BLOCK}) || h AS h FROM digits),
  blocks AS (SELECT {key}, i, substr(h, i * {2 * BLOCK} + 1, {2 * BLOCK}) AS h
             FROM padded, LATERAL (SELECT unnest(range(length(h) // {2 * BLOCK})) AS i)),
  bytes AS (SELECT {key}, i, list_transform(range({BLOCK}), lambda k: ({digit.format(1)} * 16 + {digit.format(2)} - 17)::UINTEGER) AS l FROM blocks),
  parts AS (SELECT {key}, i, list_reduce(list_prepend(0::UINTEGER, l), lambda c, x: xor(c >> 8, {byte}[(xor(c, x) & 255) + 1])) AS r FROM bytes),
  crcs AS (SELECT {key}, xor(4294967295::UINTEGER, list_reduce(list(r ORDER BY i), lambda c, r: xor({shifted}, r)))::BIGINT AS crc
           FROM parts GROUP BY {key})"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op11_sharding"] = f"""
WITH RECURSIVE {crc32_ctes("documents", "doc_id", "text")},
keys AS (SELECT DISTINCT k FROM (SELECT coalesce(doc_id, -9223372036854775808) AS k FROM documents UNION ALL SELECT crc FROM crcs)),
walk(k, state, prior, spot, nxt, step) AS (
  SELECT k, CASE WHEN k < 0 THEN k::HUGEINT + 18446744073709551616 ELSE k::HUGEINT END, (-1)::BIGINT, (-1)::BIGINT, 0::BIGINT, 0 FROM keys
  UNION ALL
  SELECT k, s, spot, nxt, floor((nxt + 1)::DOUBLE * (2147483648.0::DOUBLE / ((s // 8589934592) + 1)::DOUBLE))::BIGINT, step + 1
  FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS s FROM walk WHERE nxt < 25)),
placed AS (
  SELECT k, CASE WHEN spot < 24 THEN spot ELSE prior END AS shard, spot AS grown FROM walk WHERE nxt >= 25),
draws AS (SELECT k, state // 8589934592 AS draw FROM walk WHERE step = 1),
rows AS (
  SELECT d.doc_id, octet_length(encode(coalesce(d.text, ''))) + 8 AS size, c.crc, p.shard, p.grown, g.shard AS text_shard,
         (w.draw + c.crc) % 1024 AS part, coalesce(d.doc_id, -9223372036854775808) AS k
  FROM documents d JOIN crcs c ON c.doc_id IS NOT DISTINCT FROM d.doc_id
  JOIN placed p ON p.k = coalesce(d.doc_id, -9223372036854775808) JOIN draws w ON w.k = p.k JOIN placed g ON g.k = c.crc)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY part, k, crc, size) - 1)::BIGINT AS slot, grown::INTEGER AS grown_shard,
       text_shard::INTEGER AS text_shard
FROM rows
"""

ORACLE["op12_importance"] = f"""
WITH found AS (
  SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 't', 0, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark),
words AS (SELECT DISTINCT w FROM found), {crc32_ctes("words", "w", "w")},
placed AS (SELECT side, id, crc % 10000 AS b FROM found JOIN crcs USING (w)),
counts AS (SELECT b, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 't') AS t FROM placed GROUP BY b),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gains AS (
  SELECT b, floor(1000 * ln(((t + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain FROM counts, totals),
docs AS (SELECT id AS doc_id, count(*) AS n, sum(gain)::BIGINT AS g FROM placed JOIN gains USING (b) WHERE side = 'd' GROUP BY id),
weighed AS (
  SELECT d.doc_id, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM documents d LEFT JOIN docs x ON x.doc_id IS NOT DISTINCT FROM d.doc_id),
scored AS (
  SELECT doc_id, n, weight, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM weighed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS r,
         10 * count(*) FILTER (WHERE n >= 20) OVER () // 100 AS drawn FROM scored)
SELECT doc_id, n::BIGINT AS n_features, weight::BIGINT AS weight, score, CASE WHEN n >= 20 AND r <= drawn THEN r END::BIGINT AS rank
FROM ranked
"""

ORACLE["op13_phrases"] = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\n\\x0B\\x0C\\r]')), '[^ \\t]+') AS w
  FROM documents),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
runs AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM pieces, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i) p, (VALUES (1), (2), (3), (4), (5)) v(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, n, cut, (1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f) AS score
  FROM candidates c JOIN totals USING (lang), LATERAL (SELECT unnest(range(1, c.k)) AS cut) x, f l, f r
  WHERE l.lang = c.lang AND r.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ') AND r.phrase = array_to_string(c.w[cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_runs AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, (VALUES (2), (3), (4)) v(size), LATERAL (SELECT unnest(range(1, k - size + 2)) AS i) p
  WHERE size < k GROUP BY 1, 2),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_runs i USING (lang, phrase) WHERE i.longer IS NULL OR i.longer < b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
