"""DuckDB SQL for the queries of the corpus operators that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

EXACT = """WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""

# A word is repeated if one of the up to three windows around it occurs twice or more in its text.
QUALITY = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
v AS (SELECT a.doc_id, a.i, a.word AS x, b.word AS y, c.word AS z FROM p a
  JOIN p b ON b.doc_id = a.doc_id AND b.i = a.i + 1 JOIN p c ON c.doc_id = a.doc_id AND c.i = a.i + 2),
o AS (SELECT doc_id, x, y, z FROM v GROUP BY ALL HAVING count(*) > 1),
r AS (SELECT DISTINCT v.doc_id, v.i + k AS i FROM v JOIN o USING (doc_id, x, y, z) CROSS JOIN (VALUES (0), (1), (2)) t(k)),
rr AS (SELECT doc_id, count(*) AS n FROM r GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
ll AS (SELECT doc_id, count(*) AS n, count(DISTINCT line) AS k FROM l
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1),
s AS (SELECT doc_id, count(*) AS n FROM p WHERE regexp_matches(word, '[A-Z]') AND NOT regexp_matches(word, '[a-z]')
  AND strlen(word) > 1 GROUP BY 1),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(t) - length(regexp_replace(t, '[^\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(ll.n - ll.k, 0) AS n_dup_lines, coalesce(rr.n, 0) AS n_repeat_words,
    coalesce(ll.n, 0) AS n_lines, coalesce(s.n, 0) AS n_shouted
  FROM d LEFT JOIN ll USING (doc_id) LEFT JOIN rr USING (doc_id) LEFT JOIN s USING (doc_id)),
b AS (SELECT *, CAST(
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN n_words > 2000000 THEN 4 ELSE 0 END + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END + CASE WHEN n_symbols > n_words THEN 32 ELSE 0 END
    + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines THEN 64 ELSE 0 END
    + CASE WHEN 100 * n_shouted > 60 * n_words THEN 128 ELSE 0 END AS BIGINT) AS failed_bits FROM m)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed_bits = 0 AS kept FROM b"""

ABLATION = f"""SELECT rule, CAST(sum(CASE WHEN failed_bits & bit <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  CAST(sum(CASE WHEN failed_bits = bit THEN 1 ELSE 0 END) AS BIGINT) AS only_this
FROM ({QUALITY}) q CROSS JOIN (VALUES ('too_few_words', 1), ('repeated_words', 2), ('too_many_words', 4),
  ('words_too_short', 8), ('words_too_long', 16), ('symbols', 32), ('repeated_lines', 64), ('shouting', 128)) t(rule, bit)
GROUP BY rule"""

# The markup around a turn has 12 + 1 + 11 characters; escaping adds one for each "<", backslashes, "|".
CHAT = r"""WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
g AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t) AS said,
    coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '') AS loss,
    list(role ORDER BY turn, role, t) AS roles,
    sum(length(role) + length(t) + 24 + len(regexp_extract_all(t, '<\\*\|'))) AS chars FROM c GROUP BY 1)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CASE WHEN roles = ['user', 'assistant'] THEN 'prompt'
    WHEN roles = ['system', 'user', 'assistant'] THEN 'instruction'
    WHEN len(list_filter(roles, lambda r: r NOT IN ('user', 'assistant'))) = 0 THEN 'shared' ELSE 'messages' END AS layout, n_turns, sha256(said) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g"""

_PARTS, _ENTRIES, _ROUNDS = 8, 16, 6


def _vector_codes() -> str:
    """Every round written out: the nearest entry of each part, then the floored mean of its parts."""
    steps = [f"""v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS (SELECT max(len(e)) // {_PARTS} AS width FROM v),
p AS MATERIALIZED (SELECT vec_id, (i - 1) // width AS part, (i - 1) % width AS place, e[i] AS x
  FROM v, w, unnest(range(1, {_PARTS} * width + 1)) t(i)),
r AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v),
c0 AS MATERIALIZED (SELECT part, entry, place, x AS c FROM p JOIN r USING (vec_id) WHERE entry < {_ENTRIES})"""]
    for k in range(_ROUNDS + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT vec_id, part, entry, far FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY far, entry) AS best FROM (
    SELECT vec_id, part, entry, sum((x - c) * (x - c)) AS far FROM p JOIN c{k} USING (part, place) GROUP BY ALL)) WHERE best = 1)""")
        if k < _ROUNDS:
            steps.append(f"""m{k} AS (SELECT part, entry, place, sum(x) AS total, count(*) AS n FROM p JOIN a{k} USING (vec_id, part) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT part, entry, place, CAST(coalesce((total - ((total % n) + n) % n) // n, c) AS BIGINT) AS c
  FROM c{k} LEFT JOIN m{k} USING (part, entry, place))""")
    steps.append(f"""f AS (SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM a{_ROUNDS} GROUP BY 1),
h AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM c{_ROUNDS})""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM f JOIN v USING (vec_id), h"""


# Checksums of words by the usual table of 256 remainders, which is made in the first line.
RESAMPLING = r"""WITH crc AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)
  ORDER BY n) AS tab FROM range(256) t(n)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
m AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
f AS (SELECT doc_id, unnest(words) AS word FROM d),
x AS (SELECT word, hex(encode(word)) AS digits FROM (SELECT word FROM f UNION SELECT word FROM m)),
b AS (SELECT word, xor(list_reduce(list_transform(range(len(digits) // 2), lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT)),
  lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM x, crc),
s AS (SELECT bucket, count(*) AS s FROM f JOIN b USING (word) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM m JOIN b USING (word) GROUP BY 1),
g AS (SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
  / ((s + 1) * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
k AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS mean FROM f JOIN b USING (word) JOIN g USING (bucket) GROUP BY 1),
z AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(mean, 0) AS weight,
  CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN k USING (doc_id)),
y AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM z),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
  count(*) FILTER (n_features >= 20) OVER () AS fit FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * fit // 100 THEN place END AS rank FROM o"""

ORACLES: dict[str, str] = {
    "op2_exact_dedup": EXACT, "op7_quality_rules": QUALITY, "op7_rule_ablation": ABLATION,
    "op10_chat_formatting": CHAT, "op12_vector_codes": _vector_codes(), "op13_resampling": RESAMPLING,
}
