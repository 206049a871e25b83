"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP8 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM d GROUP BY source
), q AS (
  SELECT *, 3 * source_size AS cap,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
            ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (
            ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS quotient
  FROM s
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * max(quotient) OVER ()) AS target FROM q
), w AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS rest
  FROM t
), h AS (
  SELECT source, h, sum(size)::BIGINT AS words,
         coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d GROUP BY source, h
), c AS (
  SELECT w.*, h.h AS cut, w.rest - h.start AS room, h.words AS at_cut
  FROM w LEFT JOIN h ON w.source IS NOT DISTINCT FROM h.source AND w.rest > 0 AND h.start <= w.rest AND w.rest < h.start + h.words
), r AS (
  SELECT d.doc_id, d.source, d.size, c.source_size, c.target,
         (c.whole + CASE WHEN d.h < c.cut THEN 1 ELSE 0 END)::BIGINT AS copies,
         (CASE WHEN d.h = c.cut THEN d.size * c.room // c.at_cut ELSE 0 END)::BIGINT AS part
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, source, size, source_size, target, copies, part, copies * size + part AS taken FROM r
"""

OP9 = r"""
WITH b AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), g AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), p AS (
  SELECT uid, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT uid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)
), m AS (
  SELECT p.uid, p.n, p.i, g.item FROM p JOIN g ON p.n = g.n AND p.gram = g.gram
), hit AS (
  SELECT uid, count(DISTINCT pos) AS n_hit FROM (SELECT uid, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT uid, n, i FROM m)) GROUP BY uid
), its AS (
  SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT uid, item FROM m) GROUP BY uid
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (uid) LEFT JOIN its USING (uid)
"""

OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), q AS (
  SELECT DISTINCT vec_id AS query_id, v FROM v WHERE vec_id % 50 = 0
), s AS (
  SELECT query_id, q.v, vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM q JOIN v c ON len(q.v) = len(c.v) AND c.vec_id <> query_id
), r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

#: Words are lower-cased A-Z; a set is the distinct word triples, or the whole sequence of a shorter text.
OP10 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents
), s AS (
  SELECT DISTINCT uid, array_to_string(w[i : i + least(len(w), 3) - 1], ' ') AS g
  FROM (SELECT uid, w, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT uid, count(*) AS n, any_value(doc_id) AS doc_id FROM s JOIN d USING (uid) GROUP BY uid
), p AS (
  SELECT a.uid AS u, b.uid AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.uid < b.uid GROUP BY 1, 2
), l AS (
  SELECT u, v FROM p JOIN n x ON x.uid = u JOIN n y ON y.uid = v WHERE 100 * k >= 90 * (x.n + y.n - k)
), e AS (
  SELECT u, v FROM l UNION ALL SELECT v, u FROM l
), c AS (
  SELECT uid AS u, uid AS v FROM n
  UNION
  SELECT c.u, e.v FROM c JOIN e ON c.v = e.u
), m AS (
  SELECT c.u, min(n.doc_id) AS component_id FROM c JOIN n ON n.uid = c.v GROUP BY c.u
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.uid = d.uid LEFT JOIN m ON m.u = d.uid
"""

#: Pieces and words at the contract's marks; every n-gram counted where it stands.
OP11 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), g AS (
  SELECT lang, k, gram, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS gram
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
  ) GROUP BY ALL
), c AS (
  SELECT lang, k, gram AS phrase, f AS a, string_split(gram, ' ') AS w FROM g WHERE k >= 2 AND f >= 10
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM c WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT c.* FROM c LEFT JOIN longer ON c.k = 2 AND c.lang = longer.lang AND c.phrase = longer.phrase
  WHERE longer.a IS NULL OR 100 * longer.a < 50 * c.a
), cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[:cut], ' ') AS head, array_to_string(w[cut + 1 :], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)
), s AS (
  SELECT cuts.lang, phrase, a, cut, h.f AS l, r.f AS r,
         (1000000::HUGEINT * a::HUGEINT * a::HUGEINT // (h.f::HUGEINT * r.f::HUGEINT))::BIGINT AS score
  FROM cuts JOIN g h ON cuts.lang = h.lang AND cuts.head = h.gram JOIN g r ON cuts.lang = r.lang AND cuts.rest = r.gram
), best AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, cut, l, r, n, score
FROM best JOIN n USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


def _add(state: str, cost: str, letter: str) -> str:
    """SQL: a state (nine digits of cost, then its audit) after one more edit; states of one row compare as text."""
    return f"lpad((left({state}, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{letter}'"


#: Blanks of ASCII, as SQL.
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP12 = rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS ck, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(key) + 1), lambda i: ascii(key[i])::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS h
  FROM src
), damaged AS (
  SELECT ck, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE h <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY ck ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), facts AS (
  SELECT *, left(role, 1) AS ini, rtrim(text, {_BLANKS}) = '' AS blank,
         row_number() OVER (PARTITION BY ck, role, text ORDER BY i) > 1 AS again,
         right(rtrim(text, {_BLANKS}), 1) NOT IN ('.', '!', '?') AS cut,
         lag(left(role, 1)) OVER (PARTITION BY ck ORDER BY i) AS before
  FROM placed
), rows_ AS (
  SELECT *, NOT blank AND NOT again AS ok, CASE WHEN NOT blank AND NOT again AND cut THEN 1 ELSE 0 END AS p FROM facts
), dp AS (
  SELECT ck, 0::BIGINT AS i, '000000000' AS s0, NULL::VARCHAR AS s1, '000000002I' AS s2, '000000004II' AS s3
  FROM (SELECT DISTINCT ck FROM src)
  UNION ALL
  SELECT ck, i, n0, n1, m2, least(n3, {_add("m2", "2", "I")}) FROM (
    SELECT *, least(n2, {_add("least(n0, n1, n3)", "2", "I")}) AS m2 FROM (
      SELECT dp.ck, r.i,
        {_add("s0", "3", "D")} AS n0,
        least({_add("s1", "3", "D")}, CASE WHEN ok AND ini = 's' THEN {_add("s0", "p", "K")} END) AS n1,
        least({_add("s2", "3", "D")}, CASE WHEN ok AND ini = 'u' THEN {_add("least(s0, s1, s3)", "p", "K")} END,
              CASE WHEN ok THEN {_add("least(s0, s1, s3)", "p + 2", "R")} END) AS n2,
        least({_add("s3", "3", "D")}, CASE WHEN ok AND ini = 'a' THEN {_add("s2", "p", "K")} END,
              CASE WHEN ok THEN {_add("s2", "p + 2", "R")} END) AS n3
      FROM dp JOIN rows_ r ON r.ck = dp.ck AND r.i = dp.i + 1))
), ended AS (
  SELECT ck, least(s0, s3) AS e FROM dp QUALIFY row_number() OVER (PARTITION BY ck ORDER BY i DESC) = 1
), audits AS (
  SELECT ck, left(e, 9)::BIGINT AS cost, substr(e, 10) AS audit FROM ended
), replay AS (
  SELECT ck, audit, 0 AS j, 0::BIGINT AS i, '' AS ini, NULL::VARCHAR AS acc FROM audits
  UNION ALL
  SELECT ck, audit, j, i, CASE WHEN e = 'D' THEN old ELSE left(said, 1) END,
         CASE WHEN e = 'D' THEN acc ELSE coalesce(acc || chr(10), '') || said || ':' || CASE WHEN e = 'I' THEN '' ELSE text END END
  FROM (
    SELECT q.*, r.text, CASE WHEN e = 'K' THEN r.role WHEN old = 'u' THEN 'assistant' ELSE 'user' END AS said
    FROM (SELECT ck, audit, j + 1 AS j, i + CASE WHEN audit[j + 1] = 'I' THEN 0 ELSE 1 END AS i, audit[j + 1] AS e, ini AS old, acc
          FROM replay WHERE j < length(audit)) q
    LEFT JOIN rows_ r ON r.ck = q.ck AND r.i = q.i)
), repaired AS (
  SELECT ck, coalesce(acc, '') AS whole FROM replay WHERE j = length(audit)
), sums AS (
  SELECT ck, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate, sum(p)::BIGINT AS truncated,
         count(*) FILTER (before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY ck
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(whole) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, ck FROM src) c JOIN audits USING (ck) JOIN repaired USING (ck) LEFT JOIN sums USING (ck)
"""

OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM documents
), win AS (
  SELECT uid, i, count(*) OVER (PARTITION BY uid, gram) AS k
  FROM (SELECT uid, i, array_to_string(w[i : i + 7], ' ') AS gram FROM (SELECT uid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8))
), rep AS (
  SELECT uid, count(DISTINCT pos) AS n FROM (SELECT uid, unnest(range(i, i + 8)) AS pos FROM win WHERE k >= 2) GROUP BY uid
), m AS (
  SELECT d.uid, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(regexp_extract_all(text, '[A-Za-z]|[^\x00-\x7F]'))::BIGINT AS n_letters, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_capitals,
         len(regexp_extract_all(text, '[!?]'))::BIGINT AS n_shouts,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')))::BIGINT AS n_plain_words
  FROM d LEFT JOIN rep USING (uid)
), b AS (
  SELECT *, (n_words < 20)::INT AS b0, (100 * n_repeat_words > 30 * n_words)::INT AS b1, (word_chars < 3 * n_words)::INT AS b2,
         (word_chars > 12 * n_words)::INT AS b3, (2 * n_symbols > n_words)::INT AS b4,
         (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)::INT AS b5, (n_letters >= 40 AND 100 * n_capitals > 70 * n_letters)::INT AS b6,
         (n_words >= 20 AND 100 * n_shouts > 60 * n_words)::INT AS b7, (100 * n_plain_words < 50 * n_words)::INT AS b8
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 + b1 > 0 AS base_failed,
       b0 + b1 + b2 + b3 + b4 + b8 = 0 AND b5 + b6 + b7 <= 1 AS kept,
       (b0 + 2 * b1 + 4 * b2 + 8 * b3 + 16 * b4 + 32 * b5 + 64 * b6 + 128 * b7 + 256 * b8)::BIGINT AS fails, '3-all' AS policy
FROM b
"""

SQL: dict[str, str] = {
    "op5_exact_top_k": OP5,
    "op8_water_filling": OP8,
    "op9_benchmark_leaks": OP9,
    "op10_ngram_join": OP10,
    "op11_collocations": OP11,
    "op12_conversation_repair": OP12,
    "op13_quality_rules": OP13,
}
