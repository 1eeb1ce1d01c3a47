"""SQL over the same tables for the operators that SQL can express.

Language, tokens, grammar files, SimHash, pseudonyms, character models and runs have none; their
tests compare with brute force.
"""

from __future__ import annotations

from .quality import WINDOW, Rules

WORD = r"[^\x20\x09-\x0D]+"

_SIZES = rf"""
sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
  FROM documents
)"""

MIXING = rf"""
WITH {_SIZES},
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
),
weighed AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS INT) + 1] AS weight,
         CAST(2 * source_size AS DOUBLE) AS cap
  FROM sources
),
levels AS (
  SELECT *, cap / weight AS fill,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0.0::DOUBLE))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
aims AS (
  SELECT source, source_size,
         CASE WHEN fill < f OR f IS NULL THEN cap ELSE weight * f END AS target
  FROM (SELECT *, max(CASE WHEN fill >= level THEN level END) OVER () AS f FROM levels)
),
queue AS (
  SELECT d.*, a.source_size, a.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.turn, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS served
  FROM sized d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source
  WHERE d.size > 0
),
copies AS (
  SELECT *, CAST(served + source_size * epoch AS DOUBLE) / target AS finish
  FROM queue, (VALUES (0), (1)) e(epoch)
),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source IS NULL, source, epoch, turn, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM copies
),
taken AS (
  SELECT doc_id, count(*) AS copies
  FROM ordered WHERE upto <= 1.5::DOUBLE * (SELECT sum(size) FROM sized)
  GROUP BY doc_id
)
SELECT d.doc_id, d.size, a.source_size, a.target,
       CAST(d.size * coalesce(t.copies, 0) AS BIGINT) AS taken, CAST(coalesce(t.copies, 0) AS BIGINT) AS copies
FROM sized d
JOIN aims a ON d.source IS NOT DISTINCT FROM a.source
LEFT JOIN taken t ON t.doc_id = d.doc_id
"""


def _half(x: str, y: str) -> str:
    return f"CASE WHEN {x} > 0 THEN {x} / 2 * log2(2 * {x} / ({x} + {y})) ELSE 0 END"


def quality(rules: Rules = Rules()) -> str:
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, lang, text IS NULL AS absent, coalesce(text, '') AS t FROM documents
),
listed AS (
  SELECT row, doc_id, lang, absent, t, regexp_extract_all(t, '{WORD}') AS words FROM docs
),
placed AS (
  SELECT row, lang, absent, words, unnest(words) AS word, unnest(range(len(words))) AS i FROM listed
),
windows AS (
  SELECT row, i, words[i + 1 : i + {WINDOW}] AS w FROM placed WHERE i + {WINDOW} <= len(words)
),
twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, w) AS n FROM windows) WHERE n > 1
),
covered AS (
  SELECT row, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) AS n_repeat_words
  FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS following FROM twice) GROUP BY row
),
lines AS (
  SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{WORD}') GROUP BY row
),
base AS (
  SELECT l.row, l.doc_id, l.lang, l.absent, CAST(len(l.words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(l.words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         length(t) AS chars,
         length(regexp_replace(t, '\P{{Ll}}', '', 'g')) AS c_lower,
         length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS c_upper,
         length(regexp_replace(t, '[^0-9]', '', 'g')) AS c_digit,
         length(regexp_replace(t, '[^.,;:!?''"()-]', '', 'g')) AS c_stop
  FROM listed l LEFT JOIN lines n USING (row) LEFT JOIN covered c USING (row)
),
classed AS (
  SELECT *, unnest([{{'k': 1, 'n': c_lower}}, {{'k': 2, 'n': c_upper}}, {{'k': 3, 'n': c_digit}}, {{'k': 4, 'n': c_stop}},
                    {{'k': 5, 'n': n_symbols}}, {{'k': 6, 'n': chars - word_chars}},
                    {{'k': 7, 'n': word_chars - c_lower - c_upper - c_digit - c_stop - n_symbols}}], recursive := true)
  FROM base
),
class_refs AS (
  SELECT lang, k, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q
  FROM classed WHERE lang IS NOT NULL AND NOT absent GROUP BY lang, k
),
class_gap AS (
  SELECT row, min(gap) AS gap FROM (
    SELECT row, r.lang, sqrt(greatest(sum({_half('(n / greatest(chars, 1))', 'q')} + {_half('q', '(n / greatest(chars, 1))')}), 0)) AS gap
    FROM classed c JOIN class_refs r USING (k) GROUP BY row, r.lang) GROUP BY row
),
counts AS (
  SELECT lang, lower(word) AS word, count(*) AS n FROM placed
  WHERE lang IS NOT NULL AND NOT absent AND length(lower(word)) <= {rules.common_letters} GROUP BY ALL
),
common AS (
  SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {rules.common_words}
),
totals AS (
  SELECT lang, sum(n_words) AS total FROM base WHERE lang IS NOT NULL AND NOT absent GROUP BY lang
),
word_refs AS (
  SELECT lang, word, n / total AS q FROM common JOIN totals USING (lang)
  UNION ALL
  SELECT lang, NULL, 1 - coalesce(sum(n), 0) / any_value(total) FROM totals LEFT JOIN common USING (lang) GROUP BY lang
),
hits AS (
  SELECT p.row, c.lang, c.word, count(*) AS n FROM placed p JOIN common c ON lower(p.word) = c.word GROUP BY ALL
),
own AS (
  SELECT row, lang, word, n FROM hits
  UNION ALL
  SELECT b.row, t.lang, NULL, b.n_words - coalesce(sum(h.n), 0)
  FROM base b CROSS JOIN totals t LEFT JOIN hits h ON h.row = b.row AND h.lang = t.lang GROUP BY b.row, t.lang, b.n_words
),
word_gap AS (
  SELECT row, min(CASE WHEN farthest > 0 THEN gap / farthest ELSE 0 END) AS gap FROM (
    SELECT row, lang, sqrt(greatest(sum({_half('p', 'q')} + {_half('q', 'p')}), 0)) AS gap,
           sqrt(greatest(sum({_half('without', 'q')} + {_half('q', 'without')}), 0)) AS farthest FROM (
      SELECT b.row, r.lang, coalesce(o.n, 0) / greatest(b.n_words, 1) AS p, r.q,
             CASE WHEN r.word IS NULL THEN 1.0::DOUBLE ELSE 0 END AS without
      FROM base b CROSS JOIN word_refs r
      LEFT JOIN own o ON o.row = b.row AND o.lang = r.lang AND o.word IS NOT DISTINCT FROM r.word)
    GROUP BY row, lang) GROUP BY row
),
failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND NOT coalesce(chars >= {rules.guard_chars} AND c.gap > {rules.class_distance}, false)
       AND NOT coalesce(n_words >= {rules.guard_words} AND w.gap > {rules.word_part}, false) AS kept
FROM failed LEFT JOIN class_gap c USING (row) LEFT JOIN word_gap w USING (row)
"""


WARC = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
),
coded AS (
  SELECT page_id, html, hex, array_to_string(
           [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   ((16 * (instr('0123456789abcdef', substr(hex, 1 + 5 * j // 4, 1)) - 1)
                     + instr('0123456789abcdef', substr(hex, 2 + 5 * j // 4, 1)) - 1) >> (3 - 5 * j % 4)) % 32 + 1, 1)
            FOR j IN range(32)], '') AS payload_digest
  FROM hashed
),
firsts AS (
  SELECT *, first_value(page_id) OVER same AS first_id, row_number() OVER same AS nth
  FROM coded WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST)
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, payload_digest,
       CASE nth WHEN 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN first_id END AS refers_to
FROM firsts
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS t FROM documents)
),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, w[i : i + k - 1] AS p FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces CROSS JOIN range(1, 6) ks(k))
),
f AS (SELECT lang, k, p, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT * FROM f WHERE k > 1),
parts AS (
  SELECT lang, a, p[i : i + m - 1] AS p FROM (
    SELECT lang, a, p, m, unnest(range(1, k - m + 2)) AS i FROM candidates CROSS JOIN range(2, 5) ms(m) WHERE m < k)
),
absorbed AS (
  SELECT DISTINCT lang, p FROM parts JOIN f c USING (lang, p) WHERE 100 * parts.a >= 100 * c.a
),
cuts AS (
  SELECT c.lang, c.p, c.a, x.a AS l, y.a AS r, n,
         1000::HUGEINT * c.a * n // (x.a::HUGEINT * y.a) AS score, cut
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates ANTI JOIN absorbed USING (lang, p)) c
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : cut]
  JOIN f y ON y.lang = c.lang AND y.p = c.p[cut + 1 : c.k]
  JOIN totals t ON t.lang = c.lang
),
best AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score
  FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
WHERE rank <= 2000
"""


VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9::DOUBLE
),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
),
components AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT c.vec_id, (SELECT count(*) FROM links WHERE a = c.vec_id) AS n_links, component_id, c.vec_id = component_id AS kept
FROM components c
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_mixing": MIXING,
        "op6_quality": quality(),
        "op9_vectors": VECTORS,
        "op11_warc": WARC,
        "op13_collocations": COLLOCATIONS,
    }
