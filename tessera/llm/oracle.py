"""SQL for the queries of this subpackage whose result SQL can state."""

from __future__ import annotations

from .line_dedup import MIN_SITES
from .mixing import MAX_REPEATS, SEED, WEIGHTS
from .ngram_join import PERCENT, SHINGLE_WORDS
from .spelling import MIN_COUNT, MIN_LENGTH, RATIO, SLIP

BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH l AS (
  SELECT doc_id, coalesce(source, '') AS site, i, string_split(text, chr(10))[i] AS line
  FROM (SELECT doc_id, source, text,
               unnest(generate_series(1, len(string_split(text, chr(10))))) AS i
        FROM documents WHERE text IS NOT NULL)
), k AS (
  SELECT *, trim(line, {TRIM}) AS key, regexp_matches(line, '{WORD_CLASS}') AS worded FROM l
), b AS (
  SELECT key, min(doc_id) AS first_doc FROM k WHERE worded
  GROUP BY key HAVING count(DISTINCT site) >= {MIN_SITES}
), m AS (
  SELECT k.*, b.key IS NOT NULL AND worded AND k.doc_id <> b.first_doc AS gone
  FROM k LEFT JOIN b ON k.key = b.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS text_md5
FROM m GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""

EXACT_DEDUP = f"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{BLANK_CLASS}+', ' ', 'g')) AS sha
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha AS text_sha256
FROM d WINDOW g AS (PARTITION BY sha)
"""

# Limits grow with source_size / weight: the first k sources by it are limited, for the k at which
# the level of the others is below their limits.
SOURCE_MIXING = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD_CLASS}')) AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, {MAX_REPEATS} * source_size AS cap, row_number() OVER (ORDER BY source_size / weight, source) AS k FROM s
), c AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent
  FROM r
), v AS (
  SELECT coalesce(arg_min((total - capped) / (weights - spent)::DOUBLE, k) FILTER ((total - capped) <= cap / weight::DOUBLE * (weights - spent)), 0) AS level
  FROM c
), t AS (
  SELECT source, source_size, least(cap::DOUBLE, level * weight) AS target FROM r, v
), p AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS take,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR || chr(1) || '{SEED}'), doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, round(target, 6) AS target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         (take // source_size) * size + greatest(0, least(size, take % source_size - start)) END::BIGINT AS taken
FROM p
"""

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD_CLASS}') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < {SHINGLE_WORDS} THEN ws ELSE ws[i : i + {SHINGLE_WORDS - 1}] END AS shingle
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - {SHINGLE_WORDS - 1}, 1))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL
), e AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= {PERCENT} * (x.n + y.n - shared)
), r AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a
)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

# crc32 by its eight shifts per byte of the UTF-8 form.
CRC = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode({0})), '..'), lambda c: ('0x' || c)::UBIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1))))"""


def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column} END"


_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
_RUN = "FROM {0} GROUP BY tree, i // 8, n HAVING n > 1"
MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('v' || lang, 'n') AS tree, sha256({_HEAD} || {_field('text')}) AS h,
         sha256({_HEAD} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS lowered,
         xor(4294967295::UBIGINT, {CRC.format('doc_id::VARCHAR')}) % 3 = 0 AS tampered
  FROM documents
), l AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM d
), t AS (
  SELECT tree, 0 AS level, i, n, h FROM l
  UNION ALL
  SELECT tree, any_value(level) + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) {_RUN.format('t')}
), s AS (
  SELECT tree, level, h AS subroot FROM t WHERE n = 1
), u AS (
  SELECT '' AS tree, 0 AS level, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, subroot AS h FROM s
  UNION ALL
  SELECT tree, any_value(level) + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) {_RUN.format('u')}
), nodes AS (
  SELECT * FROM t UNION ALL SELECT * FROM u
), step AS (
  SELECT doc_id, h AS leaf, tree, 0 AS level, i, n, 0 AS k, CASE WHEN tampered THEN lowered ELSE h END AS h, '' AS proof FROM l
  UNION ALL
  (WITH a AS (
     SELECT p.doc_id, p.leaf, p.tree, p.level, p.i, p.n, p.k, sha256(string_agg(CASE WHEN o.i = p.i THEN p.h ELSE o.h END, '' ORDER BY o.i)) AS h,
            p.proof AS lower, string_agg(o.h, '' ORDER BY o.i) FILTER (o.i <> p.i) AS others
     FROM step p JOIN nodes o ON o.tree = p.tree AND o.level = p.level AND o.i // 8 = p.i // 8
     WHERE p.n > 1 GROUP BY p.doc_id, p.leaf, p.tree, p.level, p.i, p.n, p.k, p.proof
   )
   SELECT doc_id, leaf, tree, level + 1, i // 8, (n + 7) // 8, k + 1, h, lower || coalesce(others, '') FROM a
   UNION ALL
   SELECT p.doc_id, p.leaf, '', 0, r.i, r.n, p.k + 1, p.h, p.proof
   FROM step p JOIN (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM s) r ON r.tree = p.tree
   WHERE p.n = 1 AND p.tree <> ''
  )
), r AS (
  SELECT h AS root FROM u WHERE n = 1
)
SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(p.proof) AS proof_sha256, p.h AS folded_root, p.h = r.root AS verified
FROM step p JOIN l USING (doc_id) JOIN s ON s.tree = l.tree, r WHERE p.tree = '' AND p.n = 1
"""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# SQL's edit distance counts bytes: the 64 letters beyond ASCII get a byte each.
_BYTES = "translate(word, '{}', '{}')".format("".join(map(chr, range(0xC0, 0x100))), "".join(map(chr, [*range(33, 39), *range(40, 97), 123])))
SPELLING = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
  GROUP BY ALL
), h AS (
  SELECT run, times, length(run) AS len, xor(4294967295::UBIGINT, {CRC.format("(doc_id || ':' || run)")}) AS h FROM r
), w AS (
  SELECT word, sum(times)::BIGINT AS n, length(word) AS len
  FROM (SELECT times, CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, (h % len)::BIGINT) || substr(run, (h % len)::BIGINT + 2) ELSE run END AS word FROM h)
  GROUP BY word HAVING sum(times) >= {MIN_COUNT} AND length(word) >= {MIN_LENGTH}
), k AS (
  -- Two words one edit apart have the same beginning or the same end.
  SELECT *, {_BYTES} AS code, unnest([substr(word, 1, 3), '-' || substr(word, len - 2)]) AS key FROM w
), p AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM k a JOIN k b ON a.key = b.key
  WHERE a.word <> b.word AND abs(a.len - b.len) <= 1 AND levenshtein(a.code, b.code) = 1
), f AS (
  SELECT word, any_value(n) AS n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n
  FROM p GROUP BY word
), g AS (
  SELECT word, n_near, CASE WHEN best_n >= {RATIO} * n THEN best END AS form, CASE WHEN best_n >= {RATIO} * n THEN best_n END AS form_n FROM f
), c AS (
  SELECT word, word AS here, 0 AS k FROM w
  UNION ALL
  SELECT c.word, g.form, k + 1 FROM c JOIN g ON g.word = c.here WHERE g.form IS NOT NULL
)
SELECT w.word, g.form, l.root, w.n, coalesce(g.n_near, 0)::BIGINT AS n_near, g.form_n
FROM w LEFT JOIN g USING (word) JOIN (SELECT word, arg_max(here, k) AS root FROM c GROUP BY word) l USING (word)
"""

ORACLE = {
    "op1_line_dedup": LINE_DEDUP,
    "op6_ngram_join": NGRAM_JOIN,
    "op7_exact_dedup": EXACT_DEDUP,
    "op10_source_mixing": SOURCE_MIXING,
    "op11_spelling_variants": SPELLING,
    "op13_merkle_manifest": MERKLE,
}


def oracle() -> dict[str, str]:
    return dict(ORACLE)
