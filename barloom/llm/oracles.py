"""DuckDB SQL of the text operators that SQL can express. Documents are taken to have distinct ids."""

from __future__ import annotations

from . import rules

_WORD = r"[^\x20\x09-\x0D]+"


def _gone(text: str, pattern: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '{pattern}+', '', 'g')))"


_COUNTS = {
    "upper": _gone("text", r"\p{Lu}"),
    "letter": f"({_gone('text', chr(92) + 'p{L}')} - {_gone('text', chr(92) + 'p{Lu}')})",
    "digit": _gone("text", r"\p{Nd}"),
    "blank": _gone("text", r"[\x20\x09-\x0D]"),
    "mark": _gone("text", r"[.,;:!?''\"()\-]"),
}
_C = list(_COUNTS)


def _share(x: str) -> str:
    return f"list_transform({x}, lambda v: v / list_sum({x}))"


def _half(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END))"


def _distance(a: str, b: str) -> str:
    return f"sqrt(greatest(0, ({_half(a, b)} + {_half(b, a)}) / 2))"


_REST = "(n_chars - " + " - ".join(_C) + ")"
RULES = f"""WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
counts AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM d WHERE lang IS NOT NULL) GROUP BY lang, word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank, sum(n) OVER (PARTITION BY lang) AS total FROM counts),
refs AS (SELECT lang, list(word ORDER BY rank) AS rw, list(CAST(n AS DOUBLE) ORDER BY rank) AS rc, CAST(max(total) AS DOUBLE) AS total FROM ranked WHERE rank <= {rules.COMMON} GROUP BY lang HAVING max(total) >= {rules.GUARD_LANG_WORDS}),
runs AS (SELECT doc_id, i, w[i:i + 4] AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS c FROM runs) WHERE c > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (SELECT unnest(range(5)) AS j) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
counted AS (SELECT d.doc_id, d.lang, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, {_gone("text", "[#*$%&|<>]")} AS n_symbols,
len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, length(text) AS n_chars, {", ".join(f"{e} AS {c}" for c, e in _COUNTS.items())}, refs.total, refs.rc,
list_transform(range(0, {rules.COMMON + 1}), lambda k: CAST(len(list_filter(w, lambda x: coalesce(list_position(refs.rw, x), 0) = k)) AS DOUBLE)) AS hist
FROM d JOIN lines USING (doc_id) LEFT JOIN repeated r USING (doc_id) LEFT JOIN refs ON refs.lang = d.lang),
classes AS (SELECT lang, {", ".join(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in _C)}, CAST(sum({_REST}) AS DOUBLE) AS rest FROM counted GROUP BY lang),
measured AS (SELECT k.*, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
CASE WHEN k.total IS NOT NULL AND n_words >= {rules.GUARD_WORDS} THEN [{", ".join(f"CAST(k.{c} AS DOUBLE)" for c in _C)}, CAST(k.n_chars - {" - ".join(f"k.{c}" for c in _C)} AS DOUBLE)] END AS p1,
[{", ".join(f"c.{c}" for c in _C)}, c.rest] AS q1, hist AS p2,
list_concat([k.total - list_sum(k.rc)], k.rc, list_transform(range({rules.COMMON} - len(k.rc)), lambda x: CAST(0 AS DOUBLE))) AS q2
FROM counted k LEFT JOIN classes c ON c.lang = k.lang),
shares AS (SELECT *, {_share("p1")} AS a1, {_share("q1")} AS b1, {_share("p2")} AS a2, {_share("q2")} AS b2 FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
NOT base_failed AND (p1 IS NULL OR (coalesce({_distance("a1", "b1")} <= {rules.MAX_CLASS}, true) AND coalesce({_distance("a2", "b2")} <= {rules.MAX_COMMON}, true))) AS kept FROM shares"""

DEBRUIJN = f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, i, w[i:i + 19] AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, (SELECT unnest(range(20)) AS j)),
words AS (SELECT doc_id, w[i] AS word, i FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256 FROM d LEFT JOIN kept k USING (doc_id)"""

NEAR = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, w[i:i + 4] AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT links.b, reach.r FROM reach JOIN links ON links.a = reach.doc_id),
roots AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN roots USING (doc_id) LEFT JOIN sizes s USING (doc_id)"""

SUFFIX = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM windows) WHERE least < doc_id),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM hit),
numbered AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, g),
ends AS (SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, length(h) // 2 AS a, length(h) // 2 AS b FROM d),
pieces AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS start FROM ends),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * start + 1, 2 * (a - start)), '' ORDER BY a, b) AS k, sum(b - a) AS n_removed, count(*) - 1 AS n_spans FROM pieces JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans, sha256(unhex(k)) AS kept_sha256 FROM d JOIN kept USING (doc_id)"""

TOP_K = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""
