"""The queries as SQL, where SQL can express them."""

from docenrich.llm.licenses import ALIGNED, TEMPLATES, THRESHOLD as DICE
from docenrich.llm.mixing import _PART_MEAN, FLATTEN
from docenrich.llm.vectors import THRESHOLD as COSINE
from docenrich.llm.warc import MIN_REVISIT_BYTES

#: The smallest node reachable over the symmetric ``links(a, b)`` of ``nodes(id)``.
_COMPONENTS = """
  reach(id, other) AS (
    SELECT id, id FROM nodes
    UNION
    SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
  )
"""

OP2 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words
), sizes AS (
  SELECT doc_id, len(s) AS n FROM sets
), tokens AS (
  SELECT doc_id, unnest(s) AS t FROM sets
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter
  FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * inter >= 80 * (p.n + q.n - inter)
), nodes AS (
  SELECT doc_id AS id FROM documents
), {_COMPONENTS}
SELECT doc_id, n AS n_shingles, component_id
FROM sizes JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) ON id = doc_id
"""

OP4 = f"""
WITH RECURSIVE sizes AS (
  SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS size FROM documents GROUP BY source
), total AS (
  SELECT sum(size) AS size, sum(pow(size, {FLATTEN})) FILTER (size > 0) AS weight FROM sizes
), rates AS (
  SELECT s.source, CASE WHEN s.size > 0 THEN t.size * pow(s.size, {FLATTEN}) / t.weight / s.size ELSE 0 END AS rate
  FROM sizes s, total t
), parts AS (
  SELECT source, rate, greatest(ceil(rate / {_PART_MEAN}), 1)::INT AS n,
         rate / greatest(ceil(rate / {_PART_MEAN}), 1)::INT AS mean FROM rates
), steps(source, mean, k, p, below) AS (
  SELECT source, mean, 0, exp(-mean), exp(-mean) FROM parts
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), below + p * mean / (k + 1) FROM steps
  WHERE k < ceil(mean + 12 * sqrt(mean) + 30)
), numbers AS (
  SELECT d.doc_id, d.source, i,
         (('0x' || substr(md5('1:' || coalesce(d.doc_id::VARCHAR, '') || ':' || i::VARCHAR), 1, 12))::BIGINT + 0.5::DOUBLE)
           / 281474976710656.0::DOUBLE AS u
  FROM documents d JOIN parts p ON p.source IS NOT DISTINCT FROM d.source, range(0, 100) r(i) WHERE i < p.n
), draws AS (
  SELECT n.doc_id, n.source, n.i, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM n.source AND s.below < n.u) AS n
  FROM numbers n
), totals AS (
  SELECT doc_id, source, sum(n)::BIGINT AS n FROM draws GROUP BY ALL
)
SELECT doc_id, source, c::BIGINT AS copy, md5('order 1:' || coalesce(doc_id::VARCHAR, '') || ':' || c::VARCHAR) AS shuffle_key
FROM (SELECT doc_id, source, unnest(range(0, n)) AS c FROM totals)
"""

OP6 = f"""
WITH RECURSIVE units AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM units x JOIN units y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_dot_product(x.v, y.v) / sqrt(list_dot_product(x.v, x.v)) / sqrt(list_dot_product(y.v, y.v)) >= {COSINE}
), nodes AS (
  SELECT vec_id AS id FROM embeddings
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
), {_COMPONENTS}
SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
FROM (SELECT id, min(other) AS component_id FROM reach GROUP BY id) LEFT JOIN counts ON a = id
"""


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '[^a-z0-9]+'), lambda w: w <> '')"


def _bigrams(words: str) -> str:
    return f"list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


_VALUES = ", ".join(
    "({}, '{}', '{}')".format(i, name, notice.replace("'", "''")) for i, (name, notice) in enumerate(TEMPLATES)
)

OP9 = f"""
WITH templates(template, license, notice) AS (VALUES {_VALUES}
), filed AS (
  SELECT template, license, w, {_bigrams("w")} AS t FROM (SELECT template, license, {_words("notice")} AS w FROM templates)
), places AS (
  SELECT template, gram, min(k) AS k FROM (
    SELECT template, k, w[k + 1] || ' ' || w[k + 2] AS gram FROM (SELECT template, w, unnest(range(0, len(w) - 1)) AS k FROM filed))
  GROUP BY ALL
), texts AS (
  SELECT row_number() OVER () AS d, doc_id, {_words("coalesce(text, '')")} AS w FROM documents
), grams AS (
  SELECT d, q, w[q + 1] || ' ' || w[q + 2] AS gram FROM (SELECT d, w, unnest(range(0, len(w) - 1)) AS q FROM texts)
), starts AS (
  SELECT d, g.template, start FROM (
    SELECT d, template, q - k AS start, count(*) AS aligned FROM grams JOIN places USING (gram) GROUP BY ALL) g
  JOIN filed f ON f.template = g.template WHERE aligned * 10 >= len(f.t) * {ALIGNED}
), windows AS (
  SELECT s.d, x.doc_id, f.license, f.t, greatest(start, 0) AS first, least(start + len(f.w), len(x.w)) AS past,
         list_slice(x.w, greatest(start, 0) + 1, least(start + len(f.w), len(x.w))) AS v
  FROM starts s JOIN texts x ON x.d = s.d JOIN filed f ON f.template = s.template
), scored AS (
  SELECT d, doc_id, license, first, past, 2.0::DOUBLE * len(list_intersect(b, t)) / (len(b) + len(t)) AS dice
  FROM (SELECT *, {_bigrams("v")} AS b FROM windows)
), matched AS (
  SELECT *, CASE WHEN first < max(past) OVER (PARTITION BY d ORDER BY first, past ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              THEN 0 ELSE 1 END AS fresh
  FROM scored WHERE dice >= {DICE}
), units AS (
  SELECT *, sum(fresh) OVER (PARTITION BY d ORDER BY first, past ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS unit FROM matched
), best AS (
  SELECT doc_id, license, dice, row_number() OVER (PARTITION BY d, unit ORDER BY dice DESC, license) AS r FROM units
)
SELECT doc_id, license, max(dice) AS dice, count(*) AS n_units FROM best WHERE r = 1 GROUP BY doc_id, license
"""

OP10 = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest AS digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= {MIN_REVISIT_BYTES} GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM payloads LEFT JOIN firsts ON digest = payload_digest
"""

OP11 = """
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM split)
), firsts AS (
  SELECT h, min(doc_id) AS first FROM windows GROUP BY h
), starts AS (
  SELECT DISTINCT doc_id, i FROM windows JOIN firsts USING (h) WHERE doc_id > first
), words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM split
), judged AS (
  SELECT doc_id, i, word, coalesce(max(CASE WHEN s.i IS NOT NULL THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM words LEFT JOIN starts s USING (doc_id, i)
), left_over AS (
  SELECT doc_id, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM judged GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN left_over USING (doc_id)
"""

OP12 = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
), marks AS (
  SELECT run, k, xor(list_reduce(list_concat([4294967295], flatten(list_transform(
      string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc_table
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
              ELSE run END AS word FROM marks)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), gaps AS (
  SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), near AS (
  SELECT x.word, y.word AS other, y.n FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.a || g.b = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.a || g.b = w.word
), best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, n AS other_n,
         row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS r FROM near
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND r = 1
), chain(word, root) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.root WHERE e.form IS NULL
"""

OP13 = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), uses AS (
  SELECT d, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS c FROM uses GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), langs AS (
  SELECT lang, sum(c)::HUGEINT AS n, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS c FROM uses SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (g.n + l.v) AS p,
         1 + (1000000000::HUGEINT * (k.c + 1)) // (l.n + l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p)::BIGINT AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), told AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pairs z ON z.lang = x.lang AND z.source = x.source AND z.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE c > 0 AND p > q
)
SELECT * FROM (
  SELECT lang, source, part, item, value,
         (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM told)
WHERE part = 'pair' OR rank <= 200
"""

ORACLE = {
    "op2_jaccard": OP2,
    "op4_mixing": OP4,
    "op6_vectors": OP6,
    "op9_license_scan": OP9,
    "op10_warc": OP10,
    "op11_substrings": OP11,
    "op12_spelling": OP12,
    "op13_divergence": OP13,
}
