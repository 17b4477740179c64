"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from reelspark.llm.quality_rules import STOP_WORDS, THRESHOLDS

ORACLE: dict[str, str] = {}

_STOP = ", ".join(f"'{word}'" for word in dict.fromkeys(STOP_WORDS))


def _passes(rule) -> str:
    bounds = []
    if rule.low is not None:
        bounds.append(f"{rule.value} + {rule.slack} >= {rule.low}::DOUBLE * {rule.per}")
    if rule.high is not None:
        bounds.append(f"{rule.value} - {rule.slack} <= {rule.high}::DOUBLE * {rule.per}")
    return "(" + " AND ".join(bounds) + ")"


ORACLE["op1_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 1
            ELSE greatest(1, ceil(payload_bytes / 1048576.0))::BIGINT END AS chunks
FROM q
"""

ORACLE["op6_quality_rules"] = rf"""
WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
texts AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM numbered),
windows AS (
  SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM texts WHERE len(w) >= 5)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY rid),
counted AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop_words,
         len(list_filter(w, lambda x: suffix(x, '!!'))) AS n_shouts
  FROM texts LEFT JOIN covered USING (rid)),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         concat_ws(',', {", ".join(f"CASE WHEN NOT {_passes(r)} THEN '{r.name}' END" for r in THRESHOLDS)}) AS failed_rules
  FROM counted)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM judged
"""

ORACLE["op10_jaccard_join"] = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM texts WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents
          UNION SELECT node, b FROM reach JOIN links ON a = other),
parts AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM texts t LEFT JOIN sizes USING (doc_id) JOIN parts ON node = t.doc_id
"""



def _crc32(texts: str) -> str:
    """CTEs that end in ``crcs (text, h)``: the CRC-32 of the UTF-8 bytes of ``text`` in ``texts``, which are distinct.

    The sum is linear: each byte has its part by its value and its distance from the end, and the start value
    has one by the length.
    """
    code = "unicode(c)"
    utf8 = f"""flatten(list_transform(string_split(text, ''), lambda c: CASE
      WHEN {code} < 128 THEN [{code}]
      WHEN {code} < 2048 THEN [192 + ({code} >> 6), 128 + ({code} & 63)]
      WHEN {code} < 65536 THEN [224 + ({code} >> 12), 128 + (({code} >> 6) & 63), 128 + ({code} & 63)]
      ELSE [240 + ({code} >> 18), 128 + (({code} >> 12) & 63), 128 + (({code} >> 6) & 63), 128 + ({code} & 63)] END))"""
    half = "CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END"
    return f"""
crc_table AS MATERIALIZED (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: {half}) AS v FROM range(256) AS r(i)),
crc_bytes AS MATERIALIZED (SELECT text, {utf8} AS bytes, strlen(text) AS size FROM {texts} WHERE text <> ''),
crc_most AS MATERIALIZED (SELECT max(size) AS most FROM crc_bytes),
crc_parts AS (
  SELECT 1 AS far, i AS byte, v FROM crc_table
  UNION ALL SELECT far + 1, byte, xor(p.v >> 8, t.v) FROM crc_parts p JOIN crc_table t ON t.i = p.v & 255
  WHERE far < (SELECT most FROM crc_most)),
crc_starts AS (
  SELECT 0 AS size, 4294967295 AS u
  UNION ALL SELECT size + 1, xor(u >> 8, v) FROM crc_starts JOIN crc_table ON i = u & 255 WHERE size < (SELECT most FROM crc_most)),
crc_sums AS (
  SELECT text, any_value(b.size) AS size, bit_xor(v) AS parts
  FROM (SELECT text, size, unnest(bytes) AS byte, size + 1 - unnest(range(1, size + 1)) AS far FROM crc_bytes) b
  JOIN crc_parts p ON p.far = b.far AND p.byte = b.byte GROUP BY text),
crcs AS (SELECT text, xor(xor(parts, u), 4294967295) AS h FROM crc_sums JOIN crc_starts USING (size))"""


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE["op11_spelling_variants"] = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), {_LOWER}) AS run FROM documents),
spelled AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
named AS MATERIALIZED (SELECT concat(id, ':', run) AS text FROM spelled),{_crc32("named")},
hashed AS (SELECT run, n, h FROM spelled JOIN crcs ON text = concat(id, ':', run)),
slipped AS (
  SELECT CASE WHEN h % 199 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shorter AS (
  SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS form
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.form = b.form AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.form = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.form = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(below := -other_n, other := other)) AS top FROM pairs GROUP BY word),
known AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.below >= 5 * n THEN top.other END AS form,
         CASE WHEN -top.below >= 5 * n THEN -top.below END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS reached, form AS ahead FROM known
  UNION ALL SELECT chain.word, known.word, known.form FROM chain JOIN known ON known.word = chain.ahead)
SELECT k.word, n, n_near, form, form_n, reached AS root FROM known k JOIN chain c ON c.word = k.word AND ahead IS NULL
"""

ORACLE["op12_importance"] = rf"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS rid, doc_id, 's' AS side, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, 't', coalesce(text, '') FROM benchmark),
worded AS (
  SELECT rid, doc_id, side, regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
  SELECT rid, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: concat(w[i], ' ', w[i + 1])))) AS f FROM worded),
named AS MATERIALIZED (SELECT DISTINCT f AS text FROM features),{_crc32("named")},
bucketed AS (SELECT rid, h % 10000 AS bucket, count(*) AS k FROM features JOIN crcs ON text = f GROUP BY ALL),
counted AS (
  SELECT r.i AS bucket, coalesce(sum(k) FILTER (rid > 0), 0)::DOUBLE AS s, coalesce(sum(k) FILTER (rid < 0), 0)::DOUBLE AS t
  FROM range(10000) AS r(i) LEFT JOIN bucketed ON bucket = r.i GROUP BY r.i),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM counted),
weighed AS (SELECT rid, sum(k)::BIGINT AS n_features, floor(sum(k * gain) / sum(k))::BIGINT AS weight
  FROM bucketed JOIN gains USING (bucket) WHERE rid > 0 GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         ('0x' || substr(sha256(concat('7:', coalesce(doc_id::VARCHAR, ''))), 1, 8))::BIGINT AS h
  FROM worded LEFT JOIN weighed USING (rid) WHERE side = 's'),
noisy AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM scored),
ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank, count(*) OVER () AS rows
  FROM noisy WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * rows // 100 THEN rank END AS rank FROM noisy LEFT JOIN ranked USING (rid)
"""
