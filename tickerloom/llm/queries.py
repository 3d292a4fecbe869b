"""The registered queries of this package and, where SQL can express them, their DuckDB SQL."""

from pyspark.sql import functions as F

from . import decontamination, fill_middle, html_text, language_id, licenses, merkle, packing, pii
from . import simhash, substring_dedup, suffix_dedup, token_store, vector_codes


def tokenizer_file(name="word_bpe_49k.json"):
    """Path of a public tokenizer file of the installed collection."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark, d):
    return decontamination.report(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op2_html_text(spark, d):
    return html_text.extract(_table(spark, d, "pages"), whole_articles=True)


def op3_packing(spark, d):
    return packing.pack(_table(spark, d, "documents"), tokenizer_file())


def op4_merkle(spark, d):
    return merkle.report(_table(spark, d, "documents"))


def op5_token_store(spark, d):
    return token_store.report(_table(spark, d, "documents"), tokenizer_file())


def op6_language_id(spark, d):
    return language_id.report(_table(spark, d, "documents"))


def op7_substring_dedup(spark, d):
    return substring_dedup.report(_table(spark, d, "documents"))


def op8_simhash(spark, d):
    return simhash.report(_table(spark, d, "documents"))


def op9_pii(spark, d):
    return pii.report(_table(spark, d, "documents"))


def op10_licenses(spark, d):
    return licenses.report(_table(spark, d, "documents"))


def op11_suffix_dedup(spark, d):
    return suffix_dedup.report(_table(spark, d, "documents"))


def op12_vector_codes(spark, d):
    return vector_codes.report(_table(spark, d, "embeddings"))


def op13_fill_middle(spark, d):
    return fill_middle.report(_table(spark, d, "documents"))


def language_id_pages(spark, d):
    """Language of web pages: extracted text, `lang` of the html element, host of the address."""
    pages = _table(spark, d, "pages")
    lang = F.nullif(F.regexp_extract("html", r"(?i)<html[^>]*\slang=[\"']?([A-Za-z]+)", 1), F.lit(""))
    rows = html_text.extract(pages, whole_articles=True, kept={"lang": lang})
    host = F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1)
    found = language_id.identify(rows, id_col="page_id", host=host)
    return found.select(F.col("doc_id").alias("page_id"), "language", F.round("posterior", 6).alias("posterior"), "accepted")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_html_text": op2_html_text,
    "op3_packing": op3_packing,
    "op4_merkle": op4_merkle,
    "op5_token_store": op5_token_store,
    "op6_language_id": op6_language_id,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_simhash": op8_simhash,
    "op9_pii": op9_pii,
    "op10_licenses": op10_licenses,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_fill_middle": op13_fill_middle,
    "language_id_pages": language_id_pages,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS k,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT rid, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)
),
hits AS (SELECT rid, i, k, item FROM places JOIN windows USING (k, g)),
words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hits) GROUP BY rid
),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
places AS (
  SELECT rid, i, array_to_string(w[i : i + 19], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
),
later AS (
  SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY g ORDER BY rid, i) AS n FROM places)
  WHERE n > 1
),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 20)) AS p FROM later),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
       ANTI JOIN gone USING (rid, p)
  GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


def _canonical_sql(column):
    out = f"regexp_replace(lower({column}), '(^|\\n)[ \\t*#/;-]*(copyright|\\(c\\)|©|all rights reserved)[^\\n]*', chr(10), 'g')"
    out = f"' ' || regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', '  ', 'g') || ' '"
    out = f"({out})"
    for one, other in licenses.EQUIVALENT:
        out = f"replace({out}, ' {one} ', ' {other} ')"
    return f"sha256(nullif(trim(replace({out}, '  ', ' ')), ''))"


def _values(rows):
    return ", ".join(f"('{k}', '{d}')" for k, d in rows)


LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
known(license, digest) AS (VALUES {_values(licenses.DIGESTS)}),
notice(name, key) AS (VALUES {_values(licenses.notices())}),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
found AS (
  SELECT rid, string_agg(DISTINCT name, ',' ORDER BY name) AS notices
  FROM (SELECT rid, {_canonical_sql('line')} AS key FROM lines WHERE contains(lower(line), 'licen'))
       JOIN notice USING (key)
  GROUP BY rid
),
texts AS (SELECT rid, doc_id, {_canonical_sql('text')} AS digest FROM d)
SELECT doc_id, digest, license, coalesce(notices, '') AS notices
FROM texts LEFT JOIN known USING (digest) LEFT JOIN found USING (rid)
"""



# Windows are pieces of the hexadecimal digits, two for each byte.
SUFFIX_DEDUP = """
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS rid, doc_id,
         hex(encode(coalesce(text, ''))) AS h
  FROM documents
),
later AS (
  SELECT rid, i FROM (
    SELECT rid, i, row_number() OVER (PARTITION BY g ORDER BY rid, i) AS n
    FROM (SELECT rid, i, substr(h, 2 * i + 1, 200) AS g
          FROM (SELECT rid, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d WHERE len(h) >= 200))
  ) WHERE n > 1
),
spans AS (
  SELECT rid, min(i) AS a, max(i) + 100 AS b FROM (
    SELECT rid, i, sum(CASE WHEN i <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS span
    FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM later)
  ) GROUP BY rid, span
),
pieces AS (
  SELECT rid, a, b, lag(b, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS start, a AS finish FROM spans
  UNION ALL
  SELECT rid, NULL, NULL, coalesce(max(b), 0), len(any_value(h)) // 2 FROM d LEFT JOIN spans USING (rid) GROUP BY rid
),
kept AS (
  SELECT rid, CAST(count(a) AS BIGINT) AS n_spans, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed,
         string_agg(substr(h, 2 * start + 1, 2 * (finish - start)), '' ORDER BY start) AS text
  FROM pieces JOIN d USING (rid) GROUP BY rid
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, n_removed, n_spans,
       sha256(unhex(text)) AS kept_sha256
FROM d JOIN kept USING (rid)
"""


def _vector_codes_sql(rounds=vector_codes.ROUNDS):
    """Plain distances to all entries, one set of tables for each round."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        """parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM kept, range(4) AS r(p)
)""",
        "book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, x AS c FROM parts WHERE rid <= 256)",
    ]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT rid, p, min((d, e)) AS best FROM (
    SELECT rid, p, e,
           list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM parts JOIN book{k} USING (p)
  ) GROUP BY rid, p
)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} AS b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY j) AS c FROM (
      SELECT p, e, j, CAST(floor(sum(value) / count(*)) AS BIGINT) AS mean FROM (
        SELECT n.p, n.best[2] AS e, unnest(x) AS value, unnest(range(1, len(x) + 1)) AS j
        FROM near{k} AS n JOIN parts USING (rid, p)
      ) GROUP BY p, e, j
    ) GROUP BY p, e
  ) AS m USING (p, e)
)""")
    return f"""
WITH {", ".join(steps)},
coded AS (
  SELECT rid, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code,
         CAST(sum(best[1]) AS BIGINT) AS error
  FROM near{rounds} GROUP BY rid
),
digest AS (
  SELECT sha256(coalesce(string_agg(array_to_string(c, ','), ',' ORDER BY p, e), '')) AS codebooks_sha256
  FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), digest
"""


FILL_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
t AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w,
         [CAST('0x' || substr(h, 8 * k + 1, 8) AS UBIGINT) FOR k IN range(4)] AS draw
  FROM d
),
c AS (
  SELECT *, least(draw[1] % (len(w) + 1), draw[2] % (len(w) + 1)) AS a,
         greatest(draw[1] % (len(w) + 1), draw[2] % (len(w) + 1)) AS b,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR draw[3] % 100 >= 90 THEN 'plain'
              WHEN draw[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM t
),
p AS (
  SELECT *, array_to_string(w[1 : a], '') AS prefix, array_to_string(w[a + 1 : b], '') AS middle,
         array_to_string(w[b + 1 :], '') AS suffix
  FROM c
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

ORACLE = {
    "op1_decontamination": DECONTAMINATION,
    "op7_substring_dedup": SUBSTRING_DEDUP,
    "op10_licenses": LICENSES,
    "op11_suffix_dedup": SUFFIX_DEDUP,
    "op12_vector_codes": _vector_codes_sql(),
    "op13_fill_middle": FILL_MIDDLE,
}
