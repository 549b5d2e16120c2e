"""The registered queries of the text operators and their DuckDB twins.

Every query applies its operator, with production parameters, to its whole
table.  Twins exist where SQL can state the result; the other operators are
held against brute force, round trips or held-out labels in ``tests/llm``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dichot.llm import (decontam, html, langid, licenses, near_dup, packing, quality, repair, rollups, secrets, substring, toxicity,
                        whitening)
from dichot.llm.spark import scratch
from dichot.session import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


#: words of every document, in order, as a list
_WORDS = r"""[x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"""


@query(rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 19], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM w)),
hit AS (SELECT doc_id, p FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, p + o AS i FROM hit, (SELECT unnest(range(0, 20)) AS o)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS t, count(*) AS n
         FROM words e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i WHERE g.i IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that windows of 20 repeat from an earlier place are removed."""
    out = substring.strip_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM documents),
sets AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[p] || ' ' || ws[p + 1] END AS g
         FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS p FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
           FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * c >= 80 * (x.n + y.n - c)),
two_way AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, b AS other FROM two_way UNION
          SELECT r.doc_id, l.b FROM reach r JOIN two_way l ON l.a = r.other),
root AS (SELECT doc_id, least(doc_id, min(other)) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
       w.doc_id = coalesce(component_id, w.doc_id) AS kept
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN root USING (doc_id)""")
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar two-word shingle sets."""
    out = near_dup.near_duplicates(table(spark, sf_dir, "documents"), n=2)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of ``documents`` that states a licence, with its family."""
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.train(docs)).drop("row")


def _cut(of: str, key: str) -> str:
    return rf"""SELECT {key}, [x FOR x IN string_split_regex(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+') IF x <> ''] AS ws FROM {of}"""


@query(rf"""
WITH dw AS ({_cut("documents", "doc_id")}), iw AS ({_cut("benchmark", "item_id")}),
lengths AS (SELECT 5 AS k UNION SELECT len(ws) FROM iw WHERE len(ws) BETWEEN 1 AND 4),
d AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + k - 1], ' ') AS g
      FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM dw, lengths)),
i AS (SELECT DISTINCT item_id, array_to_string(ws[p:p + k - 1], ' ') AS g
      FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p
            FROM (SELECT item_id, ws, least(len(ws), 5) AS k FROM iw WHERE len(ws) > 0))),
size AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY item_id),
common AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN i USING (g) GROUP BY ALL)
SELECT doc_id, item_id, item_shingles, shared FROM common JOIN size USING (item_id)
WHERE 100 * shared >= 80 * item_shingles""")
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 80 % of the five-word shingles of an item, or a whole shorter item."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _held_out(modulus: int, remainder: int) -> F.Column:
    """Rows whose crc32 of the id as text has this remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document by a network of the labels not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    told = toxicity.labelled_sample(docs, labels.where(~_held_out(3, 1)))
    return toxicity.score(docs, toxicity.train(told)).select(
        "doc_id", _held_out(3, 1).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals by source, language and tokenizer version after four commits:
    all documents, their revision with white space made single, the deletion of
    those labelled low in quality, and the revision once more (a repeated id)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang").withColumn("op", F.lit("upsert"))
    revised = docs.withColumn("text", F.regexp_replace("text", r"\s+", " "))
    low = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id", F.lit("delete").alias("op"), *(
        F.lit(None).cast("string").alias(c) for c in ("text", "source", "lang")))
    store = rollups.TokenRollup(spark, scratch(spark, "rollup"))
    for name, batch in (("load", docs), ("revise", revised), ("delete", low), ("revise", revised)):
        store.commit(name, batch, "byte_bpe_50k", TOKENIZER, RANKS)
    return store.totals()


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by a model of the documents not held out."""
    docs = table(spark, sf_dir, "documents")
    told = docs.withColumn("held_out", _held_out(4, 2))
    model = langid.train(told.where("not held_out"))
    return langid.identify(docs, model).select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query()
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page by the winning path of its host."""
    return html.extract(table(spark, sf_dir, "pages"))


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token pieces of every document in as few sequences of 2048 as possible."""
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, RANKS)


def _limit_sql(name: str, by: str) -> str:
    """Thresholds of the merged sketches by the given columns."""
    cols = f"{by}, " if by else ""
    part = f"PARTITION BY {cols}name"
    floors = " ".join(f"WHEN '{k}' THEN {v}" for k, v in quality.FLOORS.items())
    pick = ", ".join(f"max(most) FILTER (name = '{k}') AS {k}" for k in quality.FLOORS)
    return f"""{name} AS (SELECT {cols}max(docs) AS docs, {pick} FROM (
  SELECT {cols}name, max(docs) AS docs, min(bucket) FILTER (2 * seen >= docs)
         + {quality.REACH} * greatest(min(bucket) FILTER (2 * seen >= docs) - min(bucket) FILTER (4 * seen >= docs),
                                      CASE name {floors} END) AS most
  FROM (SELECT {cols}name, bucket, sum(n) OVER ({part} ORDER BY bucket) AS seen, sum(n) OVER ({part}) AS docs
        FROM (SELECT {cols}name, bucket, count(*) AS n FROM long GROUP BY {cols}name, bucket))
  GROUP BY {cols}name){f" GROUP BY {by}" if by else ""})"""


@query(rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 7], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS p FROM w)),
twice AS (SELECT doc_id, p FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, count(DISTINCT p + o) AS n FROM twice, (SELECT unnest(range(0, 8)) AS o) GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls,
             CAST(len([i FOR i IN range(2, len(ws) + 1) IF ws[i] = ws[i - 1]]) AS BIGINT) AS n_same_words,
             coalesce(rep.n, 0) AS n_repeat_words
      FROM w LEFT JOIN rep USING (doc_id)),
c AS (SELECT * EXCLUDE (ls), CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
b AS (SELECT *, least(1000 * n_symbols // greatest(word_chars, 1), 10000) AS symbols,
             least(1000 * n_dup_lines // greatest(n_lines, 1), 10000) AS lines,
             least(1000 * n_repeat_words // greatest(n_words, 1), 10000) AS repeats,
             least(1000 * n_same_words // greatest(n_words, 1), 10000) AS same,
             least(100 * word_chars // greatest(n_words, 1), 10000) AS length FROM c),
long AS (SELECT lang, source, unnest(['symbols', 'lines', 'repeats', 'same', 'length']) AS name,
                unnest([symbols, lines, repeats, same, length]) AS bucket FROM b WHERE NOT base_failed),
{_limit_sql("own", "lang, source")}, {_limit_sql("by_lang", "lang")}, {_limit_sql("whole", "")},
lim AS (SELECT own.lang, own.source, {", ".join(f"CASE WHEN own.docs >= 200 THEN own.{k} WHEN by_lang.docs >= 200 THEN by_lang.{k} ELSE whole.{k} END AS {k}" for k in quality.FLOORS)}
        FROM own JOIN by_lang ON own.lang IS NOT DISTINCT FROM by_lang.lang, whole)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"b.{k} <= lim.{k}" for k in quality.FLOORS)} AS kept
FROM b LEFT JOIN lim ON b.lang IS NOT DISTINCT FROM lim.lang AND b.source IS NOT DISTINCT FROM lim.source""")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and the verdict of the adaptive thresholds."""
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four leading whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _any_case(pattern: str) -> str:
    """Key words in either case, ASCII letters only."""
    key, rest = pattern[1:].split(")", 1)
    return "(" + re.sub("[a-z]", lambda m: f"[{m.group().upper()}{m.group()}]", key) + ")" + rest.replace("'", "''")


def _spans_sql(name: str, kind: str, pattern: str, least: str = "true") -> str:
    """Matches of a pattern with their places, from the texts between them."""
    return f"""{name} AS (SELECT row, kind, begins AS start, begins + length(m) AS stop, m FROM (
  SELECT row, '{kind}' AS kind, m, sum(length(g) + length(coalesce(before, ''))) OVER (PARTITION BY row ORDER BY i) AS begins FROM (
    SELECT row, i, ms[i] AS m, gs[i] AS g, CASE WHEN i > 1 THEN ms[i - 1] END AS before FROM (
      SELECT row, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM (
        SELECT row, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d)))) WHERE {least})"""


_ASSIGN_SQL, _NAMED_SQL = _any_case(secrets.ASSIGN), _any_case(secrets.NAMED)
_STRONG_SQL = ", ".join(f"'{k}'" for k in secrets.STRONG)
_RANK_SQL = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(secrets.KINDS)) + " END"
_ROLE_SQL = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in secrets.ROLES.items()) + " END"
_LISTED_SQL = f"string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, {_RANK_SQL})"


def _free_of(name: str, of: str, taken: str) -> str:
    return f"""{name} AS (SELECT * FROM {of} AS w WHERE NOT EXISTS (
  SELECT 1 FROM {taken} AS s WHERE s.row = w.row AND s.start < w.stop AND w.start < s.stop))"""


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
{_spans_sql("a", "assign", _ASSIGN_SQL, f"length(regexp_extract(m, '{_ASSIGN_SQL}', 2)) >= 6")},
{_spans_sql("k", "access", secrets.ACCESS)}, {_spans_sql("h", "hex", secrets.HEX)},
strong AS (SELECT * EXCLUDE (m) FROM (FROM a UNION ALL FROM k UNION ALL FROM h)),
{_spans_sql("named", "identifier", _NAMED_SQL, f"length(regexp_extract(m, '{_NAMED_SQL}', 2)) >= 3")},
{_free_of("ids", "named", "strong")},
taken AS (FROM strong UNION ALL SELECT * EXCLUDE (m) FROM ids),
{_spans_sql("runs", "token", f"{secrets.TOKEN}{{{secrets.LEAST_TOKEN},}}", "regexp_matches(m, '[0-9@:]')")},
cut AS (SELECT row, start + length(m) - length(ltrim(m, '.:')) AS start, trim(m, '.:') AS m FROM runs),
tokens AS (SELECT row, CASE
    WHEN regexp_full_match(m, '(?:{secrets.URL}|{secrets.ADDRESS}|{secrets.HOST_PORT})') THEN 'endpoint'
    WHEN regexp_full_match(m, '{secrets.MAIL}') THEN 'identifier'
    WHEN regexp_full_match(m, '{secrets.OPAQUE}') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')
         AND regexp_matches(m, '[0-9]') AND len(list_distinct(string_split(m, ''))) >= {secrets.LEAST_DISTINCT} THEN 'secret' END AS kind,
    start, start + length(m) AS stop FROM cut WHERE length(m) >= {secrets.LEAST_TOKEN}),
told AS (SELECT * FROM tokens WHERE kind IS NOT NULL),
{_free_of("free", "told", "taken")},
parts AS (SELECT row, kind, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop, kind IN ({_STRONG_SQL}) AS sure, {_ROLE_SQL} AS role,
                 {_RANK_SQL} AS rank, len(regexp_extract_all(substr(t, 1, CAST(start AS BIGINT)), '{secrets.BREAK}')) AS scope
          FROM (FROM taken UNION ALL SELECT row, kind, start, stop FROM free) JOIN d USING (row)),
near AS (SELECT w.row, w.kind, w.start, w.stop, w.role, bit_or(o.role) AS near, bit_or(CASE WHEN o.sure THEN o.role ELSE 0 END) AS firm
         FROM parts w JOIN parts o ON o.row = w.row AND o.scope = w.scope AND o.role <> w.role
          AND CASE WHEN (w.start, w.rank) < (o.start, o.rank) THEN o.start < w.stop + {secrets.REACH} ELSE w.start < o.stop + {secrets.REACH} END
         WHERE NOT w.sure GROUP BY ALL),
linked AS (SELECT row, kind, start, stop FROM near WHERE firm > 0 OR near | role = 7),
base AS (SELECT row, kind, start, stop FROM parts WHERE sure),
told_base AS (SELECT row, {_LISTED_SQL} AS spans, count(*) FILTER (kind = 'assign') AS n_assign,
                     count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex FROM base GROUP BY row),
told_all AS (SELECT row, {_LISTED_SQL} AS spans FROM (FROM base UNION ALL FROM linked) GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.spans, '')) AS base_sha256, coalesce(e.spans, '') AS spans
FROM d LEFT JOIN told_base b USING (row) LEFT JOIN told_all e USING (row)""")
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document and the parts linked to them."""
    out = secrets.scan(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda p: p["kind"].isin(*secrets.STRONG))
    return out.select("doc_id", *(count(k) for k in secrets.STRONG), F.sha2(secrets.listed(base), 256).alias("base_sha256"),
                      secrets.listed(F.col("spans")).alias("spans"))


@query(r"""
WITH RECURSIVE crc(n, c, k) AS (
  SELECT i, CAST(i AS BIGINT), 0 FROM (SELECT unnest(range(256)) AS i) UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8),
tab AS (SELECT list(c ORDER BY n) AS t FROM crc WHERE k = 8),
said AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id FROM conversations),
hit AS (SELECT * EXCLUDE (id, t), xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(id, '')]),
               lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 20 AS hit FROM said, tab),
damaged AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
                   CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM hit, LATERAL (SELECT unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))) WHERE hit <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS before,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again > 1 THEN 'd'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS again FROM damaged)),
step(q, x, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
-- what insertions alone can do between two rows
hop AS (SELECT q, q AS q2, 0 AS c, '' AS l FROM (SELECT unnest(range(4)) AS q) UNION ALL
        SELECT q, q2, 2, 'I' FROM step WHERE x <> 's' UNION ALL
        SELECT a.q, b.q2, 4, 'II' FROM step a JOIN step b ON b.q = a.q2 WHERE a.x <> 's' AND b.x <> 's'),
edit AS (SELECT conv_id, i, q, q2, CASE WHEN fault = 't' THEN 1 ELSE 0 END + CASE WHEN x = left(role, 1) THEN 0 ELSE 2 END AS c,
                CASE WHEN x = left(role, 1) THEN 'K' ELSE 'R' END AS l
         FROM r, step WHERE fault NOT IN ('b', 'd') AND (x = left(role, 1) OR x <> 's')
         UNION ALL SELECT conv_id, i, q, q, 3, 'D' FROM r, (SELECT unnest(range(4)) AS q)),
ids AS (SELECT DISTINCT conv_id FROM conversations),
-- lightest (cost, audit) of each state after each row, insertions before it included
path AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS given FROM ids
         UNION ALL
         SELECT conv_id, i, q, cost, audit, given FROM (
           SELECT p.conv_id, p.i + 1 AS i, e.q2 AS q, p.cost + h.c + e.c AS cost, p.audit || h.l || e.l AS audit, p.given AS given,
                  row_number() OVER (PARTITION BY p.conv_id, e.q2 ORDER BY p.cost + h.c + e.c, p.audit || h.l || e.l) AS best
           FROM path p JOIN hop h ON h.q = p.q JOIN edit e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.q = h.q2)
         WHERE best = 1),
size AS (SELECT conv_id, count(*) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (i > 1 AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
done AS (SELECT p.conv_id, cost + h.c AS cost, audit || h.l AS audit FROM path p LEFT JOIN size s ON s.conv_id IS NOT DISTINCT FROM p.conv_id
         JOIN hop h ON h.q = p.q AND h.q2 IN (0, 3) WHERE p.i = coalesce(n, 0)
         QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY cost + h.c, audit || h.l) = 1),
letter AS (SELECT conv_id, j, l, sum(CASE WHEN l = 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE WHEN l = 'D' THEN 0 ELSE 1 END) OVER w AS o,
                  sum(CASE WHEN l = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id) AS outs
           FROM (SELECT conv_id, j, audit[j] AS l FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM done))
           WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
line AS (SELECT t.conv_id, j, CASE WHEN l = 'K' THEN r.role WHEN (o - outs % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                || CASE WHEN l = 'I' THEN '' ELSE r.text END AS s
         FROM letter t LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i WHERE l <> 'D'),
whole AS (SELECT conv_id, string_agg(s, chr(10) ORDER BY j) AS s FROM line GROUP BY conv_id)
SELECT done.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(s, '')) AS repaired_sha256
FROM done LEFT JOIN size ON size.conv_id IS NOT DISTINCT FROM done.conv_id LEFT JOIN whole ON whole.conv_id IS NOT DISTINCT FROM done.conv_id""")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lightest repair of every damaged conversation."""
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")), texts=False)


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline.py`` one after another."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
