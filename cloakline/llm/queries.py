"""The queries ``opN_<name>`` and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakline.llm import (
    decontam, embeddings, langid, lines, lpf, minhash, mixing, pages, phrases, runs, secrets, sentences, toxicity,
)
from cloakline.llm.common import identity, table, text_batches, utf8

Query = Callable[[SparkSession, str], DataFrame]


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_secrets(spark: SparkSession, sf: str) -> DataFrame:
    out = secrets.find_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE]

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select(
        "doc_id", *map(number, base),
        sha256(secrets.listing(F.filter("spans", lambda s: s["kind"].isin(*base)))).alias("base_sha256"),
        secrets.listing(F.col("spans")).alias("spans"))


def op2_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = F.coalesce(remainder(5) == 0, F.lit(False))
    base = langid.train(docs.where(~held).select("text", "lang"))
    out = langid.predict(docs.select("doc_id", "text"), base, "p")
    return out.select("doc_id", held.alias("held_out"), "p.lang_pred", "p.score")


def op3_lpf(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    cut = lpf.removed(docs).select("_k", "_h", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    text = utf8("text")
    rows = docs.select("doc_id", *identity(), F.octet_length(text).cast("long").alias("n_bytes"), sha256(text).alias("s"))
    none = F.lit(0).cast("long")
    return rows.join(cut, ["_k", "_h"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("kept_sha256", "s").alias("kept_sha256"))


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    p = mixing.plan(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return p.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op5_minhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    near = minhash.near_duplicates(docs, width=4, least=80)
    out = docs.select("doc_id", *identity()).join(near, ["_k", "_h"])
    return out.select("doc_id", "n_shingles", "component_id", (F.col("component_id") == F.col("_k")).alias("kept"))


def op6_lines(spark: SparkSession, sf: str) -> DataFrame:
    out = lines.drop_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op7_decontam(spark: SparkSession, sf: str) -> DataFrame:
    out = decontam.mark_contaminated(
        table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    items = F.array_sort("items")
    return out.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      sha256(F.array_join(items, ",")).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op8_sentences(spark: SparkSession, sf: str) -> DataFrame:
    out = sentences.drop_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_sentences", "n_removed",
                      sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op9_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    out = embeddings.near_vectors(table(spark, sf, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held = F.coalesce(remainder(4) == 2, F.lit(False))
    model = toxicity.train(docs.where(~held), table(spark, sf, "labels"))
    out = toxicity.with_score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.mine(table(spark, sf, "documents").select("lang", "text"))


def repeated_tail(words: Column) -> Column:
    """The words of one document in ten with its tail made periodic, as the contract of operator 12 has it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size(words)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    tail = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))
    return F.when((h % 10 == 0) & (n > 0), tail).otherwise(words)


def op12_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", runs.words("text").alias("w"))
    out = runs.find_runs(docs.select("doc_id", repeated_tail(F.col("w")).alias("w")), F.col("w"), "found")
    best = F.array_min(F.transform("found.runs", lambda r: F.struct(
        (-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.array_join(F.transform("found.runs", lambda r: F.format_string(
        "%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    length = -F.col("best.length")
    return out.withColumn("best", best).select(
        "doc_id", F.size("found.runs").cast("long").alias("n_runs"), "best.start", length.alias("length"), "best.period",
        F.floor(1000 * length / F.col("best.period")).alias("exponent_milli"),
        sha256(listed).alias("runs_sha256"), sha256(F.col("found.collapsed")).alias("collapsed_sha256"))


def op13_pages(spark: SparkSession, sf: str) -> DataFrame:
    out = pages.extract(table(spark, sf, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def _query(f: Query) -> Query:
    @wraps(f)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        text_batches(spark)
        return f(spark, sf)

    return run


QUERIES: dict[str, Query] = {f.__name__: _query(f) for f in (
    op1_secrets, op2_language, op3_lpf, op4_mixing, op5_minhash, op6_lines, op7_decontam, op8_sentences,
    op9_embeddings, op10_toxicity, op11_phrases, op12_runs, op13_pages,
)}
ORACLES: dict[str, str] = {}

_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op5_minhash"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c
  FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p WHERE 100 * c >= 80 * (nx + ny - c)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS node, doc_id AS low FROM documents
      UNION SELECT l.y, r.low FROM r JOIN l ON l.x = r.node WHERE r.low < l.y)
SELECT s.doc_id, len(s.s) AS n_shingles, c.low AS component_id, c.low = s.doc_id AS kept
FROM s JOIN (SELECT node, min(low) AS low FROM r GROUP BY node) c ON c.node = s.doc_id"""

ORACLES["op6_lines"] = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
k AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line,
    {_FOLD.format("trim(unnest(l), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM d),
h AS (SELECT k FROM k WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(h.k) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN h.k IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM k LEFT JOIN h ON k.k = h.k GROUP BY doc_id"""

_ALNUM = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
ORACLES["op7_decontam"] = f"""
WITH b AS (
  SELECT item_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM benchmark),
win AS (
  SELECT item_id, least(len(w), 10) AS k,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS g
  FROM b WHERE len(w) > 0),
d AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents),
ks AS (SELECT DISTINCT k FROM win),
dw AS (
  SELECT doc_id, k, generate_subscripts(range(1, len(w) - k + 2), 1) AS i,
    unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
  FROM d, ks WHERE len(w) >= k),
m AS (SELECT doc_id, i, dw.k, item_id FROM dw JOIN win ON dw.g = win.g AND dw.k = win.k),
hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM m) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items,
  sha256(coalesce(it.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""


def _quoted(pattern: str) -> str:
    """The pattern within SQL text: quotes doubled."""
    return pattern.replace("'", "''")


def _secrets_sql() -> str:
    """Matches are marked by two private characters; lengths before a mark give its place."""
    parts = []
    for order, r in enumerate(secrets.RULES):
        pattern = _quoted(r.pattern)
        flags = "(?i)" if r.fold else ""
        n = f"len(regexp_extract(m, '^{flags}{pattern}$', 2))" if "(" in r.pattern and r.kind == "assign" else "len(m)"
        parts.append(f"""
  SELECT doc_id, {order} AS o, '{r.kind}' AS kind, s, s + len(m) AS e FROM (
    SELECT doc_id, split_part(p[i], chr(57345), 1) AS m,
      list_sum(list_transform(p[:i - 1], lambda x: len(x))) - (i - 2) AS s
    FROM (SELECT doc_id, p, unnest(range(2, len(p) + 1)) AS i FROM (
      SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '{flags}({pattern})',
        chr(57344) || '\\1' || chr(57345), 'g'), chr(57344)) AS p FROM documents)))
  WHERE {n} >= {r.least}""")
    listed = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o){0}, '')"
    count = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    base = " FILTER (o < %d)" % len(secrets.BASE)
    return f"""WITH f AS ({" UNION ALL ".join(parts)})
SELECT d.doc_id, {count}, sha256({listed.format(base)}) AS base_sha256, {listed.format(" FILTER (kind IS NOT NULL)")} AS spans
FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id"""


ORACLES["op1_secrets"] = _secrets_sql()

ORACLES["op3_lpf"] = """
WITH RECURSIVE d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (
  SELECT doc_id, i, md5(b[i + 1:i + 100]) AS w
  FROM (SELECT doc_id, b, unnest(range(octet_length(b) - 99)) AS i FROM d WHERE octet_length(b) >= 100)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM w),
g AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM f WHERE r > 1),
h AS (SELECT doc_id, i, sum((before IS NULL OR i > before + 100)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM g),
s AS (SELECT doc_id, n, min(i) AS a, max(i) + 100 AS b FROM h GROUP BY doc_id, n),
k AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b
  FROM s GROUP BY doc_id),
t AS (
  SELECT d.doc_id, octet_length(d.b)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    CASE WHEN n_removed IS NULL THEN sha256(d.b) ELSE sha256(unhex(list_reduce(list_prepend('', list_transform(
      range(1, len(k.a) + 2), lambda j: hex(d.b[CASE WHEN j = 1 THEN 1 ELSE k.b[j - 1] + 1 END:
        CASE WHEN j > len(k.a) THEN octet_length(d.b) ELSE k.a[j] END]))), lambda x, y: x || y))) END AS kept_sha256
  FROM d LEFT JOIN k USING (doc_id))
SELECT * FROM t"""

ORACLES["op9_embeddings"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x),
r AS (SELECT vec_id AS node, vec_id AS low FROM embeddings
      UNION SELECT l.y, r.low FROM r JOIN l ON l.x = r.node WHERE r.low < l.y)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.low AS component_id, c.low = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.x = e.vec_id
JOIN (SELECT node, min(low) AS low FROM r GROUP BY node) c ON c.node = e.vec_id"""

_PIECES = f"string_split_regex({_FOLD.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')"
ORACLES["op11_phrases"] = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda k: list_transform(
  range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase FROM w),
f AS (SELECT lang, phrase, count(*) AS f, len(string_split(phrase, ' ')) AS k FROM g GROUP BY lang, phrase),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, k FROM f WHERE k > 1 AND f >= 100),
held AS (SELECT lang, phrase, max(a) AS most FROM (
  SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(
    range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS phrase FROM c WHERE k > 2) GROUP BY ALL),
cuts AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS cut FROM c),
s AS (
  SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, n,
    ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[cut + 1:cuts.k], ' ') JOIN n ON n.lang = cuts.lang),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
r AS (
  SELECT low.*, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, low.phrase) AS rank
  FROM low LEFT JOIN held ON held.lang = low.lang AND held.phrase = low.phrase WHERE coalesce(most < a, true))
SELECT lang, rank, phrase, a, l, r, n, score FROM r WHERE rank <= 2000"""

ORACLES["op12_runs"] = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))),
      lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS h
  FROM documents),
g AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS tail, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
x AS (
  SELECT doc_id, n, CASE WHEN tail THEN list_transform(range(n), lambda i:
    CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM p),
t AS (
  SELECT doc_id, i - 1 AS i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t
  FROM (SELECT doc_id, w, unnest(range(1, n - 1)) AS i FROM x WHERE n > 5)),
often AS (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS c FROM t QUALIFY c >= 3),
m AS (
  SELECT a.doc_id, b.i - a.i AS q, a.i FROM often a JOIN often b ON a.doc_id = b.doc_id AND a.t = b.t AND b.i > a.i),
island AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM m),
per AS (SELECT doc_id, q, min(i) AS s, count(*) + 2 + q AS len FROM island GROUP BY doc_id, q, k),
run AS (SELECT doc_id, s, len, min(q) AS q FROM per WHERE len >= greatest(6, 4 * q) GROUP BY doc_id, s, len),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (
  SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM x) x
  LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i WHERE gone.i IS NULL GROUP BY x.doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listing,
    min({'len': -len, 's': s, 'q': q}) AS best FROM run GROUP BY doc_id)
SELECT x.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.len AS length, best.q AS period,
  (1000 * -best.len) // best.q AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256,
  sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM x LEFT JOIN listed ON listed.doc_id = x.doc_id LEFT JOIN kept ON kept.doc_id = x.doc_id"""
