"""The registered queries of this subpackage and their SQL.

Each query applies its operator with production parameters to the whole of
its table and derives the digest columns from the operator's output.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.llm import decontaminate, jaccard_join, language_id, main_text, mixing, periodic_runs, quality_classifier, quality_rules, secret_scan, spelling_variants, token_files, toxicity, url_filter
from commitlake.llm.common import crc_mod, cut, table
from commitlake.session import scratch_path


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.with_hits(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), "hits"
    )
    n_hit = decontaminate.n_hit("hits")
    return found.select(
        "doc_id",
        "hits.n_words",
        n_hit.alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    net = language_id.train(docs.where(crc_mod("doc_id", 4) != 2))
    return docs.withColumn("x", language_id.language(F.col("text"), net)).select(
        "doc_id", held_out.alias("held_out"), F.col("x.lang").alias("lang_pred"), "x.score"
    )


#: Fixed values of the token files.
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def token_report(docs: DataFrame, known: int = token_files.KNOWN, keep: bool = True) -> DataFrame:
    """Writes token files of ``docs`` to a new folder below the checkpoint folder
    and reads them back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    path = scratch_path(docs.sparkSession, f"token-files-{uuid.uuid4().hex}")
    files = token_files.write(docs, path, public_tokenizers.path(TOKENIZER), END_ID, known=known, keep=keep)
    return files.read_all().select(
        F.col("key").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.Mix(docs).report().drop("source")


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages with ``good``: the labels of the document that the url's path names
    (``/en/825``): quality 1 and not toxic; null where it has no labels."""
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    rated = labels.where("quality IS NOT NULL").groupBy("doc_id")
    rated = rated.agg((F.min("quality") * (1 - F.coalesce(F.max("toxic"), F.lit(0))) > 0).alias("good"))
    number = F.regexp_extract(url_filter.path_of(F.col("url")), "^/[^/]*/([0-9]{1,18})", 1)
    named = pages.withColumn("doc_id", F.when(number != "", number).cast("long"))
    return named.join(rated, "doc_id", "left")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(page_outcomes(spark, sf_dir), F.col("good"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("stratum"), "text")
    counted = docs.withColumn("x", quality_rules.text_counts(F.col("text").cast("string")))
    counted = cut(counted.select("doc_id", "stratum", "x.*"))
    labels = table(spark, sf_dir, "labels").where("quality IS NOT NULL").groupBy("doc_id")
    labels = labels.agg((F.min("quality") == 1).alias("good"))
    judged = quality_rules.with_verdict(counted.join(labels, "doc_id", "left"), F.coalesce("good", F.lit(False)))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.JaccardJoin(docs).result().withColumnRenamed("n", "n_shingles")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    model = toxicity.train(docs, labels.where(crc_mod("doc_id", 5) != 0))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = quality_classifier.train(docs, labels.where(crc_mod("doc_id", 4) != 2))
    score = quality_classifier.quality(F.col("text"), spark.sparkContext.broadcast(model))
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def planted_runs(doc_id: Column, text: Column) -> Column:
    """The text; of a tenth of the ids (by crc32 of their decimal form) with a tail of
    words that repeats: word i >= a becomes word a + (i - a) % p. A null id or
    text stays as it is."""

    def plant(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            out = texts.to_pylist()
            for row, key in enumerate(ids.to_pylist()):
                h = 1 if key is None else zlib.crc32(key.encode())
                words = (out[row] or "").encode().split() if h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    period = 1 + (n - a) // (3 + g % 8)
                    tail = words[a : a + period]
                    times = -(-(n - a) // period)
                    out[row] = b" ".join(words[:a] + (tail * times)[: n - a]).decode()
            yield pa.array(out, pa.string())

    return F.arrow_udf(plant, "string").asNondeterministic()(doc_id.cast("string"), text.cast("string"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", periodic_runs.periodic_runs(planted_runs(F.col("doc_id"), F.col("text"))).alias("x"))
    # longest first, then smallest start, then period
    best = F.array_min(F.transform("x.runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    found = found.select("doc_id", "x", best.alias("best"))
    length, period = -F.col("best.col1"), F.col("best.period")
    lines = F.transform("x.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("x.runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("x.collapsed", 256).alias("collapsed_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = spelling_variants.count_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = spelling_variants.variants(counted.where("n >= 5"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.main_text(pages, url_filter.host_of(F.col("url"))).select("page_id", "url", "main.*")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, len(w[i:i+9]) AS n, w[i:i+9] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, i, n, w[i:i+n-1] AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, win)),
hw AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
hi AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)"""

_OP6_LEVEL = """
  SELECT {key}, {parent}, n, good, n + m AS weight, (good + m * mu) / (n + m) AS mean
  FROM {name}, (
    SELECT 1 / least(greatest(coalesce((sum(n * pow(good / n - mu, 2)) FILTER (n > 0) - sum(mu * (1 - mu)) FILTER (n > 0))
               / nullif(sum((n - 1) * mu * (1 - mu)) FILTER (n > 0), 0), 0.001), 0.001), 0.5) - 1 AS m FROM {name})"""

_BAR, _SURE, _WIDE, _POINTS = url_filter.MIN_GOOD, url_filter.SURE, url_filter.WIDE, url_filter.POINTS
_SUFFIX_LIST = ", ".join(f"'{x}'" for x in url_filter.SUFFIXES)
_OP6_PART = (
    "list_sum(list_transform(range(0, %d), lambda i: exp(a * ln(sin({first} + (i + 0.5) * (({last} - {first}) / %d)))"
    " + b * ln(cos({first} + (i + 0.5) * (({last} - {first}) / %d))) - top))) * (({last} - {first}) / %d)"
) % ((_POINTS,) * 4)

_OP6 = rf"""
WITH rated AS (
  SELECT doc_id, min(quality) * (1 - coalesce(max(toxic), 0)) > 0 AS good
  FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN ''
                             ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages)),
q AS (
  SELECT p.*, good FROM p LEFT JOIN rated
  ON rated.doc_id = TRY_CAST(nullif(regexp_extract(path, '^/[^/]*/([0-9]{{1,18}})', 1), '') AS BIGINT)),
b0 AS (SELECT regexp_replace(host, ':[0-9]*$', '') AS host, good FROM q),
s9 AS (SELECT host, coalesce(max_by(s, length(s)), regexp_extract(host, '[^.]*$')) AS suffix
       FROM (SELECT DISTINCT host FROM b0) LEFT JOIN (SELECT unnest([{_SUFFIX_LIST}]) AS s)
         ON ends_with('.' || host, '.' || s) GROUP BY host),
h0 AS (
  SELECT host, count(good) AS n, count(*) FILTER (good) AS good, suffix,
         CASE WHEN length(host) <= length(suffix) THEN host
              ELSE regexp_extract(left(host, length(host) - length(suffix) - 1), '[^.]*$') || '.' || suffix END AS domain
  FROM b0 JOIN s9 USING (host) GROUP BY host, suffix),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h0 GROUP BY ALL),
s0 AS (SELECT suffix, '' AS top, sum(n) AS n, sum(good) AS good,
              (sum(sum(good)) OVER () + 1) / (sum(sum(n)) OVER () + 2) AS mu FROM d0 GROUP BY suffix),
s AS ({_OP6_LEVEL.format(key="suffix", parent="top", name="s0")}),
d1 AS (SELECT d0.*, s.mean AS mu FROM d0 JOIN s USING (suffix)),
d AS ({_OP6_LEVEL.format(key="domain", parent="suffix", name="d1")}),
h1 AS (SELECT h0.*, d.mean AS mu FROM h0 JOIN d USING (domain)),
h AS ({_OP6_LEVEL.format(key="host", parent="domain", name="h1")}),
u0 AS (
  SELECT host, 2 * mean * weight - 1 AS a, 2 * (1 - mean) * weight - 1 AS b, asin(sqrt(mean)) AS peak,
         greatest(0, asin(sqrt(mean)) - {_WIDE} / (2 * sqrt(weight + 1))) AS low,
         least(pi() / 2, asin(sqrt(mean)) + {_WIDE} / (2 * sqrt(weight + 1))) AS high
  FROM h WHERE mean < {_BAR}),
u1 AS (SELECT *, least(greatest(asin(sqrt({_BAR})), low), high) AS middle, a * ln(sin(peak)) + b * ln(cos(peak)) AS top FROM u0),
u2 AS (
  SELECT host, {_OP6_PART.format(first="low", last="middle")} AS under, {_OP6_PART.format(first="middle", last="high")} AS over
  FROM u1),
v AS (SELECT host AS bare, coalesce(under / (under + over) >= {_SURE}, false) AND (SELECT sum(n) FROM h0) > 0 AS blocked
      FROM h LEFT JOIN u2 USING (host)),
r AS (
  SELECT page_id, host, path, blocked, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM q JOIN v ON bare = regexp_replace(host, ':[0-9]*$', ''))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM r"""

_OP8 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
s AS (
  SELECT DISTINCT r, w[i:i+2] AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS (
  SELECT x, y FROM (SELECT a.r AS x, b.r AS y, count(*) AS o FROM s a JOIN s b USING (g) WHERE a.r <> b.r GROUP BY ALL)
  JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * o >= 90 * (p.n + q.n - o)),
c AS (SELECT r, r AS o FROM d UNION SELECT c.r, l.y FROM c JOIN l ON l.x = c.o)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(e.doc_id) AS component_id
FROM c JOIN d USING (r) JOIN d e ON e.r = c.o LEFT JOIN n ON n.r = d.r GROUP BY d.r, d.doc_id, n.n"""

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_language_id": op2_language_id,
    "op3_token_files": op3_token_files,
    "op4_secret_scan": op4_secret_scan,
    "op5_mixing": op5_mixing,
    "op6_url_filter": op6_url_filter,
    "op7_quality_rules": op7_quality_rules,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_toxicity": op9_toxicity,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_main_text": op13_main_text,
}
ORACLE_SQL = {"op1_decontaminate": _OP1, "op6_url_filter": _OP6, "op8_jaccard_join": _OP8}
