"""One query per operator, each over its whole tables, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.llm import filter_audit, language, licenses, spelling, token_codes, toxicity, url_filter
from gridstats.llm.bpe import encode
from gridstats.llm.decontaminate import contaminated
from gridstats.llm.ngram_join import jaccard_components
from gridstats.llm.pii import pseudonymise
from gridstats.llm.sharding import shard, size_of
from gridstats.llm.vectors import near_duplicates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


# All pairs that share a shingle, and the closure of the links by repeated minima.
ORACLE["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r AS (SELECT DISTINCT x AS node, x AS reached FROM e UNION SELECT r.node, e.y FROM r JOIN e ON r.reached = e.x),
c AS (SELECT node, min(reached) AS component FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, coalesce(c.component, s.doc_id) AS component_id FROM s LEFT JOIN c ON c.node = s.doc_id
"""


@query
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = encode(docs, public_tokenizers.path("word_bpe_49k.json"), decoded="decoded")
    listed = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return done.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op7_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.train(toxicity.with_labels(docs.where(~held_out), table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model)
    predicted = F.when(F.col("toxicity") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), predicted.alias("predicted"), F.size("toxic_passages").alias("n_passages"))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


# Every alignment of every document with every item, without seeds.
ORACLE["op4_benchmark_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
iw AS (SELECT item_id, len(w) AS n_words, unnest(w) AS word, unnest(range(len(w))) AS p FROM i),
a AS (SELECT doc_id, item_id, n_words, dw.p - iw.p AS start, count(*) AS matched FROM dw JOIN iw USING (word)
      GROUP BY ALL HAVING count(*) >= 0.8 * n_words),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, start) AS k FROM a)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(matched AS INTEGER) AS matched,
       CAST(n_words AS INTEGER) AS n_words, round(matched / n_words, 6) AS share FROM r WHERE k = 1
"""


@query
def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), "example key", count="n_values")


@query
def op9_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    done = shard(table(spark, sf_dir, "documents"), 16, F.xxhash64(text), size_of(F.col("text")))
    digest = F.crc32(text.cast("binary")).alias("text_crc32")
    return done.select("doc_id", size_of(F.col("text")).alias("size"), digest, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language.train(docs.where(~held_out))
    found = language.identify(docs.drop("lang"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_accepted").alias("accepted"))


@query
def op3_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


# The listed rules.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@query
def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.train(pages, URL_RULES), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_score")


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", F.round("dice", 6).alias("dice"), "kind", "place")


# Every segment of every document with every template.
ORACLE["op5_license_scan"] = (
    "WITH t(k, license, text) AS (VALUES "
    + ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(licenses.TEMPLATES))
    + r"""),
pieces AS (SELECT doc_id, string_split(text, chr(10)) AS l, regexp_split_to_array(text, '\n[ \t]*\n') AS p, text FROM documents),
s AS (SELECT doc_id, 0 AS kind, unnest(l) AS segment, unnest(range(len(l))) AS place FROM pieces
      UNION ALL SELECT doc_id, 1, unnest(p), unnest(range(len(p))) FROM pieces WHERE len(l) > 1
      UNION ALL SELECT doc_id, 2, text, 0 FROM pieces WHERE len(p) > 1),
sw AS (SELECT doc_id, kind, place, regexp_extract_all(lower(segment), '[\p{L}\p{N}]+') AS w FROM s),
sg AS (SELECT doc_id, kind, place, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM sw WHERE len(w) > 1),
tw AS (SELECT k, license, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM t),
tg AS (SELECT k, license, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM tw),
ug AS (SELECT k, license, len(g) AS a, unnest(g) AS g FROM tg),
n AS (SELECT doc_id, kind, place, len(g) AS b, unnest(g) AS g FROM sg),
d AS (SELECT doc_id, license, kind, place, 2.0 * count(*) / (a + b) AS dice FROM n JOIN ug USING (g)
      GROUP BY doc_id, license, k, kind, place, a, b HAVING 2.0 * count(*) / (a + b) >= 0.8),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, kind, place) AS q FROM d)
SELECT doc_id, license, round(dice, 6) AS dice, ['line', 'paragraph', 'text'][kind + 1] AS kind, place FROM r WHERE q = 1
"""
)


@query
def op11_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = token_codes.write_codes(docs, public_tokenizers.path("byte_bpe_50k.json"), token_codes.scratch_folder(spark))
    return token_codes.read_codes(files).withColumnRenamed("key", "doc_id")


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    flags = labels.select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audited(docs, filter_audit.quality_conditions(), F.col("lang"), flags, repeated="E")


# Every document through every step of every order.
ORACLE["op12_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (SELECT doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t),
  regexp_matches(t, '[#$%&*|]'), doc_id > least] AS fails FROM w),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT f.*, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM f LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
k AS (SELECT unnest(range(1, 6)) AS k),
o AS (SELECT [a.k, b.k, x.k, y.k, z.k] AS ks FROM k a, k b, k x, k y, k z WHERE len(list_distinct([a.k, b.k, x.k, y.k, z.k])) = 5),
s AS (SELECT array_to_string(list_transform(ks, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, k.k AS step, ks[k.k] AS own, ks[1:k.k - 1] AS earlier FROM o, k),
e AS (SELECT part, filter_order, step, own, n, good, toxic, fails[own] AS failed, len(list_filter(earlier, lambda k: fails[k])) > 0 AS gone,
  len(list_filter(fails, lambda x: x)) AS failed_by FROM c, s),
r AS (SELECT part, filter_order, step, own, CAST(coalesce(sum(n) FILTER (NOT failed AND NOT gone), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (failed AND NOT gone), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (failed AND gone), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (failed AND failed_by = 1), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (failed AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (failed AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM e GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.runs(table(spark, sf_dir, "documents").select("doc_id", "text"), 7)
    return spelling.variants(found.where("n >= 2"))


# crc32 step by step; near words by the words that one deletion leaves.
ORACLE["op13_spelling_variants"] = r"""
WITH RECURSIVE t AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
l AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY ALL),
b AS (SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END)) AS bytes FROM l),
h AS (SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) AS h FROM b, t),
d AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM w),
c AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS cut FROM x),
e AS (SELECT a.word, b.word AS other, b.n AS other_n FROM c a JOIN c b ON a.p = b.p AND a.cut = b.cut AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM c JOIN w ON c.cut = w.word UNION SELECT w.word, c.word, c.n FROM c JOIN w ON c.cut = w.word),
k AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM e),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form, CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM w LEFT JOIN k ON k.word = w.word AND k.k = 1),
g AS (SELECT word, word AS at, form FROM f UNION ALL SELECT g.word, g.form, f.form FROM g JOIN f ON f.word = g.form WHERE g.form IS NOT NULL)
SELECT f.word, f.form, g.at AS root, n, n_near, form_n FROM f JOIN g ON g.word = f.word AND g.form IS NULL
"""
