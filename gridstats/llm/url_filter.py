"""URL verdicts: listed rules first, and gradient-boosted trees on lexical features for what no rule covers.

A rule is a host and a path prefix with a verdict; it covers the host with all its subdomains, and the longest rule
that fits decides. The trees learn from the URLs that rules decide, from features of the URL's text alone: lengths,
depth, shares of digits, entropy, parameters, and how often URLs with the same end of the host were blocked.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridstats.functions.binding import let
from gridstats.llm.columns import unused
from gridstats.plans.sizing import broadcast_if_small, spill

SAMPLE = 50_000  # different URLs of each verdict that the trees are fitted to; suffix statistics cover all
SPARE = 50  # further URLs drawn beyond twice the sample, so that even a sample of one is found
TREES, DEPTH = 20, 4
PRIOR = 10.0  # URLs of even odds added to the count of each host suffix
FEATURES = (
    "url_length", "host_length", "path_length", "query_length", "depth", "host_labels", "digit_ratio", "host_digit_ratio",
    "letter_ratio", "hyphens", "entropy", "parameters", "fragment", "secure", "extension", "longest_run", "suffix1", "suffix2",
)

Rule = tuple[str, str, str]  # host, path prefix, allow or block


@dataclass(frozen=True)
class UrlModel:
    trees: GBTClassificationModel | None
    suffixes: DataFrame | None  # suffix, blocked share


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to one of ``/?#``, and from there up to ``?`` or ``#``; else both empty."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def decided(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. Of equal length the first listed."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    for rule_host, rule_path, rule_verdict in reversed(ordered):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, rule_verdict).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Bits per character, of the whole text: equal characters are sorted side by side and their runs summed."""
    weight = lambda n: n * F.log2(F.greatest(n, F.lit(1)).cast("double"))

    def add(state: Column, c: Column) -> Column:
        same = state["c"] == c
        total = F.when(same, state["s"]).otherwise(state["s"] + weight(state["n"]))
        return F.struct(c.alias("c"), F.when(same, state["n"] + 1).otherwise(1).alias("n"), total.alias("s"))

    def of(chars: Column) -> Column:
        begin = F.struct(F.lit("").alias("c"), F.lit(0).alias("n"), F.lit(0.0).alias("s"))
        own = F.aggregate(F.sort_array(chars), begin, add, lambda state: state["s"] + weight(state["n"]))
        return F.greatest(F.lit(0.0), F.log2(F.size(chars).cast("double")) - own / F.size(chars))

    return F.when(F.length(text) > 0, let(F.split(text, ""), of)).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    def share(text: Column, kept: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{kept}]", "")) / F.greatest(F.length(text), F.lit(1))

    count = lambda text, what: F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    runs = F.transform(F.split(F.concat_ws("/", host, path), r"[^A-Za-z0-9]+"), lambda x: F.length(x))
    return {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "query_length": F.length(query),
        "depth": count(path, "/"), "host_labels": count(host, ".") + F.when(host != "", 1).otherwise(0),
        "digit_ratio": share(url, "0-9"), "host_digit_ratio": share(host, "0-9"), "letter_ratio": share(url, "A-Za-z"), "hyphens": count(url, "-"),
        "entropy": entropy(url), "parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "fragment": url.contains("#").cast("int"), "secure": url.startswith("https://").cast("int"),
        "extension": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"), "longest_run": F.coalesce(F.array_max(runs), F.lit(0)),
    }


def described(pages: DataFrame, url: str, rules: Sequence[Rule]) -> DataFrame:
    """``pages`` with _host, _path, _rule, _given and the lexical features under names of their own."""
    names = [f"_c{i}" for i in range(len(pages.columns))]
    rows = pages.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(pages.columns, names, strict=True)], F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")).alias("_url"))
    host, path = parts(F.col("_url"))
    rows = rows.withColumns({"_host": host, "_path": path})
    rule, verdict = decided(F.col("_host"), F.col("_path"), rules)
    rows = rows.withColumns({"_rule": rule, "_given": verdict})
    features = lexical(F.col("_url"), F.col("_host"), F.col("_path"))
    return rows.withColumns({f"f_{n}": c.cast("double") for n, c in features.items()} | {f"s{k}": F.substring_index("_host", ".", -k) for k in (1, 2)})


def with_suffixes(rows: DataFrame, suffixes: DataFrame | None) -> DataFrame:
    for k in (1, 2):
        if suffixes is None:
            rows = rows.withColumn(f"f_suffix{k}", F.lit(0.5))
            continue
        own = broadcast_if_small(suffixes.select(F.col("suffix").alias(f"s{k}"), F.col("share").alias(f"f_suffix{k}")))
        rows = rows.join(own, f"s{k}", "left").withColumn(f"f_suffix{k}", F.coalesce(f"f_suffix{k}", F.lit(0.5)))
    return rows


def train(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> UrlModel:
    """Trees from the URLs that a rule decides: up to ``SAMPLE`` different ones of each verdict, those with the smallest hash.

    Without URLs of both verdicts there are no trees, and what no rule covers is allowed.
    """
    rows = described(pages.select(url), url, rules).where("_given is not null").withColumn("label", (F.col("_given") == "block").cast("double"))
    rows = rows.withColumn("h", F.xxhash64("_url", F.lit(3)))
    # copies share a hash, so the share is one of different URLs
    found = dict(map(tuple, rows.select("label", "h").distinct().groupBy("label").count().collect()))
    if len(found) < 2:
        return UrlModel(None, None)
    own = rows.select("label", F.explode(F.array_distinct(F.array("s1", "s2"))).alias("suffix"))
    suffixes = own.groupBy("suffix").agg(((F.sum("label") + PRIOR / 2) / (F.count("*") + PRIOR)).alias("share"))
    suffixes = spill(suffixes)
    share = F.when(F.col("label") == 1, (2 * SAMPLE + SPARE) / found[1.0]).otherwise((2 * SAMPLE + SPARE) / found[0.0])
    drawn = rows.where((F.col("h") / 2.0**64 + 0.5 < share) | (share >= 1)).dropDuplicates(["label", "h"])
    first = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    drawn = drawn.withColumn("r", first).where(F.col("r") <= SAMPLE)
    drawn = with_suffixes(drawn, suffixes).select("label", *[f"f_{n}" for n in FEATURES])
    drawn = spill(VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(drawn).select("label", "features"))
    return UrlModel(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1).fit(drawn), suffixes)


def judge(pages: DataFrame, model: UrlModel, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and block_score (null where a rule decides).

    A null URL counts as empty: host and path are empty and the trees decide. All rows stay; columns of the new names
    are replaced.
    """
    added = ["host", "path", "rule", "verdict", "block_score"]
    kept = [c for c in pages.columns if c.lower() not in added]
    place = unused(pages, "judged_url")
    given = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{url}`").alias(place))
    rows = with_suffixes(described(given, place, rules), model.suffixes)
    score = F.lit(0.0)
    if model.trees is not None:
        rows = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(rows)
        rows, score = model.trees.transform(rows), vector_to_array(F.col("probability"))[1]
    own = F.when(F.col("_given").isNull(), score)
    verdict = F.coalesce("_given", F.when(own >= 0.5, "block").otherwise("allow"))
    columns = [F.col(f"_c{i}").alias(c) for i, c in enumerate(kept)]
    return rows.select(*columns, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), verdict.alias("verdict"), own.alias("block_score"))
