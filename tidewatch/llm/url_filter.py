"""Verdicts on urls: rules by host and path, and boosted trees for the rest.

Rules are looked up: a url asks for each suffix of its host, and of the rules found the longest
whose path begins the url's path wins. Urls with a rule are the labelled ones: gradient-boosted
trees learn block and allow from a bounded sample of them and judge the urls without a rule.

The trees see lexical features only: lengths and depth of host, path and query, share of digits,
letters, hyphens and dots, entropy of the characters, numbers of parameters, of subdomains and of
digits in the last path segment, and two statistics of the url's host suffix and first path
segment: how often each occurs, and the share of blocked urls among the sample's, smoothed.

Everything is DataFrame operations; the trees are Spark's. Rows: a null url, or one without
``://``, has an empty host and path, so no rule, and is judged like the others. Without labels of
both kinds every url without a rule gets the labels' only verdict, or ``allow`` where there is none.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.staging import stage

#: ``(host, path, verdict)``
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Labelled urls that the trees learn from, at most.
SAMPLE = 20_000
TREES = 12
DEPTH = 4
SEED = 7
#: Weight of the overall share in a smoothed one.
PRIOR = 20.0

FEATURES = (
    "n_url", "n_host", "n_path", "n_query", "depth", "subdomains", "parameters", "digit_share",
    "letter_share", "hyphens", "dots", "entropy", "last_digits", "longest_run", "tls", "fragment",
    "suffix_count", "suffix_share", "segment_count", "segment_share",
)


def parts(pages: DataFrame, id: str, url: str) -> DataFrame:
    """``id, u, host, path, query`` of each page."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = pages.select(F.col(id).alias("id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("u"))
    rows = rows.withColumn("rest", F.expr("if(locate('://', u) > 0, substring(u, locate('://', u) + 3), '')"))
    rows = rows.withColumn("raw", F.regexp_extract("rest", r"^[^/?#]*", 0))
    rows = rows.withColumn("after", F.expr("substring(rest, length(raw) + 1)"))
    return rows.select(
        "id", "u", F.translate("raw", upper, lower).alias("host"),
        F.regexp_extract("after", r"^[^?#]*", 0).alias("path"),
        F.regexp_extract("after", r"^[^?#]*\?([^#]*)", 1).alias("query"),
    )


def with_rules(rows: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Adds ``rule`` and ``ruled``, the verdict of the longest rule that fits."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    known = F.create_map(
        *[x for h in dict.fromkeys(r[0] for r in rules) for x in (
            F.lit(h),
            F.array(*[F.struct(F.lit(p).alias("path"), F.lit(v).alias("verdict")) for host, p, v in rules if host == h]),
        )]
    )
    fits = F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(
                F.filter(F.coalesce(known[s], F.array().cast("array<struct<path:string,verdict:string>>")),
                         lambda r: F.col("path").startswith(r["path"])),
                lambda r: F.struct(
                    (F.length(s) + F.length(r["path"])).alias("n"), F.concat(s, r["path"]).alias("rule"),
                    r["verdict"].alias("verdict"),
                ),
            ),
        )
    )
    rows = rows.withColumn("fit", F.array_max(fits))
    return rows.withColumns({"rule": F.col("fit.rule"), "ruled": F.col("fit.verdict")}).drop("fit")


def _count(text: str, pattern: str) -> Column:
    return F.regexp_count(F.col(text), F.lit(pattern)).cast("double")


def lexical(rows: DataFrame) -> DataFrame:
    chars = F.filter(F.split("u", ""), lambda c: c != "")
    n = F.greatest(F.length("u"), F.lit(1)).cast("double")
    times = F.transform(
        F.array_distinct("chars"),
        lambda c: F.size(F.filter("chars", lambda x: x == c)).cast("double") / n,
    )
    entropy = F.aggregate(times, F.lit(0.0), lambda total, p: total - p * F.log2(p))
    last = F.regexp_extract("path", r"([^/]*)/?$", 1)
    rows = rows.withColumns({"chars": chars, "last": last})
    return rows.withColumns(
        {
            "n_url": F.length("u").cast("double"),
            "n_host": F.length("host").cast("double"),
            "n_path": F.length("path").cast("double"),
            "n_query": F.length("query").cast("double"),
            "depth": _count("path", "/[^/]"),
            "subdomains": _count("host", r"\."),
            "parameters": F.when(F.col("query") == "", 0.0).otherwise(1.0 + _count("query", "&")),
            "digit_share": _count("u", "[0-9]") / n,
            "letter_share": _count("u", "[A-Za-z]") / n,
            "hyphens": _count("u", "-"),
            "dots": _count("u", r"\."),
            "entropy": entropy,
            "last_digits": _count("last", "[0-9]"),
            "longest_run": F.coalesce(
                F.array_max(F.transform(F.split("u", "[^A-Za-z]+"), lambda x: F.length(x))), F.lit(0)
            ).cast("double"),
            "tls": F.col("u").startswith("https:").cast("double"),
            "fragment": F.col("u").contains("#").cast("double"),
            "suffix": F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0),
            "segment": F.regexp_extract("path", r"^/?([^/]*)", 1),
        }
    ).drop("chars", "last")


def _statistics(rows: DataFrame, sample: DataFrame, name: str, share: float) -> DataFrame:
    """``name``, its count over all urls, and its smoothed share of blocked urls in the sample."""
    counts = rows.groupBy(name).agg(F.log1p(F.count(F.lit(1))).alias(f"{name}_count"))
    blocked = sample.groupBy(name).agg(
        ((F.sum("target") + share * PRIOR) / (F.count(F.lit(1)) + PRIOR)).alias(f"{name}_share")
    )
    return counts.join(blocked, name, "left").withColumn(f"{name}_share", F.coalesce(f"{name}_share", F.lit(share)))


def judge(pages: DataFrame, rules: tuple = RULES, id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of all rows; the score is null where a rule decides."""
    rows = stage(lexical(with_rules(parts(pages, id, url), rules)), "urls")
    output = ["id", "host", "path", "rule"]
    labelled = rows.where("ruled is not null").withColumn("target", (F.col("ruled") == "block").cast("double"))
    order = F.xxhash64("u", "id")
    last = labelled.select(order.alias("mark")).orderBy("mark").limit(SAMPLE).agg(F.max("mark")).head()[0]
    sample = stage(labelled.where(order <= F.lit(last)), "labelled")
    mean, low, high = sample.agg(F.avg("target"), F.min("target"), F.max("target")).head()
    done = rows.where("ruled is not null").select(*output, F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("score"))
    left = rows.where("ruled is null")
    if low == high:
        verdict = "block" if low == 1.0 else "allow"
        judged = left.select(*output, F.lit(verdict).alias("verdict"), F.lit(low or 0.0).alias("score"))
    else:
        for name in ("suffix", "segment"):
            known = stage(_statistics(rows, sample, name, mean), name)
            sample, left = sample.join(known, name), left.join(known, name)
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        trees = GBTClassifier(labelCol="target", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
        taught = vector.transform(sample).select("target", "features", order.alias("mark"))
        model = trees.fit(taught.repartitionByRange(4, "mark").sortWithinPartitions("mark"))
        judged = model.transform(vector.transform(left)).select(
            *output, F.when(F.col("prediction") == 1.0, "block").otherwise("allow").alias("verdict"),
            vector_to_array("probability")[1].alias("score"),
        )
    return done.unionByName(judged).withColumnRenamed("id", id)
