"""Personal data: base patterns, and unseen identifiers found by bootstrapped contexts.

Base spans are the leftmost non-overlapping matches of each kind's expression that pass its test.
They are the seeds. The words beside a seed are its lexical patterns (the last one and the last two
before it, the first one and the first two after it). Words with a digit and at least ``SHORTEST``
characters that no base span touches are the candidates, and the same words beside them make
the graph of patterns and instances. Scores go back and forth over its distinct edges ``ROUNDS`` times:

* a pattern's confidence in a kind is the mean score of its distinct instances, with ``PRIOR``
  instances of score 0 added, if its instances of score 1 or more than ``SURE`` are at least ``SUPPORT``;
* an instance that is no seed scores one minus the product of its patterns' doubts (seeds stay 1).

A candidate becomes a span of a kind where one of its patterns there has at least ``SURE``
confidence and its own score reaches it. Base spans stay as they are; ``n_email`` and the like count them.

Only DataFrame operations. A text is scanned once; what goes on is spans and words. An edge is one row
however often a passage is repeated. Expressions are written so that no scan backs up: a match may only
begin where a run of its characters begins or the match before ended, and runs are possessive.

Rows: null text is empty; every row is a document of its own, also if its id is null or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.staging import stage

KINDS = ("email", "ip", "card", "phone")
EXPRESSIONS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
CANDIDATE = r"(?<![A-Za-z0-9])(?=[A-Za-z._-]{0,32}[0-9])[A-Za-z0-9][A-Za-z0-9._-]{5,}+"
SHORTEST = 6
#: Characters beside a match in which its words are looked for.
BESIDE = 48
ROUNDS = 3
SURE = 0.8
SUPPORT = 3
PRIOR = 1.0


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, k: Column) -> Column:
        digit = F.substring(digits, k, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when((n - k) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def passes(kind: int, value: Column) -> Column:
    if kind == 1:
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    if kind == 2:
        return F.when(n.between(12, 19), luhn(digits)).otherwise(False)
    if kind == 3:
        return n.between(9, 15)
    return F.lit(True)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def _patterns(before: Column, after: Column) -> Column:
    left, right = _words(F.substring(before, -BESIDE, BESIDE)), _words(F.substring(after, 1, BESIDE))
    last = lambda n: F.slice(left, -n, n)
    some = [
        F.when(F.size(left) >= n, F.concat(F.lit(f"{n}<"), F.array_join(last(n), " "))) for n in (1, 2)
    ] + [
        F.when(F.size(right) >= n, F.concat(F.lit(f"{n}>"), F.array_join(F.slice(right, 1, n), " "))) for n in (1, 2)
    ]
    return F.filter(F.array(*some), lambda p: p.isNotNull())


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``rid`` and ``hits``: all matches of a text with the length of the gap before each."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text.alias("text"),
        F.monotonically_increasing_id().alias("rid"),
    )
    scanned = {}
    expressions = (*EXPRESSIONS, CANDIDATE)
    for k, expression in enumerate(expressions):
        scanned[f"found{k}"] = F.regexp_extract_all("text", F.lit(expression), F.lit(0))
    rows = rows.withColumns(scanned)
    rows = rows.withColumns(
        {f"gaps{k}": F.when(F.size(f"found{k}") > 0, F.split("text", e, -1)) for k, e in enumerate(expressions)}
    )

    def hits(k: int) -> Column:
        gaps = F.col(f"gaps{k}")
        at = lambda i: F.get(gaps, i)
        return F.transform(
            F.col(f"found{k}"),
            lambda value, i: F.struct(
                F.lit(k).alias("kind"), i.alias("place"), F.length(at(i)).alias("gap"), F.length(value).alias("n"),
                value.alias("value"), _patterns(at(i), at(i + 1)).alias("patterns"),
            ),
        )

    return rows.select("row", "rid", F.flatten(F.array(*[hits(k) for k in range(len(expressions))])).alias("hits"))


def located(scanned: DataFrame) -> DataFrame:
    """``rid, kind, start, end, value, patterns`` of base spans (kind below 4) and free candidates."""
    rows = scanned.where(F.size("hits") > 0).select("rid", F.explode("hits").alias("hit")).select("rid", "hit.*")
    before = Window.partitionBy("rid", "kind").orderBy("place")
    end = F.sum(F.col("gap") + F.col("n")).over(before)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("n"))
    good = F.lit(True)
    for k in range(len(KINDS)):
        good = F.when(F.col("kind") == k, passes(k, F.col("value"))).otherwise(good)
    rows = rows.where(good)
    # a candidate is free if no base span reaches over its start and none begins before its end
    base_end = F.when(F.col("kind") < len(KINDS), F.col("end"))
    base_start = F.when(F.col("kind") < len(KINDS), F.col("start"))
    order = Window.partitionBy("rid").orderBy("start", "kind")
    reached = F.max(base_end).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    begins = F.min(base_start).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    touched = (F.coalesce(reached, F.lit(-1)) > F.col("start")) | (F.coalesce(begins, F.col("end")) < F.col("end"))
    rows = rows.withColumn("touched", touched)
    return rows.where((F.col("kind") < len(KINDS)) | ~F.col("touched")).select(
        "rid", "kind", "start", "end", "value", "patterns"
    )


def bootstrap(spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confidence of patterns and scores of candidate instances, by kind."""
    edges = stage(
        spans.select(
            F.explode("patterns").alias("pattern"), F.lower("value").alias("instance"),
            F.when(F.col("kind") < len(KINDS), F.col("kind")).alias("seed"),
        ).distinct(),
        "edges",
    )
    seeds = edges.where("seed is not null").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    width = edges.groupBy("pattern").agg(F.count_distinct("instance").alias("instances"))
    width = stage(width, "width")
    pairs = stage(edges.select("pattern", "instance").distinct(), "pairs")
    scores, confidence = seeds, None
    for _ in range(ROUNDS):
        scores = stage(scores, "scores")
        sure = F.sum(F.when(F.col("score") >= SURE, 1).otherwise(0))
        confidence = (
            pairs.join(scores, "instance").groupBy("pattern", "kind")
            .agg(F.sum("score").alias("total"), sure.alias("support"))
            .where(F.col("support") >= SUPPORT).join(width, "pattern")
            .select("pattern", "kind", (F.col("total") / (F.col("instances") + PRIOR)).alias("confidence"))
        )
        confidence = stage(confidence, "confidence")
        doubt = F.sum(F.log1p(-F.least("confidence", F.lit(0.999999))))
        found = pairs.join(confidence, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
        scores = seeds.unionByName(found.join(seeds, ["instance", "kind"], "left_anti"))
    return confidence, stage(scores, "scores")


def all_spans(scanned: DataFrame) -> DataFrame:
    """``rid, kind, start, end, base``: base spans and those that the contexts add."""
    spans = stage(located(scanned), "spans")
    confidence, scores = bootstrap(spans)
    added = (
        spans.where(F.col("kind") == len(KINDS)).drop("kind")
        .select("rid", "start", "end", F.lower("value").alias("instance"), F.explode("patterns").alias("pattern"))
        .join(confidence.where(F.col("confidence") >= SURE), "pattern")
        .join(scores.where(F.col("score") >= SURE).select("instance", "kind"), ["instance", "kind"])
        .select("rid", "kind", "start", "end").distinct()
    )
    base = spans.where(F.col("kind") < len(KINDS)).select("rid", "kind", "start", "end")
    return base.withColumn("base", F.lit(True)).unionByName(added.withColumn("base", F.lit(False)))


def _joined(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(
        F.transform(spans, lambda s: F.concat(name(s), F.lit(":"), s["start"], F.lit(":"), s["end"])), ","
    )


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of all rows."""
    scanned = stage(scan(docs, ["doc_id"]), "scan")
    spans = all_spans(scanned)
    entry = F.struct("start", "kind", "end", "base")
    by_row = spans.groupBy("rid").agg(F.array_sort(F.collect_list(entry)).alias("found"))
    rows = scanned.select("rid", "row.doc_id").join(by_row, "rid", "left")
    found = F.coalesce("found", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,base:boolean>>"))
    rows = rows.withColumn("found", found).withColumn("based", F.filter("found", lambda s: s["base"]))
    count = lambda k: F.size(F.filter("based", lambda s: s["kind"] == k)).cast("bigint")
    return rows.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_joined(F.col("based")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with each stretch of personal data replaced by its kind in brackets.

    Overlapping spans are one stretch, named after the one that begins first. ``n_chars`` follows.
    """
    kept = docs.columns
    scanned = stage(scan(docs, kept), "scan")
    spans = all_spans(scanned)
    order = Window.partitionBy("rid").orderBy("start", "kind", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("fresh", F.when(F.coalesce(reached, F.lit(-1)) < F.col("start"), 1).otherwise(0))
    spans = spans.withColumn("stretch", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    stretches = spans.groupBy("rid", "stretch").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "kind")).alias("kind")
    )
    by_row = stretches.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("found"))
    # merged at every size, so that volume grows with the input alone
    rows = scanned.select("rid", "row").join(by_row.hint("merge"), "rid", "left")
    text, found = F.col("row.text").cast("string"), F.col("found")
    name = lambda s: F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), s["kind"] + 1)
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(found, i - 1)["end"])
    cut = lambda a, n: F.substring(text, (a + 1).cast("int"), n.cast("int"))
    pieces = F.transform(found, lambda s, i: F.concat(cut(before(i), s["start"] - before(i)), name(s)))
    last = F.element_at(found, -1)["end"]
    cleaned = F.concat(F.array_join(pieces, ""), cut(last, F.length(text)))
    cleaned = F.when(found.isNull(), text).otherwise(cleaned)
    rows = rows.withColumn("cleaned", cleaned)
    out = {c: F.col(f"row.`{c}`") for c in kept} | {"text": F.col("cleaned")}
    if "n_chars" in kept:
        out["n_chars"] = F.when(found.isNull(), F.col("row.n_chars")).otherwise(F.length("cleaned")).cast(
            dict(docs.dtypes)["n_chars"]
        )
    return rows.select(*[c.alias(name) for name, c in out.items()])
