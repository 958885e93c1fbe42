"""Mixing of sources to target weights, by blocks.

The words of a source's documents, in a hashed order, are one stream, packed into blocks of
``BLOCK`` words (the last one shorter). Sources in code-point order, null last, weigh ``WEIGHTS``, again and
again; they share ``SHARE`` times all words by weight, and what would exceed ``MOST`` times a source
goes to the others by weight. A source's target makes its number of slots. The slots are drawn to
output shards at random, which makes each shard's source counts multinomial given the totals, so
that the totals meet the targets. A shard numbers its slots on from the shards before it; a number
becomes a block through a pseudorandom permutation of the source's blocks, one for each round over
the source, and slots are joined to blocks by that index. The last slot takes the words that are
left.

The permutation is a mixed-radix Feistel network over ``a * b >= n`` places, walked until it falls
below ``n``. All draws are hashes of fixed seeds, so reruns agree. Positions in a stream are running
sums within slices of the hash, in three levels: no window holds a source.

The mix is a table of slots with the words of their blocks, written in a folder for each shard. The
ranges of documents that a slot needs go to the texts, by two hashes of the row, and only the words
cut out there go on to the shards. They are staged first and go in ``TURNS`` turns, each with its own shards;
what a turn has staged and shuffled is deleted when its shards are written, so that the disk never holds all
movements of all words beside the mix. Counts by document are sums over the written table.

Rows: null text has size 0; every row is a document of its own, also if its id is null or repeated;
a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.staging import drop_folder, new_folder, shuffles_freed, stage

BLOCK = 256
#: Slots of an output shard, about.
SHARD = 4096
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20240501
#: Slices of a source, and documents of a slice of a slice, about.
_SLICES, _ROWS = 64, 1000
_ROUNDS, _WALKS = 4, 16
#: The slots of a shard are put together in one task for each such run of slot numbers.
_RUN = 1024
#: Turns in which the cut words go to their shards, each all words of its own shards.
TURNS = 4
WORD = r"[^\x20\x09-\x0D]+"


def targets(rows: DataFrame) -> DataFrame:
    """``source, source_size, target`` of each source of rows with ``source, size``.

    A source is full if its limit for each unit of weight is below the level that what the fuller
    ones leave would give the others; sorted by that, one running sum finds the level.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    sizes = sizes.withColumn("weight", weight).withColumn("limit", (F.col("source_size") * MOST).cast("double"))
    by_fullness = Window.orderBy(F.col("limit") / F.col("weight"), "source")
    before = by_fullness.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    sizes = sizes.withColumn("level", left / weights)
    open_level = F.when(F.col("limit") / F.col("weight") > F.col("level"), F.col("level"))
    # the level rises while sources are full and falls after the first that is not
    level = F.max(open_level).over(everything)
    share = F.least(F.col("limit"), F.col("weight") * F.coalesce(level, F.lit(float("inf"))))
    return sizes.select("source", "source_size", share.alias("target"))


def placed(rows: DataFrame) -> DataFrame:
    """``start`` of each row's words in its source's stream."""
    slices = max(1, rows.count() // (_SLICES * _ROWS))
    mark = F.xxhash64(F.lit(SEED), "doc_id", "size")
    rows = rows.withColumns(
        {"mark": mark, "one": F.pmod(mark, F.lit(_SLICES)), "two": F.pmod(F.shiftrightunsigned(mark, 8), F.lit(slices))}
    )
    levels = ["source", "one", "two"]
    before = lambda keys, *order: (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    so_far = lambda name, window: F.coalesce(F.sum(name).over(window), F.lit(0))
    inner = rows.groupBy(*levels).agg(F.sum("size").alias("words"))
    outer = inner.groupBy("source", "one").agg(F.sum("words").alias("words"))
    outer = outer.select("source", "one", so_far("words", before(["source"], "one")).alias("base"))
    inner = inner.withColumn("base2", so_far("words", before(["source", "one"], "two"))).drop("words")
    bases = stage(
        inner.join(outer, inner["source"].eqNullSafe(outer["source"]) & (inner["one"] == outer["one"]))
        .select(inner["source"], inner["one"], "two", (F.col("base") + F.col("base2")).alias("base")),
        "bases",
    )
    rows = rows.withColumn("within", so_far("size", before(levels, "mark", "doc_id", "rid")))
    same = rows["source"].eqNullSafe(bases["source"]) & (rows["one"] == bases["one"]) & (rows["two"] == bases["two"])
    return rows.join(bases, same).select(
        *[rows[c] for c in ("rid", "doc_id", "source", "size", "print0", "print1")], (F.col("base") + F.col("within")).alias("start")
    )


def permuted(number: Column, n: Column, *seed: Column) -> Column:
    """The place of ``number`` (below ``n``) in a pseudorandom permutation of 0 to n - 1."""
    high = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    low = F.ceil(n / high).cast("bigint")
    first = F.struct(
        F.floor(number / low).cast("bigint").alias("x"), (number % low).alias("y"), F.lit(False).alias("done")
    )

    def step(state: Column, k: Column) -> Column:
        x = F.when(k % 2 == 1, F.pmod(state["x"] + F.pmod(F.xxhash64(state["y"], k % _ROUNDS, *seed), high), high)).otherwise(state["x"])
        y = F.when(k % 2 == 0, F.pmod(state["y"] + F.pmod(F.xxhash64(state["x"], k % _ROUNDS, *seed), low), low)).otherwise(state["y"])
        moved = F.struct(x.alias("x"), y.alias("y"), ((k % _ROUNDS == 0) & (x * low + y < n)).alias("done"))
        return F.when(state["done"], state).otherwise(moved)

    last = F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS * _WALKS)), first, step)
    return last["x"] * low + last["y"]


def slots(sources: DataFrame) -> DataFrame:
    """``source, shard, slot, round, block`` of the mix; ``sources`` has ``source, source_size, words``."""
    n = F.ceil(F.col("source_size") / BLOCK).cast("bigint")
    rounds = F.floor(F.col("words") / F.col("source_size")).cast("bigint")
    rest = F.col("words") - rounds * F.col("source_size")
    # one slot more than the rest fills, as it may meet the short block
    sources = sources.where("words > 0").withColumns(
        {"n": n, "slots": rounds * n + F.least(n, F.ceil(rest / BLOCK).cast("bigint") + F.when(rest > 0, 1).otherwise(0))}
    )
    total = sources.agg(F.sum("slots")).head()[0] or 0
    shards = max(1, -(-total // SHARD))
    # slots are dealt in runs, so that no array holds a source
    runs = sources.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("slots") - 1) / SHARD))))
    dealt = runs.withColumn(
        "number",
        F.explode(F.sequence(F.col("run") * SHARD, F.least(F.col("slots"), (F.col("run") + 1) * SHARD) - 1)),
    ).withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED + 1), "source", "number"), F.lit(shards)))
    counts = dealt.groupBy("source", "shard", "n").agg(F.count(F.lit(1)).alias("count"))
    before = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0)))
    # few counts are many slots, so they are dealt out again
    parts = min(shards, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = counts.repartition(parts, "source", "shard")
    numbered = counts.withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)))
    numbered = numbered.withColumn("round", F.floor(F.col("slot") / F.col("n")).cast("bigint"))
    block = permuted(F.col("slot") % F.col("n"), F.col("n"), F.lit(SEED + 2), F.col("source"), F.col("round"))
    return numbered.select("source", "shard", "slot", "round", block.alias("block"))


def _mixed(docs: DataFrame, folder: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sizes of all rows, the sources and the written mix."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    named = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), text.alias("text"),
    )
    prints = [F.xxhash64(F.lit(k), "doc_id", "source", "text").alias(f"print{k}") for k in range(2)]
    rows = stage(
        named.select("doc_id", "source", "size", *prints, F.monotonically_increasing_id().alias("rid")), "sizes"
    )
    sources = stage(targets(rows), "targets").withColumn("words", F.round("target").cast("bigint"))
    drawn = stage(slots(sources), "slots")
    turns = min(TURNS, 1 + (drawn.agg(F.max("shard")).head()[0] or 0))

    # a round's words before a slot: whole blocks, less what the short one lacks if it came before
    lacking = F.pmod(-F.col("source_size"), F.lit(BLOCK)).cast("bigint")
    n = F.ceil(F.col("source_size") / BLOCK).cast("bigint")
    sized = sources.select(F.col("source").alias("s"), "source_size", "words", lacking.alias("lacking"), n.alias("n"))
    drawn = drawn.join(sized, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    short = drawn.where(F.col("block") == F.col("n") - 1).select(
        F.col("source").alias("s"), F.col("round").alias("r"), F.col("slot").alias("short")
    )
    drawn = drawn.join(short, F.col("source").eqNullSafe(F.col("s")) & (F.col("round") == F.col("r")), "left")
    ahead = (
        F.col("round") * F.col("source_size") + (F.col("slot") % F.col("n")) * BLOCK
        - F.when(F.col("short") < F.col("slot"), F.col("lacking")).otherwise(0)
    )
    filled = BLOCK - F.when(F.col("block") == F.col("n") - 1, F.col("lacking")).otherwise(0)
    taken = F.least(filled, F.col("words") - ahead)
    drawn = drawn.withColumn("taken", taken).where("taken > 0").select("source", "shard", "slot", "block", "taken")

    pieces = placed(rows).where("size > 0").withColumn(
        "piece",
        F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("size") - 1) / BLOCK))),
    )
    origin = F.col("piece") * BLOCK
    low = F.greatest(F.lit(0), F.col("start") - origin)
    pieces = pieces.select(
        "rid", "doc_id", "print0", "print1", F.col("source").alias("s"), "piece", low.alias("low"),
        F.least(F.lit(BLOCK), F.col("start") + F.col("size") - origin).alias("high"),
        (origin + low - F.col("start")).alias("first"),
    )
    joined = pieces.join(drawn, F.col("s").eqNullSafe(F.col("source")) & (F.col("piece") == F.col("block")))
    joined = joined.withColumn("n", F.least("high", "taken") - F.col("low")).where("n > 0")
    ranges = joined.groupBy("print0", "print1", "source").agg(
        F.collect_list(F.struct("shard", "slot", "block", "low", "rid", "doc_id", "first", "n")).alias("ranges")
    )

    # rows that are equal in all have one text
    same = Window.partitionBy("print0", "print1").orderBy("print0")
    worded = named.where(F.col("text").rlike(WORD)).select(*prints, "text")
    texts = worded.withColumn("again", F.lag("print0").over(same))
    texts = texts.where("again is null").join(ranges.hint("merge"), ["print0", "print1"])
    texts = texts.select("source", "ranges", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("all"))
    cut = lambda r: F.array_join(F.slice("all", r["first"].cast("int") + 1, r["n"].cast("int")), " ")
    # the size keeps the list of words a column of its own, which is made once for each text
    cuts = F.when(F.size("all") > 0, F.transform("ranges", lambda r: r.withField("words", cut(r))))
    sent = texts.select("source", F.explode(cuts).alias("r")).select("source", "r.*")
    sent = sent.withColumns({"run": F.floor(F.col("slot") / _RUN), "turn": (F.col("shard") % turns).cast("int")})
    staged, folder = new_folder(spark, "cuts"), folder or new_folder(spark, "mixture")
    with shuffles_freed(spark):
        sent.write.partitionBy("turn").option("compression", "zstd").parquet(staged)
        for turn in range(turns):
            cuts = spark.read.schema(sent.schema).parquet(staged).where(F.col("turn") == turn)
            blocks = _blocks(cuts)
            mode = "append" if turn else "errorifexists"
            blocks.write.mode(mode).partitionBy("shard").option("compression", "zstd").parquet(folder)
            drop_folder(spark, f"{staged}/turn={turn}")
    return rows, sources, spark.read.schema(blocks.schema).parquet(folder)


def _blocks(cuts: DataFrame) -> DataFrame:
    """``slot, source, block, words, parts, shard`` from the words that were cut out of the texts."""
    slot = ["shard", "source", "run", "slot", "block"]
    blocks = cuts.repartition("shard", "run").groupBy(*slot).agg(
        F.array_sort(F.collect_list(F.struct("low", "rid", "doc_id", "n", "words"))).alias("parts")
    )
    return blocks.select(
        "slot", "source", "block", F.array_join(F.col("parts.words"), " ").alias("words"),
        F.transform("parts", lambda p: F.struct(p["rid"].alias("rid"), p["doc_id"].alias("doc_id"), p["n"].alias("n"))).alias("parts"),
        "shard",
    )


def mixture(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``slot, source, block, words, parts, shard`` of the mix, as written to the folder: the words of the
    slot with blanks between, and how many of them come from which rows, in order."""
    return _mixed(docs, folder)[2]


def mix(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of all rows; the mix itself is written to the folder."""
    rows, sources, blocks = _mixed(docs, folder)
    taken = blocks.select(F.explode("parts").alias("p")).groupBy(F.col("p.rid").alias("rid")).agg(F.sum("p.n").alias("taken"))
    result = rows.join(taken, "rid", "left")
    known = sources.select(F.col("source").alias("s"), "source_size", "target")
    return result.join(known, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )
