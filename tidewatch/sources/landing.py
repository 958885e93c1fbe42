"""Landing and curation: JSON lines in, VARIANT rows with their file name, typed tables out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.snapshots import Snapshots
from tidewatch.staging import drop_folder, move_folder, new_folder, setting, shuffles_freed

# The expected file of each table, and its fields with their curated types.
FILES = {
    "customer": "customers",
    "account": "accounts",
    "device": "devices",
    "ip_address": "ip_addresses",
    "session": "sessions",
    "transaction": "transactions",
    "ground_truth": "ground_truth",
}
FIELDS = {
    "customer": {
        "customer_id": "string", "customer_type": "string", "full_name": "string",
        "date_of_birth": "date", "nationality": "string", "email": "string", "phone": "string",
        "address": "string", "occupation_or_industry": "string",
        "declared_income_aud": "decimal(18,2)", "kyc_status": "string", "kyc_payload": "variant",
        "risk_rating": "string", "onboard_dt": "date", "status": "string",
        "created_at": "timestamp_ntz",
    },
    "account": {
        "account_id": "string", "customer_id": "string", "account_number": "string",
        "account_type": "string", "currency": "string", "balance": "decimal(18,2)",
        "status": "string", "open_date": "date", "branch_code": "string",
    },
    "device": {
        "device_id": "string", "device_fingerprint": "string", "device_type": "string",
        "os": "string", "first_seen": "timestamp_ntz", "last_seen": "timestamp_ntz",
    },
    "ip_address": {
        "ip_id": "string", "ip_address": "string", "country": "string", "city": "string",
        "is_vpn": "boolean", "risk_score": "decimal(5,2)",
    },
    "session": {
        "session_id": "string", "account_id": "string", "device_id": "string", "ip_id": "string",
        "session_time": "timestamp_ntz", "channel": "string", "auth_method": "string",
    },
    "transaction": {
        "transaction_id": "string", "account_id": "string", "counterparty_account_id": "string",
        "session_id": "string", "txn_time": "timestamp_ntz", "amount": "decimal(18,2)",
        "currency": "string", "txn_type": "string", "channel": "string", "branch_code": "string",
        "description": "string", "status": "string",
    },
    "ground_truth": {
        "transaction_id": "string", "pattern_label": "string", "chain_id": "string",
        "hop_index": "int",
    },
}


#: Lines of a file at most. One task reads a gzip file, so this is the work of the largest load task.
LINES = 250_000
#: Turns in which a table is clustered, each over a slice of its time.
TURNS = 4


def jsonl_path(folder: str, name: str) -> str:
    return f"{folder}/{FILES[name]}.jsonl"


def write_jsonl(table: DataFrame, folder: str, name: str, gzip: bool = True, level: str = "BEST_SPEED") -> str:
    """Write a table as JSON lines with explicit nulls and ISO-8601 times ending in Z, in files of at most
    ``LINES`` lines. They are read once, so gzip is asked for speed, unless ``level`` names another of zlib's."""
    path = jsonl_path(folder, name)
    (
        table.write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", LINES)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        .option("compression", "gzip" if gzip else "none")
        .option("zlib.compress.level", level)
        .json(path)
    )
    return path


def land_raw_json(spark: SparkSession, path: str) -> DataFrame:
    """One VARIANT row per line of the JSON-lines files under ``path``, gzipped or not, as it is read.

    A line that is not JSON stops the load. A gzip file is read by one task, so large inputs
    should arrive as many files.
    """
    return (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(
            F.parse_json("value").alias("payload"),
            F.col("_metadata.file_path").alias("src_file"),
            F.localtimestamp().alias("loaded_ts"),
        )
    )


def load_raw(
    spark: SparkSession, store: str, paths: Mapping[str, str], shredded: bool = True, once: bool = False
) -> dict[str, DataFrame]:
    """Load the files of each named table into the RAW tables under ``store``, and open those.

    The tables are VARIANT Parquet, parsed and stamped once; Spark stores the fields of the documents as
    columns beside the rest, so that curation reads only those it asks for. Splitting the documents costs as much
    as parsing them, so tables that are not curated can be stored whole (``shredded=False``), with the
    same rows. The load replaces all tables at once or, if any line is not JSON, none.

    With ``once`` the files of a table are deleted as soon as it is stored, also if another table then
    stops the load; it is for files that can be landed again.
    """
    tables = {f"{name}_raw": land_raw_json(spark, path) for name, path in paths.items()}
    loaded = (lambda name: drop_folder(spark, paths[name.removesuffix("_raw")])) if once else None
    with (
        setting(spark, "spark.sql.variant.writeShredding.enabled", str(shredded).lower()),
        setting(spark, "spark.sql.parquet.compression.codec", "zstd"),
    ):
        Snapshots(spark, store).write(tables, loaded)
    return open_raw(spark, store, paths)


def open_raw(spark: SparkSession, store: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The RAW tables of the last load, by table name."""
    tables = Snapshots(spark, store).read([f"{name}_raw" for name in names])
    return {name.removesuffix("_raw"): table for name, table in tables.items()}


def stage_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Files that arrived per expected table; a table without files shows 0 of both."""
    expected = spark.createDataFrame([(f"{f}.jsonl",) for f in FILES.values()], "entity string")
    arrived = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json*")
        .load(folder)
        .select(F.regexp_extract("path", r"([a-z_]+\.jsonl)", 1).alias("entity"), "length")
    )
    return (
        expected.join(arrived, "entity", "left")
        .groupBy("entity")
        .agg(F.count("length").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    )


def curate(raw: DataFrame, name: str) -> DataFrame:
    """Typed columns from landed documents. JSON null and a missing key both become null; a
    value that does not fit its type stops the load."""
    return raw.select(
        *[F.variant_get("payload", f"$.{f}", kind).alias(f) for f, kind in FIELDS[name].items()]
    )


def write_curated(table: DataFrame, folder: str, name: str) -> None:
    """Replace a curated table. Transactions are clustered by time and account, so that time
    and account filters skip files."""
    if name == "transaction":
        _write_clustered(table, folder, name, ["txn_time", "account_id"])
    else:
        table.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")


def _write_clustered(table: DataFrame, folder: str, name: str, keys: list[str]) -> None:
    """Replace a table by one whose files are ranges of ``keys``.

    The rows are staged by slices of the first key (those without one are in the first slice), and a slice is ranged
    and sorted in its turn. What a turn has staged and shuffled is deleted when its files are written, so that the
    disk never holds the shuffle of the whole table, which is several times as large as its files. Where the slices
    are cut only matters for that. The new files take the table's place when all turns are done.
    """
    spark = table.sparkSession
    shares = [turn / TURNS for turn in range(1, TURNS)]
    # as text, since the first key may lie beyond Python's dates
    cuts = table.select(F.percentile_approx(keys[0], shares, 1000).cast("array<string>")).head()[0] or []
    turn = F.lit(0)
    for k, cut in enumerate(cuts, 1):
        turn = F.when(F.col(keys[0]) >= F.lit(cut).cast(table.schema[keys[0]].dataType), k).otherwise(turn)
    sliced = table.withColumn("_turn", turn)
    staged, building = new_folder(spark, "unclustered"), f"{folder}/_{name}"
    try:
        # a task has a file open for each turn, else Spark would sort its rows by turn
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(TURNS)):
            sliced.write.partitionBy("_turn").option("compression", "zstd").parquet(staged)
        with shuffles_freed(spark):
            for k in range(TURNS):
                rows = spark.read.schema(sliced.schema).parquet(staged).where(F.col("_turn") == k).drop("_turn")
                rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                rows.write.mode("append" if k else "overwrite").option("compression", "zstd").parquet(building)
                drop_folder(spark, f"{staged}/_turn={k}")
        move_folder(spark, building, f"{folder}/{name}")
    finally:
        drop_folder(spark, staged)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows, in the order of the names."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        for name, df in tables.items()
    ]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total.orderBy("tbl")
