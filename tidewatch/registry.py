"""Every query by name. Each takes a session and a folder of sample tables.

Results are flattened to plain columns (numbers, text, true/false) so that any SQL engine can
be asked the same question: decimals become doubles, dates and times text, arrays joined text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import microsecond_text
from tidewatch.operators import links, mule, nearest, rings, structuring, walks
from tidewatch.plans import alerts, evaluate, governance, graph_tables, patterns, quality, serving
from tidewatch.plans.pipeline import PUBLISHED, Run
from tidewatch.sources import landing
from tidewatch.staging import Staged, new_folder, noting, together

Query = Callable[[SparkSession, str], DataFrame]


def flat(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        col, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.DateType):
            col = col.cast("string")
        elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
            col = microsecond_text(col)
        elif isinstance(kind, T.ArrayType):
            col = F.array_join(col.cast("array<string>"), ",")
        return col.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


#: When the alerts of the sample were raised, so that the time can be checked.
RAISED_AT = "2024-07-01 09:30:00"


def _over_run(build: Callable[[Run], DataFrame]) -> Query:
    return lambda spark, sf_dir: flat(build(Run.over_sample(spark, sf_dir, RAISED_AT)))


def _over_graph(build: Callable[[patterns.Graph], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        run = Run.over_sample(spark, sf_dir)
        return flat(build(patterns.Graph(graph_tables.graph_tables(run.table))))

    return query


def _landed(
    spark: SparkSession, sf_dir: str, names: list[str], shredded: bool = True, once: bool = False
) -> tuple[str, dict[str, DataFrame]]:
    """Write the named tables as JSON lines and load them into RAW tables, ``shredded`` for curation. With
    ``once`` the lines are gzipped for size and go as they are loaded."""
    run = Run.over_sample(spark, sf_dir)
    folder = new_folder(spark, "landing")
    tables = {name: run.table(name) for name in names}
    level = "DEFAULT_COMPRESSION" if once else "BEST_SPEED"
    together(*[partial(landing.write_jsonl, table, folder, name, level=level) for name, table in tables.items()])
    paths = {name: landing.jsonl_path(folder, name) for name in names}
    return folder, landing.load_raw(spark, new_folder(spark, "raw"), paths, shredded, once)


ENTITY_TABLES = [name for name in landing.FILES if name != "ground_truth"]
FIRST_KEY = {name: next(iter(fields)) for name, fields in landing.FIELDS.items()}


def land_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, raw = _landed(spark, sf_dir, ENTITY_TABLES, shredded=False)
    parts = [
        df.select(
            F.regexp_extract("src_file", r"([a-z_]+\.jsonl)", 1).alias("src_file"),
            F.variant_get("payload", f"$.{FIRST_KEY[name]}", "string").alias("first_key"),
            F.col("loaded_ts").isNotNull().alias("stamped"),
        )
        for name, df in raw.items()
    ]
    landed = parts[0]
    for part in parts[1:]:
        landed = landed.unionByName(part)
    return landed


def land_ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, raw = _landed(spark, sf_dir, ["ground_truth"])
    return flat(landing.curate(raw["ground_truth"], "ground_truth"))


def stage_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = _landed(spark, sf_dir, list(landing.FILES), shredded=False)
    return landing.stage_listing(spark, folder).select("entity", (F.col("files") > 0).alias("arrived"))


def raw_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, raw = _landed(spark, sf_dir, ENTITY_TABLES, shredded=False)
    return landing.row_counts({f"{name.upper()}_RAW": df for name, df in raw.items()})


def raw_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed document with the smallest customer id, as its list of keys."""
    _, raw = _landed(spark, sf_dir, ["customer"])
    key = F.variant_get("payload", "$.customer_id", "string")
    one = raw["customer"].select(key.alias("customer_id"), "payload").orderBy("customer_id").limit(1)
    keys = F.array_sort(F.json_object_keys(F.to_json("payload")))
    return one.select("customer_id", F.array_join(keys, ",").alias("keys"))


def _curate(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, raw = _landed(spark, sf_dir, [name])
        curated = landing.curate(raw[name], name)
        if name == "customer":
            curated = curated.withColumn(
                "abn", F.variant_get("kyc_payload", "$.abn", "string")
            ).withColumn(
                "source_of_funds", F.variant_get("kyc_payload", "$.source_of_funds", "string")
            ).drop("kyc_payload")
        return flat(curated)

    return query


def reset_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all curated tables twice; the second run replaces the first. What a run has landed and loaded
    is deleted when its curated tables are written."""
    folder = new_folder(spark, "curated")
    for _ in range(2):
        with Staged() as scratch, noting(scratch.folders):
            _, raw = _landed(spark, sf_dir, list(landing.FILES), once=True)
            curated = {name: landing.curate(df, name) for name, df in raw.items()}
            together(*[partial(landing.write_curated, table, folder, name) for name, table in curated.items()])
        counts = {name.upper(): spark.read.parquet(f"{folder}/{name}") for name in curated}
    return landing.row_counts(counts)


def table_row_counts(run: Run) -> DataFrame:
    return landing.row_counts({name.upper(): run.table(name) for name in landing.FILES})


def _tables(run: Run, *names: str) -> list[DataFrame]:
    return [run.table(name) for name in names]


def money_walk(run: Run) -> DataFrame:
    return walks.single_hops(run.edges).unionByName(run.long_walks)


def structuring_rolling(run: Run, **rule) -> DataFrame:
    """Each account's densest window with its lists, one row for each part of them."""
    inside = run.window_deposits(**rule)
    totals = structuring.structuring_rolling(inside)
    return totals.join(structuring.deposit_lists(inside, totals), "account_id")


def structuring_summary(run: Run) -> DataFrame:
    return structuring.structuring_summary(structuring.structuring_rolling(run.window_deposits(min_deposits=3)))


def published_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each table that a run has published."""
    folder = new_folder(spark, "published")
    with Run.over_sample(spark, sf_dir) as run:
        run.publish(folder)
    opened = Run.opened(spark, folder, run.table)
    return landing.row_counts({name.upper(): getattr(opened, name) for name in PUBLISHED})


def detection_counts(run: Run) -> DataFrame:
    run.detect()
    found = {
        "round_trip": run.round_trip, "layering": run.layering, "mule": run.mule,
        "structuring": run.structuring,
    }
    parts = [
        df.groupBy("tier").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("detector"), "tier", "n")
        for name, df in found.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts.orderBy("detector", "tier")


def fraud_alert(run: Run) -> DataFrame:
    detail = lambda name, kind: F.variant_get("trigger_detail", f"$.{name}", kind).alias(name)
    return run.alerts.select(
        "alert_id", "account_id", "transaction_id", "alert_type", "fraud_score", "status",
        detail("tier", "string"), detail("closed_by", "string"), detail("hops", "int"),
        detail("decay_pct", "decimal(5,1)"), detail("device_id", "string"),
        detail("n_deposits", "int"), detail("total_amount", "decimal(28,2)"),
        F.col("raised_at").isNotNull().alias("raised"),
    )


def _detail_fields(alert: DataFrame, fields: dict[str, str]) -> DataFrame:
    document = F.parse_json("_detail")
    return alert.select(
        "account_id", "transaction_id", "alert_type", "fraud_score",
        *[F.variant_get(document, f"$.{name}", kind).alias(name) for name, kind in fields.items()],
    )


def identity_link_counts(run: Run) -> DataFrame:
    return links.link_counts(run.shared)


def mule_ground_truth(run: Run) -> DataFrame:
    return evaluate.mule_ground_truth(*_tables(run, "ground_truth", "transaction"))


def detection_txns(run: Run) -> DataFrame:
    run.detect_paths()
    return evaluate.detection_txns(run.round_trip, run.layering)


def best_detection(run: Run) -> DataFrame:
    return evaluate.best_detection(evaluate.path_labels(run.table("ground_truth")), detection_txns(run))


def _evaluation_inputs(run: Run):
    run.detect()
    return (
        run.table("ground_truth"), run.table("transaction"), run.round_trip, run.layering,
        run.mule_found, run.structuring,
    )


def _customer_secure(role: str) -> Callable[[Run], DataFrame]:
    def build(run: Run) -> DataFrame:
        seen = governance.customer_secure(run.table("customer"), role)
        return seen.withColumn(
            "source_of_funds", F.variant_get("kyc_payload", "$.source_of_funds", "string")
        ).drop("kyc_payload")

    return build


def _transaction_secure(role: str) -> Callable[[Run], DataFrame]:
    return lambda run: governance.transaction_secure(
        run.table("transaction"), run.table("branch_access_map"), role
    )


def pii_catalog(run: Run) -> DataFrame:
    tables = {name: run.table(name) for name in ("customer", "account")}
    spark = run.table("account").sparkSession
    return governance.pii_columns(governance.pii_catalog(spark), tables)


def _graph_table(name: str) -> Query:
    return _over_graph(lambda graph: graph.tables[name])


def _csv_copy(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    run = Run.over_sample(spark, sf_dir)
    folder = new_folder(spark, "graph-csv")
    graph_tables.write_csv(graph_tables.graph_tables(run.table), folder)
    return graph_tables.read_csv(spark, folder)


def graph_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per CSV table after a round trip through the files."""
    return landing.row_counts(_csv_copy(spark, sf_dir))


def graph_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges of all edge tables whose two ends exist, read from CSV."""
    tables, found = _csv_copy(spark, sf_dir), None
    for name, ends in graph_tables.EDGE_ENDS.items():
        (start, _), (end, _) = ends
        part = graph_tables.attached_edges(tables, name).select(
            F.lit(name).alias("edge"), F.col(start).alias("start_key"), F.col(end).alias("end_key")
        )
        found = part if found is None else found.unionByName(part)
    return found


def graph_csv_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed transfers whose two ends exist, read from CSV."""
    return flat(graph_tables.attached_edges(_csv_copy(spark, sf_dir), "edge_sent_to"))


def graph_duplicate_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_tables.duplicate_nodes(_csv_copy(spark, sf_dir))


# The sample data starts in 1995, so "recent" is counted from there.
SAMPLE_SINCE = "1995-01-01"

RUN_QUERIES: dict[str, Callable[[Run], DataFrame]] = {
    # data quality
    "table_row_counts": table_row_counts,
    "orphan_check": lambda r: quality.orphan_check(*_tables(r, "customer", "account", "session", "transaction")),
    "null_landing_check": lambda r: quality.null_landing_check(r.table("transaction")),
    "variant_shape_check": lambda r: quality.variant_shape_check(r.table("customer")),
    "structuring_band_check": lambda r: quality.structuring_band_check(r.table("transaction")),
    "link_view_counts": lambda r: links.link_view_counts(*_tables(r, "session", "account", "ip_address")),
    "fk_violations": lambda r: quality.fk_violations(
        *_tables(r, "customer", "account", "device", "ip_address", "session", "transaction")
    ),
    "session_owner_violations": lambda r: quality.session_owner_violations(*_tables(r, "transaction", "session")),
    "null_rule_violations": lambda r: quality.null_rule_violations(r.table("transaction")),
    "ground_truth_coverage": lambda r: quality.ground_truth_coverage(*_tables(r, "transaction", "ground_truth")),
    "payload_shape_diff": lambda r: quality.payload_shape_diff(r.table("customer")),
    "label_histogram": lambda r: quality.label_histogram(r.table("ground_truth")),
    "nearest_session_join": lambda r: nearest.nearest_session_join(*_tables(r, "transaction", "session")),
    # shared-attribute links
    "shared_device_link": lambda r: links.shared_device_link(*_tables(r, "session", "account")),
    "shared_ip_link": lambda r: links.shared_ip_link(*_tables(r, "session", "account", "ip_address")),
    "shared_contact_link": lambda r: links.shared_contact_link(r.table("customer")),
    "high_risk_links": lambda r: links.links_of(
        r.table("customer").filter("risk_rating = 'high'").select("customer_id"),
        *_tables(r, "session", "account", "ip_address", "customer"),
    ),
    # detectors
    "money_edge": lambda r: r.lazy_edges(),
    "acc_link": lambda r: links.acc_link(r.shared),
    "identity_groups": lambda r: links.value_groups(r.shared),
    "money_walk": money_walk,
    "round_trip_candidates": lambda r: r.lazy_candidates(),
    "maximal_rings": lambda r: rings.maximal_rings(r.candidates),
    "ring_shared_pairs": lambda r: rings.with_shared_pairs(
        rings.maximal_rings(r.candidates), r.shared
    ).select("path_key", "shared_pairs", "shared_via"),
    "round_trip": lambda r: r.lazy_round_trip(),
    "layering": lambda r: r.lazy_layering(),
    "pass_through": lambda r: mule.pass_through(r.table("transaction")),
    "mule_ring": lambda r: r.mule.join(r.mule_lists, "device_id"),
    "structuring_daily": lambda r: r.structuring.join(r.structuring_lists, "account_id"),
    "structuring_rolling": structuring_rolling,
    "structuring_rolling_3": lambda r: structuring_rolling(r, min_deposits=3),
    "structuring_summary": structuring_summary,
    "detection_counts": detection_counts,
    # alerts
    "fraud_alert": fraud_alert,
    "alert_round_trip": lambda r: _detail_fields(
        alerts.alert_round_trip(r.round_trip),
        {"tier": "string", "closed_by": "string", "closed_on": "string", "hops": "int",
         "path": "array<string>", "txn_ids": "array<string>", "first_amount": "decimal(18,2)",
         "last_amount": "decimal(18,2)", "decay_pct": "decimal(5,1)", "shared_via": "array<string>"},
    ),
    "alert_layering": lambda r: _detail_fields(
        alerts.alert_layering(r.layering),
        {"tier": "string", "hops": "int", "path": "array<string>", "txn_ids": "array<string>",
         "first_amount": "decimal(18,2)", "last_amount": "decimal(18,2)", "decay_pct": "decimal(5,1)"},
    ),
    "alert_mule": lambda r: _detail_fields(
        alerts.alert_mule(r.mule),
        {"tier": "string", "device_id": "string", "n_customers": "int", "n_accounts": "int"},
    ),
    "alert_structuring": lambda r: _detail_fields(
        alerts.alert_structuring(r.structuring),
        {"tier": "string", "n_days": "int", "n_deposits": "int", "total_amount": "decimal(28,2)",
         "n_branches": "int", "first_day": "date", "last_day": "date"},
    ),
    "v_dash_rings": lambda r: alerts.v_dash_rings(r.alerts),
    "v_dash_mule": lambda r: alerts.v_dash_mule(r.alerts, r.mule_lists),
    "v_dash_alert_summary": lambda r: alerts.v_dash_alert_summary(r.alerts),
    # dashboards
    "dash_rings_by_tier": lambda r: serving.rings_by_tier(r.alerts),
    "dash_ring_list": lambda r: serving.ring_list(r.alerts),
    "dash_ring_length": lambda r: serving.ring_length(r.alerts),
    "dash_identity_links": lambda r: serving.identity_links(identity_link_counts(r)),
    "dash_mule_list": lambda r: serving.mule_list(r.alerts, r.mule_lists),
    "dash_mule_size": lambda r: serving.mule_size(r.alerts),
    "dash_open_alerts": lambda r: serving.open_alerts(r.alerts),
    "dash_alerts_by_type": lambda r: serving.alerts_by_type(r.alerts),
    "dash_alert_queue": lambda r: serving.alert_queue(r.alerts),
    "dash_alert_queue_by_type": lambda r: serving.alert_queue(r.alerts, ["mule_network", "structuring"]),
    "dash_benchmark": lambda r: serving.benchmark_list(r.benchmark),
    "dash_structuring": lambda r: serving.structuring_list(r.structuring),
    "ring_edges": lambda r: serving.ring_edges(r.alerts, r.edges),
    "ring_identity_links": lambda r: serving.ring_identity_links(r.alerts, r.shared),
    "mule_members": lambda r: serving.mule_members(r.alerts, r.mule_found, r.table("account")),
    "kpi_rings": lambda r: serving.kpi_rings(r.alerts),
    "kpi_mule": lambda r: serving.kpi_mule(r.mule, identity_link_counts(r)),
    "kpi_alerts": lambda r: serving.kpi_alerts(r.alerts),
    "kpi_quality": lambda r: serving.kpi_quality(r.benchmark),
    "recall_table": lambda r: serving.recall_table(r.benchmark),
    "outcome_unpivot": lambda r: serving.outcome_unpivot(r.benchmark),
    "fp_by_detector": lambda r: serving.fp_by_detector(r.benchmark, r.alerts),
    "display_labels": lambda r: serving.display_labels(r.alerts),
    # evaluation
    "detection_txns": detection_txns,
    "mule_ground_truth": mule_ground_truth,
    "mule_found": lambda r: r.mule_found.select("device_id", "account_id"),
    "structuring_ground_truth": lambda r: evaluate.structuring_ground_truth(
        *_tables(r, "ground_truth", "transaction")
    ),
    "best_detection": best_detection,
    "chain_recall": lambda r: evaluate.chain_recall(*_evaluation_inputs(r)),
    "pattern_recall": lambda r: evaluate.pattern_recall(evaluate.chain_recall(*_evaluation_inputs(r))),
    "false_positives": lambda r: evaluate.false_positives(*_evaluation_inputs(r)),
    "benchmark": lambda r: r.benchmark,
    # governance
    "customer_secure_analyst": _customer_secure("AML_ANALYST"),
    "customer_secure_engineer": _customer_secure("AML_DATA_ENGINEER"),
    "transaction_secure_engineer": _transaction_secure("AML_DATA_ENGINEER"),
    "transaction_secure_branch": _transaction_secure("AML_BRANCH_STAFF"),
    "pii_catalog": pii_catalog,
}

GRAPH_QUERIES: dict[str, Callable[[patterns.Graph], DataFrame]] = {
    "cycles_3_6": patterns.cycles_3_6,
    "cycles_pruned": patterns.cycles_pruned,
    "rings_tiers_graph": patterns.rings_tiers_graph,
    "high_ring_evidence": patterns.high_ring_evidence,
    "all_ring_evidence": patterns.all_ring_evidence,
    "layering_graph": patterns.layering_graph,
    "mule_onboarding": lambda g: patterns.mule_onboarding(g, SAMPLE_SINCE),
    "example_phone_ring": patterns.example_phone_ring,
    "example_mule": lambda g: patterns.example_mule(g, SAMPLE_SINCE),
    "example_plain_cycle": patterns.example_plain_cycle,
}

SOURCE_QUERIES: dict[str, Query] = {
    "stage_listing": stage_listing,
    "land_raw_json": land_raw_json,
    "land_ground_truth": land_ground_truth,
    "raw_row_counts": raw_row_counts,
    "raw_sample": raw_sample,
    **{f"curate_{name}": _curate(name) for name in ENTITY_TABLES},
    "reset_curated": reset_curated,
    **{name: _graph_table(name) for name in graph_tables.CSV_SCHEMAS},
    "graph_csv_sink": graph_csv_sink,
    "graph_csv_source": graph_csv_source,
    "graph_csv_transfers": graph_csv_transfers,
    "graph_duplicate_nodes": graph_duplicate_nodes,
    "published_run": published_run,
}


def queries() -> dict[str, Query]:
    return {
        **SOURCE_QUERIES,
        **{name: _over_run(build) for name, build in RUN_QUERIES.items()},
        **{name: _over_graph(build) for name, build in GRAPH_QUERIES.items()},
    }
