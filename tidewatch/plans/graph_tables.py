"""Node and edge tables for a graph copy, and their CSV form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import iso_second

CONTACT_KINDS = ("phone", "email", "address")

# Column types when the CSV files are read back.
CSV_SCHEMAS = {
    "node_customer": "customer_id string, customer_type string, risk_rating string, "
                     "kyc_status string, onboard_dt date, status string",
    "node_account": "account_id string, customer_id string, account_type string, "
                    "branch_code string, status string",
    "node_device": "device_id string, device_type string, os string",
    "node_ip": "ip_id string, ip_address string, country string, is_vpn string",
    "node_contact": "kind string, value string, contact_key string",
    "edge_owns": "customer_id string, account_id string",
    "edge_sent_to": "transaction_id string, src_account_id string, dst_account_id string, "
                    "amount decimal(18,2), txn_time timestamp_ntz, channel string, "
                    "device_id string, ip_id string",
    "edge_used_device": "account_id string, device_id string, session_count bigint, "
                        "first_seen timestamp_ntz, last_seen timestamp_ntz",
    "edge_used_ip": "account_id string, ip_id string, session_count bigint, "
                    "first_seen timestamp_ntz, last_seen timestamp_ntz",
    "edge_has_contact": "customer_id string, contact_key string",
}
NODE_KEYS = {
    "node_customer": "customer_id",
    "node_account": "account_id",
    "node_device": "device_id",
    "node_ip": "ip_id",
    "node_contact": "contact_key",
}
# Each end of an edge table: its column, and the node table and key it must be found in.
EDGE_ENDS = {
    "edge_owns": (("customer_id", "node_customer"), ("account_id", "node_account")),
    "edge_sent_to": (("src_account_id", "node_account"), ("dst_account_id", "node_account")),
    "edge_used_device": (("account_id", "node_account"), ("device_id", "node_device")),
    "edge_used_ip": (("account_id", "node_account"), ("ip_id", "node_ip")),
    "edge_has_contact": (("customer_id", "node_customer"), ("contact_key", "node_contact")),
}


def node_customer(customer: DataFrame) -> DataFrame:
    return customer.select(
        "customer_id", "customer_type", "risk_rating", "kyc_status",
        F.date_format("onboard_dt", "yyyy-MM-dd").alias("onboard_dt"), "status",
    )


def node_account(account: DataFrame) -> DataFrame:
    return account.select("account_id", "customer_id", "account_type", "branch_code", "status")


def node_device(device: DataFrame) -> DataFrame:
    return device.select("device_id", "device_type", "os")


def node_ip(ip_address: DataFrame) -> DataFrame:
    return ip_address.select("ip_id", "ip_address", "country", "is_vpn")


def _contacts(customer: DataFrame) -> DataFrame:
    return (
        customer.select("customer_id", *[F.trim(c).alias(c) for c in CONTACT_KINDS])
        .unpivot("customer_id", list(CONTACT_KINDS), "kind", "value")
        .filter("value <> ''")
        .withColumn("contact_key", F.concat_ws("|", "kind", "value"))
    )


def node_contact(customer: DataFrame) -> DataFrame:
    return _contacts(customer).select("kind", "value", "contact_key").distinct()


def edge_owns(account: DataFrame) -> DataFrame:
    return account.select("customer_id", "account_id")


def edge_sent_to(transaction: DataFrame, session: DataFrame) -> DataFrame:
    """Completed transfers, own-account ones included, with device and address of the login."""
    login = session.select("session_id", "device_id", "ip_id")
    return (
        transaction.filter("txn_type = 'transfer' and status = 'completed'")
        .filter("account_id is not null and counterparty_account_id is not null")
        .join(login, "session_id", "left")
        .select(
            "transaction_id",
            F.col("account_id").alias("src_account_id"),
            F.col("counterparty_account_id").alias("dst_account_id"),
            "amount",
            iso_second(F.col("txn_time")).alias("txn_time"),
            "channel",
            "device_id",
            "ip_id",
        )
    )


def _used(session: DataFrame, place: str) -> DataFrame:
    return (
        session.filter(F.col(place).isNotNull())
        .groupBy("account_id", place)
        .agg(
            F.count(F.lit(1)).alias("session_count"),
            F.min("session_time").alias("first_seen"),
            F.max("session_time").alias("last_seen"),
        )
        .select(
            "account_id", place, "session_count",
            iso_second(F.col("first_seen")).alias("first_seen"),
            iso_second(F.col("last_seen")).alias("last_seen"),
        )
    )


def edge_used_device(session: DataFrame) -> DataFrame:
    return _used(session, "device_id")


def edge_used_ip(session: DataFrame) -> DataFrame:
    return _used(session, "ip_id")


def edge_has_contact(customer: DataFrame) -> DataFrame:
    return _contacts(customer).select("customer_id", "contact_key")


def graph_tables(table) -> dict[str, DataFrame]:
    """All node and edge tables; ``table`` returns a domain table by name."""
    return {
        "node_customer": node_customer(table("customer")),
        "node_account": node_account(table("account")),
        "node_device": node_device(table("device")),
        "node_ip": node_ip(table("ip_address")),
        "node_contact": node_contact(table("customer")),
        "edge_owns": edge_owns(table("account")),
        "edge_sent_to": edge_sent_to(table("transaction"), table("session")),
        "edge_used_device": edge_used_device(table("session")),
        "edge_used_ip": edge_used_ip(table("session")),
        "edge_has_contact": edge_has_contact(table("customer")),
    }


def write_csv(tables: dict[str, DataFrame], folder: str) -> None:
    """CSV files with a header line, one folder per table; transfers in order of time.

    Any text comes back as it was: it is quoted with doubled quotes, blanks at its ends stay, and an empty text, a
    line break or a backslash is written as a backslash and a letter or two backslashes, so that each row is one
    line, files can be split, and an empty text is told from a missing one.
    """
    for name, df in tables.items():
        if name == "edge_sent_to":
            df = df.orderBy("txn_time")
        texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
        df = df.withColumns({c: _escaped(F.col(c)) for c in texts})
        df.write.mode("overwrite").options(header=True, **_TEXT).csv(f"{folder}/{name}")


#: Quotes are doubled, as CSV has it, and nothing else stands for another character within the format.
_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _escaped(text: Column) -> Column:
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return F.when(text == "", "\\e").otherwise(text)


def _unescaped(text: Column) -> Column:
    """Undo `_escaped`: between two backslashes that belong together nothing is read as a line break."""
    parts = F.transform(
        F.split(text, r"\\\\"),
        lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
    )
    return F.when(text == "\\e", "").otherwise(F.array_join(parts, "\\"))


def read_csv(spark: SparkSession, folder: str, names=tuple(CSV_SCHEMAS)) -> dict[str, DataFrame]:
    """The tables read back with their types; ``is_vpn`` becomes true only for the text true."""
    tables = {}
    for name in names:
        df = (
            spark.read.schema(CSV_SCHEMAS[name])
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
            .options(**_TEXT)
            .csv(f"{folder}/{name}")
        )
        texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
        df = df.withColumns({c: _unescaped(F.col(c)) for c in texts})
        if name == "node_ip":
            df = df.withColumn("is_vpn", F.lower("is_vpn") == "true")
        tables[name] = df
    return tables


def attached_edges(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """The edges whose two ends both exist as nodes."""
    edges = tables[name]
    for column, node in EDGE_ENDS[name]:
        keys = tables[node].select(F.col(NODE_KEYS[node]).alias(column))
        edges = edges.join(keys, column, "left_semi")
    return edges.select(*tables[name].columns)


def duplicate_nodes(tables: dict[str, DataFrame]) -> DataFrame:
    """``(node, key, n)`` for keys that occur more than once; a graph load would refuse them."""
    found = None
    for name, key in NODE_KEYS.items():
        part = (
            tables[name].groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select(F.lit(name).alias("node"), "key", "n")
        )
        found = part if found is None else found.unionByName(part)
    return found
