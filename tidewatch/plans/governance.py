"""Who may see what. Spark has no session role, so the role is an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Roles, mask text and the catalogue of personal data.
PII_ROLES = ("AML_ANALYST", "ACCOUNTADMIN")
ALL_BRANCH_ROLES = ("AML_ANALYST", "AML_DATA_ENGINEER", "ACCOUNTADMIN")
MASK = "****MASKED****"
PII_CATALOG = (
    ("CUSTOMER", "full_name", "identity"),
    ("CUSTOMER", "date_of_birth", "identity"),
    ("CUSTOMER", "email", "contact"),
    ("CUSTOMER", "phone", "contact"),
    ("CUSTOMER", "address", "contact"),
    ("CUSTOMER", "kyc_payload", "identity_document"),
    ("ACCOUNT", "account_number", "financial"),
)
MASKED_TEXT = ("full_name", "email", "phone", "address")
MASKED_NULL = ("date_of_birth",)


def customer_secure(customer: DataFrame, role: str) -> DataFrame:
    """Customers with personal columns masked, unless the role may see them. The identity
    document is catalogued as personal but, as specified, not masked."""
    if role in PII_ROLES:
        return customer

    def shown(name: str) -> Column:
        if name in MASKED_TEXT:
            return F.lit(MASK).alias(name)
        if name in MASKED_NULL:
            return F.lit(None).cast(customer.schema[name].dataType).alias(name)
        return F.col(name)

    return customer.select(*[shown(name) for name in customer.columns])


def transaction_secure(transaction: DataFrame, branch_access: DataFrame, role: str) -> DataFrame:
    """All transactions for roles without branch limits, else those of the role's branches."""
    if role in ALL_BRANCH_ROLES:
        return transaction
    allowed = branch_access.filter(F.col("role_name") == role).select("branch_code").distinct()
    return transaction.join(allowed, "branch_code", "left_semi").select(*transaction.columns)


def pii_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PII_CATALOG, "table_name string, column_name string, classification string"
    )


def pii_columns(catalog: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """The catalogue with the number of rows that hold a value in each listed column."""
    counts = None
    for name, df in tables.items():
        listed = [c for t, c, _ in PII_CATALOG if t == name.upper() and c in df.columns]
        wide = df.agg(*[F.count(c).alias(c) for c in listed])
        pairs = F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("values")) for c in listed])
        )
        part = wide.select(F.lit(name.upper()).alias("table_name"), pairs.alias("p")).select(
            "table_name", "p.*"
        )
        counts = part if counts is None else counts.unionByName(part)
    return catalog.join(counts, ["table_name", "column_name"], "left")
