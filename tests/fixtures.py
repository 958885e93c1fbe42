"""Small hand-made domain tables."""

from datetime import datetime, timedelta
from decimal import Decimal

START = datetime(2026, 3, 1, 9, 0, 0)


def at(hours=0.0, seconds=0):
    return START + timedelta(hours=hours, seconds=seconds)


EDGE = "transaction_id string, src string, dst string, amount decimal(18,2), txn_time timestamp_ntz"
SHARED = "account_id string, customer_id string, via string, value string"
TXN = (
    "transaction_id string, account_id string, counterparty_account_id string, session_id string, "
    "txn_time timestamp_ntz, amount decimal(18,2), currency string, txn_type string, "
    "channel string, branch_code string, description string, status string"
)
ACCOUNT = "account_id string, customer_id string, open_date date"
SESSION = "session_id string, account_id string, device_id string, ip_id string, session_time timestamp_ntz"


def edges(spark, rows):
    """Rows of (id, src, dst, amount, time)."""
    return spark.createDataFrame([(i, s, d, Decimal(str(a)), t) for i, s, d, a, t in rows], EDGE)


def shared(spark, rows):
    return spark.createDataFrame(rows, SHARED)


def txn(id, src=None, dst=None, amount="100.00", time=START, kind="transfer", session=None,
        channel="web", branch=None, status="completed"):
    return (id, src, dst, session, time, Decimal(amount), "AUD", kind, channel, branch, "", status)


def deposit(id, account, amount, time, branch="B1", status="completed"):
    return txn(id, None, account, amount, time, "cash_deposit", None, "branch", branch, status)


def transactions(spark, rows):
    return spark.createDataFrame(rows, TXN)


def accounts(spark, rows):
    return spark.createDataFrame(rows, ACCOUNT)


def sessions(spark, rows):
    return spark.createDataFrame(rows, SESSION)
