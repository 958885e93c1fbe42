"""The domain tables, presented from the sample star schema.

The sample data has events, orders and line items but no bank. These views give every row of
it a banking role: users are accounts, pairs of neighbouring users share an owner, events are
logins and transfers, line items are cash deposits, orders are cash withdrawals. So that every
rule has something to find, some events are long chains of transfers, some orders bursts of
deposits, and one device is registered twice. The text is plain SQL over ``{events}``, ``{orders}``, ``{lineitem}``, ``{customer}`` and ``{nation}``
that Spark and other SQL engines read alike, so the check queries start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("events", "orders", "lineitem", "customer", "nation")

# Texts may name @users, the number of user ids, and @session, the session view.
_USERS = "(select max(user_id) + 1 from {events})"

CUSTOMER = """
select 'CUS-' || cast(c.c_custkey as varchar(20)) as customer_id,
       case when c.c_mktsegment in ('MACHINERY', 'FURNITURE') then 'business' else 'retail' end
           as customer_type,
       c.c_name as full_name,
       case when c.c_mktsegment in ('MACHINERY', 'FURNITURE') then null
            else date '1950-01-01' + cast(c.c_custkey * 91 % 18000 as int) end as date_of_birth,
       n.n_name as nationality,
       case when c.c_custkey % 50 = 6 then null
            when c.c_custkey % 46 in (0, 2)
                then 'home' || cast(c.c_custkey - c.c_custkey % 46 as varchar(20)) || '@mail.example'
            else 'user' || cast(c.c_custkey as varchar(20)) || '@mail.example' end as email,
       case when c.c_custkey in (5, 12, 75) then ' '
            when c.c_custkey % 70 = 6 then null
            when c.c_custkey % 38 in (0, 4)
                then '04-' || cast(c.c_custkey - c.c_custkey % 38 as varchar(20))
            when c.c_custkey % 90 = 8
                then '04' || cast(c.c_custkey % (@users - 10) as varchar(20)) || ' '
            else '04' || cast(c.c_custkey % (@users - 10) as varchar(20)) end as phone,
       cast(c.c_custkey % (@users - 20) as varchar(20)) || ' Harbour Street' as address,
       c.c_mktsegment as occupation_or_industry,
       cast(c.c_acctbal as decimal(18, 2)) as declared_income_aud,
       case when c.c_custkey % 20 = 3 then 'pending' else 'verified' end as kyc_status,
       case when c.c_mktsegment in ('MACHINERY', 'FURNITURE') then
            '{{"abn": ' || case when c.c_custkey % 9 = 0 then 'null'
                              else '"' || cast(50000000000 + c.c_custkey as varchar(20)) || '"' end
            || ', "entity_type": "company", "directors": [{{"name": "' || c.c_name
            || '", "role": "director"}}], "source_of_funds": "trading"}}'
            else
            '{{"identity_documents": [{{"type": "passport", "country": "' || n.n_name
            || '"}}], "source_of_funds": "salary", "employer": '
            || case when c.c_custkey % 4 = 1 then 'null' else '"' || c.c_mktsegment || '"' end
            || ', "pep_flag": false}}' end as kyc_json,
       case when c.c_custkey % 11 = 0 then 'high' when c.c_custkey % 3 = 0 then 'medium'
            else 'low' end as risk_rating,
       date '1994-01-01' + cast(c.c_custkey * 53 % 500 as int) as onboard_dt,
       'active' as status,
       timestamp '1994-01-01 09:00:00' + interval '1' hour * cast(c.c_custkey % 10000 as int)
           as created_at
from   {customer} c
left join {nation} n on n.n_nationkey = c.c_nationkey
"""

ACCOUNT = """
select 'ACC-' || cast(user_id as varchar(20)) as account_id,
       'CUS-' || cast(user_id - user_id % 2 as varchar(20)) as customer_id,
       'N' || cast(100000 + user_id as varchar(20)) as account_number,
       case when user_id % 3 = 0 then 'savings' else 'transaction' end as account_type,
       'AUD' as currency,
       cast(user_id % 1000 + 0.25 as decimal(18, 2)) as balance,
       'active' as status,
       date '1994-01-01' + cast(user_id * 37 % 500 as int) as open_date,
       'BR-' || cast(user_id % 25 as varchar(20)) as branch_code
from  (select distinct user_id from {events}) u
"""

SESSION = """
select 'SES-' || cast(event_id as varchar(20)) as session_id,
       'ACC-' || cast(user_id as varchar(20)) as account_id,
       case when event_id % 40 = 0
                then 'DEV-S' || cast(cast(floor(event_id / 40.0) as bigint)
                                     % cast(floor(@users / 3.0) as bigint) as varchar(20))
            else 'DEV-U' || cast(user_id as varchar(20)) end as device_id,
       case when event_id % 25 = 1
                then 'IP-S' || cast(cast(floor(event_id / 25.0) as bigint)
                                    % cast(floor(@users / 3.0) as bigint) as varchar(20))
            when event_id % 60 = 2 then null
            else 'IP-U' || cast(user_id as varchar(20)) end as ip_id,
       ts as session_time,
       case when event_type in ('view', 'click') then 'web' else 'mobile_app' end as channel,
       case when event_type = 'signup' then 'otp' else 'password' end as auth_method
from   {events}
"""

DEVICE = """
select device_id,
       'fp-' || device_id as device_fingerprint,
       case when device_id like 'DEV-S%' then 'desktop' else 'mobile' end as device_type,
       case when device_id like 'DEV-S%' then 'windows' else 'android' end as os,
       min(session_time) as first_seen,
       max(session_time) as last_seen
from  (@session) s
group by device_id
union all
select device_id, 'fp2-' || device_id, 'desktop', 'linux', min(session_time), max(session_time)
from  (@session) s
where  device_id = 'DEV-S0'
group by device_id
"""

IP_ADDRESS = """
select ip_id,
       '10.' || cast(floor(num / 65536.0) as int) || '.' || cast(floor(num / 256.0) as int) % 256
             || '.' || cast(num % 256 as int) as ip_address,
       'Australia' as country,
       'Sydney' as city,
       case when kind <> 'S' then false when num % 3 = 0 then true when num % 3 = 1 then null
            else false end as is_vpn,
       cast(num % 100 as decimal(5, 2)) as risk_score
from  (select distinct ip_id, substring(ip_id, 4, 1) as kind,
              cast(substring(ip_id, 5, 20) as bigint) as num
       from (@session) s where ip_id is not null) i
"""

_TRANSFER = """
select 'TRF-' || cast(event_id as varchar(20)) as transaction_id,
       'ACC-' || cast(user_id as varchar(20)) as account_id,
       'ACC-' || cast((user_id + (case when event_id % 6 < 3 then event_id % 6 - 3
                                       else event_id % 6 - 2 end) + @users) % @users as varchar(20))
           as counterparty_account_id,
       case when event_id % 30 = 4 then null
            when event_id % 97 = 5 then 'SES-' || cast(event_id + 1 as varchar(20))
            else 'SES-' || cast(event_id as varchar(20)) end as session_id,
       ts as txn_time,
       cast(value as decimal(18, 2)) as amount,
       'AUD' as currency,
       'transfer' as txn_type,
       case when event_type in ('view', 'click') then 'web' else 'mobile_app' end as channel,
       case when event_id % 1000 = 9 then 'BR-1' end as branch_code,
       event_type as description,
       case when event_id % 50 = 7 then 'reversed' when event_id % 50 = 31 then 'blocked'
            else 'completed' end as status
from   {events}
"""

_DEPOSIT = """
select 'DEP-' || cast(l_orderkey as varchar(20)) || '-' || cast(l_linenumber as varchar(20))
             || '-' || cast(l_partkey as varchar(20)) || '-' || cast(l_suppkey as varchar(20)),
       case when l_orderkey % 1500 = 2 then 'ACC-0' end,
       'ACC-' || cast(l_suppkey as varchar(20)),
       cast(null as varchar(20)),
       l_shipdate + interval '1' hour * cast(l_partkey % 10 as int),
       cast(l_extendedprice as decimal(18, 2)),
       'AUD',
       'cash_deposit',
       'branch',
       case when l_orderkey % 800 = 3 then null
            else 'BR-' || cast(l_partkey % 25 as varchar(20)) end,
       l_returnflag,
       case when l_linestatus = 'F' and l_linenumber = 7 then 'reversed' else 'completed' end
from   {lineitem}
"""

_WITHDRAWAL = """
select 'WDR-' || cast(o_orderkey as varchar(20)),
       'ACC-' || cast(o_custkey % (@users + 2) as varchar(20)),
       case when o_orderkey % 1500 = 3 then 'ACC-1' end,
       cast(null as varchar(20)),
       o_orderdate + interval '1' hour * cast(o_orderkey % 25 as int),
       cast(o_totalprice / 5 as decimal(18, 2)),
       'AUD',
       'cash_withdrawal',
       'atm',
       case when o_orderkey % 500 = 3 then null
            else 'BR-' || cast(o_custkey % 25 as varchar(20)) end,
       o_orderpriority,
       'completed'
from   {orders}
"""

# Rows to take a row of the sample several times; the key 0 makes it a plain equality join.
_TIMES = "(" + " union all ".join(f"select {k} as k, 0 as z" for k in range(8)) + ")"

# Some events start money on its way over five to eight accounts, and half of it comes back.
_CHAIN = f"""
select 'CHN-' || cast(event_id as varchar(20)) || '-' || cast(k as varchar(20)),
       'ACC-' || cast((user_id + 2 * k) % @users as varchar(20)),
       'ACC-' || cast(case when back and k = hops - 1 then user_id
                           else (user_id + 2 * k + 2) % @users end as varchar(20)),
       cast(null as varchar(20)),
       ts + interval '1' hour * k,
       cast(950 + event_id % 40 - 12 * k as decimal(18, 2)),
       'AUD', 'transfer', 'web', cast(null as varchar(20)), event_type, 'completed'
from  (select event_id, user_id, ts, event_type, k,
              cast(floor(event_id / 1000.0) as int) % 2 = 0 as back,
              5 + cast(floor(event_id / 250.0) as int) % 4 as hops
       from {{events}} join {_TIMES} times on z = event_id % 250) c
where  k < hops or not back
"""

# Some orders are five deposits over eight days at two or three branches.
_BURST = f"""
select 'BST-' || cast(o_orderkey as varchar(20)) || '-' || cast(k as varchar(20)),
       cast(null as varchar(20)),
       'ACC-' || cast(o_custkey % @users as varchar(20)),
       cast(null as varchar(20)),
       o_orderdate + interval '48' hour * k,
       cast(3000 + 100 * k + o_custkey % 50 as decimal(18, 2)),
       'AUD', 'cash_deposit', 'branch',
       'BR-' || cast(k % (2 + cast(floor(o_orderkey / 100.0) as int) % 2) as varchar(20)),
       o_orderpriority, 'completed'
from   {{orders}} join {_TIMES} times on z = o_orderkey % 100
where  k < 5
"""

TRANSACTION = " union all ".join((_TRANSFER, _DEPOSIT, _WITHDRAWAL, _CHAIN, _BURST))

GROUND_TRUTH = """
select 'TRF-' || cast(event_id as varchar(20)) as transaction_id,
       case when event_id % 30 = 29 then 'round_trip_sub_threshold'
            when chain % 10 = 0 then 'round_trip'
            when chain % 10 = 1 then 'round_trip_shared_device'
            when chain % 10 = 2 then 'round_trip_phone_link'
            when chain % 10 = 3 then 'layering_chain'
            else 'normal' end as pattern_label,
       case when event_id % 30 = 29 then 'CT-' || cast(event_id as varchar(20))
            when chain % 10 < 4 then 'CH-' || cast(chain as varchar(20)) end as chain_id,
       case when event_id % 30 = 29 then 0
            when chain % 10 < 4 then cast(event_id % 3 as int) end as hop_index
from  (select event_id, cast(floor(event_id / 3.0) as bigint) as chain from {events}) e
union all
select 'DEP-' || cast(l_orderkey as varchar(20)) || '-' || cast(l_linenumber as varchar(20))
             || '-' || cast(l_partkey as varchar(20)) || '-' || cast(l_suppkey as varchar(20)),
       case when l_quantity = 7 then 'structuring' when l_quantity = 11 then 'mule_network'
            else 'normal' end,
       case when l_quantity = 7 then 'CS-' || cast(l_suppkey as varchar(20))
            when l_quantity = 11
                then 'CM-' || cast(cast(floor(l_suppkey / 4.0) as bigint) as varchar(20)) end,
       case when l_quantity in (7, 11) then cast(l_linenumber % 2 as int) end
from   {lineitem}
union all
select case when o_orderkey % 1000 = 1 then 'LOST-' else 'WDR-' end
             || cast(o_orderkey as varchar(20)),
       'normal', cast(null as varchar(20)), cast(null as int)
from   {orders}
"""

BRANCH_ACCESS_MAP = """
select 'AML_BRANCH_STAFF' as role_name, 'BR-' || cast(n_nationkey as varchar(20)) as branch_code
from   {nation} where n_regionkey = 1
"""

_TEXTS = {
    "customer": CUSTOMER,
    "account": ACCOUNT,
    "session": SESSION,
    "device": DEVICE,
    "ip_address": IP_ADDRESS,
    "transaction": TRANSACTION,
    "ground_truth": GROUND_TRUTH,
    "branch_access_map": BRANCH_ACCESS_MAP,
}
VIEWS = {
    name: text.replace("@session", SESSION).replace("@users", _USERS)
    for name, text in _TEXTS.items()
}


class SampleTables:
    """Domain tables over the sample Parquet files in one folder; each file is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._base: dict[str, DataFrame] = {}

    def _base_table(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        return self._base[name]

    def __call__(self, name: str) -> DataFrame:
        text = VIEWS[name]
        used = {t: self._base_table(t) for t in BASE_TABLES if f"{{{t}}}" in text}
        table = self._spark.sql(text, **used)
        if name == "customer":
            table = table.withColumn("kyc_payload", F.parse_json("kyc_json")).drop("kyc_json")
        return table
