"""The same questions as SQL over the sample tables, to check the jobs against.

The SQL states each rule directly (recursion, comparing every pair, windows) and shares
nothing with the jobs but the text of the domain views. Each entry of ``WITH`` is a named
subquery; a check pulls in the ones it uses.
"""

from __future__ import annotations

import re

from tidewatch.functions import labels
from tidewatch.plans.governance import ALL_BRANCH_ROLES, MASK, PII_CATALOG
from tidewatch.sources.landing import FIELDS, FILES
from tidewatch.sources.sample import BASE_TABLES, VIEWS


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _second(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S')"


def _decay(first: str, last: str) -> str:
    """Percent lost, rounded half up to one decimal, in whole cents."""
    f, l = f"cast({first} * 100 as hugeint)", f"cast({last} * 100 as hugeint)"
    return f"(((2000 * ({f} - {l}) + {f}) // (2 * {f})) / 10.0)"


def _follows(edge: str) -> str:
    """Which transfer may come right after which."""
    return f"""
    select e.id, n.id as next_id, n.dst as next_dst
    from {edge} n inner join {edge} e on e.dst = n.src
    where n.amt between e.amt * 0.80 and e.amt
      and n.ts - e.ts between interval 1 microsecond and interval 48 hours"""


def _trail(edge: str, follows: str, revisit: bool) -> str:
    """Lists of transfers that follow one another, grown at the end, with the accounts passed."""
    allowed = "" if revisit else " and going and not list_contains(path[2:], next_dst)"
    return f"""
    select [id] as ids, [src, dst] as path, src <> dst as going from {edge}
    union all
    select ids || [next_id], path || [next_dst], next_dst <> path[1]
    from @SELF, {follows} where {follows}.id = ids[-1] and len(ids) <= 7{allowed}"""


def _walk(edge: str, trail: str) -> str:
    return f"""
    select path[1] as origin, path[-1] as cur, z.ts as last_time, z.amt as last_amount,
           a.amt as first_amount, len(ids) as hops, path, ids
    from {trail}, {edge} a, {edge} z where a.id = ids[1] and z.id = ids[-1]"""


def _windows(least_deposits: int) -> str:
    """Each account's ten days that end at a deposit and hold most deposits, as a list of them."""
    return f"""
    select account_id, arg_min(ds, (-len(ds), -list_sum([d.amount for d in ds]), window_end)) as ds
    from (select account_id, txn_time as window_end, list(deposit) over ten_days as ds from small_deposits
          window ten_days as (partition by account_id order by txn_time
                              range between interval '9 days 23:59:59.999999' preceding and current row))
    where len(ds) >= {least_deposits} and len(list_distinct([d.branch for d in ds])) > 1
    group by account_id"""


def _rolling(windows: str) -> str:
    return f"""
    select account_id, len(ds) as n_deposits, len(list_distinct([d.branch for d in ds])) as n_branches,
           list_sum([d.amount for d in ds]) as total_amount, list_max([d.amount for d in ds]) as max_single,
           list_min([d.at for d in ds])::date as first_day, list_max([d.at for d in ds])::date as last_day,
           array_to_string(list_sort(list_distinct([d.branch for d in ds])), ',') as branches,
           array_to_string([d.id for d in list_sort(ds)], ',') as txn_ids
    from {windows}"""


_CONTACTS = "(values ('phone'), ('email'), ('address'))"

WITH = {
    **{f"x_{name}": text.format(**{t: t for t in BASE_TABLES}) for name, text in VIEWS.items()},
    "p1_edge": """
    select transaction_id as id, account_id as src, counterparty_account_id as dst, amount as amt, txn_time as ts
    from x_transaction tr
    where (txn_type, status) = ('transfer', 'completed')
      and (select max(customer_id) from x_account where x_account.account_id = tr.account_id)
          <> (select max(customer_id) from x_account where x_account.account_id = tr.counterparty_account_id)""",
    "holder": """
    select account_id as acc, customer_id as cust, via, val
    from x_account natural join
         (select * from (unpivot (select customer_id, phone, email from x_customer) on phone, email
                         into name via value val))
    union
    select account_id, customer_id, 'device', device_id
    from (select account_id, device_id from x_session where device_id is not null) natural join x_account""",
    "link": """
    select distinct p.acc as a, q.acc as b, via
    from (select via, list({'acc': acc, 'cust': cust}) as users from holder group by via, val) g,
         unnest(g.users) as t(p), unnest(g.users) as u(q)
    where p.cust <> q.cust""",
    "follows": _follows("p1_edge"),
    "trail": _trail("p1_edge", "follows", False).replace("@SELF", "trail"),
    "walk": _walk("p1_edge", "trail"),
    "closer": "select a, b, min(via) as via from link group by all",
    "candidate": """
    select walk.*, if(cur = origin, 'same_account', 'linked_' || via) as closed_by
    from walk left join closer on (a, b) = (origin, cur)
    where hops > 2 and (cur = origin or via is not null)""",
    "maximal": """
    select small.* from candidate small
    anti join candidate large on len(large.ids) > len(small.ids) and list_has_all(large.ids, small.ids)""",
    "ring_links": """
    select ids, count(*) as shared_pairs, string_agg(distinct via, ',' order by via) as shared_via
    from maximal join link on list_has_all(path, [a, b]) group by ids""",
    "ring": f"""
    select maximal.*, coalesce(shared_pairs, 0) as shared_pairs, coalesce(shared_via, '') as shared_via,
           {_decay('first_amount', 'last_amount')} as decay_pct, array_to_string(maximal.ids, ',') as path_key
    from maximal left join ring_links on ring_links.ids = maximal.ids""",
    "tiered": """
    select *, if(closed_by = 'same_account' and shared_pairs = 0, 'medium', 'high') as tier from ring""",
    "long_walk": "select * from walk where hops >= 4",
    "chain": f"""
    select w.*, {_decay('w.first_amount', 'w.last_amount')} as decay_pct, array_to_string(w.ids, ',') as path_key
    from long_walk w
    anti join long_walk more on more.hops > w.hops and list_has_all(more.ids, w.ids)
    anti join maximal r on list_has_any(r.ids, w.ids)
    where w.cur <> w.origin""",
    "passing": """
    select distinct came.account_id
    from (select counterparty_account_id as account_id, txn_time as at, amount as got
          from x_transaction where status = 'completed' and amount >= 1000) came
    semi join (select account_id, txn_time as at, amount as paid from x_transaction where status = 'completed') went
         on went.account_id = came.account_id and went.paid between 0.90 * came.got and came.got
            and went.at - came.at between interval 1 microsecond and interval 24 hours""",
    "member": """
    select device_id, account_id, customer_id
    from x_account natural join (select distinct device_id, account_id from x_session)
    where account_id in (from passing) and open_date + 150 >= (select min(txn_time)::date from x_transaction)""",
    "mules": """
    select device_id, len(list_distinct(owners)) as n_customers, len(users) as n_accounts, users[1] as first_account,
           array_to_string(users, ',') as accounts
    from (select device_id, list(customer_id) as owners, list(account_id order by account_id) as users
          from member group by device_id)
    where len(list_distinct(owners)) > 2""",
    "mule_accounts": "select device_id, account_id, customer_id from member where device_id in (select device_id from mules)",
    "band": """
    select counterparty_account_id as account_id, txn_time::date as day,
           {'at': txn_time, 'id': transaction_id, 'amount': amount, 'branch': branch_code} as deposit
    from x_transaction
    where (txn_type, status) = ('cash_deposit', 'completed') and amount >= 7000 and amount < 10000""",
    "flagged": """
    select account_id, list_sort(flatten(list(ds))) as ds, count(*) as n_days
    from (select account_id, day, list(deposit) as ds from band where account_id is not null group by all)
    where len(ds) > 1 and list_sum([d.amount for d in ds]) >= 10000
    group by account_id""",
    "daily": """
    select account_id, n_days, len(ds) as n_deposits, list_sum([d.amount for d in ds]) as total_amount,
           len(list_distinct([d.branch for d in ds])) as n_branches, ds[1].at::date as first_day,
           ds[-1].at::date as last_day, ds[1].id as first_txn, array_to_string([d.id for d in ds], ',') as txn_ids,
           array_to_string(list_sort(list_distinct([d.branch for d in ds])), ',') as branches
    from flagged""",
    "small_deposits": """
    select counterparty_account_id as account_id, txn_time,
           {'at': txn_time, 'id': transaction_id, 'amount': amount, 'branch': branch_code} as deposit
    from x_transaction
    where (txn_type, status) = ('cash_deposit', 'completed') and amount < 10000
      and coalesce(counterparty_account_id || branch_code, '') <> ''""",
    "windows_5": _windows(5),
    "windows_3": _windows(3),
    "rolling": _rolling("windows_5"),
    "rolling_3": _rolling("windows_3"),
    "found": """
    select origin as account_id, ids[1] as transaction_id, 'round_trip' as alert_type,
           case when tier = 'high' then 90 else 60 end as fraud_score, tier, closed_by, hops,
           decay_pct, cast(null as varchar) as device_id, cast(null as bigint) as n_deposits,
           cast(null as decimal(38, 2)) as total_amount, path_key as k
    from tiered
    union all
    select origin, ids[1], 'layering_chain', 60, 'medium', null, hops, decay_pct, null, null, null,
           path_key from chain
    union all
    select first_account, null, 'mule_network', 60, 'medium', null, null, null, device_id, null, null,
           device_id from mules
    union all
    select account_id, first_txn, 'structuring', 60, 'medium', null, null, null, null, n_deposits,
           total_amount, account_id from daily""",
    "alert": """
    select 'ALT-' || case when n < 1000000 then lpad(cast(n as varchar), 6, '0') else cast(n as varchar) end
               as alert_id, f.*
    from (select *, row_number() over (order by alert_type, account_id, transaction_id nulls last, k) as n
          from found) f""",
    "detection": """
    select 'R:' || path_key as det_id, tier, ids from tiered
    union all by name select 'L:' || path_key as det_id, 'medium' as tier, ids from chain""",
    "det_txn": "select det_id, tier, unnest(ids) as transaction_id from detection",
    "path_label": "select * from x_ground_truth where regexp_matches(pattern_label, '^(round_trip.*|layering_chain)$')",
    "labelled_account": """
    select pattern_label, chain_id, hop_index, counterparty_account_id as account_id
    from x_transaction natural join x_ground_truth where pattern_label in ('mule_network', 'structuring')""",
    "mule_label": "select distinct chain_id, account_id from labelled_account where pattern_label[1] = 'm' and hop_index = 0",
    "structuring_label": "select distinct chain_id, account_id from labelled_account where pattern_label[1] = 's'",
    "hits": "select chain_id, det_id, tier, count(*) as hit_txn from path_label natural join det_txn group by all",
    "best": """
    select chain_id, unnest(arg_min({'hit_txn': hit_txn, 'tier': tier, 'det_id': det_id}, (-hit_txn, tier, det_id)))
    from hits group by chain_id""",
    "recall": """
    select pattern_label, chain_id, n_txn, ifnull(hit_txn, 0) as hit_txn, tier
    from (select pattern_label, chain_id, count(*) as n_txn from path_label group by all) left join best using (chain_id)
    union all
    select 'mule_network', chain_id, sum(greatest(seen, 1)), sum(seen), null
    from (select chain_id, (select count(*) from mule_accounts m where m.account_id = x.account_id) as seen
          from mule_label x) group by chain_id
    union all
    select 'structuring', chain_id, 1, max(if(account_id in (select account_id from daily), 1, 0)), null
    from structuring_label group by chain_id""",
    "by_pattern": """
    select pattern_label, count(*) as chains, count_if(hit_txn = n_txn) as found_full,
           count_if(hit_txn between 1 and n_txn - 1) as found_partial, count_if(hit_txn = 0) as missed,
           array_to_string(list_sort(list_distinct(list(tier))), ',') as tiers
    from recall group by pattern_label""",
    "right_txn": "select transaction_id from x_ground_truth where pattern_label <> 'normal'",
    "right_det": "select distinct det_id[1] as kind, det_id from det_txn where transaction_id in (from right_txn)",
    "right_device": "select distinct device_id from mule_accounts where account_id in (select account_id from mule_label)",
    "fp": """
    select * from (values
      ('round_trip (detector)', (select count(*) from tiered) - (select count(*) from right_det where kind = 'R')),
      ('layering (detector)', (select count(*) from chain) - (select count(*) from right_det where kind = 'L')),
      ('mule (detector)', (select count(*) from mules) - (select count(*) from right_device)),
      ('structuring (detector)', (select count(*) from daily anti join structuring_label using (account_id)))
    ) f(pattern_label, false_positives)""",
    "bench": """
    select pattern_label, chains, found_full, found_partial, missed, tiers,
           cast(null as bigint) as false_positives
    from by_pattern
    union all
    select pattern_label, null, null, null, null, null, false_positives from fp""",
    "contact": f"""
    select customer_id, kind, trim(case kind when 'phone' then phone when 'email' then email else address end)
               as value
    from x_customer cross join {_CONTACTS} k(kind)""",
    "contact_key": """
    select customer_id, kind, value, kind || '|' || value as contact_key from contact where value <> ''""",
    "sent": f"""
    select t.transaction_id as id, t.account_id as src, t.counterparty_account_id as dst, t.amount as amt,
           date_trunc('second', t.txn_time) as ts, t.channel, s.device_id, s.ip_id
    from x_transaction t left join x_session s using (session_id)
    where t.txn_type = 'transfer' and t.status = 'completed'
      and t.account_id is not null and t.counterparty_account_id is not null""",
    "g_follows": _follows("sent"),
    "g_trail": _trail("sent", "g_follows", True).replace("@SELF", "g_trail"),
    "g_walk": _walk("sent", "g_trail"),
    "g_path": """
    select *, array_to_string(ids, ',') as path_key from g_walk where hops >= 3""",
    "g_holder": """
    select a.account_id as acc, a.customer_id as cust, 'contact' as via, k.contact_key as val
    from x_account a join contact_key k using (customer_id) where k.kind in ('phone', 'email')
    union all
    select distinct a.account_id, a.customer_id, 'device', s.device_id
    from x_session s join x_account a using (account_id) where s.device_id is not null""",
    "g_shared": """
    select p.acc as a, q.acc as b, p.via, p.val
    from g_holder p join g_holder q on p.via = q.via and p.val = q.val and p.cust <> q.cust""",
    "g_closing": """
    select *, case when cur = origin then 'same_account' else 'linked' end as closed_by from g_path w
    where cur = origin or exists (select 1 from g_shared l where l.a = w.origin and l.b = w.cur)""",
    "g_ring": """
    select c.*, case when closed_by = 'linked'
                       or exists (select 1 from g_shared l where list_contains(c.path, l.a)
                                                             and list_contains(c.path, l.b))
                     then 'high' else 'medium' end as tier
    from g_closing c
    where not exists (select 1 from g_closing b where len(b.ids) > len(c.ids) and list_has_all(b.ids, c.ids))""",
    "g_evidence": """
    select r.path_key, 'closing' as kind, l.a, l.b, l.val as value
    from g_ring r join g_shared l on l.a = r.origin and l.b = r.cur and l.via = 'contact'
    where r.origin <> r.cur
    union all
    select r.path_key, l.via, l.a, l.b, l.val
    from g_ring r join g_shared l on list_contains(r.path, l.a) and list_contains(r.path, l.b) and l.a < l.b""",
    "g_users": """
    select distinct s.device_id, a.account_id, a.customer_id
    from x_session s join x_account a using (account_id) join x_customer c using (customer_id)
    where s.device_id is not null and c.onboard_dt >= date '1995-01-01' - 150""",
    "g_mule": """
    select u.* from g_users u
    where device_id in (select device_id from g_users group by 1 having count(distinct customer_id) >= 3)""",
}
_RECURSIVE = {"trail", "g_trail"}
_ORDER = list(WITH)


def _uses(text: str) -> set[str]:
    return set(re.findall(r"[a-z_0-9]+", text)) & set(WITH)


def _needed(text: str) -> list[str]:
    todo, seen = _uses(text), set()
    while todo:
        name = todo.pop()
        if name not in seen:
            seen.add(name)
            todo |= _uses(WITH[name]) - {name}
    return [name for name in _ORDER if name in seen]


def check(select: str) -> str:
    """A complete statement: the named subqueries it needs, then the select."""
    needed = _needed(select)
    if not needed:
        return select
    recursive = "recursive " if _RECURSIVE & set(needed) else ""
    return f"with {recursive}" + ",\n".join(f"{n} as ({WITH[n]})" for n in needed) + "\n" + select


def _curated(name: str) -> str:
    columns = []
    for field, kind in FIELDS[name].items():
        if kind == "variant":
            columns.append("json_extract_string(kyc_json, '$.abn') as abn")
            columns.append("json_extract_string(kyc_json, '$.source_of_funds') as source_of_funds")
        elif kind.startswith("decimal"):
            columns.append(f"cast({field} as double) as {field}")
        elif kind == "date":
            columns.append(f"cast({field} as varchar) as {field}")
        elif kind == "timestamp_ntz":
            columns.append(f"{_time(field)} as {field}")
        elif kind == "int":
            columns.append(f"cast({field} as bigint) as {field}")
        else:
            columns.append(field)
    return f"select {', '.join(columns)} from x_{name}"


def _names(table: dict[str, str], code: str) -> str:
    return f"case {code} " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items()) + " end"


def _title(code: str) -> str:
    return f"upper({code}[1:1]) || lower({code}[2:])"


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(f"select '{k}' as tbl, count(*) as n from {v}" for k, v in tables.items())


_PATTERN = f"coalesce({_names(labels.PATTERNS, 'pattern_label')}, pattern_label)"
_WALK_COLUMNS = f"""origin, cur, {_time('last_time')} as last_time, cast(last_amount as double) as last_amount,
    cast(first_amount as double) as first_amount, cast(hops as bigint) as hops,
    array_to_string(path, ',') as path, array_to_string(ids, ',') as txn_ids,
    array_to_string(ids, ',') as path_key"""
_AMOUNTS = "cast(first_amount as double) as first_amount, cast(last_amount as double) as last_amount"
_DAILY = """cast(n_days as bigint) as n_days, cast(n_deposits as bigint) as n_deposits,
    cast(total_amount as double) as total_amount, cast(n_branches as bigint) as n_branches,
    cast(first_day as varchar) as first_day, cast(last_day as varchar) as last_day"""
_ROLLING = """account_id, n_deposits, n_branches, cast(total_amount as double) as total_amount,
    cast(max_single as double) as max_single, cast(first_day as varchar) as first_day,
    cast(last_day as varchar) as last_day, cast(last_day - first_day + 1 as bigint) as n_days, branches,
    txn_ids, if(n_branches >= 3, 'high', 'medium') as tier, 0::bigint as part, 1::bigint as parts"""
#: The sample's lists are short.
_ONE_PART = "0::bigint as part, 1::bigint as parts"
_BENCH = """pattern_label, cast(chains as bigint) as chains, cast(found_full as bigint) as found_full,
    cast(found_partial as bigint) as found_partial, cast(missed as bigint) as missed, tiers"""


def _shared_place(place: str, where: str = "true") -> str:
    """Pairs of sessions of different customers at one place, summed up by pair of customers."""
    return f"""
    select p.who as customer_a, q.who as customer_b, {place}, count(*) as session_count,
           {_time('min(least(p.at, q.at))')} as first_seen, {_time('max(greatest(p.at, q.at))')} as last_seen
    from (select {place}, list({{'who': customer_id, 'at': session_time}}) as visits
          from x_session natural join (select account_id, customer_id from x_account)
          where {place} is not null and {where} group by {place}) place,
         unnest(place.visits) as t(p), unnest(place.visits) as u(q)
    where p.who < q.who group by all"""


_RAISED = "'2024-07-01 09:30:00.000000'"
_OPEN_IP = "ip_id in (select ip_id from x_ip_address where is_vpn is not true)"
_CASH = "coalesce(channel in ('branch', 'atm'), false)"


def _broken(rule: str, child: str, row: str, key: str, parent: str, parent_key: str, nullable: bool) -> str:
    null_rule = f" and c.{key} is not null" if nullable else ""
    return f"""select '{rule}' as rule, c.{row} as row_id, c.{key} as missing_key from x_{child} c
    where not exists (select 1 from x_{parent} p where p.{parent_key} = c.{key}){null_rule}"""


_FK = " union all ".join([
    _broken("account -> customer", "account", "account_id", "customer_id", "customer", "customer_id", False),
    _broken("session -> account", "session", "session_id", "account_id", "account", "account_id", False),
    _broken("session -> device", "session", "session_id", "device_id", "device", "device_id", False),
    _broken("session -> ip", "session", "session_id", "ip_id", "ip_address", "ip_id", False),
    _broken("transaction -> account", "transaction", "transaction_id", "account_id", "account", "account_id", True),
    _broken("transaction -> counterparty", "transaction", "transaction_id", "counterparty_account_id", "account",
            "account_id", True),
    _broken("transaction -> session", "transaction", "transaction_id", "session_id", "session", "session_id", True),
])
_NEAREST = f"""
    select t.transaction_id, t.account_id, {_time('t.txn_time')} as txn_time,
           (select s.session_id from x_session s where s.account_id = t.account_id
            order by abs(epoch_us(s.session_time) - epoch_us(t.txn_time)), s.session_time < t.txn_time desc,
                     case when s.session_time < t.txn_time then s.session_id end desc, s.session_id
            limit 1) as session_id
    from x_transaction t where t.account_id is not null"""

_GRAPH_TABLES = {
    "node_customer": """select customer_id, customer_type, risk_rating, kyc_status,
        cast(onboard_dt as varchar) as onboard_dt, status from x_customer""",
    "node_account": "select account_id, customer_id, account_type, branch_code, status from x_account",
    "node_device": "select device_id, device_type, os from x_device",
    "node_ip": "select ip_id, ip_address, country, is_vpn from x_ip_address",
    "node_contact": "select distinct kind, value, contact_key from contact_key",
    "edge_owns": "select customer_id, account_id from x_account",
    "edge_sent_to": f"""select id as transaction_id, src as src_account_id, dst as dst_account_id,
        cast(amt as double) as amount, {_second('ts')} as txn_time, channel, device_id, ip_id from sent""",
    "edge_used_device": f"""select account_id, device_id, count(*) as session_count,
        {_second('min(session_time)')} as first_seen, {_second('max(session_time)')} as last_seen
        from x_session where device_id is not null group by 1, 2""",
    "edge_used_ip": f"""select account_id, ip_id, count(*) as session_count,
        {_second('min(session_time)')} as first_seen, {_second('max(session_time)')} as last_seen
        from x_session where ip_id is not null group by 1, 2""",
    "edge_has_contact": "select customer_id, contact_key from contact_key",
}


def _masked(role: str) -> str:
    text = _curated("customer").replace("json_extract_string(kyc_json, '$.abn') as abn, ", "")
    if role in ("AML_ANALYST", "ACCOUNTADMIN"):
        return text
    for name in ("full_name", "email", "phone", "address"):
        text = re.sub(rf"(?<=[ ,]){name},", f"'{MASK}' as {name},", text, count=1)
    return text.replace("cast(date_of_birth as varchar) as date_of_birth", "cast(null as varchar) as date_of_birth")


def _secure_rows(role: str) -> str:
    text = _curated("transaction")
    if role in ALL_BRANCH_ROLES:
        return text
    return text + f""" t where exists (select 1 from x_branch_access_map m
        where m.role_name = '{role}' and m.branch_code = t.branch_code)"""


def _selects() -> dict[str, str]:
    entity_tables = [n for n in FILES if n != "ground_truth"]
    keys = {n: next(iter(FIELDS[n])) for n in FIELDS}
    pii = " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, '{k}' as classification, "
        f"(select count({'kyc_json' if c == 'kyc_payload' else c}) from x_{t.lower()}) as \"values\""
        for t, c, k in PII_CATALOG
    )
    bench_number = "cast(sum({0}) as bigint) as {1}"
    return {
        "stage_listing": " union all ".join(
            f"select '{f}.jsonl' as entity, true as arrived" for f in FILES.values()),
        "land_raw_json": " union all ".join(
            f"select '{FILES[n]}.jsonl' as src_file, {keys[n]} as first_key, true as stamped from x_{n}"
            for n in entity_tables),
        "land_ground_truth": _curated("ground_truth"),
        "raw_row_counts": _counts({f"{n.upper()}_RAW": f"x_{n}" for n in entity_tables}),
        "raw_sample": "select min(customer_id) as customer_id, "
            f"'{','.join(sorted(FIELDS['customer']))}' as keys from x_customer",
        **{f"curate_{n}": _curated(n) for n in entity_tables},
        "reset_curated": _counts({n.upper(): f"x_{n}" for n in FILES}),
        "published_run": _counts({
            "EDGES": "p1_edge", "LONG_WALKS": "(select * from walk where hops > 1)", "CANDIDATES": "candidate",
            "SHARED": "(select distinct acc, via, val from holder where (via, val) in"
                      " (select (via, val) from holder group by via, val having count(distinct cust) > 1))",
            "ROUND_TRIP": "tiered", "LAYERING": "chain", "MULE_MEMBERS": "member", "MULE": "mules",
            "MULE_LISTS": "mules", "STRUCTURING": "daily", "STRUCTURING_LISTS": "daily",
            "FLAGGED_DEPOSITS": "(select unnest(ds) from flagged)", "ALERTS": "found", "BENCHMARK": "bench"}),
        **_GRAPH_TABLES,
        "graph_csv_sink": _counts({n: f"({t}) t" for n, t in _GRAPH_TABLES.items()}),
        "graph_csv_source": " union all ".join([
            "select 'edge_owns' as edge, customer_id as start_key, account_id as end_key from x_account"
            " where customer_id in (select customer_id from x_customer)",
            "select 'edge_sent_to', src, dst from sent where len(list_intersect([src, dst],"
            " (select list(account_id) from x_account))) = len(list_distinct([src, dst]))",
            *[f"select distinct 'edge_used_{k}', account_id, {k}_id from x_session where {k}_id is not null"
              " and account_id in (select account_id from x_account)"
              f" and {k}_id in (select {k}_id from x_{v})" for k, v in (("device", "device"), ("ip", "ip_address"))],
            "select 'edge_has_contact', customer_id, contact_key from contact_key"]),
        "graph_csv_transfers": f"""select id as transaction_id, src as src_account_id, dst as dst_account_id,
            cast(amt as double) as amount, {_time('ts')} as txn_time, channel, device_id, ip_id from sent
            where src in (select account_id from x_account) and dst in (select account_id from x_account)""",
        "graph_duplicate_nodes": " union all ".join(
            f"select '{n}' as node, {k} as key, count(*) as n from ({_GRAPH_TABLES[n]}) t group by 2 having count(*) > 1"
            for n, k in (("node_customer", "customer_id"), ("node_account", "account_id"),
                         ("node_device", "device_id"), ("node_ip", "ip_id"), ("node_contact", "contact_key"))),
        # quality
        "table_row_counts": _counts({n.upper(): f"x_{n}" for n in FILES}),
        "orphan_check": """select
            (select count(*) from x_account a where not exists
                (select 1 from x_customer c where c.customer_id = a.customer_id)) as orphan_accounts,
            (select count(*) from x_session s where not exists
                (select 1 from x_account a where a.account_id = s.account_id)) as orphan_sessions,
            (select count(*) from x_transaction t where t.account_id is not null and not exists
                (select 1 from x_account a where a.account_id = t.account_id)) as orphan_txn_src,
            (select count(*) from x_transaction t where t.counterparty_account_id is not null and not exists
                (select 1 from x_account a where a.account_id = t.counterparty_account_id)) as orphan_txn_dst""",
        "null_landing_check": """select txn_type, count(*) as txn_count, count(account_id) as has_src,
            count(counterparty_account_id) as has_dst, count(branch_code) as has_branch
            from x_transaction group by 1""",
        "variant_shape_check": """select customer_type, count(*) as customers,
            count(json_extract(kyc_json, '$.abn')) as have_abn,
            count(json_extract(kyc_json, '$.identity_documents')) as have_id_docs,
            count(json_extract(kyc_json, '$.directors')) as have_directors from x_customer group by 1""",
        "structuring_band_check": """select count(*) as cash_deposits,
            count(*) filter (amount between 7000 and 9999.99) as in_structuring_band,
            cast(max(amount) as double) as largest from x_transaction where txn_type = 'cash_deposit'""",
        "link_view_counts": f"""select 'shared_device_pairs' as view, count(*) as n from ({_shared_place('device_id')}) d
            union all select 'shared_ip_pairs', count(*) from ({_shared_place('ip_id', _OPEN_IP)}) i""",
        "fk_violations": _FK,
        "session_owner_violations": """select t.transaction_id, t.session_id, s.account_id as session_account,
            t.account_id from x_transaction t join x_session s using (session_id)
            where s.account_id is distinct from t.account_id""",
        "null_rule_violations": f"""
            select 'cash_deposit has a payer' as rule, transaction_id from x_transaction
            where txn_type = 'cash_deposit' and account_id is not null
            union all select 'cash_withdrawal has a receiver', transaction_id from x_transaction
            where txn_type = 'cash_withdrawal' and counterparty_account_id is not null
            union all select 'cash channel without branch', transaction_id from x_transaction
            where {_CASH} and branch_code is null
            union all select 'digital channel with branch', transaction_id from x_transaction
            where not {_CASH} and branch_code is not null""",
        "ground_truth_coverage": """select
            (select count(distinct transaction_id) from x_transaction
             where transaction_id not in (select transaction_id from x_ground_truth)) as unlabelled,
            (select count(distinct transaction_id) from x_ground_truth
             where transaction_id not in (select transaction_id from x_transaction)) as orphaned""",
        "payload_shape_diff": """select key, bool_or(customer_type = 'business') as in_business,
            bool_or(customer_type = 'retail') as in_retail
            from (select customer_type, unnest(json_keys(kyc_json)) as key from x_customer) k group by 1""",
        "label_histogram": """select pattern_label, count(*) as n, count(distinct chain_id) as chains,
            round(100.0 * count(*) / (select count(*) from x_ground_truth), 2) as pct
            from x_ground_truth group by 1""",
        "nearest_session_join": _NEAREST,
        # links
        "shared_device_link": _shared_place("device_id"),
        "shared_ip_link": _shared_place("ip_id", _OPEN_IP),
        "shared_contact_link": " union all ".join(
            f"""select c.customer_id as customer_a, d.customer_id as customer_b, '{k}' as match_type,
            c.{k} as match_value from x_customer c join x_customer d
            on c.{k} = d.{k} and c.customer_id < d.customer_id""" for k in ("email", "phone", "address")),
        "high_risk_links": f"""select * from (with seen as (
              select 'device' as kind, device_id as val, customer_id as cust from x_session join x_account using (account_id)
              where device_id is not null
              union
              select 'ip', ip_id, customer_id from x_session join x_account using (account_id)
              where ip_id in (select ip_id from x_ip_address where is_vpn is distinct from true)
              {"".join(f" union select '{k}', {k}, customer_id from x_customer where {k} is not null" for k in ("email", "phone", "address"))}),
            risky as (select customer_id from x_customer where risk_rating = 'high')
            select kind, val as value, a.cust as customer_a, b.cust as customer_b
            from seen a join seen b using (kind, val)
            where a.cust < b.cust and (a.cust in (from risky) or b.cust in (from risky)))""",
        # detectors
        "money_edge": f"""select id as transaction_id, src, dst, cast(amt as double) as amount,
            {_time('ts')} as txn_time from p1_edge""",
        "acc_link": "select a, b, via from link",
        "identity_groups": """select via, val as value, acc as account_id, cust as customer_id, members,
            members - (select count(*) from holder k where (k.via, k.val, k.cust) = (h.via, h.val, h.cust)) as linked
            from (select *, count(*) over (partition by via, val) as members,
                         min(cust) over (partition by via, val) <> max(cust) over (partition by via, val) as shared
                  from holder) h where shared""",
        "money_walk": f"select {_WALK_COLUMNS} from walk",
        "round_trip_candidates": f"select {_WALK_COLUMNS}, closed_by from candidate",
        "maximal_rings": f"select {_WALK_COLUMNS}, closed_by from maximal",
        "ring_shared_pairs": "select path_key, shared_pairs, shared_via from ring",
        "round_trip": f"""select path_key, origin, cur as closed_on, closed_by, cast(hops as bigint) as hops,
            array_to_string(path, ',') as path, array_to_string(ids, ',') as txn_ids, {_AMOUNTS}, decay_pct,
            shared_pairs, shared_via, tier from tiered""",
        "layering": f"""select path_key, origin, cur as ends_on, cast(hops as bigint) as hops,
            array_to_string(path, ',') as path, array_to_string(ids, ',') as txn_ids, {_AMOUNTS}, decay_pct,
            'medium' as tier from chain""",
        "pass_through": "select account_id from passing",
        "mule_ring": f"""select device_id, n_customers, n_accounts, first_account, accounts,
            'medium' as tier, {_ONE_PART} from mules""",
        "structuring_daily": f"""select account_id, {_DAILY}, first_txn, txn_ids, branches, 'medium' as tier, {_ONE_PART}
            from daily""",
        "structuring_rolling": f"select {_ROLLING} from rolling",
        "structuring_rolling_3": f"select {_ROLLING} from rolling_3",
        "structuring_summary": """select case when n_branches >= 3 then 'high' else 'medium' end as tier,
            count(*) as accounts, cast(sum(n_deposits) as bigint) as deposits,
            round(avg(last_day - first_day + 1), 1) as avg_days, round(avg(total_amount)) as avg_total
            from rolling_3 group by 1""",
        "detection_counts": """select 'round_trip' as detector, tier, count(*) as n from tiered group by tier
            union all select * from (select 'layering', 'medium', count(*) as n from chain) where n > 0
            union all select * from (select 'mule', 'medium', count(*) as n from mules) where n > 0
            union all select * from (select 'structuring', 'medium', count(*) as n from daily) where n > 0""",
        # alerts
        "fraud_alert": """select alert_id, account_id, transaction_id, alert_type,
            cast(fraud_score as double) as fraud_score, 'open' as status, tier, closed_by,
            cast(hops as bigint) as hops, cast(decay_pct as double) as decay_pct, device_id,
            cast(n_deposits as bigint) as n_deposits, cast(total_amount as double) as total_amount,
            true as raised from alert""",
        "alert_round_trip": f"""select origin as account_id, ids[1] as transaction_id, 'round_trip' as alert_type,
            case when tier = 'high' then 90.0::double else 60.0::double end as fraud_score, tier, closed_by,
            cur as closed_on, cast(hops as bigint) as hops, array_to_string(path, ',') as path,
            array_to_string(ids, ',') as txn_ids, {_AMOUNTS}, decay_pct, shared_via from tiered""",
        "alert_layering": f"""select origin as account_id, ids[1] as transaction_id,
            'layering_chain' as alert_type, 60.0::double as fraud_score, 'medium' as tier,
            cast(hops as bigint) as hops, array_to_string(path, ',') as path,
            array_to_string(ids, ',') as txn_ids, {_AMOUNTS}, decay_pct from chain""",
        "alert_mule": """select first_account as account_id, cast(null as varchar) as transaction_id,
            'mule_network' as alert_type, 60.0::double as fraud_score, 'medium' as tier, device_id,
            n_customers, n_accounts from mules""",
        "alert_structuring": f"""select account_id, first_txn as transaction_id, 'structuring' as alert_type,
            60.0::double as fraud_score, 'medium' as tier, {_DAILY} from daily""",
        "v_dash_rings": f"""select * from (
            select a.alert_id, t.tier, t.closed_by, cast(t.hops as bigint) as hops,
                   array_to_string(t.path, ' -> ') as path, {_AMOUNTS.replace('(', '(t.')}, t.decay_pct
            from alert a join tiered t on t.path_key = a.k where a.alert_type = 'round_trip'
            union all
            select a.alert_id, 'medium', null, cast(t.hops as bigint), array_to_string(t.path, ' -> '),
                   cast(t.first_amount as double), cast(t.last_amount as double), t.decay_pct
            from alert a join chain t on t.path_key = a.k where a.alert_type = 'layering_chain') v""",
        "v_dash_mule": f"""select a.alert_id, m.device_id, m.n_customers, replace(m.accounts, ',', ', ') as accounts, {_ONE_PART}
            from alert a join mules m on m.device_id = a.k where a.alert_type = 'mule_network'""",
        "v_dash_alert_summary": "select alert_type, tier, count(*) as alerts from found group by 1, 2",
        # dashboards
        "dash_rings_by_tier": """select alert_type, tier, count(*) as alerts from found
            where alert_type in ('round_trip', 'layering_chain') group by 1, 2""",
        "dash_ring_length": f"""select cast(hops as bigint) as hops, case when closed_by is null
            then '{labels.PATTERNS["layering_chain"]}' else '{labels.PATTERNS["round_trip"]}' end as type,
            count(*) as n from found where hops is not null group by 1, 2""",
        "dash_identity_links": "select via, count(*) // 2 as pairs from link group by 1",
        "dash_mule_size": "select n_customers, count(*) as rings from mules group by 1",
        "dash_open_alerts": "select count(*) as open_alerts from found",
        "dash_alerts_by_type": "select alert_type, tier, count(*) as alerts from found group by 1, 2",
        "dash_alert_queue": f"""select alert_id, alert_type, cast(fraud_score as double) as fraud_score, account_id,
            tier, closed_by, 'open' as status, {_RAISED} as raised_at from alert""",
        "dash_alert_queue_by_type": f"""select alert_id, alert_type, 60.0::double as fraud_score, account_id, tier, closed_by,
            'open' as status, {_RAISED} as raised_at from alert where alert_type in ('mule_network', 'structuring')""",
        "dash_benchmark": f"select {_BENCH}, cast(false_positives as bigint) as false_positives from bench",
        "dash_structuring": f"select account_id, {_DAILY} from daily",
        "ring_edges": f"""select a.alert_id, e.src, e.dst, cast(e.amt as double) as amount,
            strftime(e.ts, '%d %b %H:%M') as ts, {_time('e.ts')} as txn_time, e.id as transaction_id
            from (select alert_id, unnest(string_split(k, ',')) as id from alert
                  where alert_type in ('round_trip', 'layering_chain')) a join p1_edge e using (id)""",
        "ring_identity_links": """select distinct a.alert_id, l.a, l.b, l.via
            from alert a join (select path_key, path from tiered union all select path_key, path from chain) p
                 on p.path_key = a.k
            join link l on l.a < l.b and list_contains(p.path, l.a) and list_contains(p.path, l.b)
            where a.alert_type in ('round_trip', 'layering_chain')""",
        "mule_members": """select a.alert_id, m.account_id, m.customer_id, strftime(c.open_date, '%d %b %Y') as opened,
            m.device_id from alert a join mule_accounts m on m.device_id = a.k
            join x_account c on c.account_id = m.account_id where a.alert_type = 'mule_network'""",
        "kpi_rings": """select count(*) filter (alert_type = 'round_trip') as round_trips,
            count(*) filter (alert_type = 'round_trip' and tier = 'high') as high,
            count(*) filter (alert_type = 'round_trip' and tier = 'medium') as medium,
            count(*) filter (alert_type = 'layering_chain') as layering_chains from found""",
        "kpi_mule": """select count(*) as mule_rings, cast(coalesce(sum(n_customers), 0) as bigint) as customers,
            cast(coalesce(sum(n_accounts), 0) as bigint) as accounts,
            (select count(*) // 2 from link) as identity_links from mules""",
        "kpi_alerts": """select count(*) as open_alerts, count(*) filter (tier = 'high') as high,
            count(*) filter (tier = 'medium') as medium, count(distinct alert_type) as alert_types from found""",
        "kpi_quality": "select " + ", ".join(
            bench_number.format(*x) for x in (("found_full", "found"), ("chains", "injected"),
                ("found_partial", "partial"), ("missed", "missed"), ("false_positives", "false_positives"))
            ) + ", round(100.0 * sum(found_full) / sum(chains), 0) as recall_pct from bench",
        "recall_table": f"""select cast(list_position([{', '.join(f"'{p}'" for p in labels.PATTERNS)}],
            pattern_label) - 1 as bigint) as rank, {_PATTERN} as pattern, chains as injected, found_full as found,
            found_partial as partial, missed, 100.0 * found_full / chains as recall,
            case tiers when '' then '—' when 'high' then 'High' when 'medium' then 'Medium'
                 else 'High, Medium' end as tier from by_pattern""",
        "outcome_unpivot": f"""select * from (
            select {_PATTERN} as pattern, 'Found' as outcome, found_full as cases, 0::bigint as rank from by_pattern
            union all select {_PATTERN}, 'Partial', found_partial, 1 from by_pattern
            union all select {_PATTERN}, 'Missed', missed, 2 from by_pattern) o where cases > 0""",
        "fp_by_detector": f"""select {_names(labels.PATTERNS, 't')} as detector,
            (select count(*) from found where alert_type = t) as alerts, false_positives
            from (select {_names(labels.DETECTORS, 'pattern_label')} as t, false_positives from fp) f""",
        "display_labels": f"""select alert_id, {_names(labels.PATTERNS, 'alert_type')} as type,
            cast(fraud_score as bigint) as score, {_title('tier')} as tier,
            coalesce({_names(labels.CLOSED_BY, 'closed_by')}, '—') as closed_by, account_id as account,
            'Open' as status, '01 Jul 2024 09:30' as raised from alert""",
        # evaluation
        "detection_txns": "select det_id, tier, transaction_id from det_txn",
        "mule_ground_truth": "select chain_id, account_id from mule_label",
        "mule_found": "select device_id, account_id from mule_accounts",
        "structuring_ground_truth": "select chain_id, account_id from structuring_label",
        "best_detection": "select chain_id, hit_txn, tier, det_id from best",
        "chain_recall": """select pattern_label, chain_id, cast(n_txn as bigint) as n_txn,
            cast(hit_txn as bigint) as hit_txn, tier from recall""",
        "pattern_recall": f"select {_BENCH} from by_pattern",
        "false_positives": "select pattern_label, false_positives from fp",
        "benchmark": f"select {_BENCH}, cast(false_positives as bigint) as false_positives from bench",
        # governance
        "customer_secure_analyst": _masked("AML_ANALYST"),
        "customer_secure_engineer": _masked("AML_DATA_ENGINEER"),
        "transaction_secure_engineer": _secure_rows("AML_DATA_ENGINEER"),
        "transaction_secure_branch": _secure_rows("AML_BRANCH_STAFF"),
        "pii_catalog": pii,
        # graph patterns
        "cycles_3_6": "select count(*) as cycles from g_path where cur = origin and hops between 3 and 6",
        "cycles_pruned": """select (select count(*) from g_path where cur = origin) as cycles,
            (select string_agg(hops, ',' order by path_key) from
                (select hops, path_key from g_path where cur = origin order by path_key limit 20) f) as hop_counts""",
        "rings_tiers_graph": "select closed_by, tier, count(*) as rings from g_ring group by 1, 2",
        "high_ring_evidence": """select e.path_key, r.origin, r.cur as closed_on, e.kind, e.a, e.b, e.value
            from g_ring r join g_evidence e using (path_key)""",
        "all_ring_evidence": """select r.path_key, r.origin, r.cur as closed_on, e.kind, e.a, e.b, e.value
            from g_ring r left join g_evidence e using (path_key)""",
        "layering_graph": """select cast(hops as bigint) as hops, count(*) as layering_chains from g_path q
            where hops >= 4 and path_key not in (select path_key from g_closing)
              and not exists (select 1 from g_path o where len(o.ids) > len(q.ids) and o.hops > 4
                                                       and list_has_all(o.ids, q.ids))
              and not exists (select 1 from g_closing r where list_has_any(r.ids, q.ids)) group by 1""",
        "mule_onboarding": """select count(distinct device_id) as mule_rings, count(*) as accounts_flagged
            from g_mule""",
        "example_phone_ring": """select path_key, origin, cur, cast(hops as bigint) as hops,
            array_to_string(path, ',') as path from g_path w
            where cur <> origin and exists (select 1 from g_shared l where l.a = w.origin and l.b = w.cur
                                                                      and starts_with(l.val, 'phone|'))
            order by path_key limit 1""",
        "example_mule": """select device_id, account_id, customer_id from g_mule
            where device_id = (select min(device_id) from g_mule)""",
        "example_plain_cycle": """select path_key, origin, cast(hops as bigint) as hops,
            array_to_string(path, ',') as path from g_path w
            where cur = origin and not exists (select 1 from g_shared l where list_contains(w.path, l.a)
                                                                         and list_contains(w.path, l.b))
            order by path_key limit 1""",
    }


def oracle_sql() -> dict[str, str]:
    selects = _selects()
    selects["dash_ring_list"] = selects["v_dash_rings"]
    selects["dash_mule_list"] = selects["v_dash_mule"]
    return {name: check(select) for name, select in selects.items()}
