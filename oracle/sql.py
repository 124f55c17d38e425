"""The same queries as SQL for DuckDB, in the plain form: cross joins, ranges, one window per key.

Written independently of the DataFrame code; nothing here is run by the library.
"""

from __future__ import annotations

# Base tables: row number n, then the source columns.
BASE = {
    "customers": """
        select c_custkey as n,
               case when c_custkey % 10 = 0 then '  C' || c_custkey::varchar || ' '
                    else 'C' || c_custkey::varchar end as customer_id,
               case when c_custkey % 23 = 0 then null else c_mktsegment end as first_name,
               case when c_custkey % 29 = 0 then null else c_name end as last_name,
               timestamp '2023-01-01 08:30:00' as created_at
        from customer""",
    "accounts": """
        select c_custkey as n,
               case form when 1 then 'A' || c_custkey::varchar when 2 then 'B' || c_custkey::varchar
                    else ' A' || c_custkey::varchar || '  ' end as account_id,
               'C' || c_custkey::varchar as customer_id,
               'DE' || lpad(c_custkey::varchar, 10, '0') as iban,
               case when c_custkey % 20 = 0 then 'USD' else 'EUR' end as currency,
               'ACTIVE' as status,
               date '2023-01-01' + cast(c_custkey % 1000 as int) as opened_at
        from customer cross join (values (1), (2), (3)) as forms(form)
        where form = 1 or (form = 2 and c_custkey % 3 = 0) or (form = 3 and c_custkey % 12 = 0)""",
    "gl_accounts": """
        select n_nationkey as n,
               (1000 + n_nationkey)::varchar as gl_account_code,
               n_name as account_name,
               case n_regionkey when 0 then 'ASSET' when 1 then 'LIABILITY'
                    when 2 then 'INCOME' else 'EXPENSE' end as account_category,
               n_nationkey % 6 <> 0 as is_active
        from nation""",
    "transactions": """
        select o_orderkey as n,
               'T' || o_orderkey::varchar as transaction_id,
               case when o_custkey % 97 = 0 then null else 'C' || o_custkey::varchar end
                   as customer_id,
               'A' || o_custkey::varchar as account_id,
               case o_orderkey % 4 when 0 then 'A' || ((o_custkey + 1) % 150)::varchar
                    when 1 then '' when 3 then '   ' end as destination_account_id,
               case when o_orderkey % 9 = 0 then null
                    else (1000 + o_orderkey % 27)::varchar end as gl_account_code,
               o_orderpriority as transaction_type,
               cast(o_totalprice as decimal(18,2)) as amount,
               case when o_orderkey % 50 = 0 then 'USD' else 'EUR' end as currency,
               o_orderstatus as status,
               cast(o_orderdate as date) as booking_date,
               cast(o_orderdate as timestamp) as created_at
        from orders""",
    "journal_entries": """
        select o_orderkey as n,
               'J' || o_orderkey::varchar as journal_entry_id,
               case when o_orderkey % 31 = 0 then null
                    else 'T' || o_orderkey::varchar end as transaction_id,
               cast(o_orderdate as date) as posting_date,
               case when o_orderstatus = 'F' then 'POSTED' else 'DRAFT' end as status
        from orders""",
    "journal_postings": """
        select o_orderkey as n,
               'P' || o_orderkey::varchar || '-' || side as posting_id,
               'J' || o_orderkey::varchar as journal_entry_id,
               case when side = 'D' then 'A' || o_custkey::varchar end as account_id,
               case when o_orderkey % 41 = 0 then null
                    else (1000 + (o_orderkey + case when side = 'D' then 0 else 1 end) % 25)::varchar
                    end as gl_account_code,
               case when side = 'D' then cast(o_totalprice as decimal(18,2)) end as debit_amount,
               case when side = 'C' then cast(o_totalprice as decimal(18,2)) end as credit_amount
        from (select * from orders where o_orderkey % 7 <> 0
              union all
              select orders.* from orders left join lineitem on l_orderkey = o_orderkey
              where o_orderkey % 7 = 0) as delivered
        cross join (values ('D'), ('C')) as sides(side)""",
}

# Present columns which a capture k replaces, and rows it has.
STATE = {
    "customers": """first_name := case when n % 8 = 0 and k = 2 then 'CHANGED' else first_name end""",
    "accounts": """
        status := case when n % 7 = 0 and k >= 2 and not (n % 14 = 0 and k = 4)
                       then 'INACTIVE' else status end;
        iban := case when n % 19 = 0 and k = 1 then null else iban end;
        customer_id := case when n % 17 = 0 and k >= 3
                            then 'C' || greatest(n - 1, 0)::varchar else customer_id end""",
    "gl_accounts": """is_active := case when n % 4 = 0 and k >= 3 then not is_active
                           else is_active end""",
    "transactions": """status := case when n % 7 = 0 and k >= 2 then 'REVERSED' else status end""",
    "journal_entries": """status := case when n % 2 = 0 and k >= 3 and status = 'DRAFT'
                           then 'POSTED' else status end""",
    "journal_postings": """
        debit_amount := cast(debit_amount + case when n % 43 = 0 and k >= 2 then 1.00 else 0.00 end
                             as decimal(18,2));
        credit_amount := cast(credit_amount + case when n % 43 = 0 and k >= 2 then 1.00 else 0.00 end
                              as decimal(18,2))""",
}

KEYS = {
    "hub_customer": ("customers", "customer_id", "customer_hk"),
    "hub_account": ("accounts", "account_id", "account_hk"),
    "hub_transaction": ("transactions", "transaction_id", "transaction_hk"),
    "hub_gl_account": ("gl_accounts", "gl_account_code", "gl_account_hk"),
    "hub_journal_entry": ("journal_entries", "journal_entry_id", "journal_entry_hk"),
}

# name -> (table, (column, hash column) twice, child key, link hash column)
LINKS = {
    "link_customer_account": (
        "accounts",
        ("customer_id", "customer_hk"),
        ("account_id", "account_hk"),
        None,
        "customer_account_hk",
    ),
    "link_transaction_source_account": (
        "transactions",
        ("transaction_id", "transaction_hk"),
        ("account_id", "account_hk"),
        None,
        "transaction_source_account_hk",
    ),
    "link_transaction_destination_account": (
        "transactions",
        ("transaction_id", "transaction_hk"),
        ("destination_account_id", "destination_account_hk"),
        None,
        "transaction_destination_account_hk",
    ),
    "link_transaction_gl_account": (
        "transactions",
        ("transaction_id", "transaction_hk"),
        ("gl_account_code", "gl_account_hk"),
        None,
        "transaction_gl_account_hk",
    ),
    "link_journal_entry_transaction": (
        "journal_entries",
        ("journal_entry_id", "journal_entry_hk"),
        ("transaction_id", "transaction_hk"),
        None,
        "journal_entry_transaction_hk",
    ),
    "link_journal_posting_account": (
        "journal_postings",
        ("journal_entry_id", "journal_entry_hk"),
        ("account_id", "account_hk"),
        "posting_id",
        "journal_posting_account_hk",
    ),
    "link_journal_posting_gl": (
        "journal_postings",
        ("journal_entry_id", "journal_entry_hk"),
        ("gl_account_code", "gl_account_hk"),
        "posting_id",
        "journal_posting_gl_hk",
    ),
}

# name -> (table, hash column, key column, [(attribute, cast to text in the hash)])
SATELLITES = {
    "sat_customer_details": (
        "customers",
        "customer_hk",
        "customer_id",
        [("first_name", False), ("last_name", False), ("created_at", True)],
    ),
    "sat_account_details": (
        "accounts",
        "account_hk",
        "account_id",
        [("iban", False), ("currency", False), ("status", False), ("opened_at", True)],
    ),
    "sat_transaction_details": (
        "transactions",
        "transaction_hk",
        "transaction_id",
        [
            ("transaction_type", False),
            ("amount", True),
            ("currency", False),
            ("status", False),
            ("booking_date", True),
            ("created_at", True),
        ],
    ),
    "sat_gl_account_details": (
        "gl_accounts",
        "gl_account_hk",
        "gl_account_code",
        [("account_name", False), ("account_category", False), ("is_active", False)],
    ),
    "sat_journal_entry_details": (
        "journal_entries",
        "journal_entry_hk",
        "journal_entry_id",
        [("posting_date", True), ("status", False)],
    ),
    "sat_journal_posting_amount": (
        "journal_postings",
        "journal_posting_gl_hk",
        "posting_id",
        [("debit_amount", True), ("credit_amount", True)],
    ),
}

PITS = {
    "pit_customer": ("customers", "hub_customer", "sat_customer_details", "sat_customer_load_dts"),
    "pit_account": ("accounts", "hub_account", "sat_account_details", "sat_account_load_dts"),
}

LOOKUP_AT = "timestamp '2026-09-29 12:00:00'"


# Keys that only the first two captures have.
GONE = {
    "customers": "trim(customer_id) || '-gone' as customer_id",
    "accounts": "trim(account_id) || '-gone' as account_id",
}


def current(table: str, earlier: bool = False) -> str:
    conditions = ["n % 5 <> 0"] if earlier and table != "gl_accounts" else ["true"]
    first = "2026-09-26 00:00:00" if earlier else "2026-09-27 00:00:00"
    second = first if earlier else "2026-09-27 06:00:00"
    return f"""
        select * exclude (n), 'core_banking' as _source_system,
               case when n % 3 = 0 then timestamp '{second}' else timestamp '{first}' end
                   as _ingested_at
        from ({BASE[table]}) as base
        where {" and ".join(conditions)}"""


def history(table: str, last: int = 4) -> str:
    conditions = [f"k <= {last}", "(not gone or k <= 2)"]
    if table != "gl_accounts":
        conditions.append("not (n % 5 = 0 and k = 1)")
    if table == "accounts":
        conditions.append("not (n % 11 = 0 and k = 3)")
        conditions.append("not (n % 13 = 0 and k = 4)")
    replaced = ", ".join(
        "{1} as {0}".format(*[part.strip() for part in change.split(":=")])
        for change in STATE[table].split(";")
    )
    rows = f"select *, false as gone from ({BASE[table]}) as base"
    if table in GONE:
        rows += f"""
            union all
            select * replace ({GONE[table]}), true as gone from ({BASE[table]}) as base
            where n % 37 = 0"""
    return f"""
        select * exclude (n, k, gone) replace ({replaced}),
               'core_banking' as _source_system,
               'cap-' || k::varchar as _snapshot_id,
               timestamp '2026-09-26 00:00:00' + to_days(cast(k as int)) as _snapshot_at
        from ({rows}) as base
        cross join (values (1), (2), (3), (4)) as captures(k)
        where {" and ".join(conditions)}"""


def entity_hash(column: str, source: str = "record_source") -> str:
    return f"sha256({source} || '|' || {column})"


def hub(name: str, source: str) -> str:
    _, key, hash_key = KEYS[name]
    return f"""
        select {entity_hash(key)} as {hash_key}, {key}, load_dts, record_source
        from (select trim({key}) as {key}, _source_system as record_source,
                     min(_ingested_at) as load_dts
              from ({source}) as rows
              where {key} is not null
              group by trim({key}), _source_system) as keys"""


def link(name: str, source: str) -> str:
    _, (first, first_hk), (second, second_hk), child, hash_key = LINKS[name]
    columns = ([child] if child else []) + [first, second]
    seen = "_snapshot_at" if name == "link_customer_account" else "_ingested_at"
    conditions = [f"{column} is not null" for column in columns]
    if second == "destination_account_id":
        conditions.append(f"trim({second}) <> ''")
    between = f"{child} || '|' || " if child else ""
    return f"""
        select sha256({first_hk} || '|' || {between}{second_hk}) as {hash_key},
               {child + "," if child else ""} {first_hk}, {second_hk}, load_dts, record_source
        from (select {child + "," if child else ""}
                     {entity_hash(first)} as {first_hk}, {entity_hash(second)} as {second_hk},
                     load_dts, record_source
              from (select {", ".join(f"trim({c}) as {c}" for c in columns)},
                           _source_system as record_source, min({seen}) as load_dts
                    from ({source}) as rows
                    where {" and ".join(conditions)}
                    group by {", ".join(f"trim({c})" for c in columns)}, _source_system
                   ) as keys
             ) as hashed"""


def satellite(name: str, source: str) -> str:
    _, hash_key, key, attributes = SATELLITES[name]
    names = ", ".join(attribute for attribute, _ in attributes)
    document = ", ".join(
        f"'{a}': {f'cast({a} as varchar)' if as_text else a}" for a, as_text in attributes
    )
    ties = ", ".join(f"{attribute} nulls first" for attribute, _ in attributes)
    if name == "sat_journal_posting_amount":
        entry = entity_hash("trim(journal_entry_id)", "_source_system")
        code = entity_hash("trim(gl_account_code)", "_source_system")
        hashed = f"sha256({entry} || '|' || trim(posting_id) || '|' || {code})"
        needed = ["posting_id", "journal_entry_id", "gl_account_code"]
    else:
        hashed = entity_hash(f"trim({key})", "_source_system")
        needed = [key]
    return f"""
        select {hash_key}, {key}, {names}, hashdiff, load_dts, snapshot_id, record_source
        from (select *, lag(hashdiff) over (partition by {hash_key}
                                            order by load_dts, snapshot_id, {ties}) as previous
              from (select {hashed} as {hash_key}, trim({key}) as {key}, {names},
                           sha256(json_merge_patch('{{}}', to_json({{{document}}}))::varchar)
                               as hashdiff,
                           _snapshot_at as load_dts, _snapshot_id as snapshot_id,
                           _source_system as record_source
                    from ({source}) as rows
                    where {" and ".join(f"{c} is not null" for c in needed)}) as versions
             ) as compared
        where previous is null or hashdiff <> previous"""


def status(source: str) -> str:
    return f"""
        select customer_account_hk, customer_hk, account_hk, is_active, load_dts, snapshot_id,
               record_source
        from (
            select *, lag(is_active) over (partition by customer_account_hk
                                           order by load_dts, snapshot_id) as previous
            from (
                select f.customer_account_hk, f.customer_hk, f.account_hk, b.snapshot_id,
                       b.load_dts, f.record_source, p.customer_account_hk is not null as is_active
                from (select customer_account_hk, customer_hk, account_hk, record_source,
                             min(load_dts) as first_load_dts
                      from ({_present(source)}) as seen group by all) as f
                cross join (select distinct _snapshot_id as snapshot_id, _snapshot_at as load_dts
                            from ({source}) as runs) as b
                left join ({_present(source)}) as p
                  on p.customer_account_hk = f.customer_account_hk
                 and p.snapshot_id = b.snapshot_id
                where b.load_dts >= f.first_load_dts) as observed
        ) as compared
        where previous is null or is_active <> previous"""


def _present(source: str) -> str:
    return f"""
        select distinct sha256(customer_hk || '|' || account_hk) as customer_account_hk,
               customer_hk, account_hk, record_source, snapshot_id, load_dts
        from (select {entity_hash("trim(customer_id)", "_source_system")} as customer_hk,
                     {entity_hash("trim(account_id)", "_source_system")} as account_hk,
                     _source_system as record_source, _snapshot_id as snapshot_id,
                     _snapshot_at as load_dts
              from ({source}) as rows
              where customer_id is not null and account_id is not null) as pairs"""


def pit(name: str, hub_rows: str, satellite_rows: str, runs: str) -> str:
    """``runs`` gives the captures as (snapshot_id, snapshot_at)."""
    _, hub_name, _, pointer = PITS[name]
    _, key, hash_key = KEYS[hub_name]
    return f"""
        select {hash_key}, {key}, snapshot_id, snapshot_at, {pointer}
        from (
            select *, lag({pointer}) over (partition by {hash_key}
                                           order by snapshot_at, snapshot_id) as previous
            from (
                select h.{hash_key}, h.{key}, b.snapshot_id, b.snapshot_at,
                       max(s.load_dts) as {pointer}
                from ({hub_rows}) as h
                cross join ({runs}) as b
                left join ({satellite_rows}) as s
                  on s.{hash_key} = h.{hash_key} and s.load_dts <= b.snapshot_at
                group by all) as observed
            where {pointer} is not null
        ) as compared
        where previous is null or {pointer} <> previous"""


def runs_of(source: str) -> str:
    return f"""select distinct _snapshot_id as snapshot_id, _snapshot_at as snapshot_at
               from ({source}) as rows"""


def as_of(name: str, pit_rows: str, satellite_rows: str, at: str = LOOKUP_AT) -> str:
    _, hub_name, satellite_name, pointer = PITS[name]
    _, key, hash_key = KEYS[hub_name]
    attributes = ", ".join(f"s.{attribute}" for attribute, _ in SATELLITES[satellite_name][3])
    return f"""
        select p.{hash_key}, p.{key}, {attributes}, p.snapshot_id, p.snapshot_at, p.{pointer}
        from (select * from ({pit_rows}) as points where snapshot_at <= {at}
              qualify row_number() over (partition by {hash_key}
                                         order by snapshot_at desc, snapshot_id desc) = 1) as p
        join (select * from ({satellite_rows}) as versions
              qualify row_number() over (partition by {hash_key}, load_dts
                                         order by snapshot_id desc) = 1) as s
          on s.{hash_key} = p.{hash_key} and s.load_dts = p.{pointer}"""


def facts_as_of(name: str, pit_rows: str, satellite_rows: str) -> str:
    """Transactions with the state of their account at a moment of their own."""
    _, hub_name, satellite_name, pointer = PITS[name]
    _, _, hash_key = KEYS[hub_name]
    attributes = ", ".join(f"s.{attribute}" for attribute, _ in SATELLITES[satellite_name][3])
    return f"""
        with points as (
            select p.{hash_key}, p.snapshot_id, p.snapshot_at, p.{pointer}, {attributes}
            from ({pit_rows}) as p
            join (select * from ({satellite_rows}) as versions
                  qualify row_number() over (partition by {hash_key}, load_dts
                                             order by snapshot_id desc) = 1) as s
              on s.{hash_key} = p.{hash_key} and s.load_dts = p.{pointer}),
        facts as (
            select transaction_id, account_id,
                   {entity_hash("trim(account_id)", "_source_system")} as fact_key,
                   timestamp '2026-09-26 00:00:00'
                       + to_hours(cast(substr(transaction_id, 2) as bigint) % 120) as asked_at
            from ({current("transactions")}) as rows)
        select f.transaction_id, f.account_id, f.asked_at, s.* exclude ({hash_key})
        from facts as f asof left join points as s
          on s.{hash_key} = f.fact_key and f.asked_at >= s.snapshot_at"""


def states(source: str) -> str:
    """Whether each relationship is in the last capture."""
    return f"""
        select customer_account_hk, customer_hk, account_hk, record_source, is_active
        from ({status(source)}) as changes
        qualify row_number() over (partition by customer_account_hk
                                   order by load_dts desc, snapshot_id desc) = 1"""


def gold_summary() -> str:
    return f"""
        select a.account_id, a.customer_id,
               concat_ws(' ', c.first_name, c.last_name) as customer_name,
               t.gl_account_code, g.account_name as gl_account_name, a.currency,
               count(t.transaction_id) as transaction_count,
               cast(coalesce(sum(t.amount), 0) as decimal(28,2)) as total_transaction_amount
        from ({current("accounts")}) as a
        left join ({current("customers")}) as c on a.customer_id = c.customer_id
        left join ({current("transactions")}) as t
          on a.account_id = t.account_id and a.currency = t.currency
         and t.transaction_id is not null
        left join ({current("gl_accounts")}) as g on t.gl_account_code = g.gl_account_code
        group by a.account_id, a.customer_id, c.first_name, c.last_name, t.gl_account_code,
                 g.account_name, a.currency"""


def gold_daily() -> str:
    return f"""
        select d.customer_id, concat_ws(' ', c.first_name, c.last_name) as customer_name,
               d.booking_date, d.currency, d.transaction_count, d.total_amount
        from (select customer_id, booking_date, currency, count(*) as transaction_count,
                     cast(sum(amount) as decimal(28,2)) as total_amount
              from ({current("transactions")}) as t
              where transaction_id is not null and customer_id is not null
                and booking_date is not null
              group by customer_id, booking_date, currency) as d
        left join ({current("customers")}) as c on d.customer_id = c.customer_id"""


def gold_top() -> str:
    return f"""
        select * from (
            select *, cast(row_number() over (order by total_transaction_amount desc, customer_id,
                                              customer_name) as int) as customer_rank
            from (select customer_id, customer_name, currency,
                         cast(sum(transaction_count) as bigint) as transaction_count,
                         cast(sum(total_amount) as decimal(28,2)) as total_transaction_amount
                  from ({gold_daily()}) as daily
                  where currency = 'EUR'
                  group by customer_id, customer_name, currency) as totals) as ranked
        where customer_rank <= 20"""


def appended(stored: str, built: str, keys: list[str]) -> str:
    """A target after a second run: what it had, and built rows whose keys it did not have."""
    same = " and ".join(f"e.{key} = b.{key}" for key in keys)
    return f"""
        with stored as ({stored}), built as ({built})
        select * from stored
        union all
        select * from built as b where not exists (select 1 from stored as e where {same})"""


def crowded_postings() -> str:
    """Captures in which a third of all postings are versions of one."""
    return f"""
        select * exclude (hash_) replace (
            case when hash_ then 'P0-D' else posting_id end as posting_id,
            case when hash_ then 'J0' else journal_entry_id end as journal_entry_id,
            case when hash_ then '1000' else gl_account_code end as gl_account_code
        )
        from (select *, cast(substr(journal_entry_id, 2) as bigint) % 3 = 0 as hash_
              from ({history("journal_postings")}) as rows) as marked"""


def all_sql() -> dict[str, str]:
    tables = list(BASE)
    found = {
        "source_row_counts": " union all ".join(
            f"select '{t}' as table_name, count(*) as row_count from ({BASE[t]}) as r"
            for t in tables
        ),
        "load_audit": " union all ".join(
            f"""select 'bronze' as layer, '{t}' as table_name, null::varchar as snapshot_id,
                       count(*) as row_count from ({current(t)}) as r
                union all
                select 'bronze_history', '{t}', _snapshot_id, count(*) from ({history(t)}) as r
                group by _snapshot_id"""
            for t in tables
        ),
        "capture_append_idempotent": history("accounts"),
        "silver_transactions": f"""
            select transaction_id, customer_id, account_id, gl_account_code, transaction_type,
                   amount, currency, status, booking_date, created_at, _source_system,
                   _ingested_at
            from ({current("transactions")}) as t where transaction_id is not null""",
        "gold_account_transaction_summary": gold_summary(),
        "gold_customer_daily_transactions": gold_daily(),
        "gold_top_customer": gold_top(),
        "gold_account_transaction_summary_by_change": gold_summary(),
        "gold_customer_daily_transactions_by_change": gold_daily(),
    }
    for table in tables:
        found[f"bronze_{table}"] = current(table)
        found[f"capture_{table}"] = history(table)
    for table in ("customers", "accounts", "gl_accounts"):
        found[f"silver_{table}"] = current(table)
    for name, (table, _, hash_key) in KEYS.items():
        found[name] = hub(name, current(table))
        stored = hub(name, current(table, earlier=True))
        found[f"{name}_incremental"] = appended(stored, found[name], [hash_key])
    for name, (table, _, _, _, hash_key) in LINKS.items():
        if name == "link_customer_account":
            earlier, now = history(table, 2), history(table)
        else:
            earlier, now = current(table, earlier=True), current(table)
        found[name] = link(name, now)
        found[f"{name}_incremental"] = appended(link(name, earlier), found[name], [hash_key])
    for name, (table, hash_key, _, _) in SATELLITES.items():
        found[name] = satellite(name, history(table))
        stored = satellite(name, history(table, 2))
        two_steps = appended(stored, found[name], [hash_key, "snapshot_id"])
        found[f"{name}_incremental"] = two_steps
        found[f"{name}_newer_captures"] = two_steps
    found["sts_customer_account"] = status(history("accounts"))
    found["sts_customer_account_incremental"] = appended(
        status(history("accounts", 2)),
        found["sts_customer_account"],
        ["customer_account_hk", "snapshot_id"],
    )
    found["sts_customer_account_unlogged_capture"] = found["sts_customer_account"]
    found["sat_journal_posting_amount_crowded"] = satellite(
        "sat_journal_posting_amount", crowded_postings()
    )
    found["sts_customer_account_newer_captures"] = found["sts_customer_account_incremental"]
    for name, (table, hub_name, satellite_name, _) in PITS.items():
        runs = runs_of(history(table))
        rows = pit(name, found[hub_name], found[satellite_name], runs)
        found[name] = rows
        remaining = f"select * from ({runs}) as runs where snapshot_id not in ('cap-1', 'cap-3')"
        found[f"{name}_range_form"] = pit(
            name, found[hub_name], found[satellite_name], remaining
        )
        subject = name.removeprefix("pit_")
        found[f"{subject}_as_of"] = as_of(name, rows, found[satellite_name])
        found[f"{name}_incremental"] = rows
    found["transactions_as_of"] = facts_as_of(
        "pit_account", found["pit_account"], found["sat_account_details"]
    )
    found["sts_customer_account_kept_state"] = states(history("accounts"))
    return found
