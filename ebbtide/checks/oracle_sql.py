"""DuckDB SQL for every query that SQL can express, to check the Spark results.

Each text is written from the definitions (filter, join, aggregate, join back) and
not from the one-pass Spark plans, so that the two can disagree. Only the base
tables are registered, so every text carries the views it needs as CTEs.
"""

from __future__ import annotations

CALL_TYPES = {"loyalty": "Loyalty", "tech": "Tech", "csb": "CS&B", "finance": "Customer Finance"}
NUMERIC_FEATURES = """
calls_total_30d calls_total_60d calls_total_90d calls_loyalty_30d calls_loyalty_90d
calls_tech_30d calls_tech_90d calls_csb_30d calls_csb_90d calls_finance_30d calls_finance_90d
days_since_last_call call_type_diversity_90d repeat_caller_flag_30d
talk_time_total_30d talk_time_total_90d hold_time_total_30d hold_time_total_90d
avg_talk_time_per_call_90d hold_ratio_90d contract_dd_cancels dd_cancel_60_day
any_contract_dd_cancel any_dd_cancel_60d ooc_days is_out_of_contract is_near_ooc
usage_drop_pct_28d speed line_speed speed_gap speed_gap_pct
""".split()
FLAG_MEANS = {
    "repeat_caller_flag_30d": "pct_repeat_caller_30d",
    "any_contract_dd_cancel": "pct_any_contract_dd_cancel",
    "any_dd_cancel_60d": "pct_any_dd_cancel_60d",
    "is_out_of_contract": "pct_out_of_contract",
    "is_near_ooc": "pct_near_ooc",
}

ID = "unique_customer_identifier"

VIEWS = {
    "customer_info": """
  select cast(o_custkey as varchar) as unique_customer_identifier,
    cast(o_orderdate as date) as datevalue,
    o_orderkey as snapshot_id,
    case when o_orderkey % 17 = 0 then null else o_orderstatus end as contract_status,
    cast(case when o_orderkey % 5 = 0 then null else o_orderkey % 4 end as int) as contract_dd_cancels,
    cast(case when o_orderkey % 7 = 0 then null else o_orderkey % 3 end as int) as dd_cancel_60_day,
    cast(floor(o_totalprice / 1000) as int) - 250 as ooc_days,
    cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) as int) as tenure_days,
    case when o_orderkey % 11 = 0 then null else n_name end as technology,
    case when o_orderkey % 13 = 0 then null else cast(20 * (1 + o_orderkey % 4) as double) end as speed,
    case when o_orderkey % 19 = 0 then null
         else cast(20 * (1 + o_orderkey % 4) - (o_custkey % 15) as double) end as line_speed,
    c_mktsegment as sales_channel,
    case when o_orderkey % 23 = 0 then null else o_orderpriority end as crm_package_name
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "cease": """
  select cast(o_custkey as varchar) as unique_customer_identifier,
    cast(o_orderdate as date) as cease_placed_date,
    case when o_orderstatus = 'F'
         then cast(cast(cast(o_orderdate as date) + 14 as date) as varchar)
         else 'null' end as cease_completed_date,
    n_name as reason_description,
    c_mktsegment as reason_description_insight
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  where o_orderpriority = '1-URGENT' and c_acctbal < 2500""",
    "calls": """
  select cast(o_custkey as varchar) as unique_customer_identifier,
    cast(l_shipdate as date) as event_date,
    case when l_partkey % 37 = 0 then null
         when l_returnflag = 'R' and l_linestatus = 'F' then 'Loyalty'
         when l_returnflag = 'R' and l_linestatus = 'O' then 'Tech'
         when l_returnflag = 'A' and l_linestatus = 'F' then 'CS&B'
         when l_returnflag = 'A' and l_linestatus = 'O' then 'Customer Finance'
         else 'Other' end as call_type,
    case when l_partkey % 41 = 0 then null else l_quantity * 60 end as talk_time_seconds,
    case when l_partkey % 43 = 0 then null else l_discount * 1000 end as hold_time_seconds
  from lineitem join orders on l_orderkey = o_orderkey""",
    "usage_daily": """
  select cast(o_custkey as varchar) as unique_customer_identifier,
    cast(l_shipdate as date) as calendar_date,
    l_extendedprice as usage_download_mbs,
    l_extendedprice * l_tax as usage_upload_mbs
  from lineitem join orders on l_orderkey = o_orderkey""",
    # anchors
    "churn_ref": """
  select unique_customer_identifier, min(cease_placed_date) as ref_date, 'Churner' as churn_group
  from cease where cease_placed_date is not null group by 1""",
    "ref_dates": """
  select * from churn_ref
  union all
  select unique_customer_identifier, max(datevalue), 'Non-churner' from customer_info
  where unique_customer_identifier not in (select unique_customer_identifier from churn_ref)
  group by 1""",
    "scoring_dates": """
  select unique_customer_identifier, max(datevalue) as ref_date from customer_info group by 1""",
    "completed": """
  select distinct unique_customer_identifier from cease
  where cease_completed_date is not null and cease_completed_date <> 'null'""",
    "raw_completed": """
  select distinct unique_customer_identifier from cease where cease_completed_date is not null""",
    "latest": """
  select * exclude (position) from (
    select *, row_number() over (partition by unique_customer_identifier
                                 order by datevalue desc, snapshot_id desc) as position
    from customer_info) where position = 1""",
}


def rounded(expression: str, digits: int) -> str:
    """Half-up rounding in decimals, as Spark rounds a double's decimal text."""
    return f"cast(round(cast({expression} as decimal(38, 12)), {digits}) as double)"


def double(expression: str) -> str:
    return f"cast({expression} as double)"


def big(expression: str) -> str:
    return f"cast({expression} as bigint)"


# --- feature CTEs, over a frame of anchors ---

_DISTANCE = "date_diff('day', {day}, r.ref_date)"


def _call_ctes(anchors: str) -> dict[str, str]:
    distance = _DISTANCE.format(day="c.event_date")
    counts = [f"sum(case when d <= {n} then 1 else 0 end) as calls_total_{n}d" for n in (30, 60, 90)]
    for kind, text in CALL_TYPES.items():
        counts += [
            f"sum(case when d <= {n} and call_type = '{text}' then 1 else 0 end) as calls_{kind}_{n}d"
            for n in (30, 90)
        ]
    names = [c.rsplit(" as ", 1)[1] for c in counts]
    filled = ", ".join(big(f"coalesce({n}, 0)") + f" as {n}" for n in names)
    return {
        "calls_90": f"""
  select r.unique_customer_identifier, {distance} as d, call_type,
    talk_time_seconds / 60 as talk, hold_time_seconds / 60 as hold
  from {anchors} r join calls c using (unique_customer_identifier)
  where {distance} between 0 and 90""",
        "call_counts": f"""
  select unique_customer_identifier, {", ".join(counts)},
    min(d) as last_call, count(distinct call_type) as kinds
  from calls_90 group by 1""",
        "call_features": f"""
  select unique_customer_identifier, {filled},
    cast(coalesce(last_call, 91) as int) as days_since_last_call,
    {big("coalesce(kinds, 0)")} as call_type_diversity_90d,
    case when calls_total_30d >= 3 then 1 else 0 end as repeat_caller_flag_30d
  from {anchors} left join call_counts using (unique_customer_identifier)""",
        "talk_sums": """
  select unique_customer_identifier,
    sum(case when d <= 30 then talk else 0 end) as t30, sum(talk) as t90,
    sum(case when d <= 30 then hold else 0 end) as h30, sum(hold) as h90, count(*) as n
  from calls_90 group by 1""",
        "talk_filled": f"""
  select unique_customer_identifier, coalesce(t30, 0.0) as t30, coalesce(t90, 0.0) as t90,
    coalesce(h30, 0.0) as h30, coalesce(h90, 0.0) as h90, coalesce(n, 0) as n
  from {anchors} left join talk_sums using (unique_customer_identifier)""",
        "talk_features": f"""
  select unique_customer_identifier,
    {rounded("t30", 6)} as talk_time_total_30d, {rounded("t90", 6)} as talk_time_total_90d,
    {rounded("h30", 6)} as hold_time_total_30d, {rounded("h90", 6)} as hold_time_total_90d,
    {rounded("case when n > 0 then t90 / n else 0.0 end", 6)} as avg_talk_time_per_call_90d,
    {rounded("case when t90 > 0 then h90 / t90 else 0.0 end", 6)} as hold_ratio_90d
  from talk_filled""",
    }


def _usage_ctes(anchors: str) -> dict[str, str]:
    distance = _DISTANCE.format(day="u.calendar_date")

    def total(column: str, condition: str, name: str) -> str:
        return f"sum(case when {condition} then {column} else 0.0 end) as {name}"

    return {
        "usage_60": f"""
  select r.unique_customer_identifier, {distance} as d,
    usage_download_mbs as dl, usage_upload_mbs as ul
  from {anchors} r join usage_daily u using (unique_customer_identifier)
  where {distance} between 0 and 60""",
        "usage_sums": f"""
  select unique_customer_identifier,
    {total("dl", "d <= 30", "dl30")}, {total("dl", "d <= 60", "dl60")},
    {total("ul", "d <= 30", "ul30")}, {total("ul", "d <= 60", "ul60")},
    min(d) as last_usage,
    {total("dl", "d <= 27", "recent")}, {total("dl", "d between 28 and 55", "earlier")}
  from usage_60 group by 1""",
        "usage_features": f"""
  select unique_customer_identifier,
    {rounded("coalesce(dl30, 0)", 4)} as download_total_30d,
    {rounded("coalesce(dl60, 0)", 4)} as download_total_60d,
    {rounded("coalesce(ul30, 0)", 4)} as upload_total_30d,
    {rounded("coalesce(ul60, 0)", 4)} as upload_total_60d,
    cast(coalesce(last_usage, 60) as int) as days_since_last_usage,
    case when earlier > 0 then {rounded("(recent - earlier) / earlier * 100", 2)} end
      as usage_drop_pct_28d
  from {anchors} left join usage_sums using (unique_customer_identifier)""",
    }


SNAPSHOT_CTES = {
    "payment_features": """
  select unique_customer_identifier, coalesce(contract_dd_cancels, 0) as contract_dd_cancels,
    coalesce(dd_cancel_60_day, 0) as dd_cancel_60_day,
    case when contract_dd_cancels > 0 then 1 else 0 end as any_contract_dd_cancel,
    case when dd_cancel_60_day > 0 then 1 else 0 end as any_dd_cancel_60d
  from latest""",
    "contract_features": """
  select unique_customer_identifier, coalesce(ooc_days, 0) as ooc_days,
    coalesce(contract_status, 'Unknown') as contract_status,
    case when coalesce(ooc_days, 0) > 0 then 1 else 0 end as is_out_of_contract,
    case when coalesce(ooc_days, 0) between -60 and 0 then 1 else 0 end as is_near_ooc,
    case when coalesce(tenure_days, 0) < 30 then '0–1 month'
         when tenure_days < 90 then '1–3 months'
         when tenure_days < 180 then '3–6 months'
         when tenure_days < 365 then '6–12 months'
         when tenure_days < 540 then '12–18 months'
         when tenure_days < 730 then '18–24 months'
         else '24+ months' end as tenure_bucket
  from latest""",
    "product_features": f"""
  select unique_customer_identifier, coalesce(sales_channel, 'Unknown') as sales_channel,
    coalesce(technology, 'Unknown') as technology, speed, line_speed,
    speed - line_speed as speed_gap,
    case when speed > 0 then {rounded("(speed - line_speed) / speed", 6)} end as speed_gap_pct
  from latest""",
}

TARGET_CTE = {
    "target": """
  select unique_customer_identifier, min(cast(cease_completed_date as date)) as ref_date,
    1 as is_churned
  from cease where cease_completed_date is not null and cease_completed_date <> 'null'
  group by 1"""
}


def _wide_sql(anchors: str, label: bool) -> str:
    parts = ["call_features", "talk_features", "payment_features", "contract_features"]
    joins = "".join(f"\n  left join {p} using ({ID})" for p in parts)
    joins += f"\n  left join (select {ID}, usage_drop_pct_28d from usage_features) using ({ID})"
    joins += f"\n  left join product_features using ({ID})"
    columns = "*"
    if label:
        joins += f"\n  left join (select {ID}, is_churned from target) using ({ID})"
        columns = "* replace (coalesce(is_churned, 0) as is_churned)"
    return f"\n  select {columns} from (select {ID} from {anchors}){joins}"


TRAINING_CTES = {
    **_call_ctes("ref_dates"),
    **SNAPSHOT_CTES,
    **_usage_ctes("ref_dates"),
    **TARGET_CTE,
    "training_features": _wide_sql("ref_dates", label=True),
}
SCORING_CTES = {
    **_call_ctes("scoring_dates"),
    **SNAPSHOT_CTES,
    **_usage_ctes("scoring_dates"),
    "inference_features": _wide_sql("scoring_dates", label=False),
}
RULE_CTES = {
    **TRAINING_CTES,
    "ruled": """
  select unique_customer_identifier, is_churned,
    coalesce(least(1.0::double, calls_total_90d::double / 5 + any_dd_cancel_60d::double / 4), 0.0)
      as churn_probability
  from training_features""",
    "scored": """
  select *, case when churn_probability >= 0.5 then 1 else 0 end as prediction from ruled""",
    "outcomes": """
  select count(*) filter (is_churned = 1 and prediction = 1)::double as tp,
    count(*) filter (is_churned = 0 and prediction = 1)::double as fp,
    count(*) filter (is_churned = 1 and prediction = 0)::double as fn,
    count(*) filter (is_churned = 0 and prediction = 0)::double as tn from scored""",
}
HASH = "('0x' || substr(md5(unique_customer_identifier || '{seed}'), 1, 8))::bigint"


def statement(select: str, *groups: dict[str, str]) -> str:
    """The select with the views and CTEs it needs, directly or through others."""
    available = dict(VIEWS)
    for group in groups:
        available.update(group)
    order = list(available)
    needed: set[str] = set()
    todo = [select]
    while todo:
        text = todo.pop()
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in order:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(available[name])
    ctes = ",\n".join(f"{name} as ({available[name]})" for name in order if name in needed)
    return f"with {ctes}\n{select}" if ctes else select


def _feature_sql() -> dict[str, str]:
    return {
        "q01_ref_dates": statement("select * from ref_dates"),
        "q01_scoring_dates": statement("select * from scoring_dates"),
        "q02_call_features": statement("select * from call_features", TRAINING_CTES),
        "q03_talk_hold_features": statement("select * from talk_features", TRAINING_CTES),
        "q04_payment_friction_features": statement("select * from payment_features", SNAPSHOT_CTES),
        "q05_contract_tenure_features": statement("select * from contract_features", SNAPSHOT_CTES),
        "q06_usage_features": statement(
            f"select {ID}, usage_drop_pct_28d from usage_features", TRAINING_CTES
        ),
        "q06_usage_features_with_totals": statement("select * from usage_features", TRAINING_CTES),
        "q07_product_tech_speed_features": statement(
            "select * from product_features", SNAPSHOT_CTES
        ),
        "q08_churn_target_completed": statement("select * from target", TARGET_CTE),
        "q09_training_features": statement("select * from training_features", TRAINING_CTES),
        "q10_inference_features": statement("select * from inference_features", SCORING_CTES),
    }


def _share(count: str, total: str, digits: int = 2) -> str:
    return rounded(f"{double(count)} / nullif({total}, 0) * 100", digits)


def _reason_sql(column: str) -> str:
    share = _share("churned_customers", "(select count(*) from completed)")
    return statement(f"""
select {column}, churned_customers, {share} as churn_percentage from (
  select {column}, count(distinct {ID}) as churned_customers from cease
  where cease_completed_date is not null and cease_completed_date <> 'null' group by 1 )
order by churn_percentage desc, {column} asc nulls first limit 20""")


def _rate_sql(column: str, expression: str) -> str:
    return statement(f"""
select {column}, customers, churned_customers,
  {_share("churned_customers", "customers")} as churn_rate_pct
from (select {expression} as {column}, count(*) as customers,
        count(r.{ID}) as churned_customers
      from latest l left join raw_completed r using ({ID}) group by 1 )""")


def _transition_ctes(direction: str) -> dict[str, str]:
    order = {
        "as_reference": "datevalue desc, snapshot_id desc",
        "chronological": "datevalue asc, snapshot_id asc",
    }[direction]
    return {
        "history": f"""
  select {ID}, datevalue, snapshot_id, crm_package_name as package from customer_info""",
        "steps": f"""
  select *, lag(package) over (partition by {ID} order by {order}) as prev_package,
    lag(datevalue) over (partition by {ID} order by {order}) as prev_date
  from history""",
        "changes": f"""
  select {ID}, prev_package as from_value, package as to_value, prev_date, datevalue
  from steps where prev_package is not null and package <> prev_package""",
        "churner_changes": f"""
  select * from changes where {ID} in (select {ID} from completed)""",
    }


def _transition_sql(direction: str) -> str:
    share = _share("transition_events", "(select count(*) from churner_changes)")
    return statement(
        f"""
select *, {share} as event_share_pct from (
  select from_value as from_package, to_value as to_package, count(*) as transition_events,
    count(distinct {ID}) as unique_customers from churner_changes group by 1, 2 )""",
        _transition_ctes(direction),
    )


GROUP_CTES = {
    "group_calls": f"""
  select r.{ID}, r.churn_group, c.call_type, c.talk_time_seconds, c.hold_time_seconds,
    date_diff('day', c.event_date, r.ref_date) as d
  from ref_dates r join calls c using ({ID})
  where date_diff('day', c.event_date, r.ref_date) between 0 and 90""",
    "per_customer": f"""
  select r.{ID}, r.churn_group,
    count(*) filter (d <= 30) as calls_30d, count(*) filter (d <= 60) as calls_60d,
    count(*) filter (d <= 90) as calls_90d,
    coalesce(sum(talk_time_seconds), 0) as talk, coalesce(sum(hold_time_seconds), 0) as hold
  from ref_dates r left join group_calls g using ({ID}) group by 1, 2""",
    "per_type": f"""
  select {ID}, churn_group, call_type, count(*) filter (d <= 30) as calls_30d,
    count(*) filter (d <= 60) as calls_60d, count(*) filter (d <= 90) as calls_90d
  from group_calls group by 1, 2, 3""",
    "sizes": """
  select churn_group, count(*) as customers from ref_dates group by 1""",
}


def _volume_sql() -> str:
    columns = []
    for n in (30, 60, 90):
        c = f"calls_{n}d"
        columns += [
            f"{rounded(f'avg({c})', 2)} as avg_{c}",
            f"quantile_disc({c}, 0.5) as median_{c}",
            f"{rounded(f'avg(case when {c} > 0 then 1 else 0 end) * 100', 2)} as pct_any_{c}",
        ]
    return statement(
        f"select churn_group, count(*) as customers, {', '.join(columns)} from per_customer group by 1",
        GROUP_CTES,
    )


def _penetration_select() -> str:
    counts = ", ".join(
        f"count(distinct case when calls_{n}d > 0 then {ID} end) as cust_any_{n}d"
        for n in (30, 60, 90)
    )
    shares = ", ".join(
        f"{_share(f'cust_any_{n}d', 'customers')} as pct_cust_any_{n}d" for n in (30, 60, 90)
    )
    return f"""
select p.*, customers, {shares}
from (select churn_group, call_type, {counts} from per_type group by 1, 2 ) p
left join sizes using (churn_group)"""


def _intensity_sql(condition: str = "") -> str:
    totals = ", ".join(f"{big(f'sum(calls_{n}d)')} as total_calls_{n}d" for n in (30, 60, 90))
    means = ", ".join(
        rounded(f"{double(f'total_calls_{n}d')} / customers", 3)
        + f" as avg_calls_per_customer_{n}d"
        for n in (30, 60, 90)
    )
    return statement(
        f"""
select p.*, customers, {means}
from (select churn_group, call_type, {totals} from per_type group by 1, 2 ) p
left join sizes using (churn_group) {condition}""",
        GROUP_CTES,
    )


def _means_sql() -> str:
    means = ", ".join(
        f"{rounded(f'avg({c})', 3)} as {FLAG_MEANS.get(c, f'avg_{c}')}" for c in NUMERIC_FEATURES
    )
    return statement(
        f"select is_churned, count(*) as customers, {means} from training_features group by 1",
        TRAINING_CTES,
    )


def _report_sql() -> dict[str, str]:
    channel_share = _share("churned_customers", "(select count(*) from completed)")
    package_share = _share(
        "churned_customers_who_ever_had_pkg", "(select count(*) from completed)"
    )
    friction = f"case when c.{ID} is null then 'Non-churner' else 'Churner' end"
    return {
        "q11_overall_churn_rate": statement(f"""
select total_customers, churned_customers,
  {_share("churned_customers", "total_customers")} as churn_rate_pct
from (select (select count(distinct {ID}) from customer_info) as total_customers,
             (select count(*) from completed) as churned_customers )"""),
        "q12_churn_share_by_reason": _reason_sql("reason_description"),
        "q13_churn_share_by_reason_insight": _reason_sql("reason_description_insight"),
        "q14_cease_customer_profiles": statement(
            f"select * from customer_info join cease using ({ID})"
        ),
        "q15_churn_share_by_sales_channel": statement(f"""
select *, {channel_share} as churn_share_pct from (
  select sales_channel, count(distinct c.{ID}) as churned_customers
  from completed c left join latest l using ({ID}) group by 1 )"""),
        "q16_churners_ever_on_package": statement(f"""
select *, {package_share} as pct_of_churners_who_ever_had_pkg from (
  select coalesce(crm_package_name, 'Unknown') as crm_package_name,
    count(distinct c.{ID}) as churned_customers_who_ever_had_pkg
  from completed c left join customer_info i using ({ID}) group by 1 )"""),
        "q17_package_transitions": _transition_sql("as_reference"),
        "q17_package_transitions_chronological": _transition_sql("chronological"),
        "q17_package_steps": statement(
            "select * from changes", _transition_ctes("as_reference")
        ),
        "q18_churn_rate_by_tenure_band": _rate_sql(
            "tenure_bucket",
            """case when tenure_days < 90 then '0–3 months'
         when tenure_days < 180 then '3–6 months'
         when tenure_days < 365 then '6–12 months'
         when tenure_days < 730 then '1–2 years'
         when tenure_days < 1095 then '2–3 years'
         else '3+ years' end""",
        ),
        "q19_churn_rate_by_speed": _rate_sql("speed", "speed"),
        "q20_churn_rate_by_technology": _rate_sql("technology", "coalesce(technology, 'Unknown')"),
        "q21_call_volume_by_group": _volume_sql(),
        "q22_payment_friction_by_group": statement(f"""
select churn_group, count(*) as customers,
  {rounded("avg(contract)", 3)} as avg_contract_dd_cancels,
  {rounded("avg(recent)", 3)} as avg_dd_cancel_60_day,
  {rounded("avg(case when contract > 0 then 1 else 0 end) * 100", 2)} as pct_with_any_contract_dd_cancel,
  {rounded("avg(case when recent > 0 then 1 else 0 end) * 100", 2)} as pct_with_any_dd_cancel_60d
from (select {friction} as churn_group, coalesce(contract_dd_cancels, 0)::double as contract,
        coalesce(dd_cancel_60_day, 0)::double as recent
      from latest left join completed c using ({ID}) ) group by 1"""),
        "q23_usage_trend_before_cease": statement(f"""
select week_before, count(distinct {ID}) as customers,
  {rounded("avg(weekly)", 2)} as avg_weekly_download_mbs,
  {rounded("quantile_disc(weekly, 0.5)", 2)} as median_weekly_download_mbs
from (select {ID}, week_before, sum(usage_download_mbs) as weekly
      from (select {ID}, usage_download_mbs,
              {big("floor(date_diff('day', calendar_date, ref_date) / 7)")} as week_before
            from churn_ref join usage_daily using ({ID})
            where date_diff('day', calendar_date, ref_date) between 0 and 55 )
      group by 1, 2 ) group by 1"""),
        "q24_call_type_penetration": statement(_penetration_select(), GROUP_CTES),
        "q24_churner_penetration": statement(
            f"select * from ( {_penetration_select()} ) where churn_group = 'Churner'", GROUP_CTES
        ),
        "q24_non_churner_penetration": statement(
            f"select * from ( {_penetration_select()} ) where churn_group = 'Non-churner'", GROUP_CTES
        ),
        "q25_call_type_intensity": _intensity_sql(),
        "q25_churner_intensity": _intensity_sql("where churn_group = 'Churner'"),
        "q25_non_churner_intensity": _intensity_sql("where churn_group = 'Non-churner'"),
        "q26_talk_hold_by_group": statement(
            f"""
select churn_group, count(*) as customers, {rounded("avg(calls_90d)", 2)} as avg_calls_90d,
  {rounded("avg(talk)", 2)} as avg_total_talk_90d_secs,
  {rounded("avg(hold)", 2)} as avg_total_hold_90d_secs
from per_customer group by 1""",
            GROUP_CTES,
        ),
        "q27_feature_means_by_label": _means_sql(),
        "q28_label_balance": statement(
            'select is_churned, count(*) as "count" from training_features group by 1',
            TRAINING_CTES,
        ),
        "q29_grain_check": statement(
            f'select {ID}, count(*) as "count" from training_features group by 1', TRAINING_CTES
        ),
        "q29_snapshot_grain": statement(
            f'select {ID}, datevalue, count(*) as "count" from customer_info group by 1, 2'
        ),
        "q30_high_risk_customers": statement(
            f"""
select {ID}, churn_probability,
  cast(row_number() over (order by churn_probability desc, {ID}) as int) as risk_rank
from scored where churn_probability >= 0.7
order by churn_probability desc, {ID} limit 100""",
            RULE_CTES,
        ),
    }


def _table_sql() -> dict[str, str]:
    widths = {"cease": 5, "customer_info": 13, "calls": 5, "usage_daily": 4}
    counts = "\nunion all\n".join(
        f"select '{name.removesuffix('_daily')}' as table_name, count(*) as row_count, "
        f"{width} as column_count from {name}"
        for name, width in widths.items()
    )
    zeroed = ", ".join(f"coalesce({c}, 0) as {c}" for c in NUMERIC_FEATURES)
    return {
        "s03_cease": statement("select * from cease"),
        "s03_customer_info": statement("select * from customer_info"),
        "s05_table_profile": statement(counts),
        "s07_features_missing_as_zero": statement(
            f"select * replace ({zeroed}) from training_features", TRAINING_CTES
        ),
        "j01_daily_calls": statement(f"""
select {ID}, call_type, event_date as fact_day, count(*) as calls,
  {rounded("sum(talk_time_seconds)", 6)} as talk_seconds,
  {rounded("sum(hold_time_seconds)", 6)} as hold_seconds
from calls where event_date is not null group by 1, 2, 3"""),
        "j01_daily_usage": statement(f"""
select {ID}, calendar_date as fact_day, {rounded("sum(usage_download_mbs)", 4)} as download_mbs,
  {rounded("sum(usage_upload_mbs)", 4)} as upload_mbs
from usage_daily where calendar_date is not null group by 1, 2"""),
    }


def _hash_ctes(seed: int, fractions: list[float]) -> dict[str, str]:
    cuts = ", ".join(f"quantile_disc(h, {f}) as cut_{i}" for i, f in enumerate(fractions))
    return {
        **TRAINING_CTES,
        "hashed": f"""
  select {ID}, is_churned, {HASH.format(seed=seed)} as h from training_features""",
        "cuts": f"""
  select is_churned, {cuts} from hashed group by 1""",
        "placed": """
  select * from hashed join cuts using (is_churned)""",
    }


ROC_CTES = {
    **RULE_CTES,
    "per_score": """
  select churn_probability as threshold, count(*) filter (is_churned = 1) as pos,
    count(*) filter (is_churned = 0) as neg from scored group by 1""",
    "curve": """
  select *, sum(pos) over down as tp, sum(neg) over down as fp,
    lead(pos) over down as next_pos, lead(neg) over down as next_neg,
    row_number() over down as place
  from per_score window down as (order by threshold desc)""",
    "totals": """
  select sum(pos)::double as p, sum(neg)::double as n from per_score""",
}


def _roc_sql(condition: str) -> str:
    return statement(
        f"""
select 'infinity'::double as threshold, 0.0::double as fpr, 0.0::double as tpr
union all
select {rounded("threshold", 6)}, {rounded("fp / (select n from totals)", 6)},
  {rounded("tp / (select p from totals)", 6)} from curve where {condition}""",
        ROC_CTES,
    )


def _learning_sql() -> dict[str, str]:
    encoded = ", ".join(
        f"cast(dense_rank() over (order by coalesce({c}, 'None')) - 1 as int) as {c}"
        for c in ("contract_status", "tenure_bucket", "sales_channel", "technology")
    )
    split = _hash_ctes(42, [0.2])
    folds = _hash_ctes(43, [0.2, 0.4, 0.6, 0.8])
    fold = " + ".join(f"(h > cut_{i})::int" for i in range(4))
    precision = "case when tp + fp > 0 then tp / (tp + fp) else 0.0 end"
    recall = "case when tp + fn > 0 then tp / (tp + fn) else 0.0 end"
    f1 = "case when p + r > 0 then 2 * p * r / (p + r) else 0.0 end"
    per_class = f"""
  select *, {f1} as f from (
    select '0' as class, case when tn + fn > 0 then tn / (tn + fn) else 0.0 end as p,
      case when tn + fp > 0 then tn / (tn + fp) else 0.0 end as r, tn + fp as s from outcomes
    union all
    select '1', {precision}, {recall}, tp + fn from outcomes )"""
    columns = ", ".join(
        f"{rounded(c, 6)} as {n}" for c, n in (("p", "precision"), ("r", "recall"), ("f", "f1_score"))
    )
    return {
        "m01_label_encode": statement(
            f"select {ID}, {encoded} from training_features", TRAINING_CTES
        ),
        "m03_stratified_split": statement(
            f"select {ID}, is_churned, (h <= cut_0)::int as is_test from placed", split
        ),
        "m04_class_weight": statement(
            """
select negatives, positives, negatives::double / positives as positive_weight
from (select count(*) filter (is_churned = 0) as negatives,
        count(*) filter (is_churned = 1) as positives from placed where h > cut_0 )""",
            split,
        ),
        "m07_classification_metrics": statement(
            f"""
select {rounded("(tp + tn) / (tp + fp + fn + tn)", 6)} as accuracy, {rounded("p", 6)} as precision,
  {rounded("r", 6)} as recall, {rounded(f1, 6)} as f1_score
from (select *, {precision} as p, {recall} as r from outcomes )""",
            RULE_CTES,
        ),
        "m08_roc_auc": statement(
            f"""
select {rounded("sum(a.neg * (case when b.threshold > a.threshold then b.pos "
                "when b.threshold = a.threshold then b.pos / 2.0 else 0 end)) "
                "/ (select p * n from totals)", 6)} as roc_auc
from per_score a, per_score b""",
            ROC_CTES,
        ),
        "m09_classification_report": statement(
            f"""
select class, {columns}, {big("s")} as support from (
  select class, p, r, f, s from per_class
  union all
  select 'accuracy', null, null, (tp + tn) / (tp + fp + fn + tn), tp + fp + fn + tn from outcomes
  union all
  select 'macro avg', avg(p), avg(r), avg(f), sum(s) from per_class
  union all
  select 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s)
  from per_class )""",
            RULE_CTES | {"per_class": per_class},
        ),
        "m10_confusion_matrix": statement(
            'select is_churned as actual, prediction as predicted, count(*) as "count" '
            "from scored group by 1, 2",
            RULE_CTES,
        ),
        "m11_roc_curve": _roc_sql(
            "place = 1 or next_pos is null or next_pos <> pos or next_neg <> neg"
        ),
        "m11_roc_curve_all_points": _roc_sql("true"),
        "m13_stratified_folds": statement(
            f"select {ID}, is_churned, {fold} as fold from placed", folds
        ),
        "m15_balanced_weight": statement(
            f"""
select {ID}, is_churned,
  {rounded("count(*) over () / (2.0::double * count(*) over (partition by is_churned))", 6)} as weight
from training_features""",
            TRAINING_CTES,
        ),
        "m17_spot_check": statement(
            f"""
select {ID}, churn_probability, prediction as predicted_churn, is_churned as actual_churn,
  case when prediction = is_churned then 'Correct' else 'Incorrect' end as prediction_status
from scored order by {HASH.format(seed=42)}, {ID} limit 10""",
            RULE_CTES,
        ),
    }


VECTOR_INPUTS = NUMERIC_FEATURES + ["contract_status", "tenure_bucket", "sales_channel", "technology"]
INDICATORS = """
contract_dd_cancels dd_cancel_60_day ooc_days any_dd_cancel_60d
usage_drop_pct_28d speed line_speed speed_gap speed_gap_pct
""".split()


def _fitted_sql() -> dict[str, str]:
    """What must hold of each row behind a fitted model."""
    names = VECTOR_INPUTS + [f"{c}_missing" for c in INDICATORS]
    listed = ", ".join(f"('{n}')" for n in names)
    scores = statement(
        f"select {ID}, cast(is_churned as int) as is_churned, true as valid, true as consistent "
        "from placed where h <= cut_0",
        _hash_ctes(42, [0.2]),
    )
    return {
        "m05_second_order_scores_checked": scores,
        "m06_test_scores_checked": scores,
        "m12_feature_importances_checked": (
            "select feature, true as valid, 1.0::double as total "
            f"from (values {listed}) as inputs(feature)"
        ),
        "m16_churn_predictions_checked": statement(
            f"select distinct {ID}, true as valid from customer_info"
        ),
    }


def all_sql() -> dict[str, str]:
    return _feature_sql() | _report_sql() | _table_sql() | _learning_sql() | _fitted_sql()
