"""DuckDB SQL with the same answer as each registered query.

The SQL states the definitions directly (counts of earlier rows by self-join,
``min`` over earlier rows) instead of repeating the window formulas of the Spark side.
"""

from __future__ import annotations

from riskweave.constants import (
    BAD_TIMESTAMP_ERROR,
    CITIES,
    EARTH_RADIUS_KM,
    MISSING_ID_ERROR,
    STATUSES,
    UNMARSHAL_PREFIX,
)
from riskweave.plans.inputs import AS_OF, CUTOFF, PAGE_ROWS
from riskweave.sources.harness import EVENT_CATEGORIES

_CITY_ROWS = ", ".join(f"('{c}', {lat!r}::double, {lon!r}::double)" for c, lat, lon in CITIES)
_CITY_NAMES = "[" + ", ".join(f"'{c}'" for c, _, _ in CITIES) + "]"
_CATEGORY = "case event_type " + " ".join(f"when '{t}' then '{c}'" for t, c in EVENT_CATEGORIES) + " end"

_CITY_OF_EVENT = (
    f"list_extract({_CITY_NAMES}, cast(case when k < 5 then k + 5 else user_id % 10 end as int) + 1)"
)


def _rfc(ts: str) -> str:
    return rf"regexp_replace(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f'), '\.?0+$', '')"


# c: cities. e: events with k and city. t: events as transactions.
BASE = f"""
c(city, lat, lon) as (values {_CITY_ROWS}),
e0 as (select *, cast(json_extract(props, '$.k') as int) as k from events),
e as (select *, {_CATEGORY} as category, {_CITY_OF_EVENT} as city,
        cast(trunc(value * 100.0) as bigint) as cents, epoch_us(ts) as us from e0),
t as (select bank || ':' || event_id as idempotency_key, * from (
        select case when event_type = 'error' then 'attack-sim' else 'bank-a' end as bank,
               cast(event_id as varchar) as native_id, cast(user_id as varchar) as account_id,
               cents as amount_cents, 'USD' as currency, event_type as merchant_name,
               category as merchant_category, city, us, k, event_id from e))"""

FLAT = """idempotency_key, bank, native_id, account_id, amount_cents, currency, merchant_name,
merchant_category, city, us as occurred_us"""

_KM = f"""{EARTH_RADIUS_KM}::double * 2 * atan2(sqrt(hh), sqrt(greatest(1 - hh, 0.0::double)))"""


def _history(source: str, reach_us: int, p: str = "", whole_seconds: bool = False) -> str:
    """CTE ``{p}h``: history of every row of CTE ``source``, stated by comparison with earlier rows."""
    a_tick, b_tick, reach = ("a.us", "b.us", reach_us)
    if whole_seconds:
        a_tick, b_tick, reach = "a.us // 1000000", "b.us // 1000000", reach_us // 1_000_000
    return f"""
{p}n as (select a.idempotency_key, count(*) as position,
        count(*) filter (where {b_tick} >= {a_tick} - {reach}) as in_window,
        count(*) filter (where b.merchant_category = a.merchant_category) = 1 as first_use
      from {source} a join {source} b on a.account_id = b.account_id
        and (b.us < a.us or (b.us = a.us and b.idempotency_key <= a.idempotency_key))
      group by a.idempotency_key),
{p}h0 as (select s.*, n.position, n.in_window, n.first_use,
        lag(s.city) over w as prev_city, lag(s.us) over w as prev_us
      from {source} s join {p}n n using (idempotency_key)
      window w as (partition by s.account_id order by s.us, s.idempotency_key)),
{p}h1 as (select h.*, pow(sin(radians(x.lat - y.lat) / 2), 2) + cos(radians(y.lat))
        * cos(radians(x.lat)) * pow(sin(radians(x.lon - y.lon) / 2), 2) as hh
      from {p}h0 h left join c x on x.city = h.city left join c y on y.city = h.prev_city),
{p}h as (select *, {_KM} as km, abs(us // 1000000 - prev_us // 1000000) / 3600.0::double as hr
      from {p}h1)"""


def _velocity(seconds: int) -> str:
    return f"case when in_window >= 5 then 'velocity: ' || in_window || ' transactions within {seconds}s' end"


_DRIFT = """case when position > 5 and first_use
 then 'mcc_drift: first time this account has used category ' || merchant_category end"""
_GEO = """case when km >= 1 and hr <= 0
 then 'geo_impossible: ' || prev_city || ' -> ' || city || ' implies traveling instantaneously'
 when km >= 1 and km / nullif(hr, 0) > 1100 then 'geo_impossible: ' || prev_city || ' -> ' || city
 || ' implies traveling ' || cast(round(km / hr) as bigint) || ' km/h' end"""


def _scored(source: str, seconds: int, p: str = "") -> str:
    """CTE ``{p}r``: flagged rows of ``source`` with ``reasons`` and ``n_flags``."""
    return f"""{_history(source, seconds * 1_000_000, p)},
{p}v as (select *, {_velocity(seconds)} as rv, {_DRIFT} as rd, {_GEO} as rg from {p}h),
{p}r as (select *, concat_ws(chr(10), rv, rd, rg) as reasons,
        (rv is not null)::int + (rd is not null)::int + (rg is not null)::int as n_flags
      from {p}v where rv is not null or rd is not null or rg is not null)"""


_DAY_S, _HOUR_S, _YEAR_S = 86_400, 3_600, 365 * 86_400
DAY_RULES = f"with {BASE},{_scored('t', _DAY_S)}"

_CUT_US = f"epoch_us(timestamp '{CUTOFF}')"
_AS_OF_US = f"epoch_us(timestamp '{AS_OF}')"
_SCORE = """case when (event_id % 100) % 5 <> 0 then (event_id % 100) / 100.0::double end"""

# d: latest decision per key. Only three event types are reviewed.
DECISIONS = """
d as (select idempotency_key, case when amount_cents < 5000 then 'approved' else 'denied' end as decision,
        us + 3600000000 as decided_us from t where merchant_name in ('click', 'purchase', 'error'))"""


def _table(source: str, name: str) -> str:
    """CTE ``name``: the flag table made of the flagged rows ``source``."""
    return f"""
{name} as (select r.idempotency_key, r.account_id, r.amount_cents, r.merchant_category, r.reasons,
        r.us as occurred_us, coalesce(d.decision, 'pending') as status, {_SCORE} as ml_score,
        {_CUT_US} as created_us, greatest(d.decided_us, {_CUT_US}) as updated_us
      from {source} r left join d using (idempotency_key))"""


FLAGS = f"{DAY_RULES},{DECISIONS},{_table('r', 'f')}"
EARLIER = f"""{DAY_RULES},{DECISIONS},
tb as (select * from t where us < {_CUT_US}),{_scored('tb', _DAY_S, 'b_')},{_table('b_r', 'cur')}"""

FLAG_FLAT = """idempotency_key, account_id, amount_cents, merchant_category, reasons, occurred_us,
status, ml_score, created_us, updated_us"""

# Feeds: what each native row must become.
_ANY_TYPE = "event_type in ('view', 'purchase')"
FEEDS = f"""
n as (select *, bank || ':' || event_id as idempotency_key from (
  select event_id, k, value,
    case when {_ANY_TYPE} then 'bank-a' when event_type in ('click', 'signup') then 'bank-b'
         else 'bank-c' end as bank,
    cast(event_id as varchar) as native_id, cast(user_id as varchar) as account_id,
    cents as amount_cents, 'USD' as currency,
    case when event_type = 'signup' then '' else event_type end as merchant_name,
    category as merchant_category,
    case when event_type = 'error' and k < 5 then '' else city end as city,
    case when event_type = 'error' and k = 13 then null else us end as us,
    case when event_type = 'error' and k = 13 then '{BAD_TIMESTAMP_ERROR}' end as error
  from e))"""
_FEED_FLAT = f"with {BASE},{FEEDS} select {FLAT}, error from n"

DIRTY = f"""
dirty as (select case when k = 7 then '' else bank end as bank,
    case when k = 8 then '' else native_id end as native_id,
    case when k = 9 then 0 else amount_cents end as amount_cents, account_id, k, us from t),
checked as (select bank || ':' || native_id as idempotency_key, *,
    case when bank = '' or native_id = '' then '{MISSING_ID_ERROR}'
         when amount_cents = 0 then 'schema: transaction ' || bank || ':' || native_id
              || ' has zero amount' end as error from dirty)"""

_BODY = f"""'{{"bank":"' || bank || '","native_id":"' || native_id || '","account_id":"' || account_id
 || '","amount_cents":' || amount_cents || ',"currency":"USD","merchant_name":"' || merchant_name
 || '","merchant_category":"' || merchant_category || '","city":"' || city || '","timestamp":"'
 || {_rfc('make_timestamp(us)')} || 'Z","raw":{{"k":' || k || '}}}}'"""

DAMAGED = """
m as (select *, case when k < 10 or k between 20 and 29 then 'malformed body'
     when k between 10 and 19 then 'not a string: bank'
     when k between 30 and 39 then 'bad timestamp' end as problem from t)"""

DELIVERED = f"""
g as (select *, k % 5 as tried from t where merchant_name = 'error'),
routed as (select idempotency_key as message_id, tried,
    case when tried >= 3 then 'dead' else 'retry' end as route,
    case when tried >= 3 then tried else tried + 1 end as retry_count,
    case when tried < 3 then {_AS_OF_US} + 2000000 end as available_us,
    case when tried >= 3 then 'gave up after ' || tried || ' retries: no answer for '
         || idempotency_key end as reason from g)"""

EVALUATED = f"""{FLAGS},
tot as (select count(*) filter (where bank = 'attack-sim') as attack_transactions,
        count(*) filter (where bank <> 'attack-sim') as legit_transactions from t),
fl as (select count(*) filter (where idempotency_key like 'attack-sim:%') as attack_flagged,
        count(*) filter (where idempotency_key not like 'attack-sim:%') as legit_flagged from f),
ev as (select *, attack_flagged / nullif(attack_flagged + legit_flagged, 0)::double as p,
        attack_flagged / nullif(attack_transactions, 0)::double as r,
        legit_flagged / nullif(legit_transactions, 0)::double as q from tot, fl)"""
_COUNTS = "attack_transactions, legit_transactions, attack_flagged, legit_flagged"
_RATIOS = """round(p, 6) as "precision", round(r, 6) as recall, round(q, 6) as false_positive_rate"""

TYPED = f"""with {BASE},
y as (select idempotency_key, merchant_name as account_id, amount_cents,
      cast(k as varchar) as merchant_category, city, us, 0 as parts from t)"""

ORDERS = f"""with {BASE.split(',' + chr(10) + 'e0')[0]},
o as (select 'bank-b:' || o_orderkey as idempotency_key, cast(o_custkey as varchar) as account_id,
        o_orderpriority as merchant_category, epoch_us(o_orderdate) as us,
        list_extract({_CITY_NAMES}, cast(c_nationkey % 10 as int) + 1) as city
      from orders join customer on o_custkey = c_custkey)"""


def _features(prefix: str, source: str, reach_s: int, keep: str = "") -> str:
    body = _history(source, reach_s * 1_000_000, "w_", whole_seconds=True)
    return f"""{prefix},{body},
feat as (select idempotency_key, amount_cents, hour(make_timestamp(us))::int as hour_of_day,
    (isodow(make_timestamp(us)) - 1)::int as weekday, (merchant_category = '7995')::int as is_high_risk_mcc,
    in_window - 1 as velocity_count, (not first_use)::int as category_seen_before,
    round(case when km >= 1 then case when us > prev_us
        then km / ((us - prev_us) / 3600000000.0::double) else km * 1e6 end else 0 end, 3)
      as geo_speed_kmh, parts::int as rule_flag_count from w_h)
select * from feat{keep}"""


COUNTED = f"""{FLAGS},
y as (select t.*, coalesce(len(string_split(f.reasons, chr(10))), 0) as parts
      from t left join f using (idempotency_key))"""


# The label that the classifier's queries learn; it is a law of three features.
_LAW = "((y.merchant_category = '7995' and isodow(make_timestamp(y.us)) >= 6) or y.parts >= 2)"


def _split(source: str) -> str:
    return f"""select idempotency_key, case when rn <= wanted then 'train' else 'test' end as split
from (select *, case when n > 1 then greatest(1, cast(floor(n * 0.8::double) as bigint)) else n end as wanted
  from (select *, row_number() over (partition by label order by us, idempotency_key) as rn,
          count(*) over (partition by label) as n from {source}))"""


_SELECT_HISTORY = "select idempotency_key, position, in_window, first_use, prev_city, prev_us"


def _rule(column: str) -> str:
    return f"{DAY_RULES} select idempotency_key, {column} as reasons from v where {column} is not null"


ORACLE: dict[str, str] = {
    "read_feed_files": _FEED_FLAT,
    "explode_landed_pages": f"""with {BASE} select 'bank-a:' || event_id as idempotency_key,
        'bank-a' as bank, native_id, account_id, amount_cents, currency, merchant_name,
        merchant_category, city, us as occurred_us from t""",
    "explode_chained_pages": f"""with {BASE} select 'bank-a:' || event_id as idempotency_key,
        'bank-a' as bank, native_id, account_id, amount_cents, currency, merchant_name,
        merchant_category, city, us as occurred_us from t""",
    "page_chain": f"""with p as (select event_id // {PAGE_ROWS} as n from events
          union select (event_id + 1) // {PAGE_ROWS} from events),
        k as (select n, case when n = 0 then '' else md5(n::varchar) end as cursor, (select max(n) from p) as last from p),
        -- The first page off the chain, by delivery; a fork that skips page 3 leaves out that one only.
        d(delivery, off) as (values ('whole', null), ('unreadable', 3), ('hole', 3), ('fork', null), ('loop', 6), ('headless', 0)),
        r as (select delivery, cursor, n, last, off, delivery = 'fork' and md5('4') < md5('3') as skips from k, d
            where not (delivery = 'hole' and n = 3) and not (delivery = 'headless' and n = 0)),
        q as (select *, n >= off is true or (skips and n = 3) as is_off from r)
        select delivery, cursor,
          case when not is_off then n - (skips and n > 3)::int end::bigint as position,
          case when is_off then 'not on the chain'
            when delivery = 'unreadable' and n = 2 then 'unreadable page'
            when delivery = 'fork' and n = 2 then 'two next pages'
            when delivery = 'hole' and n = 2 then 'next page missing'
            when delivery = 'loop' and n = 5 then 'loops back' end as problem
        from q
        union all select 'headless', '', null, 'first page missing'""",
    "page_overlap": f"""with p as (select event_id // {PAGE_ROWS} as page_no from events
        union all select (event_id + 1) // {PAGE_ROWS} from events
          where (event_id + 1) // {PAGE_ROWS} <> event_id // {PAGE_ROWS})
        select page_no, count(*) as n, count(*) - 1 as last_pos from p group by page_no""",
    "page_delivery_gaps": f"""with p as (select distinct event_id // {PAGE_ROWS} as page_no from events
        union select (event_id + 1) // {PAGE_ROWS} from events)
        select page_no, case when page_no = 2 then 'unreadable page' else 'next page missing' end as problem
        from p where page_no in (2, 4) or page_no = (select max(page_no) from p)""",
    "pages_unreadable": f"""select 'bank-a:page-' || p as message_id, 0 as retry_count,
        '{UNMARSHAL_PREFIX}malformed page' as reason
        from (select distinct event_id // {PAGE_ROWS} as p from events union
          select (event_id + 1) // {PAGE_ROWS} from events)""",
    "parse_envelopes": f"""with {BASE},{DAMAGED} select idempotency_key as message_id,
        '{UNMARSHAL_PREFIX}' || problem as error,
        case when problem is null then idempotency_key end as idempotency_key,
        case when problem is null then amount_cents end as amount_cents,
        case when problem is null then case when k between 40 and 49 then '' else city end end as city,
        case when problem is null then us end as occurred_us from m""",
    "unparseable_envelopes": f"""with {BASE},{DAMAGED},
        b as (select *, {_BODY} as body from m where problem is not null)
        select idempotency_key as message_id, 0 as retry_count,
        '{UNMARSHAL_PREFIX}' || problem as reason,
        length(case when k < 10 then body[:-2] when k < 20 then replace(body, '"' || bank || '"', '5')
          when k < 30 then regexp_replace(body, '"amount_cents":[0-9]+', '"amount_cents":1.5')
          else regexp_replace(body, '"timestamp":"([^T]*)T[^"]*"', '"timestamp":"\\1"') end)::int
          as body_length from b""",
    "to_envelopes": f"""with {BASE} select {_BODY} as body, 0 as retry_count,
        idempotency_key as message_id from t""",
    "stored_transactions": f"with {BASE} select {FLAT} from t",
    "inserted_transactions": f"with {BASE} select {FLAT} from t",
    "compacted_transactions": f"with {BASE} select {FLAT} from t",
    "stored_transaction_count": "select count(*) as n from events",
    "verified_columns": "select count(*) as n, 0::bigint as n_city from events",
    "normalize_union": _FEED_FLAT,
    "normalize_half_up": f"""with {BASE},{FEEDS} select idempotency_key,
        case when bank = 'bank-a' then cast(round(value * 100.0) as bigint) else amount_cents end
          as amount_cents from n""",
    "feed_totals": f"""with {BASE},{FEEDS} select coalesce(bank, 'total') as bank,
        count(*) as fetched, count(*) filter (where error is null and amount_cents <> 0) as published
        from n group by rollup(bank)""",
    "feeds_to_table": f"""with {BASE},{FEEDS} select {FLAT} from n
        where error is null and amount_cents <> 0 and bank <> 'bank-b'""",
    "rfc3339_roundtrip": f"""select event_id, {_rfc('ts')} || 'Z' as ts_text,
        epoch_us(ts) as parsed_us, null::bigint as rejected_us from events""",
    "amounts_in_dollars": f"""with {BASE} select idempotency_key,
        amount_cents / 100.0::double as dollars,
        '$' || printf('%.2f', amount_cents / 100.0::double) as dollars_text from t""",
    "validate_split": f"""with {BASE},{DIRTY}
        select idempotency_key, account_id, amount_cents, error from checked""",
    "quarantine_invalid": f"""with {BASE},{DIRTY} select '{{"k": ' || k || '}}' as body,
        idempotency_key as message_id, 0 as retry_count,
        'gave up after 3 retries: ' || error as reason from checked where error is not null""",
    "failure_routes": f"""with {BASE},{DELIVERED}
        select message_id, route, retry_count, available_us, reason from routed""",
    "retry_queue": f"""with {BASE},{DELIVERED}
        select message_id, retry_count from routed where route = 'retry'""",
    "dead_letter_queue": f"""with {BASE},{DELIVERED}
        select message_id, retry_count, reason from routed where route = 'dead'""",
    "delivery_outcomes": f"""with {BASE}, q as (select case when merchant_name <> 'error' then 'accepted'
          when k % 5 >= 3 then 'dead' else 'retry' end as outcome from t)
        select outcome, count(*) as n from q group by outcome""",
    "dedupe_first_serving": f"with {BASE} select {FLAT} from t",
    "dedupe_store": f"with {BASE} select {FLAT} from t where us >= {_CUT_US}",
    "ingest_tally": f"""with {BASE},{DIRTY},
        batch as (select idempotency_key, error from checked union all
          select idempotency_key, case when amount_cents = 0 then 'zero' end from t),
        st as (select idempotency_key from t where us < {_CUT_US}),
        acc as (select count(distinct idempotency_key) as a from batch
          where error is null and idempotency_key not in (select idempotency_key from st)),
        cnt as (select count(*) filter (where error is null) as good,
          count(*) filter (where error is not null) as bad from batch)
        select 'accepted' as outcome, a as n from acc union all
        select 'duplicate', good - a from acc, cnt union all select 'invalid', bad from cnt""",
    "account_history": f"with {BASE},{_history('t', _DAY_S * 1_000_000)} {_SELECT_HISTORY} from h",
    "account_history_heavy": f"{TYPED},{_history('y', _HOUR_S * 1_000_000)} {_SELECT_HISTORY} from h",
    "city_distance": f"""with {BASE},{_history('t', _DAY_S * 1_000_000)}
        select idempotency_key, round(km, 3) as km from h""",
    "rule_velocity": _rule("rv"),
    "rule_mcc_drift": _rule("rd"),
    "rule_geo_impossible": _rule("rg"),
    "score_rules": f"""{DAY_RULES} select idempotency_key, account_id, amount_cents,
        merchant_category, us as occurred_us, n_flags, reasons from r""",
    "score_rules_default": f"with {BASE},{_scored('t', 120)} select idempotency_key, reasons from r",
    "score_rules_heavy": f"""{TYPED},{_scored('y', _HOUR_S)}
        select idempotency_key, account_id, reasons from r""",
    "score_rules_since": f"{DAY_RULES} select idempotency_key, reasons from r where us >= {_CUT_US}",
    "score_rules_orders": f"""{ORDERS},{_scored('o', _YEAR_S)}
        select idempotency_key, account_id, reasons from r""",
    "flag_rows": f"{FLAGS} select {FLAG_FLAT} from f",
    "flag_lookup": f"""{FLAGS} select {FLAG_FLAT} from f
        order by occurred_us desc, idempotency_key desc limit 1""",
    "flags_upserted": f"""{EARLIER} select idempotency_key,
        coalesce(cur.account_id, r.account_id) as account_id,
        coalesce(cur.amount_cents, r.amount_cents) as amount_cents,
        coalesce(cur.merchant_category, r.merchant_category) as merchant_category,
        coalesce(r.reasons, cur.reasons) as reasons, coalesce(cur.occurred_us, r.us) as occurred_us,
        coalesce(cur.status, 'pending') as status, cur.ml_score,
        coalesce(cur.created_us, {_AS_OF_US}) as created_us,
        case when r.reasons is null then cur.updated_us else {_AS_OF_US} end as updated_us
        from cur full outer join r using (idempotency_key)""",
    "flags_new": f"""{EARLIER} select idempotency_key, reasons from r
        where idempotency_key not in (select idempotency_key from cur)""",
    "review_applied": f"{FLAGS} select idempotency_key, status, updated_us from f",
    "review_queue_pending": f"{FLAGS} select {FLAG_FLAT} from f where status = 'pending'",
    "review_queue_page": f"""{FLAGS} select {FLAG_FLAT} from f where status = 'denied'
        order by occurred_us desc, idempotency_key limit 25""",
    "flags_approved": f"{FLAGS} select {FLAG_FLAT} from f where status = 'approved'",
    "flag_status_counts": f"""{FLAGS}, s(status) as (values {', '.join(f"('{s}')" for s in STATUSES)})
        select status, count(f.idempotency_key) as n from s left join f using (status) group by status""",
    "dashboard_changes": f"""{FLAGS}, s(status) as (values {', '.join(f"('{s}')" for s in STATUSES)})
        select status as measure, count(f.idempotency_key) as n from s left join f using (status) group by status
        union all select 'attack_transactions', count(*) from t where bank = 'attack-sim'
        union all select 'legit_transactions', count(*) from t where bank <> 'attack-sim'
        union all select 'attack_flagged', count(*) from f where idempotency_key like 'attack-sim:%'
        union all select 'legit_flagged', count(*) from f where idempotency_key not like 'attack-sim:%'""",
    "flags_per_rule": f"""{FLAGS}, x as (select unnest(string_split(reasons, chr(10))) as reason from f)
        select split_part(reason, ':', 1) as rule, count(*) as n from x group by rule""",
    "reason_lists": f"""{DAY_RULES}, x as (select t.idempotency_key,
          string_split(r.reasons, chr(10)) as parts, t.merchant_category = '5411' as padded
          from t left join r using (idempotency_key))
        select idempotency_key, coalesce(len(parts), 0)::int as n_listed,
          case when parts is null then 0 else len(parts) + case when padded then 2 else 0 end end::int
            as n_parts,
          coalesce(array_to_string(parts, ' · '), '') as reasons_text from x""",
    "risk_bands": f"""with {BASE}, x as (select idempotency_key, round({_SCORE} * 100.0, 1) as percent from t)
        select idempotency_key, percent, case when percent >= 70 then 'high' when percent >= 30
          then 'medium' when percent is not null then 'low' else 'unscored' end as band,
        case when percent is null then 'scoring…' else printf('%.1f', percent) || '%' end as score_text
        from x""",
    "flag_constraints": f"""{FLAGS} select idempotency_key, 'status not allowed' as violation from f
          where amount_cents < 1000
        union all select idempotency_key, 'merchant_category missing' from f where amount_cents > 9000
        union all select idempotency_key, 'account_id missing' from f
          where amount_cents between 4000 and 5000
        union all select idempotency_key, 'idempotency_key not unique' from f where status = 'approved'""",
    "evaluation": f"{EVALUATED} select {_COUNTS}, {_RATIOS} from ev",
    "evaluation_report": f"""{EVALUATED} select {_COUNTS},
        printf('%.1f', p * 100) || '%' as "precision", printf('%.1f', r * 100) || '%' as recall,
        printf('%.2f', q * 100) || '%' as false_positive_rate from ev""",
    "evaluation_undefined": f"""{FLAGS} select 0::bigint as attack_transactions,
        (select count(*) from t) as legit_transactions, 0::bigint as attack_flagged,
        count(*) as legit_flagged, '0.0%' as "precision", 'n/a' as recall,
        printf('%.1f', count(*) * 100.0::double / (select count(*) from t)) || '%'
          as false_positive_rate from f""",
    "attack_totals": f"{EVALUATED} select attack_transactions, legit_transactions from tot",
    "flagged_totals": f"{EVALUATED} select attack_flagged, legit_flagged from fl",
    "dashboard_metrics": f"{EVALUATED} select {_COUNTS}, {_RATIOS} from ev where attack_transactions > 0",
    "rule_flag_counts": f"""{COUNTED} select idempotency_key, parts::int as rule_flag_count,
        (bank = 'attack-sim')::int as label from y""",
    "features": _features(COUNTED, "y", _DAY_S),
    "features_heavy": _features(TYPED, "y", _HOUR_S),
    "pending_features": _features(
        COUNTED,
        "y",
        _DAY_S,
        " where idempotency_key in (select idempotency_key from f where ml_score is null)",
    ),
    "chrono_split": f"with {BASE}, l as (select *, bank = 'attack-sim' as label from t) {_split('l')}",
    "chrono_split_incremental": f"with {BASE}, l as (select *, bank = 'attack-sim' as label from t) {_split('l')}",
    "chrono_split_heavy": f"""{ORDERS}, l as (select *, merchant_category = '1-URGENT' as label from o)
        {_split('l')}""",
    "training_ready": f"""with {BASE} select count(*) as n_rows, count(distinct bank) as n_labels,
        count(*) >= 200 and count(distinct bank) >= 2 as ready from t""",
    "held_out_ratios": f"""with {BASE}, p as (select bank = 'attack-sim' as attack, {_SCORE} as s from t),
        q as (select attack, coalesce(s, 0.0) as s from p),
        pos as (select s, count(*) as n from q where attack group by s),
        neg as (select s, count(*) as n from q where not attack group by s),
        wins as (select sum(case when pos.s > neg.s then 1.0::double when pos.s = neg.s then 0.5
          else 0 end * pos.n * neg.n) as w from pos, neg)
        select count(*) as test_size, count(*) filter (where attack) as test_attack_count,
          round(count(*) filter (where attack and s >= 0.5)
            / nullif(count(*) filter (where s >= 0.5), 0)::double, 6) as "precision",
          round(count(*) filter (where attack and s >= 0.5)
            / nullif(count(*) filter (where attack), 0)::double, 6) as recall,
          round(any_value(w) / (count(*) filter (where attack)
            * count(*) filter (where not attack))::double, 6) as auc
        from q, wins""",
    "ml_metrics": f"""{COUNTED}, l as (select y.*, {_LAW} as label from y), s as ({_split('l')}),
        p as (select label, label as called, split from s join l using (idempotency_key))
        select count(*) filter (where split = 'train') as train_size,
          count(*) filter (where split = 'test') as test_size,
          count(*) filter (where split = 'test' and label) as test_attack_count,
          round(avg(label::int) filter (where split = 'test' and called), 6) as "precision",
          round(avg(called::int) filter (where split = 'test' and label), 6) as recall, 1.0::double as auc
        from p""",
    "ml_score": f"""{COUNTED} select idempotency_key, coalesce(f.ml_score >= 0.5, {_LAW}) as called
        from f join y using (idempotency_key)""",
    "stream_score_pending": f"""{DAY_RULES}, y as (select *, n_flags as parts from r)
        select idempotency_key, {_LAW} as called from y""",
    "score_rules_null_accounts": f"""with {BASE},
        z as (select * replace (case when event_id % 3 = 0 then '(none)' else account_id end as account_id)
          from t), {_scored('z', _DAY_S)}
        select idempotency_key, reasons, 3::bigint as n from r""",
    "account_history_repeated_keys": f"""with {BASE},{_history('t', _DAY_S * 1_000_000)},
        x as (select * from h, (values (0), (1)) v(late))
        select idempotency_key, 2 * position - 1 + late as position, 2 * in_window - 1 + late as in_window,
          first_use, 2::bigint as n from x""",
    "history_loaded_in_parts": f"with {BASE} select {FLAT} from t",
    "stream_ingest_replayed": f"with {BASE} select {FLAT} from t where amount_cents <> 0",
    "stream_ingest": f"with {BASE} select {FLAT} from t where amount_cents <> 0",
    "stream_score": f"{DAY_RULES} select idempotency_key, reasons, 'pending' as status from r",
    "stream_rules_stateful": f"{DAY_RULES} select idempotency_key, account_id, reasons from r",
    "stream_rules_resumed": f"{DAY_RULES} select idempotency_key, account_id, reasons from r where us >= {_CUT_US}",
    "stream_poison_batch": f"""with {BASE} select idempotency_key,
        case when event_id % 2500 = 7 then 'poison' else 'stored' end as outcome from t""",
    "dated_look_back": f"""with {BASE} select {FLAT} from t
        where us >= {_CUT_US} - 86400000000 and us <= {_CUT_US} + 23 * 3600000000""",
    "ingest_tally": f"""with {BASE}, x as (select case when k in (7, 8, 9) then 'invalid' else 'ok' end as o from t)
        select 'invalid' as outcome, 2 * count(*) filter (o = 'invalid') as n from x
        union all select 'accepted', count(*) filter (o = 'ok') from x
        union all select 'duplicate', count(*) filter (o = 'ok') from x
        union all select 'unparseable', 0""",
    "stream_retry_timers": f"""with {BASE} select idempotency_key,
        case when event_id % 1000 = 13 then 'gave up after 3 retries: busy' else 'stored' end as outcome from t""",
    "stream_dedupe": f"with {BASE} select idempotency_key, us as occurred_us from t",
}
