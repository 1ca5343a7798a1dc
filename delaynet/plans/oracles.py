"""The registered queries once more as SQL, written against the input tables.

The text runs on DuckDB. It follows the definitions, not the Spark plans: pairs
are compared one by one, ranks and labels are unrolled round by round.
"""

from __future__ import annotations

from delaynet.operators.aggregates import top_key_error
from delaynet.operators.bloom import shape

TRIALS = 50
EPSILONS = [0.01, 0.1, 0.5, 1.0, 5.0, 10.0]
WIDTHS = [10, 50, 100, 250, 500, 1000, 2000]


def md5_int(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def unit(text: str) -> str:
    return f"((('0x' || substr(md5({text}), 1, 12))::BIGINT + 0.5) / 281474976710656.0 - 0.5)"


SHIP_DAY = "strftime(l_shipdate, '%Y-%m-%d')"

FLIGHT_EXPRESSIONS = {
    "flight_id": f"concat_ws('|', sn.n_name, cn.n_name, p_brand, l_linenumber::VARCHAR, {SHIP_DAY}, l_orderkey::VARCHAR)",
    "tail_number": "l_suppkey::VARCHAR",
    "flight_number": "l_linenumber",
    "origin": "sn.n_name",
    "destination": "cn.n_name",
    "scheduled_departure": f"{SHIP_DAY} || 'T' || lpad(((l_partkey * 7 + l_linenumber) % 24)::VARCHAR, 2, '0') || ':00:00'",
    "delay_minutes": "greatest(0, l_quantity * 5 - 60)::INT",
    "delay_cause": """case when l_quantity <= 12 then 'on_time_or_no_cause'
        when l_partkey % 5 = 0 then 'carrier' when l_partkey % 5 = 1 then 'weather'
        when l_partkey % 5 = 2 then 'nas' when l_partkey % 5 = 3 then 'security' else 'late_aircraft' end""",
}


def flights(*columns: str) -> str:
    """`flights as (...)` with the asked columns and the joins they need."""
    columns = columns or tuple(FLIGHT_EXPRESSIONS)
    everything = "flight_id" in columns
    joins = "from lineitem"
    if everything or "origin" in columns:
        joins += " join supplier on l_suppkey = s_suppkey join nation sn on s_nationkey = sn.n_nationkey"
    if everything or "destination" in columns:
        joins += """ join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
            join nation cn on c_nationkey = cn.n_nationkey"""
    if everything:
        joins += " join part on l_partkey = p_partkey"
    picked = ", ".join(f"{FLIGHT_EXPRESSIONS[name]} as {name}" for name in columns)
    return f"flights as materialized (select {picked} {joins})"


RAW = """raw as materialized (select
  case when l_linenumber = 3 then strftime(l_shipdate, '%Y') || '.0' else strftime(l_shipdate, '%Y') end as "YEAR",
  month(l_shipdate)::VARCHAR as "MONTH", day(l_shipdate)::VARCHAR as "DAY_OF_MONTH",
  l_returnflag || l_linestatus as "OP_UNIQUE_CARRIER",
  case l_linenumber when 1 then '' when 2 then 'NaN' else l_orderkey::VARCHAR || '.9' end as "OP_CARRIER_FL_NUM",
  '  S' || l_suppkey::VARCHAR || ' ' as raw_origin,
  case when l_tax = 0 then '' else 'L' || l_linenumber::VARCHAR end as raw_dest,
  case when l_linenumber = 4 then ''
       when l_linenumber = 5 then ((l_partkey * 37 + l_linenumber * 13) % 2600)::VARCHAR || '.0'
       when l_linenumber = 6 then '2400'
       when l_linenumber = 7 and l_discount = 0 then 'x12'
       else ((l_partkey * 37 + l_linenumber * 13) % 2600)::VARCHAR end as "CRS_DEP_TIME",
  case l_linenumber when 2 then '' when 3 then 'NaN' else (l_quantity::INT - 10)::VARCHAR || '.5' end as "DEP_DELAY",
  round(l_discount * 100)::INT as carrier_d, round(l_tax * 100)::INT as weather_d, l_linenumber as nas_d,
  case when l_returnflag = 'R' then null else 5 end as late_d,
  l_shipdate::DATE as d, l_linenumber as ln, l_quantity::INT as q
  from lineitem)"""

# hour and minute numbers of a raw row; null when there is no readable time
RAW_TIMED = (
    RAW
    + """, timed as materialized (select *, try_cast(nullif("CRS_DEP_TIME", '') as double)::INT as hhmm from raw),
  parsed as materialized (select *,
    case when "CRS_DEP_TIME" = '' then strftime(d, '%Y-%m-%d') || 'T00:00:00'
         when hhmm is null then null
         when hhmm // 100 >= 24 then strftime(d + 1, '%Y-%m-%d') || 'T00:'
              || lpad((case when hhmm % 100 < 60 then hhmm % 100 else 0 end)::VARCHAR, 2, '0') || ':00'
         when hhmm % 100 >= 60 then null
         else strftime(d, '%Y-%m-%d') || 'T' || lpad((hhmm // 100)::VARCHAR, 2, '0') || ':'
              || lpad((hhmm % 100)::VARCHAR, 2, '0') || ':00' end as scheduled_departure,
    case when ln in (1, 2) then 0 else trunc(replace("OP_CARRIER_FL_NUM", '.9', '')::DOUBLE)::INT end as flight_number,
    case when ln in (2, 3) then 0
         else greatest(0, (case when q - 10 < 0 then 0
                                when (q - 10) % 2 = 0 then q - 10 else q - 9 end)) end as delay_minutes,
    case when greatest(carrier_d, weather_d, nas_d, coalesce(late_d, 0)) <= 0 then 'on_time_or_no_cause'
         when carrier_d >= greatest(weather_d, nas_d, coalesce(late_d, 0)) then 'carrier'
         when weather_d >= greatest(nas_d, coalesce(late_d, 0)) then 'weather'
         when nas_d >= coalesce(late_d, 0) then 'nas'
         else 'late_aircraft' end as delay_cause,
    trim(raw_origin) as origin, raw_dest as destination
    from timed),
  normal as materialized (select
    origin || '|' || destination || '|' || "OP_UNIQUE_CARRIER" || '|' || flight_number::VARCHAR || '|'
      || "YEAR" || '-' || "MONTH" || '-' || "DAY_OF_MONTH" || '|'
      || case when "CRS_DEP_TIME" = '' then '' else hhmm::VARCHAR end as flight_id,
    '' as tail_number, flight_number, origin, destination, scheduled_departure, delay_minutes, delay_cause,
    "OP_UNIQUE_CARRIER" as carrier, scheduled_departure is null as rejected, "YEAR", "MONTH", "DAY_OF_MONTH",
    "CRS_DEP_TIME", "DEP_DELAY" from parsed)"""
)

EDGES = flights("origin", "destination", "delay_minutes") + """, edges as materialized (
  select origin, destination, sum(delay_minutes)::BIGINT as weight from flights group by all)"""
ROUTE_LINKS = "links as materialized (select origin as src, destination as dst, weight::DOUBLE as amount from edges)"
PLAIN_LINKS = "links as materialized (select origin as src, destination as dst, 1.0::DOUBLE as amount from edges)"
HOMES = """home as materialized (
  select 'C' || c_custkey::VARCHAR as origin, n_name as destination from customer join nation on c_nationkey = n_nationkey
  union all select 'S' || s_suppkey::VARCHAR, n_name from supplier join nation on s_nationkey = n_nationkey
  union all select n_name, r_name from nation join region on n_regionkey = r_regionkey)"""
TRADE = """edges as materialized (
  select case when l_returnflag = 'R' then 'S' || l_suppkey::VARCHAR else 'C' || o_custkey::VARCHAR end as origin,
         case when l_returnflag = 'R' then 'C' || o_custkey::VARCHAR else 'S' || l_suppkey::VARCHAR end as destination,
         sum(l_quantity)::BIGINT as weight
  from lineitem join orders on l_orderkey = o_orderkey group by all)"""


def ranks(iterations: int = 10) -> str:
    """From `links(src, dst, amount)` to `ranks(airport, pagerank)`."""
    parts = [
        """ids as materialized (select src as id from links union select dst from links),
        sends as materialized (select src, dst, amount / sum(amount) over (partition by src) as share from links),
        r0 as materialized (select id, 1.0::DOUBLE as rank from ids)"""
    ]
    for i in range(iterations):
        parts.append(
            f"""r{i + 1} as materialized (select ids.id, 0.15 + 0.85 * coalesce(sum(s.share * p.rank), 0) as rank
            from ids left join (sends s join r{i} p on p.id = s.src) on s.dst = ids.id group by ids.id)"""
        )
    parts.append(
        f"""ranks as materialized (select id as airport,
        round(rank * (select count(*) / sum(rank) from r{iterations}), 6) as pagerank from r{iterations})"""
    )
    return ",\n".join(parts)


def components(rounds: int = 12) -> str:
    """From `pairs(a, b)` to `components(airport, component_id)` by spreading the smallest label."""
    parts = [
        """ways as materialized (select a, b from pairs union select b, a from pairs),
        l0 as materialized (select distinct a as id, a as label from ways)"""
    ]
    for i in range(rounds):
        parts.append(
            f"""l{i + 1} as materialized (select id, min(label) as label from (
            select id, label from l{i} union all
            select w.b, l.label from ways w join l{i} l on l.id = w.a) group by id)"""
        )
    parts.append(f"components as materialized (select id as airport, label as component_id from l{rounds})")
    return ",\n".join(parts)


ROUTE_RANKS = f"{EDGES}, {ROUTE_LINKS}, {ranks()}"
REGIONS = "regions as (select n_name as airport, r_name as region from nation join region on n_regionkey = r_regionkey)"
HOME_COMPONENTS = f"{HOMES}, pairs as materialized (select origin as a, destination as b from home), {components()}"
VOLUMES = """volumes as materialized (select n_name as airport, count(*) as n from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name)"""
RANKINGS = f"""{ROUTE_RANKS}, {VOLUMES},
  ours as materialized (select row_number() over (order by pagerank desc, airport) as rank, airport as key from ranks),
  theirs as materialized (select row_number() over (order by n desc, airport) as rank, airport as key from volumes)"""


def bags(bucket: int) -> str:
    token = f"'b' || ((delay_minutes // {bucket}) * {bucket})::VARCHAR || '|' || delay_cause"
    return (
        flights("origin", "destination", "delay_minutes", "delay_cause")
        + f""", tokens as materialized (select distinct origin || '|' || destination as group_id, {token} as token from flights),
        sizes as materialized (select group_id, count(*) as size, string_agg(token, ',' order by token) as spelled,
          {", ".join(f"min({md5_int(f"'{i}|' || token")}) as h{i}" for i in range(3))}
          from tokens group by group_id)"""
    )


def group_pairs(bucket: int) -> str:
    """All unordered group pairs that share a token, with distance and MinHash agreement."""
    return (
        bags(bucket)
        + """, shared as materialized (select x.group_id as a, y.group_id as b, count(*) as n
          from tokens x join tokens y on x.token = y.token and x.group_id < y.group_id group by all),
        measured as materialized (select a, b, 1.0 - n::DOUBLE / (x.size + y.size - n) as distance,
          x.h0 = y.h0 as t0, x.h1 = y.h1 as t1, x.h2 = y.h2 as t2, x.spelled = y.spelled as same
          from shared join sizes x on x.group_id = a join sizes y on y.group_id = b)"""
    )


def profile_pairs(condition: str) -> str:
    """Group pairs folded into pairs of profiles; equal groups become one pair with themselves."""
    return f"""with {group_pairs(15)},
      profiles as materialized (select spelled, min(group_id) as profile, count(*) as members from sizes group by spelled),
      lookup as materialized (select group_id, profile, members from sizes join profiles using (spelled))
      select least(x.profile, y.profile) as profile_a, greatest(x.profile, y.profile) as profile_b,
        any_value(case when x.profile <= y.profile then x.members else y.members end) as members_a,
        any_value(case when x.profile <= y.profile then y.members else x.members end) as members_b,
        round(any_value(distance), 6) as jaccard_distance
      from measured join lookup x on x.group_id = a join lookup y on y.group_id = b
      where {condition} group by 1, 2"""


LAPLACE = "(-({scale}) * sign({u}) * ln(1.0 - 2.0 * abs({u})))"


def noise(scale: str, u: str) -> str:
    return LAPLACE.format(scale=scale, u=u)


ORIGIN_COUNTS = "counts as materialized (select n_name as origin, count(*) as n from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by n_name)"
DRAWS = f"""draws as materialized (select origin, n, trial, {unit("origin || '|' || trial::VARCHAR")} as u
  from counts, range(0, {TRIALS}) t(trial))"""
BUDGETS = "budgets as (select unnest([" + ", ".join(f"{e}::DOUBLE" for e in EPSILONS) + "]) as epsilon)"


def hll_registers(item: str, source: str, p: int) -> str:
    return f"""registers as materialized (select h & {(1 << p) - 1} as register,
      max(case when (h >> {p}) = 0 then {61 - p} else {61 - p} - length(ltrim(bin(h >> {p}), '0')) end) as rho
      from (select {md5_int(item)} as h from {source}) group by 1)"""


def hll_estimate(p: int) -> str:
    m = 1 << p
    alpha = 0.7213 / (1 + 1.079 / m)
    return f"""estimated as (select case when raw <= {2.5 * m} and empty > 0 then {m}.0 * ln({m}.0 / empty) else raw end as estimate
      from (select {alpha}::DOUBLE * {m * m}::DOUBLE / (sum(pow(2.0, -rho)) + {m} - count(*)) as raw, {m} - count(*) as empty from registers))"""


def cms(counts: str, key: str, widths: list[int], depth: int = 5) -> str:
    """`cells` and `estimates(key, width, estimate)` from a (key, n) relation."""
    return f"""hashed as materialized (select {key} as key, n, i as depth_row, {md5_int(f"i::VARCHAR || '|' || {key}")} as h
      from {counts}, range(0, {depth}) r(i)),
    placed as materialized (select key, n, depth_row, width, h % width as bucket
      from hashed, (select unnest({widths}) as width)),
    cells as materialized (select width, depth_row, bucket, sum(n)::BIGINT as n from placed group by all),
    estimates as materialized (select p.key, width, min(c.n) as estimate from placed p join cells c using (width, depth_row, bucket) group by all)"""


BLOOM_PER_ITEM, BLOOM_HASHES = shape(0.01)


def bloom_blocks(source: str) -> str:
    """Blocks of 512 bits of a filter for all rows of a source."""
    return f"(select greatest(1, (count(*) * {BLOOM_PER_ITEM} + 511) // 512) from {source})"


def _bloom_bit(blocks: str) -> str:
    """Number of the i-th bit of an item."""
    block, address = md5_int("'0|' || item"), md5_int("(1 + i // 6)::VARCHAR || '|' || item")
    return f"({block} % {blocks}) * 512 + (({address} >> (9 * (i % 6))::INTEGER) & 511)"


def bloom_bits(item: str, source: str, blocks: str, name: str = "bits") -> str:
    return f"""{name} as materialized (select distinct {_bloom_bit(blocks)} as bit
      from (select {item} from {source}) s(item), range(0, {BLOOM_HASHES}) r(i))"""


def bloom_hits(item: str, source: str, blocks: str, bits: str = "bits") -> str:
    return f"""select item, count(bit) = {BLOOM_HASHES} as maybe_seen from (
      select item, i, {_bloom_bit(blocks)} as asked
      from (select distinct {item} from {source}) s(item), range(0, {BLOOM_HASHES}) r(i)) left join {bits} on bit = asked group by item"""


TAIL_COUNTS = "counts as materialized (select l_suppkey::VARCHAR as tail_number, count(*) as n from lineitem group by 1)"

GAPPY = flights("origin", "destination", "scheduled_departure", "delay_minutes", "delay_cause") + """, gappy as (select
  case when origin = destination then null else origin end as origin, destination,
  case when scheduled_departure[12:13] = '00' and delay_cause = 'nas' then null else delay_minutes end as delay_minutes,
  case when delay_cause <> 'on_time_or_no_cause' then delay_cause end as delay_cause from flights)"""

BLOCK = """case when hour < 4 then 'Late Night (00-04)' when hour < 8 then 'Early Morning (04-08)'
  when hour < 12 then 'Morning (08-12)' when hour < 16 then 'Afternoon (12-16)'
  when hour < 20 then 'Evening (16-20)' else 'Night (20-24)' end"""
BIN = "((delay_minutes // 15) * 15)::VARCHAR || '-' || ((delay_minutes // 15) * 15 + 15)::VARCHAR || ' min'"
HOUR = "scheduled_departure[12:13]::INT"
GENERALIZED = flights() + f""", general as materialized (select flight_id, origin, destination, {BLOCK} as time_block,
  {BIN} as delay_bin, delay_cause from (select *, {HOUR} as hour from flights))"""

SENT = """sent as materialized (select l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR as flight_id, l_linenumber as flight_number,
  case when o_orderpriority = '5-LOW' and year(l_shipdate) % 2 = 0 then null else o_orderpriority end as origin,
  o_orderstatus as destination, (floor(o_totalprice)::BIGINT % 300)::INT as delay_minutes, l_discount = 0 as cut, strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00' as departure
  from lineitem join orders on l_orderkey = o_orderkey)"""

LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag"
BUYERS = "events where event_type = 'purchase'"
KEPT_LINES = "lineitem where l_returnflag <> 'R'"
LINE_ID = "l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR"
K = "json_extract_string(props, '$.k')::INT"


ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_parquet": "select event_id, user_id, event_type, value from events where value > 50",
    "json_decode": f"select event_id, {K} as k from events",
    "json_encode": "select event_id, user_id, event_type, value from events",
    "quarantine": "select event_id as source_id, event_type = 'error' as quarantined from events",
    "keyed_messages": f"with {flights()} select 'flight-' || flight_id as key, origin, delay_minutes from flights",
    "csv_quarantine": """with lines as (select l_returnflag || l_linestatus as carrier, l_tax = 0 as cut,
        l_tax <> 0 and l_linenumber = 7 and l_discount = 0 as surplus from lineitem)
      select case when cut or surplus then 'aside' else 'record' end as kind, carrier as "OP_UNIQUE_CARRIER", count(*) as n,
        count(*) filter (surplus) as surplus from lines group by 1, 2""",
    "heavy_hitters": f"""with keyed as (select l_returnflag as span,
        case when l_partkey % 10 < 3 then 'H' || (l_partkey % 5) else l_partkey::VARCHAR end as key from lineitem),
      every as (select * from keyed union all select 'all', key from keyed),
      counts as (select span, key, count(*) as exact from every group by 1, 2)
      select span, key, exact, true as listed_within_error from counts where exact > 2 * {top_key_error(512)}::DOUBLE *
        (select count(*) from every where every.span = counts.span)""",
    "hll_ranges": """with firsts as (select l_orderkey, min(year(l_shipdate)) as y from lineitem group by 1),
      years as (select distinct year(l_shipdate)::INTEGER as until from lineitem)
      select until, count(*) as exact, true as within_three_errors from years join firsts on y <= until group by until""",
    "csv_scan": f"""with {RAW_TIMED} select "YEAR", carrier as "OP_UNIQUE_CARRIER", count(*) as n, sum(flight_number)::BIGINT as number_sum,
      count(*) filter (destination = '') as blank_dest, count(*) filter ("CRS_DEP_TIME" = '') as blank_time
      from normal group by 1, 2""",
    "multi_file_scan": "select month(l_shipdate)::INT as file_month, count(*) as n, count(*) as matching from lineitem group by 1",
    "curated_sink": f"""with {flights()} select origin, delay_cause, count(*) as n, sum(delay_minutes)::BIGINT as minutes
      from flights group by 1, 2""",
    "result_sink": f"""with {EDGES}, {HOME_COMPONENTS}
      select 'edges' as name, origin || '-' || destination as key, weight::VARCHAR as value from edges
      union all select 'components', airport, component_id from components
      union all select 'component_sizes', component_id, count(*)::VARCHAR from components group by component_id""",
    "report_sink": f"""with {flights("flight_id", "origin", "delay_minutes")} select origin, split_part(flight_id, '|', 3) as carrier,
      count(*) as flight_count, round(avg(delay_minutes), 6) as avg_delay from flights group by 1, 2
      order by flight_count desc, origin, carrier limit 50""",
    "map_export": f"""with {ROUTE_RANKS}, {HOME_COMPONENTS}
      select airport, pagerank, component_id, n_nationkey * 3.0::DOUBLE - 30 as lat, n_nationkey * 5.0::DOUBLE - 60 as lng
      from ranks join components using (airport) join nation on n_name = airport where lat <> 0 or lng <> 0""",
    "log_metrics": f"""select strftime(ts, '%Y-%m-%d') || '#' || event_id as source, event_id::DOUBLE as records, value as throughput, user_id::DOUBLE as etl_seconds,
      round({K} * case event_type when 'error' then 1.0 / 1024 when 'click' then 1024.0 else 1.0 end::DOUBLE, 6) as parquet_mb
      from events""",
    "log_sweeps": f"""with days as (select *, strftime(ts, '%Y-%m-%d') as day from events),
      marks as (select day, min(event_id) as start from days where event_type = 'error' group by 1)
      select day as source, count(*) as n, sum({K})::DOUBLE as parameters, round(sum(value), 6) as errors
      from days join marks using (day) where event_id > start and event_type <> 'error' group by 1""",
    # rows and scalars
    "normalize_row": f"""with {RAW_TIMED} select flight_id, tail_number, flight_number, origin, destination, scheduled_departure,
      delay_minutes, delay_cause, carrier, rejected from normal""",
    "hhmm_to_iso": f"""with {RAW_TIMED} select distinct "YEAR", "MONTH", "DAY_OF_MONTH", "CRS_DEP_TIME", scheduled_departure from normal""",
    "delay_cause_argmax": f"""with {RAW_TIMED} select carrier as "OP_UNIQUE_CARRIER", delay_cause, count(*) as n from normal group by 1, 2""",
    "composite_id": f"with {RAW_TIMED} select flight_id, count(*) as n from normal group by 1",
    "clamp_round": f"""with {RAW_TIMED} select "DEP_DELAY", delay_minutes, count(*) as n from normal group by 1, 2""",
    "delay_tokens": f"""with {flights("delay_minutes", "delay_cause")}
      select 'b' || ((delay_minutes // 5) * 5)::VARCHAR || '|' || delay_cause as token, count(*) as n from flights group by 1""",
    "token_vocabulary": f"""with {flights("delay_minutes", "delay_cause")}
      select 'b' || ((delay_minutes // 5) * 5)::VARCHAR || '|' || delay_cause as token, count(*) as n from flights group by 1
      order by n desc, token limit 5000""",
    "hour_of_day": f"""with {flights("scheduled_departure")} select {HOUR} as hour, count(*) as n from flights group by 1""",
    "time_block": f"""with {flights("scheduled_departure")} select hour, {BLOCK} as time_block, count(*) as n
      from (select {HOUR} as hour from flights) group by 1, 2""",
    "delay_bin": f"""with {flights("delay_minutes")} select delay_minutes, {BIN} as delay_bin, count(*) as n from flights group by 1, 2""",
    "generalize": f"with {GENERALIZED} select * from general",
    "split_carrier": f"""with {flights("flight_id")} select split_part(flight_id, '|', 3) as carrier, count(*) as n from flights group by 1""",
    # filters and samples
    "clean_rows": f"""with {GAPPY} select origin, coalesce(delay_cause, 'UNKNOWN') as delay_cause, count(*) as n from gappy
      where origin is not null and destination is not null and delay_minutes is not null group by 1, 2""",
    "drop_unrouted": f"with {GAPPY} select origin, count(*) as n from gappy where origin is not null and destination is not null group by 1",
    "hash_sample": f"""select event_id, user_id from events where {md5_int("'0|' || event_id::VARCHAR")} % 1000 < 100""",
    "limit_n": "select event_id, user_id, value from events order by value desc, event_id limit 100",
    "uniform_n": f"""select event_id, user_id from events order by {md5_int("'0|' || event_id::VARCHAR")}, event_id::VARCHAR limit 100""",
    # joins and deduplication
    "semi_join_ids": f"""select {LINE} from lineitem where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT')""",
    "anti_join_seen": f"""select {LINE} from lineitem x where l_returnflag = 'R' and not exists (select 1 from lineitem y
      where y.l_returnflag <> 'R' and y.l_orderkey = x.l_orderkey and y.l_linenumber = x.l_linenumber)""",
    "dedup_batch": "select distinct l_orderkey, l_linenumber from lineitem",
    "dedup_keep_first": f"""select {LINE} from (select *, row_number() over (partition by l_orderkey, l_linenumber
      order by l_partkey, l_suppkey, l_quantity, l_returnflag) as place from lineitem) where place = 1""",
    "dedup_audit": """with ids as (select year(l_shipdate)::INT as batch, l_orderkey, l_linenumber, count(*) as n from lineitem group by all),
      marked as (select *, row_number() over (partition by l_orderkey, l_linenumber order by batch) as visit from ids)
      select batch, sum(n)::BIGINT as rows, count(*) as total, count(*) filter (visit = 1) as accepted,
        count(*) filter (visit > 1) as dupes from marked group by batch""",
    "rank_side_by_side": f"""with {RANKINGS} select rank, coalesce(x.key, 'N/A') as ours, coalesce(y.key, 'N/A') as theirs
      from (select * from ours where rank <= 20) x full join (select * from theirs where rank <= 30) y using (rank)""",
    # aggregates
    "row_count": f"with {flights('flight_id')} select count(*) as n from flights",
    "counts_by_origin": f"with {ORIGIN_COUNTS} select origin, n from counts",
    "route_edges": f"with {EDGES} select * from edges",
    "hub_attribution": f"""with {flights("flight_id", "origin", "delay_minutes")} select origin, split_part(flight_id, '|', 3) as carrier,
      count(*) as flight_count, round(avg(delay_minutes), 6) as avg_delay from flights group by 1, 2
      order by flight_count desc, origin, carrier limit 50""",
    "fairness": f"""with {flights("flight_id", "delay_minutes")} select
      case when split_part(flight_id, '|', 3) in ('Brand#1', 'Brand#11', 'Brand#12', 'Brand#13', 'Brand#14', 'Brand#15')
        then 'Major/Legacy' else 'Regional/Low-Cost' end as carrier_type,
      round(avg(delay_minutes), 6) as mean_delay_minutes, count(*) as sample_size from flights group by 1""",
    "distinct_routes": f"with {flights('origin', 'destination')} select distinct origin || '-' || destination as route from flights",
    "top_keys": f"with {TAIL_COUNTS} select tail_number, n from counts order by n desc, tail_number limit 100",
    # sketches
    "hll_registers": f"""with {flights("origin", "destination")}, {hll_registers("origin || '-' || destination", "flights", 12)}
      select register, rho from registers""",
    "hll_estimate": f"""with {hll_registers("l_orderkey::VARCHAR", "lineitem", 10)}, {hll_estimate(10)}
      select round(estimate, 6) as estimate from estimated""",
    "hll_merge": f"""with {hll_registers("l_partkey::VARCHAR", "lineitem", 12)}, {hll_estimate(12)}
      select round(estimate, 6) as estimate from estimated""",
    "hll_vs_exact": f"""with {flights("origin", "destination")}, {hll_registers("origin || '-' || destination", "flights", 12)}, {hll_estimate(12)}
      select exact, round(estimate, 6) as estimate, round(abs(exact - estimate) * 100.0 / exact, 6) as error_pct
      from estimated, (select count(distinct origin || '-' || destination) as exact from flights)""",
    "approx_distinct": "select count(distinct l_orderkey) as exact, true as builtin_ok, true as sketch_ok from lineitem",
    "cms_table": f"""with {TAIL_COUNTS}, {cms("counts", "tail_number", [50])} select width, depth_row, bucket, n from cells""",
    "cms_estimate": f"""with {TAIL_COUNTS}, {cms("counts", "tail_number", [50])} select key as tail_number, estimate from estimates""",
    "cms_vs_exact": f"""with {TAIL_COUNTS}, {cms("counts", "tail_number", [50])}
      select tail_number, n as exact, estimate, estimate - n as error
      from (select * from counts order by n desc, tail_number limit 5) join estimates on key = tail_number""",
    "cms_width_sweep": f"""with {TAIL_COUNTS}, {cms("counts", "tail_number", WIDTHS)}
      select width, (width * 20)::INT as bytes, round(avg(abs(estimate - n)), 6) as mae, round(width * 20 / 1024.0::DOUBLE, 6) as kilobytes
      from (select * from counts order by n desc, tail_number limit 100) join estimates on key = tail_number group by width""",
    "bloom_bits": f"with {bloom_bits('user_id::VARCHAR', 'events', bloom_blocks('(select distinct user_id from events)'))} select bit from bits",
    "bloom_probe": f"""with asked as (select distinct user_id from events union all select distinct user_id + 1000000000 from events),
      {bloom_bits('user_id::VARCHAR', BUYERS, bloom_blocks(BUYERS))},
      hits as ({bloom_hits('user_id::VARCHAR', 'asked', bloom_blocks(BUYERS))})
      select asked.user_id, coalesce(added, false) as added, maybe_seen from asked join hits on item = asked.user_id::VARCHAR
      left join (select user_id, bool_or(event_type = 'purchase') as added from events group by user_id) e on e.user_id = asked.user_id""",
    "bloom_dedup": f"""with {bloom_bits(LINE_ID, KEPT_LINES, bloom_blocks(KEPT_LINES))}
      select item as record_id, not maybe_seen as accepted from ({bloom_hits(LINE_ID, "lineitem where l_returnflag = 'R'", bloom_blocks(KEPT_LINES))})""",
    "sketch_scorecard": f"""with counts as materialized (select l_partkey::VARCHAR as k, count(*) as n from lineitem group by 1),
      {hll_registers("k", "counts", 12)}, {hll_estimate(12)}, {cms("counts", "k", [1000])}, {bloom_bits("k", "counts", bloom_blocks("counts"))},
      hits as ({bloom_hits("'X' || p_partkey::VARCHAR", "part", bloom_blocks("counts"))})
      select 'hyperloglog' as sketch, 4096::BIGINT as bytes,
        round(100.0 - abs((select count(*) from counts) - estimate) * 100.0 / (select count(*) from counts), 6) as accuracy_pct from estimated
      union all select 'count_min', 20000, round(100.0 - avg(abs(estimate - n) / n::DOUBLE) * 100, 6) from counts join estimates on key = k
      union all select 'bloom', {bloom_blocks('counts')} * 64, round(avg((not maybe_seen)::INT) * 100, 6) from hits""",
    # graph
    "graph_vertices": f"with {EDGES} select origin as airport from edges union select destination from edges",
    "graph_stats": f"""with {TRADE} select
      (select count(*) from (select origin from edges union select destination from edges)) as vertices, (select count(*) from edges) as edges""",
    "pagerank": f"with {HOMES}, edges as (from home), {PLAIN_LINKS}, {ranks()} select * from ranks",
    "pagerank_weighted": f"""with {EDGES}, links as materialized (select origin as src, destination as dst, weight::DOUBLE as amount from edges),
      {ranks()} select * from ranks""",
    "pagerank_trade": f"""with {TRADE}, links as materialized (select origin as src, destination as dst, 1.0::DOUBLE as amount from edges),
      {ranks()} select * from ranks""",
    "top_hubs": f"with {TRADE}, {PLAIN_LINKS}, {ranks()} select * from ranks order by pagerank desc, airport limit 20",
    "connected_components": f"with {HOME_COMPONENTS} select * from components",
    "components_trade": f"with {TRADE}, pairs as materialized (select origin as a, destination as b from edges), {components()} select * from components",
    "component_sizes": f"with {HOME_COMPONENTS} select component_id, count(*) as size from components group by 1",
    # similarity
    "token_bags": f"with {bags(5)} select group_id, spelled as tokens from sizes",
    "minhash_signatures": f"with {bags(15)} select group_id, h0, h1, h2 from sizes",
    "lsh_candidates": f"""with {bags(15)}, buckets as (select 0 as t, h0 as h from sizes union all select 1, h1 from sizes
      union all select 2, h2 from sizes)
      select t as "table", h as minhash, count(*) as groups, (count(*) * (count(*) - 1)) // 2 as pairs from buckets group by 1, 2""",
    "lsh_similarity_join": profile_pairs("distance < 0.3 and (t0 or t1 or t2)"),
    "exact_jaccard_join": profile_pairs("distance < 0.3"),
    "similar_routes": f"""with {group_pairs(15)} select a as group_a, b as group_b, round(distance, 3) as jaccard_distance
      from measured where distance < 0.85 and (t0 or t1 or t2) order by 3, 1, 2 limit 10""",
    "similar_routes_directed": f"""with {group_pairs(15)}, close as (select a, b, round(distance, 6) as distance from measured
      where distance < 0.3 and (t0 or t1 or t2))
      select group_a, group_b, jaccard_distance from (select a as group_a, b as group_b, distance as jaccard_distance from close
      union all select b, a, distance from close) order by 3, 1, 2 limit 100""",
    "lsh_quality": f"""with {group_pairs(15)}, every as (select x.h0 = y.h0 as t0, x.h1 = y.h1 as t1, x.h2 = y.h2 as t2
        from sizes x join sizes y on x.group_id < y.group_id),
      steps as (select unnest([1, 2, 3]) as tables),
      cand as (select tables, count(*) as candidates from steps, every
        where t0 or (tables >= 2 and t1) or (tables >= 3 and t2) group by 1),
      hit as (select tables, count(*) as true_pairs, count(*) filter (t0 or (tables >= 2 and t1) or (tables >= 3 and t2)) as hits
        from steps, measured where distance < 0.3 group by 1),
      points as (select tables, candidates, coalesce(true_pairs, 0) as true_pairs, coalesce(hits, 0) as hits,
        coalesce(hits, 0) / candidates::DOUBLE as precision, hits / true_pairs::DOUBLE as recall
        from cand left join hit using (tables)),
      gaps as (select (recall - lag(recall) over (order by recall, precision)) * (precision + lag(precision) over (order by recall, precision)) / 2 as piece
        from points)
      select tables, candidates, true_pairs, hits, round(precision, 6) as precision, round(recall, 6) as recall,
        (select round(coalesce(sum(piece), 0), 6) from gaps) as pr_auc from points""",
    "lsh_recall_sample": f"""with {group_pairs(15)}, steps as (select unnest([1, 2, 3]) as tables),
      profiles as materialized (select spelled, min(group_id) as profile, count(*) as members, any_value(size) as size from sizes group by spelled),
      placed as (select profile, a, b, count(*) over (partition by a, b) as total,
        row_number() over (partition by a, b order by {md5_int("'0|' || profile")}, profile) as place
        from (select *, floor(log2(members)) as a, floor(log2(size)) as b from profiles)),
      sample as materialized (select * from placed where place <= 200),
      lookup as materialized (select group_id, profile from sizes join profiles using (spelled)),
      ends as materialized (select profile, t0, t1, t2 from (select a as group_id, t0, t1, t2 from measured where distance < 0.3 and not same
        union all select b, t0, t1, t2 from measured where distance < 0.3 and not same) join lookup using (group_id)),
      per as (select sample.profile, a, b, total, tables, count(ends.profile) as x,
        count(*) filter (ends.profile is not null and (t0 or (tables >= 2 and t1) or (tables >= 3 and t2))) as y
        from sample cross join steps left join ends on ends.profile = sample.profile group by 1, 2, 3, 4, 5),
      inside as (select sum(members * (members - 1) // 2) as n from profiles),
      totals as materialized (select tables, sum(share) as profiles, sum(drawn) as sampled, sum(share * mx) / 2 + any_value(n) as true_pairs,
        sum(share * my) / 2 + any_value(n) as hits
        from (select tables, a, b, any_value(total) as share, count(*) as drawn, avg(x) as mx, avg(y) as my from per group by 1, 2, 3), inside group by 1),
      errors as (select tables, a, b, any_value(total) as share, count(*) as drawn, var_samp(y - hits / true_pairs * x) / 4 as v
        from per join totals using (tables) group by 1, 2, 3),
      spread as (select tables, 1.96 * sqrt(sum(case when share > drawn then share * (share - drawn)::DOUBLE / drawn * v else 0.0 end)) as half from errors group by 1),
      every as (select x.h0 = y.h0 as t0, x.h1 = y.h1 as t1, x.h2 = y.h2 as t2 from sizes x join sizes y on x.group_id < y.group_id),
      cand as (select tables, count(*) as candidates from steps, every where t0 or (tables >= 2 and t1) or (tables >= 3 and t2) group by 1)
      select tables, profiles::BIGINT as profiles, sampled::BIGINT as sampled, candidates, round(true_pairs, 6) as true_pairs, round(hits, 6) as hits,
        round(hits / candidates, 6) as precision, round(hits / true_pairs, 6) as recall,
        round(greatest(hits / true_pairs - half / true_pairs, 0.0), 6) as recall_low,
        round(least(hits / true_pairs + half / true_pairs, 1.0), 6) as recall_high
      from totals join spread using (tables) join cand using (tables)""",
    "similarity_clusters": f"""with {group_pairs(15)}, pairs as materialized (select a, b from measured where distance < 0.3), {components(20)}
      select group_id, coalesce(component_id, group_id) as cluster_id from sizes left join components on airport = group_id""",
    # privacy
    "laplace_noise": f"""with {ORIGIN_COUNTS}, {DRAWS} select origin, trial::INT as trial, round({noise('2.0', 'u')}, 6) as noise,
      round(n + {noise('2.0', 'u')}, 6) as released from draws""",
    "dp_counts": f"""with {ORIGIN_COUNTS}, released as (select origin, n, greatest(0.0, n + {noise('1.0 / 0.5', unit('origin'))}) as noisy from counts)
      select origin, n, round(noisy, 6) as noisy, round(abs(n - noisy), 6) as abs_error from released order by n desc, origin limit 10""",
    "dp_epsilon_sweep": f"""with {ORIGIN_COUNTS}, {DRAWS}, {BUDGETS}
      select epsilon, round(avg(abs(greatest(0.0, n + {noise('1.0 / epsilon', 'u')}) - n)), 6) as mae from draws, budgets group by epsilon""",
    "dp_leakage_audit": f"""with {ORIGIN_COUNTS}, {DRAWS}, {BUDGETS},
      guesses as (select epsilon, greatest(0.0, n + {noise('1.0 / epsilon', 'u')}) > n - 0.5 as hit,
        greatest(0.0, n - 1 + {noise('1.0 / epsilon', 'u')}) > n - 0.5 as alarm from draws, budgets)
      select epsilon, round(avg((hit and alarm)::INT), 6) as overlap,
        round(avg((hit::INT + (not alarm)::INT) / 2.0::DOUBLE), 6) as accuracy from guesses group by epsilon""",
    "k_anonymity": f"""with {GENERALIZED} select origin, destination, time_block, delay_bin, delay_cause, count(*) as n, any_value(class_size) as class_size
      from (select *, count(*) over (partition by origin, destination, time_block, delay_bin) as class_size from general)
      where class_size >= 5 group by 1, 2, 3, 4, 5""",
    "k_suppression": f"""with {GENERALIZED}, classes as (select count(*) as n from general group by origin, destination, time_block, delay_bin)
      select count(*) as classes, sum(n)::BIGINT as rows, count(*) filter (n < 5) as suppressed_classes,
        coalesce(sum(n) filter (n < 5), 0)::BIGINT as suppressed_rows from classes""",
    # rankings
    "precision_at_k": f"""with {RANKINGS}, cut as (select least(count(*), 20)::INT as k from ours),
      common as (select count(*) as n from ours join theirs using (key), cut where ours.rank <= k and theirs.rank <= k)
      select k, n as common, round(n / k::DOUBLE * 100, 6) as precision_pct from cut, common""",
    "overlap_curve": f"""with {RANKINGS}, ks as (select unnest([5, 10, 15, 20, 25, 30]) as k)
      select k, (select count(*) from ours join theirs using (key) where ours.rank <= k and theirs.rank <= k) as common,
        round((select count(*) from ours join theirs using (key) where ours.rank <= k and theirs.rank <= k) / k::DOUBLE * 100, 6) as overlap_pct
      from ks where k <= (select count(*) from ours)""",
    "ranking_overlap": f"""with {RANKINGS}, found as (select count(*) as common from ours join theirs using (key)
        where ours.rank <= 20 and theirs.rank <= 20)
      select common, round(common / 20.0::DOUBLE * 100, 6) as overlap_pct,
        case when common / 20.0 * 100 >= 70 then 'validated' else 'differs' end as verdict from found""",
    "validation_summary": f"""with {RANKINGS}, {REGIONS},
      a as (select region, airport, row_number() over (partition by region order by pagerank desc, airport) as place from ranks join regions using (airport)),
      b as (select region, airport, row_number() over (partition by region order by n desc, airport) as place from volumes join regions using (airport))
      select 'region ' || a.region as metric, round(count(b.airport) / count(*)::DOUBLE * 100, 6) as overlap_pct
      from a left join (select * from b where place <= 2) b on a.region = b.region and a.airport = b.airport where a.place <= 2 group by a.region
      union all select 'top ' || k::VARCHAR, round((select count(*) from ours join theirs using (key)
        where ours.rank <= k and theirs.rank <= k) / k::DOUBLE * 100, 6) from (select unnest([10, 20]) as k)""",
    # audits
    "data_quality": f"""with {RAW_TIMED} select count(*) as total_rows, count(distinct flight_id) as distinct_keys,
      round(100.0 * count(*) filter (flight_id is not null and scheduled_departure is not null) / count(*), 6) as compliance_pct,
      round(100.0 * (count(*) filter (flight_id is null) + 2 * count(*) filter (scheduled_departure is null)) / (count(*) * 9), 6) as null_density_pct,
      (count(*) + count(*) filter (destination = ''))::BIGINT as blank_values,
      round(100.0 * (count(*) - count(distinct flight_id)) / count(*), 6) as duplicate_pct,
      min(scheduled_departure::TIMESTAMP)::VARCHAR as first_ts, max(scheduled_departure::TIMESTAMP)::VARCHAR as last_ts,
      date_diff('second', max(scheduled_departure::TIMESTAMP), timestamp '2005-01-01') as freshness_seconds from normal""",
    "throughput_windows": """with placed as (select date_trunc('day', ts) as w, value, row_number() over (partition by date_trunc('day', ts) order by value) as place,
        count(*) over (partition by date_trunc('day', ts)) as n from events)
      select strftime(w, '%Y-%m-%d %H:%M:%S') as window_start, count(*) as records, round(count(*) / 86400.0::DOUBLE, 6) as records_per_sec,
        max(value) filter (place = greatest(1, ceil(n * 50 / 100))) as p50, max(value) filter (place = greatest(1, ceil(n * 99 / 100))) as p99
      from placed group by w""",
    "quantile_sketches": """with spans as (select unnest([{'level': 'day', 'span': strftime(ts, '%Y-%m-%d')}, {'level': 'month', 'span': strftime(ts, '%Y-%m')},
        {'level': 'all', 'span': 'all'}]) as s from events)
      select s.level as level, s.span as span, count(*) as records, true as p50_close, true as p99_close from spans group by 1, 2""",
    "tier_summary": """with days as (select date_diff('day', (select min(ts) from events)::DATE, ts::DATE) as day from events),
      volume as (select tier, count(*) as records from days, (select unnest([1, 7, 30]) as tier) where day < tier group by tier)
      select tier, records, round(records / (tier * 86400.0::DOUBLE), 6) as records_per_sec,
        round(records / (lag(records) over (order by tier))::DOUBLE, 6) as growth from volume""",
    "hub_scorecard": f"""with {ROUTE_RANKS}, {ORIGIN_COUNTS}, joined as (select airport, pagerank, coalesce(n, 0) as n
        from ranks left join counts on origin = airport),
      scored as (select *, pagerank / (select max(pagerank) from joined) as relative from joined)
      select airport, round(relative, 6) as relative_rank,
        case when relative >= 0.95 then 'CRITICAL' when relative >= 0.85 then 'HIGH' else 'MODERATE' end as band,
        round(case when n > 0 then (pagerank / (select sum(pagerank) from joined)) / (n / (select sum(n) from joined)::DOUBLE) end, 6) as amplification
      from scored""",
    # streams
    "stream_ingest": f"""with {SENT} select distinct flight_id, flight_number, origin, destination, delay_minutes from sent
      where not cut and origin is not null""",
    "stream_dedup": f"""with {SENT} select count(*) as messages, count(distinct flight_id) filter (not cut and origin is not null) as accepted,
      count(*) filter (not cut and origin is not null) - count(distinct flight_id) filter (not cut and origin is not null) as dupes,
      count(*) filter (cut) as quarantined, count(*) filter (not cut and origin is null) as unrouted from sent""",
    "stream_quarantine": f"""with {SENT} select raw, reason, count(*) as n from (
      select case when cut then '{{"flight_id":"' || flight_id else '{{"flight_id":"' || flight_id || '","tail_number":"","flight_number":' ||
        flight_number || ',"destination":"' || destination || '","scheduled_departure":"' || departure || '","delay_minutes":' ||
        delay_minutes || ',"delay_cause":"nas"}}' end as raw,
        case when cut then 'unreadable' else 'unrouted' end as reason from sent where cut or origin is null) group by all""",
    "bloom_stream": f"""with {SENT} select count(*) as messages, count(*) filter (cut) as quarantined,
      count(*) filter (not cut and origin is null) as unrouted, true as adds_up, true as all_written, true as each_id_once,
      true as within_rate, true as no_more_than_new from sent""",
}
