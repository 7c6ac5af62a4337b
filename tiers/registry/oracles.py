"""For each named query the SQL that gives the same rows on the same tables in another engine."""

from __future__ import annotations

from tiers.registry.queries import LATER_RUN, MIDDLE, RUN_TIME, SAMPLE_TABLES
from tiers.specs import SPECS, EntitySpec

FEED_SQL = {
    "consumer": """
select case when c_custkey % 97 = 0 then null when c_custkey % 89 = 0 then 'C-' || cast(c_custkey as varchar)
            else cast(c_custkey as varchar) end as consumerid,
       case when c_custkey % 2 = 0 then 'F' else 'M' end as sex,
       c_mktsegment as ethnicity,
       cast(c_nationkey as varchar) as race,
       case when c_custkey % 41 = 0 then 'unknown' when c_custkey % 37 = 0 then null
            else cast(18 + c_custkey % 60 as varchar) end as age,
       'customer.parquet' as raw_file_name,
       timestamp '2024-01-01 00:00:00' as load_timestamp
from customer""",
    "purchase": """
select case when o_orderkey % 211 = 0 then null else cast(o_orderkey as varchar) end as purchaseid,
       case when o_orderkey % 101 = 0 then null when o_custkey % 89 = 0 then 'C-' || cast(o_custkey as varchar)
            else cast(o_custkey as varchar) end as consumerid,
       cast(cast(o_orderdate as date) as varchar) as graphed_date,
       cast(o_orderkey % 1000 as varchar) as avocado_bunch_id,
       case when o_orderkey % 53 = 0 then 'n/a' else cast(year(o_orderdate) as varchar) end as reporting_year,
       o_orderpriority as qa_process,
       cast(o_orderkey * 7 as varchar) as billing_provider_sku,
       cast(o_custkey % 25 as varchar) as grocery_store_id,
       case when o_orderkey % 29 = 0 then null else cast(o_orderkey % 11 as varchar) end as price_index,
       'orders.parquet' as raw_file_name,
       timestamp '2024-01-01 00:00:00' as load_timestamp
from orders""",
    "avocado": """
select case when l_orderkey % 103 = 0 then null when o_custkey % 89 = 0 then 'C-' || cast(o_custkey as varchar)
            else cast(o_custkey as varchar) end as consumerid,
       cast(l_orderkey as varchar) as purchaseid,
       cast(l_suppkey as varchar) as avocado_bunch_id,
       cast(l_partkey as varchar) as plu,
       case when l_orderkey % 59 = 0 then 'ripe' else cast(l_linenumber as varchar) end as ripe_index_when_picked,
       cast(cast(o_orderdate as date) as varchar) as born_date,
       cast(cast(l_shipdate as date) as varchar) as picked_date,
       cast(cast(l_shipdate as date) + cast(l_quantity as int) - 10 as varchar) as sold_date,
       'lineitem.parquet' as raw_file_name,
       l_shipdate as load_timestamp
from lineitem join orders on l_orderkey = o_orderkey""",
    "fertilizer": """
select case when l_orderkey % 107 = 0 then null else cast(l_orderkey as varchar) end as purchaseid,
       case when o_custkey % 89 = 0 then 'C-' || cast(o_custkey as varchar) else cast(o_custkey as varchar) end as consumerid,
       cast(l_orderkey * 10 + l_linenumber as varchar) as fertilizerid,
       p_type as type,
       case when l_partkey % 3 = 0 then null when l_partkey % 31 = 0 then '5mg'
            when l_partkey % 37 = 0 then ' ' || cast(p_size as varchar) || '  '
            when l_partkey % 41 = 0 then cast(p_size as varchar) || '.75'
            when l_partkey % 43 = 0 then '99999999999' when l_partkey % 47 = 0 then 'NaN'
            else cast(p_size as varchar) end as mg,
       l_returnflag as frequency,
       'lineitem.parquet' as raw_file_name,
       l_shipdate as load_timestamp
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
}

# Columns of the sample tables by kind: n number, s text, o other.
SAMPLE_COLUMNS = {
    "benchmark": {"item_id": "n", "text": "s"},
    "conversations": {"conv_id": "n", "turn": "n", "role": "s", "text": "s"},
    "customer": {"c_custkey": "n", "c_name": "s", "c_nationkey": "n", "c_acctbal": "n", "c_mktsegment": "s"},
    "documents": {"doc_id": "n", "text": "s", "lang": "s", "source": "s", "n_chars": "n"},
    "embeddings": {"vec_id": "n", "embedding": "o", "label": "n"},
    "events": {"event_id": "n", "ts": "o", "user_id": "n", "event_type": "s", "value": "n", "props": "s"},
    "labels": {"doc_id": "n", "quality": "n", "toxic": "n"},
    "lineitem": {
        "l_orderkey": "n",
        "l_partkey": "n",
        "l_suppkey": "n",
        "l_linenumber": "n",
        "l_quantity": "n",
        "l_extendedprice": "n",
        "l_discount": "n",
        "l_tax": "n",
        "l_returnflag": "s",
        "l_linestatus": "s",
        "l_shipdate": "o",
    },
    "nation": {"n_nationkey": "n", "n_name": "s", "n_regionkey": "n"},
    "orders": {
        "o_orderkey": "n",
        "o_custkey": "n",
        "o_orderstatus": "s",
        "o_totalprice": "n",
        "o_orderdate": "o",
        "o_orderpriority": "s",
    },
    "pages": {"page_id": "n", "url": "s", "html": "s"},
    "part": {"p_partkey": "n", "p_name": "s", "p_brand": "s", "p_type": "s", "p_size": "n", "p_retailprice": "n"},
    "region": {"r_regionkey": "n", "r_name": "s"},
    "supplier": {"s_suppkey": "n", "s_name": "s", "s_nationkey": "n", "s_acctbal": "n"},
}

SQL_TYPES = {"string": "varchar", "int": "integer", "bigint": "bigint", "date": "date"}


def whole(text: str, kind: str) -> str:
    """Whole number in a text; a fraction is cut off, anything else is NULL."""
    t = f"trim({text})"
    return (
        f"cast(case when regexp_full_match({t}, '[+-]?[0-9]+') then try_cast({t} as {kind}) "
        rf"when regexp_full_match({t}, '[+-]?[0-9]+\.[0-9]*') "
        rf"then try_cast(regexp_extract({t}, '([+-]?[0-9]+)\.', 1) as {kind}) "
        rf"when regexp_full_match({t}, '[+-]?\.[0-9]+') then 0 end as {kind})"
    )


def typed(text: str, kind: str) -> str:
    if kind == "string":
        return text
    return f"try_cast({text} as date)" if kind == "date" else whole(text, SQL_TYPES[kind])


def columns(*names: str) -> str:
    return ", ".join(names)


STAMP = "strftime(load_timestamp, '%Y-%m-%d %H:%M:%S') as load_timestamp"
AUDIT = f"raw_file_name, {STAMP}"


def business(spec: EntitySpec) -> str:
    return columns(*spec.feed_order)


def with_feeds(body: str, *names: str, **more: str) -> str:
    """A statement over the feeds, each under the name ``bz_<feed>``, and further named steps."""
    steps = {f"bz_{name}": FEED_SQL[name] for name in (names or SPECS)} | more
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in steps.items()) + "\n" + body


def typed_columns(spec: EntitySpec) -> str:
    return columns(*[f"{typed(c.name, c.type)} as {c.name}" for c in spec.columns])


def latest(spec: EntitySpec, source: str, load_order: bool = True) -> str:
    """Latest row per key, the key typed and everything else as it arrived."""
    (key,) = spec.primary_key
    kind = next(c.type for c in spec.columns if c.name == key)
    order = ["load_timestamp desc nulls last"] if load_order else []
    order += [f"{c} asc nulls last" for c in spec.tie_breakers]
    rest = columns(*[c for c in spec.feed_order if c != key], "raw_file_name", "load_timestamp")
    return (
        f"select {key}, {rest} from (select *, row_number() over (partition by {key} order by {columns(*order)}) as rn "
        f"from (select * replace ({typed(key, kind)} as {key}) from {source}) where {key} is not null) where rn = 1"
    )


def clean(spec: EntitySpec, source: str | None = None, load_order: bool = True) -> str:
    (key,) = spec.primary_key
    values = columns(*[f"{c.name if c.name == key else typed(c.name, c.type)} as {c.name}" for c in spec.columns])
    rows = latest(spec, source or f"bz_{spec.name}", load_order)
    filled = " and ".join(f"{c} is not null" for c in spec.required)
    return (
        f"select * from (select {values}, raw_file_name, load_timestamp from ({rows})) where {filled}"
    )


def validated(spec: EntitySpec) -> str:
    parts = []
    for c in spec.columns:
        parts.append(f"{typed(c.name, c.type)} as {c.name}")
        if c.type != "string":
            parts += [f"({typed(c.name, c.type)}) is not null as {c.name}_valid", f"{c.name} as {c.name}_raw"]
    parts += ["raw_file_name", "load_timestamp", "load_timestamp is not null as load_timestamp_valid"]
    return f"select {columns(*parts)} from bz_{spec.name}"


def rejected(spec: EntitySpec) -> str:
    empty = columns(*[f"case when {c} is null then '{c}' end" for c in spec.required])
    missing = " or ".join(f"{c} is null" for c in spec.required)
    return (
        f"select *, 'missing or unreadable: ' || concat_ws(', ', {empty}) as error_reason "
        f"from ({validated(spec)}) where {missing}"
    )


def restamped(rows: str, *more: str) -> str:
    """Rows with their load time as text."""
    extra = "".join(f", {m}" for m in more)
    return f"select * replace (strftime(load_timestamp, '%Y-%m-%d %H:%M:%S') as load_timestamp){extra} from ({rows})"


def silver(load_order: bool = True) -> dict[str, str]:
    return {f"sv_{name}": clean(spec, load_order=load_order) for name, spec in SPECS.items()}


DAYS = (
    "date_diff('day', born_date, sold_date) as avocado_days_sold, "
    "date_diff('day', picked_date, sold_date) as avocado_days_picked"
)
GOLD_COLUMNS = (
    "consumer_id, sex, age, cast(avocado_days_sold as integer) as avocado_days_sold, avocado_ripe_index, "
    "cast(avocado_days_picked as integer) as avocado_days_picked, fertilizer_type"
)


def gold(avocado: str = "sv_avocado", consumer_id: str = "a.consumerid", layer: str = "sv") -> str:
    return f"""
select distinct {GOLD_COLUMNS} from (
    select {consumer_id} as consumer_id, sex, age, avocado_days_sold, ripe_index_when_picked as avocado_ripe_index,
           avocado_days_picked, type as fertilizer_type
    from (select *, {DAYS} from {avocado}) a
    left join (select p.purchaseid, p.consumerid, c.sex, c.age
               from {layer}_purchase p left join {layer}_consumer c on p.consumerid = c.consumerid) b
           on a.purchaseid = b.purchaseid and a.consumerid = b.consumerid
    left join {layer}_fertilizer f on a.purchaseid = f.purchaseid and a.consumerid = f.consumerid
    where avocado_days_sold > 0 and avocado_days_picked > 0)"""


GOLD_OUTER = f"""
select distinct {GOLD_COLUMNS} from (
    select consumerid as consumer_id, sex, age, avocado_days_sold, ripe_index_when_picked as avocado_ripe_index,
           avocado_days_picked, type as fertilizer_type
    from sv_consumer full join sv_purchase using (consumerid)
    full join (select purchaseid, consumerid, ripe_index_when_picked, {DAYS} from sv_avocado) a
         using (purchaseid, consumerid)
    full join sv_fertilizer f using (purchaseid, consumerid)
    where avocado_days_sold > 0 and avocado_days_picked > 0)"""


def texts(rows: str, *names: str) -> str:
    return f"select {columns(*[f'cast({n} as varchar) as {n}' for n in names])} from ({rows})"


GOLD_NAMES = (
    "consumer_id",
    "sex",
    "age",
    "avocado_days_sold",
    "avocado_ripe_index",
    "avocado_days_picked",
    "fertilizer_type",
)


def purchase_view() -> str:
    spec = SPECS["fertilizer"]
    order = columns(*[f"{c} asc nulls last" for c in spec.names if c != "fertilizerid"])

    def one_each(source: str) -> str:
        key = f"coalesce(cast({whole('fertilizerid', 'bigint')} as varchar), trim(fertilizerid))"
        ranked = f"select *, row_number() over (partition by {key} order by {source}{order}) as rn"
        return f"select * from ({ranked} from bz_fertilizer) where rn = 1"

    return f"""
select p.consumerid, sex, age, avocado_days_sold, avocado_ripe_index, avocado_days_picked, fertilizer_type
from (select {whole('purchaseid', 'bigint')} as purchaseid, consumerid from bz_purchase) p
left join (select consumerid, sex, {whole('age', 'integer')} as age from bz_consumer) c
       on p.consumerid = c.consumerid
left join (select {whole('purchaseid', 'bigint')} as purchaseid, consumerid, type as fertilizer_type
           from ({one_each('load_timestamp desc nulls last, ')})) f
       on p.purchaseid = f.purchaseid and p.consumerid = f.consumerid
left join (select purchaseid, consumerid, ripe_index_when_picked as avocado_ripe_index,
                  cast(date_diff('day', born_date, sold_date) as integer) as avocado_days_sold,
                  cast(date_diff('day', picked_date, sold_date) as integer) as avocado_days_picked
           from (select {typed_columns(SPECS['avocado'])} from bz_avocado)
           where picked_date > born_date and sold_date > picked_date) a
       on p.purchaseid = a.purchaseid and p.consumerid = a.consumerid
where p.purchaseid is not null and p.consumerid is not null"""


EXPLORE = """
select purchaseid, consumerid, sex, ethnicity, race, age, graphed_date, p.avocado_bunch_id, reporting_year,
       qa_process, billing_provider_sku, grocery_store_id, price_index,
       avocado_consumerid, avocado_avocado_bunch_id, plu, ripe_index_when_picked, born_date, picked_date, sold_date,
       fertilizer_consumerid, fertilizerid, type, mg, frequency
from bz_consumer c full join bz_purchase p using (consumerid)
full join (select purchaseid, consumerid as avocado_consumerid, avocado_bunch_id as avocado_avocado_bunch_id, plu,
                  ripe_index_when_picked, born_date, picked_date, sold_date from bz_avocado) a using (purchaseid)
full join (select purchaseid, consumerid as fertilizer_consumerid, fertilizerid, type, mg, frequency
           from bz_fertilizer) f using (purchaseid)"""


def is_missing(column: str, kind: str = "s") -> str:
    if kind == "o":
        return f"{column} is null"
    return f"({column} is null or coalesce(isnan(try_cast({column} as double)), false))"


SPARK_NAMES = " ".join(
    f"when '{duck}' then '{spark}'"
    for duck, spark in (
        ("BIGINT", "bigint"),
        ("INTEGER", "int"),
        ("DOUBLE", "double"),
        ("VARCHAR", "string"),
        ("DATE", "date"),
        ("TIMESTAMP", "timestamp_ntz"),
        ("TIMESTAMP WITH TIME ZONE", "timestamp"),
        ("FLOAT[]", "array<float>"),
    )
)


def profile(feed: str, source: str, kinds: dict[str, str], types: bool = True) -> str:
    rows = []
    for name, kind in kinds.items():
        number = f"try_cast({name} as double)"
        text = kind == "s"
        figures = [f"'{feed}' as feed", f"'{name}' as column_name"]
        if types:
            figures.append(f"case max(typeof({name})) {SPARK_NAMES} end as data_type")
        figures += [
            "count(*) as row_count",
            f"count({name}) as filled",
            f"count(*) filter (where {is_missing(name, kind)}) as missing",
        ]
        for figure, function in (("mean", "avg"), ("stddev", "stddev_samp"), ("number_min", "min"), ("number_max", "max")):
            value = "null" if kind == "o" else f"round({function}({number}), 6)"
            figures.append(f"cast({value} as double) as {figure}")
        figures += [
            f"{f'min({name})' if text else 'cast(null as varchar)'} as text_min",
            f"{f'max({name})' if text else 'cast(null as varchar)'} as text_max",
        ]
        rows.append(f"select {columns(*figures)} from {source}")
    return "\nunion all ".join(rows)


def profile_of_feeds() -> str:
    return "\nunion all ".join(
        profile(name, f"bz_{name}", dict.fromkeys(spec.feed_order, "s")) for name, spec in SPECS.items()
    )


def report_of_feeds() -> str:
    parts = []
    for name, spec in SPECS.items():
        source, (key,) = f"bz_{name}", spec.primary_key
        for c in spec.feed_order:
            for figure, value in (
                ("data_type", f"case max(typeof({c})) {SPARK_NAMES} end"),
                ("filled", f"cast(count({c}) as varchar)"),
                ("missing", f"cast(count(*) filter (where {is_missing(c)}) as varchar)"),
                ("text_min", f"min({c})"),
                ("text_max", f"max({c})"),
                *[
                    (figure, f"coalesce(cast(try_cast({function}(try_cast({c} as double)) as decimal(38, 6)) as varchar), case when count({c}) filter (where isnan(try_cast({c} as double))) > 0 then 'NaN' end)")
                    for figure, function in (("mean", "avg"), ("stddev", "stddev_samp"), ("number_min", "min"), ("number_max", "max"))
                ],
            ):
                parts.append(f"select '{name}' as feed, '{c}' as column_name, '{figure}' as figure, {value} as value from {source}")
        for figure, value in (
            ("row_count", f"select count(*) from {source}"),
            ("duplicate_rows", f"select count(*) - (select count(*) from (select distinct {business(spec)} from {source})) from {source}"),
            ("duplicate_keys", f"select count(*) from (select {key} from {source} group by {key} having count(*) > 1)"),
        ):
            parts.append(f"select '{name}' as feed, '*' as column_name, '{figure}' as figure, cast(({value}) as varchar) as value")
    return "\nunion all ".join(parts)


def two_deliveries(keys: tuple[str, ...]) -> tuple[str, dict[str, str]]:
    """The avocados that remain of an earlier and a later delivery, and the steps that takes."""
    spec = SPECS["avocado"]
    early = f"(select * from bz_avocado where load_timestamp < timestamp '{MIDDLE}')"
    late = f"(select * from bz_avocado where load_timestamp >= timestamp '{MIDDLE}')"
    match = " and ".join(f"o.{k} = n.{k}" for k in keys)
    rows = f"select * from new_rows union all select * from old_rows o where not exists (select 1 from new_rows n where {match})"
    return rows, {"old_rows": clean(spec, early), "new_rows": clean(spec, late)}


def upserted(keys: tuple[str, ...]) -> str:
    rows, steps = two_deliveries(keys)
    return with_feeds(restamped(rows), "avocado", **steps)


def incremental() -> str:
    rows, steps = two_deliveries(("purchaseid",))
    parts = [
        f"select '{name}' as feed, purchaseid, consumerid, plu, load_timestamp from ({part})"
        for name, part in (("silver", rows), ("rejects", rejected(SPECS["avocado"])))
    ]
    return with_feeds(restamped(" union all ".join(parts)), "avocado", **steps)


def replaced_gold() -> str:
    spec = SPECS["avocado"]
    steps = {f"sv_{name}": clean(s) for name, s in SPECS.items() if name != "avocado"}
    for part, operator in (("early", "<"), ("late", ">=")):
        source = f"(select * from bz_avocado where load_timestamp {operator} timestamp '{MIDDLE}')"
        steps[f"sv_{part}"] = clean(spec, source)
        steps[f"gold_{part}"] = gold(f"sv_{part}")
    body = "select * from gold_late union all select * from gold_early where consumer_id not in (select consumer_id from gold_late)"
    return with_feeds(body, **steps)


def gold_by_change() -> str:
    """Gold of the second state, and of the first one for consumers that have no rows any more."""
    by_load = f"load_timestamp {{}} timestamp '{MIDDLE}'"
    moved = "select * replace (case when ends_with(purchaseid, '44') then '1' else consumerid end as consumerid) from bz_avocado"
    sources = {
        "avocado": (f"from bz_avocado where {by_load.format('<')}", f"from ({moved}) where {by_load.format('>=')}"),
        "fertilizer": tuple(f"from bz_fertilizer where {by_load.format(op)}" for op in ("<", ">=")),
        "purchase": tuple(f"from bz_purchase where graphed_date {op} '{MIDDLE}'" for op in ("<", ">=")),
        "consumer": ("from (select * replace ('?' as sex) from bz_consumer)", "from bz_consumer where race in ('1', '3', '5')"),
    }
    steps = {}
    for name, (first, second) in sources.items():
        (key,) = SPECS[name].merge_key
        steps[f"one_{name}"] = clean(SPECS[name], f"(select * {first})")
        steps[f"new_{name}"] = clean(SPECS[name], f"(select * {second})")
        kept = f"select * from one_{name} where {key} not in (select {key} from new_{name})"
        steps[f"two_{name}"] = f"select * from new_{name} union all {kept}"
    steps |= {"gold_one": gold("one_avocado", layer="one"), "gold_two": gold("two_avocado", layer="two")}
    body = "select * from gold_two union all select * from gold_one where consumer_id not in (select consumer_id from gold_two)"
    return with_feeds(body, **steps)


def counted_loads() -> str:
    parts = []
    for name, spec in SPECS.items():
        for layer, figure, rows in (
            ("bronze", "rows_in", f"bz_{name}"),
            ("silver", "rows_in", f"bz_{name}"),
            ("silver", "kept", f"({clean(spec, load_order=False)})"),
            ("silver", "rejected", f"({rejected(spec)})"),
        ):
            parts.append(f"select '{name}' as feed, '{layer}' as layer, '{figure}' as figure, count(*) as row_count from {rows}")
    return with_feeds("\nunion all ".join(parts))


def all_oracles() -> dict[str, str]:
    """Query name to SQL."""
    avocado, consumer, fertilizer, purchase = (SPECS[n] for n in ("avocado", "consumer", "fertilizer", "purchase"))
    purchases = with_feeds(f"select {business(purchase)} from bz_purchase", "purchase")
    split_purchases = with_feeds(
        f"select * replace (case when graphed_date < '{MIDDLE}' then null else price_index end as price_index) "
        f"from (select {business(purchase)} from bz_purchase)",
        "purchase",
    )
    mixed = (
        "select * replace (case when length(purchaseid) % 2 = 0 then fertilizerid || '.0' else ' ' || fertilizerid end "
        f"as fertilizerid) from ({FEED_SQL['fertilizer']})"
    )
    changed = "case when ends_with(purchaseid, '250') then '{0}' else {1} end as {1}"
    hot = {
        f"bz_{name}": f"select * replace ({changed.format('250', 'purchaseid')}, {changed.format('hot', 'consumerid')}) "
        f"from ({FEED_SQL[name]})"
        for name in ("avocado", "fertilizer", "purchase")
    }
    sql = {
        "scan_csv_text": with_feeds(f"select {business(avocado)} from bz_avocado", "avocado"),
        "ingest_metadata": with_feeds(
            f"select {business(consumer)}, 'consumer' as raw_file_name, '{RUN_TIME}' as load_timestamp from bz_consumer",
            "consumer",
        ),
        "literal_metadata": with_feeds(
            f"select {business(fertilizer)}, 'fertilizer.csv' as raw_file_name, '{RUN_TIME}' as load_timestamp "
            "from bz_fertilizer",
            "fertilizer",
        ),
        "read_drops_by_header": split_purchases,
        "ingest_stream_purchase": purchases,
        "ingest_stream_evolve": split_purchases,
        "evolve_to_silver": with_feeds(
            f"select {columns(*purchase.names)} from ({clean(purchase, 'evolved')})",
            "purchase",
            evolved=f"""select * replace (
                case when graphed_date < '{MIDDLE}' then null else price_index end as price_index,
                case when graphed_date < '{MIDDLE}' then timestamp '{RUN_TIME}' else timestamp '{LATER_RUN}' end as load_timestamp)
                from bz_purchase""",
        ),
        "ingest_stream_as_found": with_feeds(f"select {business(avocado)} from bz_avocado", "avocado"),
        "ingest_stream_inferred": with_feeds(
            "select * replace ("
            + columns(
                *[f"cast({c} as integer) as {c}" for c in ("purchaseid", "avocado_bunch_id", "plu")],
                *[f"cast({c} as date) as {c}" for c in ("born_date", "picked_date", "sold_date")],
            )
            + f") from (select {business(avocado)} from bz_avocado)",
            "avocado",
        ),
        "ingest_stream_drift": split_purchases,
        "normalize_names": with_feeds(
            f"select {business(purchase)}, regexp_replace(qa_process, '[^a-zA-Z0-9]', '_', 'g') as qa_identifier "
            "from bz_purchase",
            "purchase",
        ),
        "trim_or_keep": with_feeds(
            "select "
            + columns(
                *[f"coalesce(cast({whole(c, 'bigint')} as varchar), trim({c})) as {c}" for c in ("consumerid", "sex", "age")]
            )
            + " from (select '  ' || consumerid || ' ' as consumerid, '  ' || sex || ' ' as sex, "
            "'  ' || age || ' ' as age from bz_consumer)",
            "consumer",
        ),
        "profile_counts_nulls": with_feeds(
            "\nunion all ".join(
                f"select '{name}' as feed, count(*) as row_count, '{c}' as column_name, "
                f"count(*) filter (where {is_missing(c)}) as missing from bz_{name}"
                for name, spec in SPECS.items()
                for c in spec.feed_order
            )
        ),
        "profile_stats": with_feeds(profile_of_feeds()),
        "profile_tables": "\nunion all ".join(profile(t, t, SAMPLE_COLUMNS[t]) for t in SAMPLE_TABLES),
        "full_row_duplicates": with_feeds(
            "\nunion all ".join(
                f"select '{label}' as feed, cast(coalesce(sum(n - 1), 0) as bigint) as duplicate_rows "
                f"from (select count(*) as n from bz_{name} group by {group})"
                for label, name, group in (
                    *[(name, name, business(spec)) for name, spec in SPECS.items()],
                    ("consumer groups", "consumer", "sex, race, age"),
                )
            )
        ),
        "key_duplicates": with_feeds(
            "\nunion all ".join(
                f"select '{name}' as feed, {spec.primary_key[0]} as key, count(*) as row_count from bz_{name} "
                f"group by {spec.primary_key[0]} having count(*) > 1"
                for name, spec in SPECS.items()
            )
        ),
        "profile_all": with_feeds(report_of_feeds()),
        "date_order": with_feeds(
            f"select * exclude (ripe_index_when_picked, days_sold, days_picked), "
            "ripe_index_when_picked as avocado_ripe_index, cast(days_sold as integer) as avocado_days_sold, "
            "cast(days_picked as integer) as avocado_days_picked "
            "from (select *, date_diff('day', born_date, sold_date) as days_sold, "
            "date_diff('day', picked_date, sold_date) as days_picked "
            f"from (select {typed_columns(avocado)} from bz_avocado)) "
            "where picked_date > born_date and sold_date > picked_date",
            "avocado",
        ),
        "positive_durations": with_feeds(
            f"select * exclude (ripe_index_when_picked, days_sold, days_picked), "
            "ripe_index_when_picked as avocado_ripe_index, cast(days_sold as integer) as avocado_days_sold, "
            "cast(days_picked as integer) as avocado_days_picked "
            "from (select *, date_diff('day', born_date, sold_date) as days_sold, "
            "date_diff('day', picked_date, sold_date) as days_picked "
            f"from (select {typed_columns(avocado)} from bz_avocado)) "
            "where days_sold > 0 and days_picked > 0",
            "avocado",
        ),
        "purchase_view": with_feeds(purchase_view()),
        "purchase_view_mixed_ids": with_feeds(purchase_view(), bz_fertilizer=mixed),
        "explore_outer": with_feeds(EXPLORE),
        "purchase_view_hot_key": with_feeds(purchase_view(), **hot),
        "explore_outer_hot_key": with_feeds(
            f"select purchaseid, sex, type, plu, count(*) as row_count from ({EXPLORE}) group by all", **hot
        ),
        "gold_output": with_feeds(gold(), **silver()),
        "gold_output_numbered": with_feeds(gold(consumer_id=whole("a.consumerid", "bigint")), **silver()),
        "gold_output_outer_form": with_feeds(GOLD_OUTER, **silver()),
        "export_text": with_feeds(texts(gold(), *GOLD_NAMES), **silver()),
        "create_table": with_feeds(f"select {business(consumer)}, {AUDIT} from bz_consumer", "consumer"),
        "upsert_avocado": upserted(("purchaseid",)),
        "upsert_bucketed": upserted(("purchaseid",)),
        "upsert_widened": upserted(("purchaseid",)).replace("from old_rows o", "from (select * replace (cast(null as date) as sold_date) from old_rows) o"),
        "reject_log_widened": with_feeds(
            restamped(
                f"select * replace (case when load_timestamp < timestamp '{MIDDLE}' then null else sold_date_raw end as sold_date_raw) "
                f"from ({rejected(avocado)})"
            ),
            "avocado",
        ),
        "upsert_composite_key": upserted(("consumerid", "purchaseid")),
        "replace_by_key_gold": replaced_gold(),
        "reject_table_twice": with_feeds(restamped(rejected(fertilizer)), "fertilizer"),
        "silver_incremental": incremental(),
        "silver_late_delivery": incremental(),
        "gold_refresh_incremental": gold_by_change(),
        "gold_refresh": with_feeds(f"select *, '{LATER_RUN}' as updated_at from ({gold()})", **silver()),
        "bronze_to_gold": with_feeds(gold(), **silver(load_order=False)),
        "load_counts": counted_loads(),
    }
    # Raw files carry no load time, so only the values decide which fertilizer row of an id is kept.
    view = purchase_view().replace("load_timestamp desc nulls last, ", "")
    names = ("consumerid", *GOLD_NAMES[1:])
    sql["adhoc_output"] = with_feeds(texts(view, *names))
    for name, spec in SPECS.items():
        analysed = [c for c in spec.columns if c.name not in spec.unused_in_analysis]
        sql[f"typed_{name}"] = with_feeds(
            f"select {columns(*[f'{typed(c.name, c.type)} as {c.name}' for c in analysed])} from bz_{name}", name
        )
        sql[f"validate_{name}"] = with_feeds(restamped(validated(spec)), name)
        sql[f"latest_per_key_{name}"] = with_feeds(restamped(latest_as_text(spec)), name)
        sql[f"required_ok_{name}"] = with_feeds(restamped(clean(spec)), name)
        sql[f"rejects_{name}"] = with_feeds(restamped(rejected(spec)), name)
        sql[f"silver_refresh_{name}"] = with_feeds(restamped(clean(spec), f"'{LATER_RUN}' as updated_at"), name)
    return sql


def latest_as_text(spec: EntitySpec) -> str:
    """Latest row per key as the key was written."""
    (key,) = spec.primary_key
    order = ["load_timestamp desc nulls last"] + [f"{c} asc nulls last" for c in spec.tie_breakers]
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {key} order by {columns(*order)}) as rn "
        f"from bz_{spec.name} where {key} is not null) where rn = 1"
    )
