"""The same answers in plain SQL, to check the queries against another engine."""

from __future__ import annotations

from cartlane.testbed.model import AS_OF, EVENT_STATUS, SEED

BUCKETS = 4096


def draw(seed: str, *keys: str) -> str:
    parts = ", ".join(f"cast({k} as varchar)" for k in keys)
    return f"cast('0x' || substr(md5(concat_ws(':', {parts}, '{seed}')), 1, 15) as bigint)"


def draw_int(seed: str, low: int, high: int, *keys: str) -> str:
    return f"({draw(seed, *keys)} % {high - low + 1} + {low})"


def draw_decimal(seed: str, low: int, high: int, scale: int, *keys: str) -> str:
    """Bounds in units of the last place."""
    return f"cast(cast({draw_int(seed, low, high, *keys)} as decimal(18,0)) * cast({10 ** -scale:.{scale}f} as decimal({scale},{scale})) as decimal(18,{scale}))"


def draw_choice(seed: str, values: list[str], *keys: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{listed}], {draw_int(seed, 1, len(values), *keys)})"


def numbered(source: str, key: str, name: str, start: str = "1") -> str:
    bucket = f"{draw('number', key)} % {BUCKETS}"
    return f"(select *, row_number() over (order by {bucket}, {key}) - 1 + {start} as {name} from ({source}))"


def assign(source, row_key, choices, choice_key, columns, seed, null_slot=False, only_if="true") -> str:
    """``columns`` maps columns of ``choices`` to names, as in the Spark operator."""
    places = f"nullif((select count(*) from ({choices})) + {int(null_slot)}, 0)"
    taken = ", ".join(f"c.{c} as {alias}" for c, alias in columns.items())
    return f"""(select r.*, {taken} from ({source}) r left join {numbered(choices, choice_key, 'slot', '0')} c
        on {only_if} and c.slot = {draw(seed, f'r.{row_key}')} % {places})"""


def days(ts: str, n: str, sign: str = "+") -> str:
    return f"({ts} {sign} to_days(cast({n} as integer)))"


NOW = f"timestamp '{AS_OF}'"
HUNDREDTH = "cast(0.01 as decimal(2,2))"


def window(age: tuple[int, int], length: tuple[int, int], seed: str, key: str) -> str:
    started = days(NOW, draw_int(f"{seed}-age", *age, key), "-")
    return f"{started} as started_at, {days(started, draw_int(f'{seed}-days', *length, key))} as expired_at"


def money(text: str) -> str:
    return f"cast({text} as decimal(15,2))"


def percent_of(amount: str, percent: str) -> str:
    return f"cast({amount} as decimal(18,2)) * cast({percent} as decimal(15,2)) * {HUNDREDTH}"


# The tables of the model.

USERS = "select c_custkey as id, c_name as username, c_name as street, c_mktsegment as unit from customer"
ROLES = "select * from (values (1,'admin'),(2,'staff'),(3,'manager'),(4,'customer')) t(id, role_name)"
STATUSES = "select * from (values (1,'Pending'),(2,'Processing'),(3,'Shipped'),(4,'Delivered'),(5,'Cancelled')) t(id, order_status_name)"
FIVE = "select cast(i as bigint) as id from range(1, 6) t(i)"
ROLE_USER = """select cast(case c_mktsegment when 'MACHINERY' then 2 when 'FURNITURE' then 3 else 4 end as bigint) as role_id,
    c_custkey as user_id from customer"""
ADDRESSES = "select o_orderkey as id, o_custkey as user_id from orders where o_orderpriority = '1-URGENT'"
CITIES = "select cast(n_nationkey as bigint) as id, n_name as city_name, cast(n_regionkey as bigint) as province_id from nation"
PRODUCTS = """select p_partkey as id, p_name as product_name, cast(p_retailprice as decimal(15,2)) as product_price,
    cast(cast(p_size as decimal(4,0)) * cast(0.4 as decimal(2,1)) as decimal(4,2)) as product_tax,
    greatest(p_size - 5, 0) as product_quantity from part"""
LINES = """select l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
    cast(cast(l_tax as decimal(4,2)) * 100 as decimal(4,2)) as product_tax,
    cast(p_retailprice as decimal(15,2)) as product_price from lineitem join part on p_partkey = l_partkey"""
ORDERS = """select o_orderkey as id, o_custkey as user_id, cast(o_totalprice as decimal(15,2)) as total_amount,
    cast(case o_orderstatus when 'P' then 1 when 'O' then 2 when 'F' then 4 end as bigint) as order_status_id,
    o_orderdate as updated_at from orders"""
CAMPAIGNS = f"""select id, {window((1, 30), (1, 10), f'{SEED}-campaign', 'id')}
    from (select cast(n_nationkey as bigint) as id from nation)"""
_TERMS = f"{SEED}-terms"
DISCOUNTS = f"""select id, adscampaign_id, type, case when type = 'percent'
        then cast({draw_int(f'{_TERMS}-percent', 1, 100, 'id')} as decimal(15,2))
        else cast({draw_decimal(f'{_TERMS}-amount', 100, 100000, 2, 'id')} as decimal(15,2)) end as value,
        {window((1, 30), (1, 30), _TERMS, 'id')}
    from (select *, {draw_choice(f'{_TERMS}-type', ['percent', 'amount'], 'id')} as type
        from {assign('select s_suppkey as id from supplier', 'id', CAMPAIGNS, 'id', {'id': 'adscampaign_id'}, f'{_TERMS}-campaign', True)})"""
CATEGORIES = """select p_partkey as id, p_name as category_name,
    case when p_partkey > 0 then p_partkey // 10 end as category_id from part"""
EVENT_TAGS = """select event_id, event_type, user_id as product_id,
    cast(json_extract_string(props, '$.k') as bigint) as tag_id from events"""
PLACES = """select c_mktsegment as city, n_name as state_name, c_acctbal / 1000 as lat, cast(c_custkey as double) as lng
    from customer join nation on n_nationkey = c_nationkey"""
PROVINCES = "select cast(n_nationkey as bigint) as id, n_name as province_name from nation where n_regionkey <> 1"

_STATUS_CASE = "case event_type " + " ".join(f"when '{e}' then {n}" for e, n in EVENT_STATUS.items()) + " end"
CHANGES = f"""select user_id as id, op, event_id as lsn, op = 'd' as deleted, date_trunc('millisecond', ts) as changed_at,
        case when op <> 'd' then cast({_STATUS_CASE} as bigint) end as order_status_id,
        case when op <> 'd' then cast(value as decimal(15,2)) end as total_amount,
        case when op <> 'd' then date_trunc('millisecond', ts) end as updated_at
    from (select *, case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end as op from events)"""


def history(changes: str) -> str:
    """A row where status or existence differs from the record before; deletes only end what was."""
    return f"""select id, order_status_id, since, lsn, until from (
        select *, lead(since) over (partition by id order by lsn) as until from (
            select id, order_status_id, deleted, changed_at as since, lsn from (
                select *, lag(order_status_id) over (partition by id order by lsn) as status_before,
                    lag(deleted) over (partition by id order by lsn) as deleted_before from ({changes}))
            where deleted_before is null or deleted_before <> deleted or status_before is distinct from order_status_id))
    where not deleted"""


HISTORY = history(CHANGES)
STATUS_CHANGES = f"select id, order_status_id, since, lsn from ({HISTORY})"
FIRST_VISITS = f"""select * from ({STATUS_CHANGES})
        qualify row_number() over (partition by id, order_status_id order by lsn) = 1"""
LATEST = f"select * from ({CHANGES}) qualify row_number() over (partition by id order by lsn desc) = 1"


def quantity(stock: str) -> str:
    return f"greatest(1, {stock} // 10)"


def totals(strict: bool) -> str:
    tax = f"{percent_of('product_price', 'product_tax')} * cast({'quantity' if strict else '1'} as decimal(10,0))"
    order_amount = "sum(product_price * cast(quantity as decimal(10,0)))"
    return f"""select order_id, {money(order_amount)} as order_amount, {money(f'sum({tax})')} as tax_amount,
        {money(f'{order_amount} + sum({tax})')} as total_amount from ({LINES}) group by order_id"""


def followed_totals(strict: bool) -> str:
    """Totals of the last record of each line, three to a line."""
    tax = f"price * rate * cast({'quantity' if strict else '1'} as decimal(10,0))"
    return f"""select order_id, {money('sum(price * cast(quantity as decimal(10,0)))')} as order_amount,
            {money(f'cast(sum({tax}) as decimal(30,4)) * {HUNDREDTH}')} as tax_amount,
            {money(f'sum(price * cast(quantity as decimal(10,0))) + cast(sum({tax}) as decimal(30,4)) * {HUNDREDTH}')} as total_amount
        from (select user_id as order_id, event_type, event_id % 7 + 1 as quantity, cast(value as decimal(15,2)) as price,
                cast(event_id % 9 as decimal(4,2)) as rate
            from events qualify row_number() over (partition by event_id // 3 order by event_id desc) = 1)
        where event_type <> 'error' group by 1"""


def discounted(source: str, key: str, seed: str, strict: bool) -> str:
    """``source`` has an order_amount; adds discount_id and the discount, not yet rounded."""
    valid = f"select * from ({DISCOUNTS}) where expired_at > {NOW}" + (f" and started_at <= {NOW}" if strict else "")
    fixed = "least(dv, order_amount)" if strict else "order_amount - dv"
    drawn = assign(
        source, key, valid, "id", {"id": "discount_id", "type": "dt", "value": "dv"}, seed,
        only_if=f"{draw(f'{seed}-chance', f'r.{key}')} % 11 >= 7",
    )
    return f"""(select *, case when dt is null then 0 when dt = 'percent'
        then cast({percent_of('order_amount', 'dv')} as decimal(38,6)) else cast({fixed} as decimal(38,6)) end as raw_discount from {drawn})"""


def discount_amounts(strict: bool) -> str:
    source = f"select id, total_amount as order_amount from ({ORDERS})"
    return f"""select id, discount_id, {money('raw_discount')} as discount_amount,
        {money('order_amount - raw_discount')} as total_amount from {discounted(source, 'id', f'{SEED}-give', strict)}"""


def baskets(requests: str, key: str, items: str, item_key: str, seed: str) -> str:
    """Ten steps of sampling, each with the list so far."""

    def powers(multiplier: int) -> str:
        return "[" + ", ".join(str(pow(multiplier, i, 2**31 - 1)) for i in range(1, 11)) + "]"

    series = f"""(hi * list_extract({powers(48271)}, i + 1)) % {2**31 - 1} * {2**31}
        + (lo * list_extract({powers(69621)}, i + 1)) % {2**31 - 1}"""
    size = f"least({draw_int(f'{seed}-size', 1, 10, key)}, n)"
    pick = f"({series}) % (n - size + i + 1)"
    return f"""
    sized as (select {key} as k, n, {size} as size, ({draw(seed, key)} >> 30) + 1 as hi, {draw(seed, key)} % {2**30} + 1 as lo from ({requests}), (select count(*) as n from ({items}))),
    steps as (
        select k, n, size, hi, lo, cast(0 as bigint) as i, cast([] as bigint[]) as chosen from sized where size > 0
        union all
        select k, n, size, hi, lo, i + 1, list_append(chosen, case when list_contains(chosen, {pick}) then n - size + i else {pick} end)
        from steps where i < size),
    picked as (select k, unnest(chosen) as slot, unnest(range(1, size + 1)) as line_number from steps where i = size),
    basket as (select k as {key}, cast(line_number as int) as line_number, t.* exclude (slot)
        from picked join {numbered(items, item_key, 'slot', '0')} t on t.slot = picked.slot)"""


def assembly(strict: bool) -> str:
    """The common part of the order assembly queries: CTEs up to ``placed`` and ``priced``."""
    source = "select o_orderkey from orders"
    by_role = f"select u.id from ({USERS}) u join ({ROLE_USER}) r on r.user_id = u.id where r.role_id = %d"
    for column, choices in {
        "user_id": by_role % 4,
        "staff_id": by_role % 2,
        "payment_method_id": FIVE,
        "shipping_method_id": FIVE,
    }.items():
        source = "select * from " + assign(source, "o_orderkey", choices, "id", {"id": column}, f"{SEED}-{column}")
    items = f"""select id as product_id, product_price, product_tax, product_quantity from ({PRODUCTS})
        where product_quantity > 0"""
    subtotal = (
        "product_price * quantity"
        if strict
        else f"{percent_of('product_price', 'product_tax')} * cast(quantity as decimal(10,0))"
    )
    tax = f"{percent_of('product_price', 'product_tax')} * cast({'quantity' if strict else '1'} as decimal(10,0))"
    share = draw_decimal(f"{SEED}-cost", 500000, 900000, 6, "o_orderkey", "product_id")
    placed = f"""
    header as (select h.*, a.address_id from ({source}) h
        join (select user_id, min(id) as address_id from ({ADDRESSES}) group by 1) a on a.user_id = h.user_id
        where staff_id is not null),
    placed as (select *, row_number() over (order by o_orderkey) + (select max(o_orderkey) from orders) as id from header),"""
    return f"""with recursive {placed}
    {baskets('select * from header', 'o_orderkey', items, 'product_id', f'{SEED}-basket')},
    priced as (select *, cast({quantity('product_quantity')} as int) as quantity from basket),
    costed as (select *, {money(subtotal)} as subtotal_amount, {money(f'product_price * {share}')} as unit_cost from priced),
    sums as (select o_orderkey, sum(product_price * cast(quantity as decimal(10,0))) as raw_amount, sum({tax}) as raw_tax
        from priced group by 1),
    amounts as (select p.*, cast(raw_amount as decimal(15,2)) as order_amount, raw_tax from placed p join sums using (o_orderkey)),
    final as (select *, {money('raw_discount')} as discount_amount, {money('raw_tax')} as tax_amount,
        {money('order_amount + raw_tax - raw_discount')} as total_amount
        from {discounted('select * from amounts', 'o_orderkey', f'{SEED}-discount', strict)})"""


TRANSACTIONS = f"""select id as order_id, 'payment' as transaction_type, total_amount as amount,
    {draw_choice(f'{SEED}-status', ['true', 'false'], 'id')} = 'true' as status,
    'Fake transaction description for order #' || cast(id as varchar) as description from ({ORDERS})"""


def after_payment(strict: bool) -> str:
    success = draw_choice(f"{SEED}-next", ["Processing", "Shipped", "Delivered"], "t.order_id")
    name = success
    if strict:
        name = f"case when t.status then {success} else {draw_choice(f'{SEED}-next', ['Pending', 'Cancelled'], 't.order_id')} end"
    return f"""select o.id, o.user_id, o.total_amount, cast(s.id as bigint) as order_status_id,
        {NOW if strict else 'o.updated_at'} as updated_at
    from ({ORDERS}) o join ({TRANSACTIONS}) t on t.order_id = o.id join ({STATUSES}) s on s.order_status_name = {name}"""


def role_bands(held: str, admins: int, managers: int, staff: int) -> str:
    """The waterfall with the given free places."""
    return f"""select user_id, cast(case role_name when 'admin' then 1 when 'staff' then 2 when 'manager' then 3 else 4 end as bigint) as role_id,
        role_name from (select id as user_id, case when rn <= {admins} then 'admin' when rn <= {admins + managers} then 'manager'
            when rn <= {admins + managers + staff} then 'staff' else 'customer' end as role_name
        from (select id, row_number() over (order by id) as rn from ({USERS}) where id not in ({held})))"""


GIVEN_DISCOUNTS = f"""select s_suppkey as id, case when s_nationkey % 2 = 0 then 'percent' else 'amount' end as type,
    cast(case when s_nationkey % 2 = 0 then s_nationkey + 1 else abs(s_acctbal) end as decimal(15,2)) as value,
    {days(NOW, 's_suppkey % 30', '-')} as started_at, {days(NOW, 's_suppkey % 20 - 5')} as expired_at from supplier"""
BASKET = f"""select l_orderkey as order_id, l_linenumber as line_number, l_partkey as product_id, product_price, product_tax,
    cast(case when l_returnflag <> 'R' then cast(l_quantity as int) else {quantity('product_quantity')} end as int) as quantity
    from lineitem join ({PRODUCTS}) p on p.id = l_partkey"""
PAID = """select o_orderkey as order_id, o_orderkey as request_id, o_custkey % 4 <> 0 as status,
        case when o_custkey % 8 = 0 then 'Cancelled' else 'Shipped' end as next_status from orders
    union all select o_orderkey, o_orderkey + 100000000, false, 'Pending' from orders where o_orderpriority = '1-URGENT'"""


OWN_TIME = f"({NOW} + to_days(cast({{0}} % 50 - 30 as integer)))"


def given_orders(strict: bool, own_time: bool = False) -> str:
    tax = f"{percent_of('product_price', 'product_tax')} * cast({'quantity' if strict else '1'} as decimal(10,0))"
    now = OWN_TIME.format("w.id") if own_time else NOW
    started = f" and started_at <= {now}" if strict else ""
    fixed = "least(value, order_amount)" if strict else "order_amount - value"
    return f"""with sums as (select order_id, sum(product_price * cast(quantity as decimal(10,0))) as amount, sum({tax}) as tax
            from ({BASKET}) group by 1),
        whole as (select o_orderkey as id, o_custkey as user_id, o_custkey % 7 + 1 as staff_id, o_orderkey as address_id,
                case when o_orderkey % 3 = 0 then o_custkey % 10 end as asked, o_orderkey % 5 + 1 as payment_method_id,
                o_custkey % 5 + 1 as shipping_method_id, cast(coalesce(amount, 0) as decimal(15,2)) as order_amount,
                coalesce(tax, 0) as tax from orders left join sums on order_id = o_orderkey),
        given as (select w.*, d.id as discount_id, case when d.id is null then 0
                when type = 'percent' then cast({percent_of('order_amount', 'value')} as decimal(38,6))
                else cast({fixed} as decimal(38,6)) end as discount
            from whole w left join ({GIVEN_DISCOUNTS}) d on d.id = asked and expired_at > {now}{started})
        select id, user_id, staff_id, address_id, order_amount, {money('discount')} as discount_amount, {money('tax')} as tax_amount,
            {money('order_amount + tax - discount')} as total_amount, discount_id, payment_method_id,
            cast(null as bigint) as payment_status_id, cast(1 as bigint) as order_status_id, shipping_method_id,
            cast(null as bigint) as shipping_status_id, cast(null as timestamp) as shipped_at,
            {now.replace('w.id', 'id')} as created_at, {now.replace('w.id', 'id')} as updated_at
        from given"""


SLUG = r"regexp_replace(lower(p_name), '\W+', '-', 'g')"
OLD_SLUGS = f"""select {SLUG} || '-' || cast(p_size as varchar) as slug from part where p_type = 'SMALL'
    union select {SLUG} from part where p_type = 'ECONOMY' and p_size > 45"""


def report(table: str, rule: str, columns: str, violations: str, source: str) -> str:
    return f"select '{table}' as table_name, '{rule}' as rule, '{columns}' as columns, cast({violations} as bigint) as violations from ({source})"


def _report() -> str:
    people = f"""select id, username, unit as email, case when unit <> 'BUILDING' then username end as mobile from ({USERS})"""
    goods = f"""select id, case when product_quantity > 0 then product_name end as product_name, product_price * 1000 as product_price,
        product_tax * 10 as product_tax, product_quantity, id + 1 as category_id from ({PRODUCTS})"""
    frames = {"users": people, "products": goods, "orders": ORDERS, "discounts": DISCOUNTS}
    parts = []

    def row(table, rule, column, test):
        parts.append(report(table, rule, column, f"count(*) filter (where {test})", frames[table]))

    def unique(table, column):
        parts.append(report(table, "unique", column, f"count({column}) - count(distinct {column})", frames[table]))

    def reference(table, column, parent):
        test = f"count(*) filter (where {column} is not null and {column} not in (select id from ({parent})))"
        parts.append(report(table, "reference", column, test, frames[table]))

    required = {
        "users": ["id", "username", "email", "mobile"],
        "products": ["id", "product_name", "product_price", "product_tax", "product_quantity", "category_id"],
        "orders": ["id", "user_id", "total_amount", "order_status_id", "updated_at"],
        "discounts": ["id"],
    }
    lengths = {"users": {"username": 100, "email": 255, "mobile": 255}, "products": {"product_name": 255}}
    decimals = {
        "products": {"product_price": (15, 2), "product_tax": (4, 2)},
        "orders": {"total_amount": (15, 2)},
        "discounts": {"value": (15, 2)},
    }
    for table, columns in required.items():
        for c in columns:
            row(table, "not_null", c, f"{c} is null")
        for c, n in lengths.get(table, {}).items():
            row(table, "length", c, f"length({c}) > {n}")
        for c, (p, s) in decimals.get(table, {}).items():
            row(table, "decimal", c, f"{c} is not null and try_cast({c} as decimal({p},{s})) is null")
        unique(table, "id")
    for c in ("username", "email", "mobile"):
        unique("users", c)
    row("discounts", "domain", "type", "type is not null and type not in ('percent', 'amount')")
    reference("products", "category_id", CATEGORIES)
    reference("orders", "user_id", USERS)
    reference("orders", "order_status_id", STATUSES)
    reference("discounts", "adscampaign_id", CAMPAIGNS)
    return " union all ".join(parts)


_LINE_ORDER = """l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus"""


def tag_cap(strict: bool) -> str:
    fresh = f"""select * from (select event_id, product_id, tag_id from ({EVENT_TAGS}) where event_type <> 'purchase'
            qualify row_number() over (partition by product_id, tag_id order by event_id) = 1) f
        where not exists (select 1 from old where old.product_id = f.product_id and old.tag_id = f.tag_id)"""
    room = "place <= 18 - coalesce(n, 0)" if strict else "coalesce(n, 0) < 18"
    return f"""with old as (select distinct product_id, tag_id from ({EVENT_TAGS}) where event_type = 'purchase')
    select event_id, product_id, tag_id from (select *, row_number() over (partition by product_id order by event_id) as place from ({fresh})) r
    left join (select product_id as p, count(*) as n from old group by 1) o on o.p = r.product_id where {room}"""


def tag_cap_by_batch(strict: bool) -> str:
    """A pair counts in the first batch that brings it; what earlier batches brought decides, or what came before it."""
    number = "-(event_id // 20)" if strict else "event_id // 20"
    before = "row_number() over (partition by product_id order by batch, event_id) - 1" if strict else """coalesce(
        sum(1) over (partition by product_id order by batch range between unbounded preceding and 1 preceding), 0)"""
    return f"""with old as (select distinct product_id, tag_id from ({EVENT_TAGS}) where event_type = 'purchase'),
        first as (select * from (select event_id, product_id, tag_id, {number} as batch from ({EVENT_TAGS}) where event_type <> 'purchase')
            qualify row_number() over (partition by product_id, tag_id order by batch, event_id) = 1),
        fresh as (select *, {before} as earlier from first f
            where not exists (select 1 from old where old.product_id = f.product_id and old.tag_id = f.tag_id))
    select event_id, product_id, tag_id, batch from fresh
    left join (select product_id as p, count(*) as n from old group by 1) o on o.p = product_id where coalesce(n, 0) + earlier < 18"""


def roles_by_batch(strict: bool) -> str:
    """Reference mode goes from batch to batch; strict mode fills the places in order of batches."""
    held = f"select user_id from ({ROLE_USER}) where role_id = 3 and user_id % 100 = 0" if strict else "select -1"
    number = "-(id // 2)" if strict else "id // 2"
    waiting = f"select id, {number} as batch from ({USERS}) where id not in ({held})"
    named = """cast(case role_name when 'admin' then 1 when 'staff' then 2 when 'manager' then 3 else 4 end as bigint) as role_id,
        role_name"""
    if strict:
        free = f"(select greatest(2 - count(*), 0) from ({held}))"
        return f"""select user_id, {named} from (select id as user_id, case when rn <= 1 then 'admin' when rn <= 1 + {free} then 'manager'
            when rn <= 5 + {free} then 'staff' else 'customer' end as role_name
            from (select id, row_number() over (order by batch, id) as rn from ({waiting})))"""
    return f"""with recursive sizes as (select row_number() over (order by batch) as i, batch, count(*) as n from ({waiting}) group by batch),
        steps as (select cast(0 as bigint) as i, 0 as a, 0 as m, 0 as s, '' as role_name
            union all select z.i, case when a < 1 then a + n else a end, case when a >= 1 and m < 2 then m + n else m end,
                case when a >= 1 and m >= 2 and s < 4 then s + n else s end,
                case when a < 1 then 'admin' when m < 2 then 'manager' when s < 4 then 'staff' else 'customer' end
            from steps join sizes z on z.i = steps.i + 1)
        select w.id as user_id, {named} from ({waiting}) w join sizes using (batch) join steps using (i)"""


_DRAWN = assign(
    f"select * from {assign('select event_id from events', 'event_id', 'select p_partkey as id from part', 'id', {'id': 'product_id'}, f'{SEED}-product')}",
    "event_id", "select s_suppkey as id from supplier", "id", {"id": "tag_id"}, f"{SEED}-tag",
)

_VALUES = assign(
    f"select * from {assign('select p_partkey from part', 'p_partkey', CATEGORIES, 'id', {'id': 'category_id'}, f'{SEED}-category')}",
    "p_partkey", "select s_suppkey as id from supplier", "id", {"id": "brand_id"}, f"{SEED}-brand",
)

_CITY_ROWS = f"""select city as city_name, p.id as province_id, lat, lng from ({PLACES}) f
    join ({PROVINCES}) p on p.province_name = f.state_name"""
_CITIES = f"""select city_name, province_id, lat as latitude, lng as longitude from ({_CITY_ROWS})
    qualify row_number() over (partition by city_name, province_id order by %s) = 1"""

ORACLES: dict[str, str] = {
    "order_totals": totals(False),
    "order_totals_strict": totals(True),
    "order_lines_priced": f"""select id, cast(quantity as int) as quantity,
            {money(f"{percent_of('product_price', 'product_tax')} * cast(quantity as decimal(10,0))")} as tax_subtotal,
            {money('product_price * quantity')} as subtotal_amount,
            {money(f"product_price * {draw_decimal(SEED, 500000, 900000, 6, 'id')}")} as unit_cost
        from (select *, {quantity('product_quantity')} as quantity from ({PRODUCTS}))""",
    "order_costs": f"""select l_orderkey as order_id, {money('sum(cast(l_extendedprice as decimal(15,2)))')} as cost_amount
        from lineitem group by 1""",
    "discount_amounts": discount_amounts(False),
    "discount_amounts_strict": discount_amounts(True),
    "order_assembly": f"""{assembly(False)} select id, o_orderkey, user_id, staff_id, address_id, order_amount, discount_amount,
        tax_amount, total_amount, discount_id, payment_method_id, cast(null as bigint) as payment_status_id,
        cast(1 as bigint) as order_status_id, shipping_method_id, cast(null as bigint) as shipping_status_id,
        cast(null as timestamp) as shipped_at, {NOW} as created_at, {NOW} as updated_at from final""",
    "order_assembly_strict": f"""{assembly(True)} select id, o_orderkey, user_id, staff_id, address_id, order_amount, discount_amount,
        tax_amount, total_amount, discount_id, payment_method_id, cast(null as bigint) as payment_status_id,
        cast(1 as bigint) as order_status_id, shipping_method_id, cast(null as bigint) as shipping_status_id,
        cast(null as timestamp) as shipped_at, {NOW} as created_at, {NOW} as updated_at from final""",
    "orders_given": given_orders(False),
    "orders_given_strict": given_orders(True),
    "order_lines_given": f"""select order_id, line_number, product_id, quantity, product_price, product_tax,
        {money(f"{percent_of('product_price', 'product_tax')} * cast(quantity as decimal(10,0))")} as subtotal_amount,
        cast(0 as decimal(15,2)) as unit_cost from ({BASKET})""",
    "discounts_given": f"""select o_orderkey as id, d.id as discount_id,
        cast(case when d.id is null then 0 when type = 'percent' then cast({percent_of('o_amount', 'value')} as decimal(38,6))
            else cast(least(value, o_amount) as decimal(38,6)) end as decimal(15,2)) as discount_amount
        from (select o_orderkey, o_custkey % 10 as asked, cast(o_totalprice as decimal(15,2)) as o_amount from orders) o
        left join (select * from ({GIVEN_DISCOUNTS}) where expired_at > {NOW} and started_at <= {NOW}) d on d.id = asked""",
    "orders_given_at_own_time": given_orders(True, own_time=True),
    "discounts_given_at_own_time": f"""select o_orderkey as id, ordered_at, d.id as discount_id,
        cast(case when d.id is null then 0 when type = 'percent' then cast({percent_of('o_amount', 'value')} as decimal(38,6))
            else cast(o_amount - value as decimal(38,6)) end as decimal(15,2)) as discount_amount
        from (select o_orderkey, o_custkey % 10 as asked, cast(o_totalprice as decimal(15,2)) as o_amount,
            {OWN_TIME.format('o_orderkey')} as ordered_at from orders) o
        left join ({GIVEN_DISCOUNTS}) d on d.id = asked and expired_at > ordered_at""",
    "orders_replayed": """with top as (select max(o_orderkey) as t from orders), odd as (select count(*) as n from orders where o_orderkey % 2 = 1),
        keyed as (select o_orderkey, row_number() over (order by o_orderkey) + t as id from orders, top where o_orderkey % 2 = 1
            union all select o_orderkey, row_number() over (order by o_orderkey) + t + n from orders, top, odd where o_orderkey % 2 = 0)
        select id, o_orderkey, count(l_orderkey) as line_count from keyed left join lineitem on l_orderkey = o_orderkey group by 1, 2""",
    "append_batches": "select event_id, user_id, cast(event_id % 3 as int) as batch_id from events",
    "due_dates": """select l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate + to_days(cast(l_linenumber * 10 as integer)) as due_at
        from lineitem""",
    "order_assembly_lines": f"""{assembly(False)} select p.id as order_id, line_number, product_id, quantity, product_price, product_tax,
        subtotal_amount, unit_cost from costed join placed p using (o_orderkey)""",
    "orders_saved": f"""{assembly(False)} select id, order_amount, total_amount, line_count from final
        join (select o_orderkey, count(*) as line_count from basket group by 1) using (o_orderkey)""",
    "parent_child_write": f"""select o.id, o.total_amount, count(l.order_id) as line_count,
            cast(coalesce(sum(l.quantity), 0) as bigint) as pieces
        from ({ORDERS}) o left join ({LINES}) l on l.order_id = o.id group by 1, 2""",
    "transactions_from_orders": TRANSACTIONS,
    "status_after_payment": after_payment(False),
    "status_after_payment_strict": after_payment(True),
    "status_change_by_name": f"""select o.id, cast(case o_orderpriority when '1-URGENT' then 3 when '5-LOW' then 5
            else o.order_status_id end as bigint) as order_status_id
        from ({ORDERS}) o join orders on o_orderkey = o.id""",
    "status_changed_twice": f"""select o_orderkey as id, cast(case when o_orderkey % 2 = 0 then 3 else 2 end as bigint) as order_status_id,
        {NOW} as updated_at from orders""",
    "transactions_stored": f"""select request_id, order_id, transaction_type, amount, status, description, created_at,
        row_number() over (order by request_id) as id from (
            select p.request_id, p.order_id, 'payment' as transaction_type, o.total_amount as amount, p.status,
                'Fake transaction description for order #' || cast(p.order_id as varchar) as description, {NOW} as created_at
            from ({PAID}) p join ({ORDERS}) o on o.id = p.order_id)""",
    "status_after_given_payment": f"""with taken as (select * from ({PAID})
            where (status and next_status in ('Processing', 'Shipped', 'Delivered')) or (not status and next_status in ('Pending', 'Cancelled'))
            qualify row_number() over (partition by order_id order by request_id desc) = 1)
        select o.id, cast(coalesce(s.id, o.order_status_id) as bigint) as order_status_id from ({ORDERS}) o
        left join taken t on t.order_id = o.id left join ({STATUSES}) s on s.order_status_name = t.next_status""",
    "status_ids": f"select order_status_id, count(*) as orders from ({ORDERS}) group by 1",
    "role_quota": role_bands("select -1", 1, 2, 4),
    "role_quota_with_holders": f"""with held as (select user_id from ({ROLE_USER}) where role_id = 2)
        {role_bands('select user_id from held', 1, 2, 0)}""",
    "role_quota_reference": f"""select id as user_id, cast(1 as bigint) as role_id, 'admin' as role_name from ({USERS})
        where id not in (select user_id from ({ROLE_USER}) where role_id = 2)""",
    "role_quota_by_batch": roles_by_batch(False),
    "role_quota_by_batch_strict": roles_by_batch(True),
    "users_with_role": f"""select id, username from ({USERS}) where id in (select user_id from ({ROLE_USER})
        where role_id in (select id from ({ROLES}) where role_name = 'staff'))""",
    "users_in_named_group": """select c_custkey as id, c_name as username from customer where c_nationkey in (
        select n_nationkey from nation where n_regionkey in (select r_regionkey from region where r_name = 'ASIA'))""",
    "customers_without_orders_since": """select c_custkey as id, c_name as username from customer where not exists (
        select 1 from orders where o_custkey = c_custkey and o_orderdate >= timestamp '2001-01-01')""",
    "ready_gate": f"""select count(*) > 0 as ready from (select 1 from ({ADDRESSES}) a join ({ROLE_USER}) u on u.user_id = a.user_id
        join ({ROLES}) r on r.id = u.role_id where r.role_name = 'customer' limit 1)""",
    "role_counts": f"""select cast(r.id as bigint) as role_id, role_name, count(u.user_id) as user_count
        from ({ROLES}) r left join ({ROLE_USER}) u on u.role_id = r.id group by 1, 2""",
    "password_digest": "select c_custkey as id, sha256(c_name) as password from customer",
    "slugged_parts": f"""select p_partkey, p_name, case when n = 0 then base else base || '-' || cast(n as varchar) end as slug
        from (select *, row_number() over (partition by base order by p_partkey) - 1 as n from (select *, {SLUG} as base from part))""",
    "slug_with_existing": rf"""with old as ({OLD_SLUGS}),
        new as (select p_partkey, p_name, base, row_number() over (partition by base order by p_partkey) as rn
            from (select *, {SLUG} as base from part where not (p_type = 'SMALL' or (p_type = 'ECONOMY' and p_size > 45)))),
        sizes as (select base, count(*) as n from new group by 1),
        places as (select base, unnest(range(0, n + (select count(*) from old))) as place from sizes),
        spelled as (select *, case when place = 0 then base else base || '-' || cast(place as varchar) end as slug from places),
        free as (select *, row_number() over (partition by base order by place) as rn from spelled where slug not in (select slug from old))
        select p_partkey, p_name, slug from new join free using (base, rn)""",
    "slugs_any_script": rf"""select doc_id, name, case when n = 0 then base else base || '-' || cast(n as varchar) end as slug
        from (select *, row_number() over (partition by base order by doc_id) - 1 as n from (
            select doc_id, name, regexp_replace(lower(name), '[^\p{{L}}\p{{N}}_]+', '-', 'g') as base
            from (select doc_id, substr(text, 1, 12) as name from documents)))""",
    "slugs_hot_base": rf"""with new as (select *, row_number() over (partition by base order by p_partkey) - 1 as rn from (
            select p_partkey, name, regexp_replace(lower(name), '\W+', '-', 'g') as base
            from (select p_partkey, case when p_size > 5 then 'Lamp' else p_name end as name from part))),
        taken as (select max(p_partkey) + 2 as n from part)
        select p_partkey, name, case when base = 'lamp' then base || '-' || cast(rn + n as varchar)
            when rn = 0 then base else base || '-' || cast(rn as varchar) end as slug from new, taken""",
    "category_tree": f"""with recursive c as ({CATEGORIES}), tree as (
            select id, id as root_id, 0 as depth from c where category_id is null
            union all select c.id, tree.root_id, depth + 1 from tree join c on c.category_id = tree.id)
        select * from tree""",
    "category_parent_names": f"""select c.id, c.category_name, c.category_id, p.category_name as parent_name
        from ({CATEGORIES}) c left join ({CATEGORIES}) p on p.id = c.category_id""",
    "category_rows": f"""select s_suppkey, category_name, slug, category_id from {assign(
            '''select s_suppkey, category_name, case when n = 0 then base else base || '-' || cast(n as varchar) end as slug
            from (select s_suppkey, n_name as category_name, lower(n_name) as base,
                row_number() over (partition by n_name order by s_suppkey) - 1 as n
                from supplier join nation on n_nationkey = s_nationkey)''',
            's_suppkey', f"select * from ({CATEGORIES}) where category_name ilike 'small%'", 'id', {'id': 'category_id'},
            f'{SEED}-parent', True)}""",
    "categories_given": f"""select category_name, category_id, case when n = 0 then base else base || '-' || cast(n as varchar) end as slug,
            {NOW} as created_at, row_number() over (order by s_suppkey) + (select max(p_partkey) from part) as id
        from (select *, lower(category_name) as base, row_number() over (partition by category_name order by s_suppkey) - 1 as n
            from (select s_suppkey, n_name as category_name, case when s_suppkey % 3 = 0 then s_suppkey % 40 end as category_id
                from supplier join nation on n_nationkey = s_nationkey
                where s_suppkey % 3 = 2 or (s_suppkey % 3 = 0 and s_suppkey % 40 in (select p_partkey from part))))""",
    "category_intervals": f"""with recursive c as ({CATEGORIES}), tree as (
            select id, id as root_id, 0 as depth, [id] as path from c where category_id is null
            union all select c.id, root_id, depth + 1, list_append(path, c.id) from tree join c on c.category_id = tree.id),
        sizes as (select top as id, count(*) as size from (select unnest(path) as top from tree) group by 1)
        select id, root_id, cast(depth as int) as depth, row_number() over (order by path) - 1 as "begin",
            row_number() over (order by path) - 1 + size as "end" from tree join sizes using (id)""",
    "category_rollup": f"""with recursive c as ({CATEGORIES}), tree as (
            select id, 0 as depth, [id] as path from c where category_id is null
            union all select c.id, depth + 1, list_append(path, c.id) from tree join c on c.category_id = tree.id),
        above as (select id as part, unnest(path) as id from tree),
        sold as (select l_partkey as part, sum(cast(l_quantity as bigint)) as pieces, count(*) as lines from lineitem group by 1)
        select tree.id, cast(depth as int) as depth, cast(coalesce(sum(pieces), 0) as bigint) as pieces,
            cast(coalesce(sum(lines), 0) as bigint) as lines
        from tree join above using (id) left join sold using (part) group by 1, 2""",
    "name_prefix": f"select id, category_name from ({CATEGORIES}) where category_name ilike 'Small%'",
    "product_values": f"""select *, cast({draw_decimal(f'{SEED}-price', 1000, 100000, 2, 'p_partkey')} as decimal(15,2)) as product_price,
            cast({draw_decimal(f'{SEED}-tax', 0, 2000, 2, 'p_partkey')} as decimal(4,2)) as product_tax,
            cast({draw_int(f'{SEED}-stock', 1, 100, 'p_partkey')} as int) as product_quantity
        from {_VALUES}""",
    "tag_cap": tag_cap(True),
    "tag_cap_reference": tag_cap(False),
    "tag_cap_by_batch": tag_cap_by_batch(False),
    "tag_cap_by_batch_strict": tag_cap_by_batch(True),
    "tags_drawn": f"""select event_id, product_id, tag_id from (
            select *, row_number() over (partition by product_id order by event_id) as place from (
                select * from {_DRAWN} qualify row_number() over (partition by product_id, tag_id order by event_id) = 1)
            where not exists (select 1 from part where p_partkey = product_id and p_size = tag_id))
        where place <= 4""",
    "tags_per_product": f"select product_id, count(*) as tag_count from ({EVENT_TAGS}) group by 1",
    "distinct_names": "select distinct p_name from part order by p_name limit 50",
    "provinces_from_file": f"""select province_name, row_number() over (order by province_name)
            + (select max(n_nationkey) from nation where n_regionkey = 2) as id
        from (select distinct state_name as province_name from ({PLACES})
            where state_name not in (select n_name from nation where n_regionkey = 2))""",
    "geo_cities": f"""select city_name, province_id, latitude, longitude, row_number() over (
            order by city_name, province_id) as id
        from ({_CITIES % 'lat, lng'})""",
    "geo_cities_from_csv": f"select * from ({_CITIES % 'lng'}) where city_name <> 'MACHINERY'",
    "places_with_null_tokens": f"""select state_name, count(*) as places, count(lat) as located from (
            select case when key % 5 > 0 then state_name when key % 7 = 5 then 'na' when key % 7 = 6 then 'Na' end as state_name,
                case when key % 10 > 0 or key % 7 >= 5 then lat end as lat
            from (select *, cast(lng as bigint) as key from ({PLACES}))) group by 1""",
    "address_attach": f"""select {draw_choice(f'{SEED}-title', ['home', 'office'], 'user_id')} as title, user_id, province_id, city_id,
            street || ', ' || unit as full_address
        from {assign(f'select id as user_id, street, unit from ({USERS}) where id not in (select user_id from ({ADDRESSES}))',
                     'user_id', CITIES, 'id', {'id': 'city_id', 'province_id': 'province_id'}, f'{SEED}-city')}""",
    "addresses_given": f"""select title, user_id, province_id, city_id, full_address, {NOW} as created_at,
            row_number() over (order by user_id) + (select max(id) from ({ADDRESSES})) as id
        from (select case when c_acctbal > 0 then 'office' else 'home' end as title, c_custkey as user_id,
                cast(n_regionkey as bigint) as province_id, cast(c_nationkey as bigint) as city_id,
                c_name || ', ' || c_mktsegment as full_address
            from customer join nation on n_nationkey = c_nationkey where c_custkey not in (select user_id from ({ADDRESSES})))""",
    "seeded_sample": f"""select o_orderkey, o_custkey from orders where o_orderstatus = 'P'
        order by {draw(SEED, 'o_orderkey')}, o_orderkey limit 10""",
    "seeded_baskets": f"""with recursive {baskets('select o_orderkey from orders', 'o_orderkey',
            f'select id as product_id from ({PRODUCTS}) where product_quantity > 0', 'product_id', SEED)}
        select o_orderkey, line_number, product_id from basket""",
    "surrogate_keys": "select c_name, row_number() over (order by c_name) + (select max(p_partkey) from part) as id from customer",
    "surrogate_keys_strided": "select o_orderkey, row_number() over (order by o_orderkey) + (select max(p_partkey) from part) as id from orders",
    "active_at": "select event_id, ts as expired_at from events where ts > timestamp '2024-01-15'",
    "active_at_each": """with flash as (select s_suppkey as discount_id, s_suppkey * 7919 % 720 as h,
            case when s_suppkey % 50 = 0 then 240 else s_suppkey % 6 + 1 end as n from supplier)
        select event_id, discount_id from events join flash on ts >= timestamp '2024-01-01' + to_hours(cast(h as integer))
            and ts < timestamp '2024-01-01' + to_hours(cast(h + n as integer))""",
    "active_discounts": f"""select * from ({DISCOUNTS}) where expired_at > timestamp '2024-01-15'
        and started_at <= timestamp '2024-01-15'""",
    "discount_terms": DISCOUNTS,
    "campaign_windows": f"select o_orderkey as id, {window((1, 30), (1, 10), SEED, 'o_orderkey')} from orders",
    "insert_ignore": f"""select * from lineitem l where l_linestatus = 'F' and not exists (select 1 from lineitem o
            where o.l_linestatus = 'O' and o.l_orderkey = l.l_orderkey and o.l_linenumber = l.l_linenumber)
        qualify row_number() over (partition by l_orderkey, l_linenumber order by {_LINE_ORDER}) = 1""",
    "insert_ignore_rejected": """with batch as (select o_orderkey, o_custkey, o_orderdate from orders where o_orderdate >= timestamp '1996-01-01'),
        there as (select distinct o_custkey from orders where o_orderdate < timestamp '1996-01-01'),
        ranked as (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from batch)
        select o_orderkey, o_custkey, o_orderdate from ranked where rn > 1 or o_custkey in (select o_custkey from there)""",
    "update_by_key": f"""with last as (select o_custkey, {draw_choice(SEED, ['GARDEN', 'KITCHEN'], 'o_orderkey')} as segment from orders
            qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
        select c_custkey, c_name, c_nationkey, c_acctbal, coalesce(segment, c_mktsegment) as c_mktsegment
        from customer left join last on o_custkey = c_custkey""",
    "seeds_if_empty": """select cast(id as bigint) as id, role_name, role_title, target
        from (values (1,'admin','Administrator'),(2,'staff','Staff'),(3,'manager','Manager'),(4,'customer','Customer')) r(id, role_name, role_title),
            (values ('empty', 'NOBODY'), ('used', 'BUILDING')) t(target, segment)
        where not exists (select 1 from customer where c_mktsegment = segment)""",
    "audit_unique": """select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1""",
    "audit_unique_together": " union all ".join(
        f"""select '{','.join(k)}' as columns, concat_ws('|', {', '.join(k)}) as key, count(*) as rows from lineitem
            group by {', '.join(k)} having count(*) > 1"""
        for k in (["l_orderkey", "l_linenumber"], ["l_orderkey", "l_partkey"], ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    ),
    "audit_fk": """select o_orderkey, count(*) as rows from orders where o_orderkey not in (select l_orderkey from lineitem) group by 1""",
    "audit_domain": "select event_id, event_type from events where event_type not in ('view', 'click', 'purchase')",
    "audit_not_null": "select doc_id from documents left join labels using (doc_id) where quality is null",
    "audit_length": "select doc_id, cast(length(text) as int) as length from documents where length(text) > 500",
    "audit_decimal": "select o_orderkey, o_totalprice as amount from orders where try_cast(o_totalprice as decimal(7,2)) is null",
    "audit_totals": f"""select l_orderkey, l_linenumber, total_amount from (
            select *, {money("order_amount + tax_amount - case when l_returnflag = 'R' then 0 else discount_amount end")} as total_amount
            from (select *, {money('order_amount * cast(l_tax as decimal(4,2))')} as tax_amount,
                {money('order_amount * cast(l_discount as decimal(4,2))')} as discount_amount
                from (select *, cast(l_extendedprice as decimal(15,2)) as order_amount from lineitem)))
        where abs(order_amount + tax_amount - discount_amount - total_amount) > 0.01""",
    "audit_report": _report(),
    "defaults_filled": f"""select l_orderkey, l_linenumber, l_partkey,
            cast(case when l_returnflag = 'R' then l_quantity else 1 end as int) as quantity,
            cast(0 as decimal(15,2)) as unit_cost, {NOW} as created_at from lineitem""",
    "stored_types": """select event_id, cast(cast(value as decimal(15,2)) as decimal(15,1)) as amount,
        date_trunc('second', ts + interval 500 milliseconds) as created_at from events""",
    "times_to_second": "select event_id, date_trunc('second', ts + interval 500 milliseconds) as second from events",
    "cdc_decode": CHANGES,
    "cdc_flatten": "select user_id as after_id, value as after_amounts_value, event_id as source_lsn, 'u' as op from events",
    "latest_state": f"select * from ({LATEST}) where not deleted",
    "status_history": HISTORY,
    "first_visits": FIRST_VISITS,
    "history_with_deletes": history(f"select * replace (order_status_id % 2 as order_status_id) from ({CHANGES})"),
    "history_stored": f"""select order_id, order_status_id, staff_id, cast(null as varchar) as comments, {NOW} as created_at,
            row_number() over (order by order_id, order_status_id) as id
        from (select v.id as order_id, order_status_id, c_custkey % 7 as staff_id from ({FIRST_VISITS}) v
            join customer on c_custkey = v.id where c_custkey % 3 > 0)""",
    "cdc_repeats": f"select id, op, lsn, deleted, changed_at, order_status_id, total_amount from ({CHANGES})",
    "cdc_state_compacted": f"""select id, op, lsn, deleted, changed_at, order_status_id, total_amount from ({LATEST}) where not deleted""",
    "cdc_times": """select user_id as id, 'u' as op, event_id as lsn, false as deleted, date_trunc('millisecond', ts) as changed_at,
            date_trunc('millisecond', ts) as created_at,
            case when event_type = 'purchase' then date_trunc('millisecond', ts) + interval 2 days end as shipped_at,
            date_trunc('millisecond', ts) as updated_at from events""",
    "cdc_rejects": """with updates as (select count(*) as n from events where event_type not in ('signup', 'error'))
        select 'unreadable' as reason, count(*) as records from events union all
        select 'incomplete', n from updates union all select 'unfit', 4 * n from updates union all
        select 'none', count(*) from events""",
    "cdc_log_once": f"select id, op, lsn, deleted, changed_at, order_status_id, total_amount from ({CHANGES})",
    "cdc_snapshot_and_log": f"select id, order_status_id, total_amount from ({LATEST}) where not deleted",
    "cdc_order_totals": followed_totals(False),
    "cdc_order_totals_strict": followed_totals(True),
    "cdc_orphans": """select user_id, count(*) as rows from (
            select case when o_orderkey % 4 = 0 then o_custkey + 1 else o_custkey end as user_id from orders where o_orderkey % 7 > 0)
        where user_id not in (select c_custkey from customer where c_custkey % 5 > 0) group by 1""",
    "cdc_history_merged": HISTORY,
    "cdc_stream_state": f"""select id, op, lsn, deleted, changed_at, order_status_id, total_amount from ({LATEST}) where not deleted""",
    "cdc_stream_history": HISTORY,
    "cdc_stream_status_log": HISTORY,
    "cdc_routed": f"""select 'products' as table_name, id, 'r' as op, id as lsn, {NOW} as changed_at, product_price as amount from ({PRODUCTS})
        union all select 'orders', id, op, lsn, changed_at, total_amount from ({CHANGES})""",
}
