"""DuckDB SQL for the registered queries, over the same Parquet tables.

The SQL is written on its own, not derived from the DataFrame code: moves come from their
four rules one by one, ranks from plain windows. Each statement is one WITH chain of the
named parts it needs.
"""

from __future__ import annotations

# Name -> (parts it reads, SQL). The first block maps the test tables, see FIXTURES.md.
PARTS: dict[str, tuple[str, str]] = {
    "headers_all": (
        "",
        """select o_orderkey as id, date '1998-07-01' - cast(o_orderkey % 40 as int) as creation_time,
            case when o_orderstatus = 'P' then 1 else 0 end as order_type, o_orderkey % 40 as age
        from orders""",
    ),
    "lines_all": (
        "",
        """select l_orderkey as originator_header_id, cast(l_linenumber as bigint) as line_no, l_partkey as item_id,
            l_suppkey as supp_id, l_extendedprice as ext, cast(l_quantity as bigint) % 4 + 1
            + case when l_partkey % 4 = 0 then 40 else 0 end + case when l_partkey % 3 = 0 then 15 else 0 end as requested_quantity,
            l_orderkey % 40 as age
        from lineitem""",
    ),
    "headers": (
        "headers_all",
        """select id, creation_time, order_type from headers_all where age <= 12
        union all select id, creation_time, order_type from headers_all where age > 10""",
    ),
    "lines": (
        "lines_all",
        """select * exclude (age) from lines_all where age <= 12
        union select * exclude (age) from lines_all where age > 10""",
    ),
    "products": ("", "select p_partkey as id, lpad(cast(p_partkey as varchar), 8, '0') as system_product_id from part"),
    "assortment": (
        "",
        """select lpad(cast(p_partkey as varchar), 8, '0') as prod_id, p_type || '-' || p_partkey as prod_code,
            case when p_partkey % 4 = 0 then 'Y' else 'N' end as hanging_garment,
            cast(p_size as bigint) as brom_size,
            case when p_partkey % 3 = 0 then 'S' else 'F' end as sor_indicator,
            cast(p_size % 12 + 1 as bigint) as uplb,
            p_size * 7 as length, p_size * 5 as width, p_size * 3 as height,
            cast(round(p_retailprice * 100) as bigint) as selling_price,
            case when p_partkey % 10 = 0 then 0 else 1 end as state
        from part""",
    ),
    "dissections": (
        "",
        """select distinct substr(p_type, 1, 3) as dissection,
            case when substr(p_type, 1, 3) in ('ECO', 'SMA') then 'HOME' else 'FASHION' end as directorate,
            cast(case when substr(p_type, 1, 3) = 'PRO' then 25 else 12 end as bigint) as partner_discount
        from part where p_type <> 'STANDARD'""",
    ),
    "snapshots": (
        "",
        """select cast(l_orderkey % 35 as int) + 1 as age, lpad(cast(l_partkey as varchar), 8, '0') as prod_id,
            cast(l_quantity as bigint) as units
        from lineitem""",
    ),
    "totes": (
        "",
        """select 'T' || l_orderkey || '-' || l_suppkey as licenceplate, l_suppkey as loc_id,
            cast(min(l_linenumber) % 4 as bigint) as cont_type_id, cast(max(l_linenumber) % 3 as bigint) as z_pos
        from lineitem group by l_orderkey, l_suppkey""",
    ),
    "held": (
        "",
        """select 'T' || l_orderkey || '-' || l_suppkey as licenceplate,
            lpad(cast(l_partkey as varchar), 8, '0') as item_number, l_partkey as item_id,
            cast(sum(l_quantity) as bigint) as quantity
        from lineitem where not (l_partkey % 16 = 5 and l_suppkey % 2 = 0) group by l_orderkey, l_suppkey, l_partkey""",
    ),
    "places": (
        "",
        """select s_suppkey as loc_id, case when s_suppkey % 2 = 0 then 'OSR' else 'ASRS' end as location,
            case when s_suppkey % 2 = 0 then 'OSM' else 'ASM' end || lpad(cast(s_suppkey as varchar), 6, '0') as locno
        from supplier join nation on s_nationkey = n_nationkey
        where s_suppkey % 5 <> 4 and n_regionkey <> 4""",
    ),
    "confirmed": (
        "",
        """select lpad(cast(p_partkey as varchar), 8, '0') as prod_id, p_partkey * 37 % 400 + 1 as demand
        from part where p_partkey % 7 = 0""",
    ),
    "forecast": (
        "",
        """select lpad(cast(p_partkey as varchar), 8, '0') as prod_id, p_partkey * 53 % 300 - 60 as forecast
        from part where p_partkey % 3 <> 0""",
    ),
    "shop_sales": (
        "",
        """select lpad(cast(p_partkey as varchar), 8, '0') as item_number,
            cast(p_partkey % 100 as double) / 128 as likelihood, (p_partkey % 9) * cast(0.75 as double) as exp_demand
        from part where p_partkey % 2 = 0""",
    ),
    "transports": (
        "",
        """select 'T' || l_orderkey || '-' || l_suppkey as licenceplate, min(l_orderkey % 3 + 1) as transport_orders
        from lineitem group by l_orderkey, l_suppkey
        having (sum(l_quantity) >= 25 and l_suppkey % 2 = 0) <> (l_orderkey % 11 = 0)""",
    ),
    "messages": (
        "",
        """select rpad(lpad(cast(l_linenumber as varchar), 10, '0'), 38, ' ') as head,
            '199806301715000001HO' || rpad(cast(l_orderkey as varchar), 20, ' ')
            || lpad(cast(l_linenumber as varchar), 5, '0') || lpad(cast(l_partkey as varchar), 8, '0')
            || lpad(cast(cast(l_quantity as bigint) as varchar), 6, '0') || '000001N' || rpad('@note', 50, ' ')
            || 'REF001REF2' as tail,
            case when l_linenumber = 7 then 'xxxxxxxxxx' else lpad(cast(l_partkey % 2000 * 5 as varchar), 10, '0') end as price,
            head || 'ORH   ' || tail || price || '|' || head || 'ORL   ' || tail || price || '|'
            || case when l_linenumber % 3 = 0 then head || 'ORL   ' || tail
                || lpad(cast(l_partkey % 2000 * 5 + 5 as varchar), 10, '0') || '|' else '' end as raw_message
        from lineitem where l_orderkey % 5 = 1""",
    ),
    # Ranked stock.
    "counted": (
        "held totes places",
        """select location, locno, z_pos, count(*) over (partition by item_number, locno, location) as loccount,
            licenceplate, item_number, quantity
        from held join totes using (licenceplate) join places using (loc_id)
        where cont_type_id <> 0""",
    ),
    "ranked": (
        "counted",
        """select *, cast(sum(quantity) over sorted as bigint) as cumunits, row_number() over sorted as itemrank
        from counted
        window sorted as (partition by item_number, location
            order by quantity desc nulls first, loccount desc nulls first, locno, z_pos, licenceplate)""",
    ),
    # Demand and the four rules.
    "demand": (
        "ranked confirmed forecast",
        """select prod_id, demand as exp_demand from confirmed where prod_id in (select item_number from ranked)
        union all
        select f.prod_id, f.forecast from forecast f
        where f.forecast > 0 and not exists (
            select 1 from confirmed c where c.prod_id = f.prod_id
            and exists (select 1 from ranked r where r.item_number = c.prod_id))""",
    ),
    "asked": (
        "ranked demand",
        """select r.*, d.exp_demand, sum(quantity) over (partition by item_number, location) as zone_units
        from ranked r join demand d on r.item_number = d.prod_id""",
    ),
    "rule_no_demand": (
        "ranked demand",
        """select item_number, location, locno, licenceplate, quantity from ranked
        where location = 'OSR' and item_number not in (select prod_id from demand)""",
    ),
    "rule_surplus": (
        "asked",
        """select item_number, location, locno, licenceplate, quantity from asked
        where location = 'OSR' and zone_units >= exp_demand and cumunits >= exp_demand
        qualify row_number() over (partition by item_number order by cumunits, itemrank) > 1""",
    ),
    "short": (
        "asked",
        """select distinct item_number, cast(exp_demand - zone_units as bigint) as required from asked
        where location = 'OSR' and zone_units < exp_demand""",
    ),
    "rule_shortfall": (
        "asked short",
        """select item_number, location, locno, licenceplate, quantity
        from asked join short using (item_number) where location = 'ASRS'
        qualify cumunits < required or row_number() over (
            partition by item_number, cumunits >= required order by cumunits, itemrank) = 1""",
    ),
    "rule_absent": (
        "asked ranked",
        """select item_number, location, locno, licenceplate, quantity from asked
        where location = 'ASRS' and item_number not in (select item_number from ranked where location = 'OSR')
        qualify cumunits < exp_demand or row_number() over (
            partition by item_number, cumunits >= exp_demand order by cumunits, itemrank) = 1""",
    ),
    "instructed": (
        "rule_no_demand rule_surplus rule_shortfall rule_absent",
        """select licenceplate, target_state_name, 'Z-ABIN2BIN' as source_zone_name,
            timestamp '1998-06-30 17:15:00' as "timestamp", cast(10 as bigint) as status
        from (
            select licenceplate, 'Z-MOVE_ASRS' as target_state_name from rule_no_demand
            union all select licenceplate, 'Z-MOVE_ASRS' from rule_surplus
            union all select licenceplate, 'Z-MOVE_OSR' from rule_shortfall
            union all select licenceplate, 'Z-MOVE_OSR' from rule_absent)""",
    ),
    # Demand features.
    "ordered": (
        "headers lines products",
        """select h.creation_time as orderdate, h.order_type, p.system_product_id as prod_id,
            count(distinct h.id) as orders, cast(sum(l.requested_quantity) as bigint) as units,
            date_diff('day', h.creation_time, date '1998-07-01') as age
        from headers h join lines l on h.id = l.originator_header_id join products p on l.item_id = p.id
        where h.order_type = 0 group by all""",
    ),
    # Prices.
    "records": (
        "messages",
        "select unnest(string_split(raw_message, '|')) as r from messages",
    ),
    "parsed": (
        "records",
        """select substr(r, 1, 38) as seqno, substr(r, 39, 6) as recordid, substr(r, 45, 8) as "date",
            substr(r, 53, 6) as "time", try_cast(substr(r, 59, 4) as double) as dc, substr(r, 63, 2) as hostid,
            substr(r, 65, 20) as orderid, try_cast(substr(r, 85, 5) as double) as orderline,
            substr(r, 90, 8) as prodid, try_cast(substr(r, 98, 6) as double) as max_qty,
            try_cast(substr(r, 104, 6) as double) as min_qty, substr(r, 110, 1) as clearind,
            replace(substr(r, 111, 50), '@', '') as glmessage, substr(r, 161, 6) as refno1,
            substr(r, 167, 4) as refno2, try_cast(substr(r, 171, 10) as double) as saleprice
        from records where substr(r, 39, 3) = 'ORL' and try_cast(substr(r, 171, 10) as double) is not null""",
    ),
    "prices": ("parsed", "select prodid, min(saleprice / 100) as saleprice from parsed group by prodid"),
    # Outcomes.
    "stats": (
        "ranked assortment dissections",
        """select date '1998-06-30' as insert_date, r.item_number, licenceplate, locno, location, z_pos, quantity,
            cumunits, itemrank, cast(case when cumunits > 100 then 1 else 0 end as bigint) as classification,
            directorate, hanging_garment, sor_indicator,
            case when cast(r.item_number as bigint) % 11 = 0 then 'KAB'
                else 'G' || cast(r.item_number as bigint) % 5 end as item_group_name
        from ranked r join assortment a on r.item_number = a.prod_id
        left join dissections d on substr(a.prod_code, 1, 3) = d.dissection""",
    ),
    "tote_facts": (
        "stats transports shop_sales confirmed",
        """select s.*, case when c.prod_id is null then coalesce(round(a.likelihood, 4), 0) else 1.0 end as likelihood,
            cast(c.prod_id is not null as bigint) as confirmed,
            cast(coalesce(c.demand, round(a.exp_demand), 0) as bigint) as exp_demand,
            cast(t.licenceplate is not null as bigint) as move
        from stats s left join transports t on s.licenceplate = t.licenceplate
        left join shop_sales a on s.item_number = a.item_number
        left join confirmed c on s.item_number = c.prod_id""",
    ),
    "complete_facts": ("tote_facts", "select * from tote_facts where directorate is not null"),
    "guessed": (
        "complete_facts",
        """select cast(likelihood >= 0.5 as bigint) as said, move as was from complete_facts
        where item_group_name <> 'KAB'""",
    ),
    "cells": (
        "guessed",
        """select *, greatest(tp + fn, tn + fp) as most,
            ((tp + fp) / n) * ((tp + fn) / n) + ((fn + tn) / n) * ((fp + tn) / n) as chance
        from (
            select count(*) filter (said = 1 and was = 1) as tp, count(*) filter (said = 1 and was = 0) as fp,
                count(*) filter (said = 0 and was = 1) as fn, count(*) filter (said = 0 and was = 0) as tn, count(*) as n
            from guessed)""",
    ),
    # Both ends of the exact interval, by halving: the shares where one tail of the binomial sum is 2.5%.
    "bounds": (
        "cells",
        """with recursive halved as (
            select 0 as step, tp + tn as k, n, 0::double as l0, 1::double as l1, 0::double as h0, 1::double as h1 from cells
            union all
            select step + 1, k, n, if(above < 0.025, lm, l0), if(above < 0.025, l1, lm), if(below > 0.025, hm, h0), if(below > 0.025, h1, hm)
            from (
                select *,
                    list_sum(list_transform(range(k, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                        + i * ln(lm) + (n - i) * ln(1 - lm)))) as above,
                    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                        + i * ln(hm) + (n - i) * ln(1 - hm)))) as below
                from (select *, (l0 + l1) / 2 as lm, (h0 + h1) / 2 as hm from halved where step < 50)))
        select (l0 + l1) / 2 as low, (h0 + h1) / 2 as high from halved where step = 50""",
    ),
    "ledger": (
        "instructed",
        "select licenceplate, target_state_name from instructed",
    ),
}


def _features(lag: int) -> dict[str, tuple[str, str]]:
    """Order, stock and joined features; ``lag`` days are added to every age."""
    first = 1 + lag

    def span(days: int) -> str:
        return f"filter (where age between {first} and {days + lag})"

    def average(kind: str, days: int) -> str:
        return f"round(coalesce(sum({kind}) {span(days)}, 0) / {days}, 4) as avg_rep_{kind}_lst{days}"

    def total(kind: str) -> str:
        return f"cast(coalesce(sum({kind}) {span(7)}, 0) as bigint) as rep_{kind}_lst7"

    averages = ", ".join(average(kind, days) for days in (7, 14, 30) for kind in ("orders", "units"))
    zeroed = ", ".join(
        f"coalesce({c}, 0) as {c}"
        for c in ["avg_stock_lst7", "avg_stock_lst14", "avg_stock_lst30", "rep_orders_lst7", "rep_units_lst7"]
        + [f"avg_rep_{kind}_lst{days}" for days in (7, 14, 30) for kind in ("orders", "units")]
    )
    return {
        f"order_part{lag}": (
            "ordered",
            f"""select prod_id, {total('orders')}, {total('units')}, {averages}
            from ordered where age between {first} and {30 + lag} group by prod_id""",
        ),
        f"stock_part{lag}": (
            "snapshots",
            f"""select prod_id, round(avg(stock), 4) as avg_stock_lst7, round(avg(stock) {span(14)}, 4) as avg_stock_lst14,
                round(avg(stock) {span(30)}, 4) as avg_stock_lst30,
                cast(coalesce(max(stock) {span(1)}, 0) as bigint) as current_stock
            from (select age, prod_id, sum(units) as stock from snapshots
                where age between {first} and {30 + lag} group by age, prod_id)
            group by prod_id""",
        ),
        f"features{lag}": (
            f"assortment dissections order_part{lag} stock_part{lag}",
            f"""select date '1998-07-01' - {lag} as insert_date, prod_id, directorate, hanging_garment, brom_size,
                sor_indicator, partner_discount, uplb,
                cast(round(cast(length * width * height as decimal(18, 0)) * 0.000001, 4) as double) as volume,
                cast(selling_price as double) / 100 as selling_price, current_stock, {zeroed}
            from assortment join stock_part{lag} using (prod_id)
            join dissections on dissection = substr(prod_code, 1, 3)
            left join order_part{lag} using (prod_id)
            where state = 1 and current_stock > 0""",
        ),
    }


PARTS.update(_features(0))
PARTS.update(_features(1))
PARTS.update(
    {
        "training": (
            "features1 ordered",
            """select f.*, coalesce(o.units, 0) as sold_rep_units
            from features1 f left join ordered o on f.prod_id = o.prod_id and o.age = 1""",
        ),
        "priced": (
            "features0 prices",
            """select f.* exclude (selling_price), selling_price,
                selling_price - coalesce(nullif(saleprice, 0), selling_price) as reduction
            from features0 f left join prices on f.prod_id = prices.prodid""",
        ),
        "priced_training": (
            "training prices",
            """select f.* exclude (selling_price, sold_rep_units), selling_price,
                selling_price - coalesce(nullif(saleprice, 0), selling_price) as reduction, sold_rep_units
            from training f left join prices on f.prod_id = prices.prodid""",
        ),
    }
)


def statement(final: str, *parts: str) -> str:
    """``final`` behind the WITH chain of ``parts`` and all they read."""
    chain: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in chain:
            needs, sql = PARTS[name]
            for need in needs.split():
                add(need)
            chain[name] = sql

    for part in parts:
        add(part)
    listed = ",\n".join(f"{name} as (\n{sql}\n)" for name, sql in chain.items())
    return f"with {listed}\n{final}"


def whole(part: str) -> str:
    """All rows of one part."""
    return statement(f"select * from {part}", part)


# Model matrix: numbers as they are, every factor level but the first as a flag.
_NUMBERS = (
    "brom_size uplb volume current_stock avg_stock_lst7 avg_stock_lst14 avg_stock_lst30 rep_orders_lst7 rep_units_lst7"
    " avg_rep_orders_lst7 avg_rep_units_lst7 avg_rep_orders_lst14 avg_rep_units_lst14 avg_rep_orders_lst30"
    " avg_rep_units_lst30 selling_price reduction"
).split()
_FLAGS = {"directorate": "'HOME'", "hanging_garment": "'Y'", "sor_indicator": "'S'", "partner_discount": "25"}
_MATRIX = ", ".join(
    [f"cast({c} as double) as x{i}" for i, c in enumerate(_NUMBERS)]
    + [f"cast({f} = {v} as double) as x{len(_NUMBERS) + i}" for i, (f, v) in enumerate(_FLAGS.items())]
)
_WIDTH = len(_NUMBERS) + len(_FLAGS)


def _per_column(template: str, joiner: str = ", ") -> str:
    return joiner.join(template.format(i=i) for i in range(_WIDTH))


_SQUARES = _per_column("coalesce(power((t.x{i} - q.x{i}) / nullif(s.s{i}, 0), 2), 0)", " + ")
_FOLD = "cast(('0x' || substr(md5('101-' || r || '|' || prod_id), 1, 8)) as bigint) % 10 + r * 10"

PARTS.update(
    {
        "train_x": ("priced_training", f"select prod_id, sold_rep_units as label, {_MATRIX} from priced_training"),
        "query_x": ("priced", f"select prod_id, {_MATRIX} from priced"),
        "spread": ("train_x", f"select {_per_column('stddev_samp(x{i}) as s{i}')} from train_x"),
        "near": (
            "train_x query_x spread",
            f"""select q.prod_id, t.label, row_number() over (partition by q.prod_id
                order by round(sqrt({_SQUARES}), 9), t.prod_id) as place
            from query_x q cross join train_x t cross join spread s""",
        ),
        "fold_x": (
            "train_x",
            f"select {_FOLD} as fold, t.* from train_x t cross join (select unnest(range(3)) as r)",
        ),
        "fold_spread": (
            "fold_x",
            f"""select h.fold, {_per_column('stddev_samp(t.x{i}) as s{i}')}
            from (select distinct fold from fold_x) h join fold_x t
                on t.fold <> h.fold and t.fold // 10 = h.fold // 10
            group by h.fold""",
        ),
        "fold_near": (
            "fold_x fold_spread",
            f"""select q.fold, q.prod_id, q.label as sold, t.label, row_number() over (partition by q.fold, q.prod_id
                order by round(sqrt({_SQUARES}), 9), t.prod_id) as place
            from fold_x q join fold_x t on t.fold <> q.fold and t.fold // 10 = q.fold // 10
            join fold_spread s on s.fold = q.fold""",
        ),
        "tuning": (
            "fold_near",
            """select k, avg(error) as rmse from (
                select fold, k, sqrt(avg(power(guess - sold, 2))) as error from (
                    select fold, prod_id, k, any_value(sold) as sold, avg(label) as guess
                    from fold_near join (values (5), (7), (9)) c(k) on place <= k group by fold, prod_id, k)
                group by fold, k)
            group by k""",
        ),
        "tuned": (
            "near tuning",
            """select prod_id, avg(label) as prediction from near
            where place <= (select k from tuning order by rmse, k limit 1) group by prod_id""",
        ),
        "foreseen": (
            "tuned",
            """select prod_id, cast(round_even(prediction, 0) as bigint) as forecast from tuned
            where round_even(prediction, 0) > 0""",
        ),
        "centre": ("train_x", f"select avg(label) as y, {_per_column('avg(x{i}) as m{i}, stddev_samp(x{i}) as s{i}')} from train_x"),
        "train_z": (
            "train_x centre",
            f"select label - y as label, {_per_column('coalesce((x{i} - m{i}) / nullif(s{i}, 0), 0) as z{i}')} from train_x, centre",
        ),
        "query_z": (
            "query_x centre",
            f"select prod_id, {_per_column('coalesce((x{i} - m{i}) / nullif(s{i}, 0), 0) as z{i}')} from query_x, centre",
        ),
        "weights": ("train_z", f"select {_per_column('sum(z{i} * label) as w{i}')} from train_z"),
        "step": (
            "train_z weights",
            f"""select any_value({_per_column('w{i} * w{i}', ' + ')}) / sum(power({_per_column('z{i} * w{i}', ' + ')}, 2)) as step
            from train_z, weights""",
        ),
    }
)


def _pls_parts() -> dict[str, tuple[str, str]]:
    """Partial least squares with one to three components, for every fold, and as group 30 for all rows.

    Its fit is least squares on u1, u2, u3: scores of the weights s, Gs and GGs, each scaled to length 1.
    """
    columns = _per_column("x{i}")
    own = "select f, prod_id, label, y, " + _per_column("coalesce((x{i} - m{i}) / nullif(s{i}, 0), 0) as z{i}")
    parts = {
        "pls_rows": (
            "fold_x train_x",
            f"""select h.fold as f, t.prod_id, t.label, {_per_column('t.x{i}')} from (select distinct fold from fold_x) h
            join fold_x t on t.fold <> h.fold and t.fold // 10 = h.fold // 10
            union all select 30, prod_id, label, {columns} from train_x""",
        ),
        "pls_asked": (
            "fold_x query_x",
            f"""select fold as f, prod_id, label, {columns} from fold_x
            union all select 30, prod_id, null, {columns} from query_x""",
        ),
        "pls_scale": (
            "pls_rows",
            f"select f, avg(label) as y, {_per_column('avg(x{i}) as m{i}, stddev_samp(x{i}) as s{i}')} from pls_rows group by f",
        ),
        "pls_scores0": ("pls_rows pls_scale", f"{own}, label - y as u0 from pls_rows join pls_scale using (f)"),
        "pls_guess0": ("pls_asked pls_scale", f"{own} from pls_asked join pls_scale using (f)"),
    }
    for c in (1, 2, 3):
        raw, length = _per_column(f"sum(z{{i}} * u{c - 1}) as v{{i}}"), _per_column("v{i} * v{i}", " + ")
        score = _per_column(f"z{{i}} * w{c}_{{i}}", " + ")
        parts[f"pls_weights{c}"] = (
            f"pls_scores{c - 1}",
            f"""select f, {_per_column(f'v{{i}} / sqrt({length}) as w{c}_{{i}}')}
            from (select f, {raw} from pls_scores{c - 1} group by f)""",
        )
        for kind in ("scores", "guess"):
            parts[f"pls_{kind}{c}"] = (
                f"pls_{kind}{c - 1} pls_weights{c}",
                f"select p.*, {score} as u{c} from pls_{kind}{c - 1} p join pls_weights{c} using (f)",
            )
    sums = ", ".join(f"sum(u{a} * u{b}) as g{a}{b}" for a in range(4) for b in range(max(a, 1), 4))
    det = "(g11 * (g22 * g33 - g23 * g23) - g12 * (g12 * g33 - g23 * g13) + g13 * (g12 * g23 - g22 * g13))"
    parts["pls_sums"] = ("pls_scores3", f"select f, {sums} from pls_scores3 group by f")
    parts["pls_lines"] = (
        "pls_guess3 pls_sums",
        f"""select f, prod_id, label, y + u1 * g01 / g11 as p1,
            y + (u1 * (g01 * g22 - g02 * g12) + u2 * (g11 * g02 - g12 * g01)) / (g11 * g22 - g12 * g12) as p2,
            y + (u1 * (g01 * (g22 * g33 - g23 * g23) - g12 * (g02 * g33 - g23 * g03) + g13 * (g02 * g23 - g22 * g03))
                + u2 * (g11 * (g02 * g33 - g23 * g03) - g01 * (g12 * g33 - g23 * g13) + g13 * (g12 * g03 - g02 * g13))
                + u3 * (g11 * (g22 * g03 - g02 * g23) - g12 * (g12 * g03 - g02 * g13) + g01 * (g12 * g23 - g22 * g13))) / {det} as p3
        from pls_guess3 join pls_sums using (f)""",
    )
    parts["pls_errors"] = (
        "pls_lines",
        """select avg(e1) as e1, avg(e2) as e2, avg(e3) as e3 from (
            select sqrt(avg(power(p1 - label, 2))) as e1, sqrt(avg(power(p2 - label, 2))) as e2,
                sqrt(avg(power(p3 - label, 2))) as e3
            from pls_lines where f < 30 group by f)""",
    )
    return parts


PARTS.update(_pls_parts())

_ROW = "select item_number, location, locno, licenceplate, quantity from"
_HASH = "md5('{seed}|' || insert_date || '|' || licenceplate || '|' || item_number)"
_INSTRUCTION = "licenceplate, target_state_name, source_zone_name, \"timestamp\", status"

ORACLES: dict[str, str] = {
    "tote_stock": whole("ranked"),
    "expected_demand": whole("demand"),
    "osr_shortfall": whole("short"),
    "moves_no_demand": whole("rule_no_demand"),
    "moves_surplus": whole("rule_surplus"),
    "moves_shortfall": whole("rule_shortfall"),
    "moves_absent": whole("rule_absent"),
    "moves": whole("instructed"),
    "write_moves": whole("instructed"),
    "moves_to_osr": statement("select * from instructed where target_state_name = 'Z-MOVE_OSR'", "instructed"),
    "moves_to_asrs": statement("select * from instructed where target_state_name = 'Z-MOVE_ASRS'", "instructed"),
    "moves_distinct": statement("select distinct * from instructed", "instructed"),
    "move_outcomes": statement(
        "select i.*, t.transport_orders from instructed i left join transports t using (licenceplate)",
        "instructed",
        "transports",
    ),
    "ledger_insert": whole("ledger"),
    "ledger_delete": statement("select * from ledger where target_state_name <> 'Z-MOVE_OSR'", "ledger"),
    "ledger_delete_all": statement("select * from ledger where target_state_name = 'Z-MOVE_OSR'", "ledger"),
    "ledger_frames": statement("select * from ledger where target_state_name <> 'Z-MOVE_OSR'", "ledger"),
    "tote_product_lookup": statement(
        """select licenceplate, (select string_agg(item_number, ',' order by item_number) from (
            select distinct item_number from ranked r where r.licenceplate = i.licenceplate)) as prod_ids
        from instructed i""",
        "instructed",
        "ranked",
    ),
    "merge_live_archive": whole("lines"),
    "merge_headers": whole("headers"),
    "merge_headers_deduped": statement("select distinct * from headers", "headers"),
    "daily_orders": statement("select * exclude (age) from ordered where age between 1 and 30", "ordered"),
    "order_features": whole("order_part0"),
    "stock_features": whole("stock_part0"),
    "stock_features_fixed": statement(
        """select p.* exclude (avg_stock_lst7), (select round(avg(stock), 4) from (
            select sum(units) as stock from snapshots s where s.prod_id = p.prod_id and age between 1 and 7
            group by age)) as avg_stock_lst7
        from stock_part0 p""",
        "stock_part0",
        "snapshots",
    ),
    "demand_features": whole("features0"),
    "refresh_features": whole("features0"),
    "features_of_days": whole("features0"),
    "training_features_of_days": whole("features1"),
    "training_features": whole("features1"),
    "training_set": whole("training"),
    "refresh_training": whole("training"),
    "average_daily_sales": statement(
        """select prod_id, 'SHOP' as order_type, round(count(*) / 30, 4) as likelihood,
            round(sum(units) / 30, 4) as exp_demand
        from ordered where age between 1 and 30 group by prod_id""",
        "ordered",
    ),
    "order_day_messages": statement("select raw_message from messages", "messages"),
    "price_lines": whole("parsed"),
    "price_lines_stream": whole("parsed"),
    "price_lines_trimmed": statement(
        """select * replace (trim(seqno, ' ') as seqno, trim(recordid, ' ') as recordid, trim(orderid, ' ') as orderid,
            trim(glmessage, ' ') as glmessage)
        from parsed""",
        "parsed",
    ),
    "min_sale_price": whole("prices"),
    "least_prices_stream": statement(
        "select prodid, min(saleprice / 100) as saleprice, count(*) as lines from parsed group by prodid", "parsed"
    ),
    "priced_features": whole("priced"),
    "level_effects": statement(
        """select item_id, n as rows, round(n * (a - m) / (n + 10), 6) as effect
        from (select item_id, count(*) as n, avg(requested_quantity) as a from lines group by item_id),
            (select sum(n * 10.0 / (n + 10) * a) / sum(n * 10.0 / (n + 10)) as m
            from (select item_id, count(*) as n, avg(requested_quantity) as a from lines group by item_id))""",
        "lines",
    ),
    "knn_forecast_nine": statement(
        "select prod_id, avg(label) as prediction from near where place <= 9 group by prod_id", "near"
    ),
    "knn_stored": statement("select prod_id, avg(label) as prediction from near where place <= 9 group by prod_id", "near"),
    "knn_candidates": statement(
        "select prod_id, cast(9 as bigint) as neighbours, cast(0 as bigint) as wrong from query_x where (select count(*) from train_x) >= 9",
        "query_x",
        "train_x",
    ),
    "knn_forecast": whole("tuned"),
    "knn_cross_validation": statement("select cast(k as bigint) as k, round(rmse, 6) as rmse from tuning", "tuning"),
    "forecast_demand": whole("foreseen"),
    "pls_one_component": statement(
        f"""select prod_id, round(y + step * ({_per_column('z{i} * w{i}', ' + ')}), 6) as prediction
        from query_z, centre, weights, step""",
        "query_z",
        "weights",
        "step",
    ),
    "pls_forecast": statement(
        """select prod_id, round(case when e1 <= e2 and e1 <= e3 then p1 when e2 <= e3 then p2 else p3 end, 4) as prediction
        from pls_lines, pls_errors where f = 30""",
        "pls_lines",
        "pls_errors",
    ),
    "pls_stored": statement(
        """select prod_id, round(case when e1 <= e2 and e1 <= e3 then p1 when e2 <= e3 then p2 else p3 end, 4) as prediction
        from pls_lines, pls_errors where f = 30""",
        "pls_lines",
        "pls_errors",
    ),
    "rmse": statement("select round(sqrt(avg(power(avg_rep_units_lst7 - sold_rep_units, 2))), 6) as rmse from training", "training"),
    "tote_features": whole("tote_facts"),
    "drop_incomplete": whole("complete_facts"),
    "balanced_sample": statement(
        f"""select * from (
            select * from tote_facts
            qualify row_number() over (partition by move order by {_HASH.format(seed=101)}) <= 10000)
        where directorate is not null""",
        "tote_facts",
    ),
    "balanced_sample_small": statement(
        f"""select * from (
            select * from tote_facts
            qualify row_number() over (partition by move order by {_HASH.format(seed=101)}) <= 1000)
        where directorate is not null""",
        "tote_facts",
    ),
    "tote_holdout": statement(
        f"""select count(*) as rows, cast(sum(move) as bigint) as positives from (
            select *, row_number() over (partition by move order by {_HASH.format(seed=102)})
                <= ceil(0.8 * count(*) over (partition by move)) as in_train
            from (
                select * from tote_facts
                qualify row_number() over (partition by move order by {_HASH.format(seed=101)}) <= 10000)
            where directorate is not null)
        where not in_train""",
        "tote_facts",
    ),
    "tote_back_test_rows": statement(
        "select count(*) as rows, cast(sum(was) as bigint) as positives from guessed", "guessed"
    ),
    "stratified_split": statement(
        f"""select insert_date, licenceplate, item_number, move,
            row_number() over (partition by move order by {_HASH.format(seed=102)})
                <= ceil(0.8 * count(*) over (partition by move)) as in_train
        from tote_facts""",
        "tote_facts",
    ),
    "resampling_folds": statement(
        f"""select cast(cast('0x' || substr({_HASH.format(seed='102-0')}, 1, 8) as bigint) % 10 as int) as fold, count(*) as n
        from tote_facts group by fold""",
        "tote_facts",
    ),
    "confusion_counts": statement("select said as prediction, was as observed, count(*) as n from guessed group by all", "guessed"),
    "confusion_matrix": statement(
        """select * replace (round(accuracy_low, 9) as accuracy_low, round(accuracy_high, 9) as accuracy_high)
        from (
            select tp, fp, fn, tn, round((tp + tn) / n, 9) as accuracy,
                round(((tp + tn) / n - chance) / (1 - chance), 9) as kappa,
                round(tp / (tp + fn), 9) as sensitivity, round(tn / (tn + fp), 9) as specificity,
                round(tp / (tp + fp), 9) as pos_pred_value, round(tn / (tn + fn), 9) as neg_pred_value,
                round((tp + fn) / n, 9) as prevalence, round(tp / n, 9) as detection_rate, round((tp + fp) / n, 9) as detection_prevalence,
                round((tp / (tp + fn) + tn / (tn + fp)) / 2, 9) as balanced_accuracy,
                bounds.low as accuracy_low, bounds.high as accuracy_high, round(most / n, 9) as no_information_rate,
                round(least(list_sum(list_transform(range(tp + tn, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                    + i * ln(most / n) + (n - i) * ln(1 - most / n)))), 1), 9) as accuracy_p,
                -- the normal tail by Simpson's rule, over twelve deviations
                round(case when fp = fn then 1 else 2 / sqrt(2 * pi()) * list_sum(list_transform(range(24001), lambda i:
                    exp(-power((abs(fp - fn) - 1) / sqrt(fp + fn) + i / 2000, 2) / 2)
                    * case when i in (0, 24000) then 1 when i % 2 = 1 then 4 else 2 end)) / 6000 end, 9) as mcnemar_p
            from cells, bounds)""",
        "cells",
        "bounds",
    ),
}


def _with_foreseen() -> str:
    """All moves, with demand from the tuned forecast instead of the stand-in."""
    stand_in = PARTS["forecast"]
    PARTS["forecast"] = ("foreseen", "select prod_id, forecast from foreseen")
    try:
        return whole("instructed")
    finally:
        PARTS["forecast"] = stand_in


ORACLES["daily_move_plan"] = _with_foreseen()
