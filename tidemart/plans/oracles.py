"""The same results as plain SQL over the same tables, for DuckDB.

Each query names the common table expressions it needs; ``all_oracles`` writes them out in
front of it.
"""

from __future__ import annotations

from tidemart import bind

HOUR, DAY = 3_600_000, 86_400_000


def _text(millis: str) -> str:
    return f"strftime(make_timestamp(({millis}) * 1000), '%Y-%m-%d %H:%M:%S')"


def _window(millis: str, width: int) -> str:
    return f"(({millis}) // {width}) * {width}"


def _name_id(column: str) -> str:
    return f"cast('0x' || substr(md5({column}), 1, 15) as bigint)"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "pl": ((), """
        select event_id, cast(user_id as varchar) mid, cast(user_id % 3 as varchar) vc,
               cast(user_id % 5 as varchar) ch, cast(user_id % 25 as varchar) ar,
               case when user_id % 2 = 0 then '1' else '0' end is_new,
               case when event_type = 'click' then 'good_detail' else event_type end page_id,
               case when event_type in ('signup', 'view') then null
                    when event_type = 'click' then 'search' else 'home' end last_page_id,
               json_extract_string(props, '$.k') item, 'sku_id' item_type,
               cast(floor(value * 1000) as bigint) during_time,
               event_id % 3 n_displays, epoch_us(ts) // 1000 ts
        from events"""),
    "fixed": (("pl",), """
        select * replace (case when is_new = '1' and row_number() over (
                   partition by mid, is_new order by ts, event_id) > 1
               then '0' else is_new end as is_new)
        from pl"""),
    "uv": (("fixed",), f"""
        select * from fixed where last_page_id is null
        qualify row_number() over (partition by mid, ts // {DAY} order by ts, event_id) = 1"""),
    "ahead": (("fixed",), """
        select *, lead(ts) over w next_ts, lead(last_page_id is null) over w next_entry
        from fixed window w as (partition by mid order by ts, event_id)"""),
    "bounce": (("ahead",), f"""
        select * exclude (next_ts, next_entry),
               case when next_ts is null or next_ts - ts >= {6 * HOUR} then 'timeout'
                    else 'matched' end bounce_kind
        from ahead
        where last_page_id is null
          and (next_ts is null or next_ts - ts >= {6 * HOUR} or next_entry)"""),
    # The log text, written as the JSON writer does: nulls are left out.
    "raw": (("pl",), """
        select *, case when event_id % 97 = 0 then substr(line, 1, 40) else line end "value",
               case when event_id % 97 = 0 then 'not_json'
                    when event_id % 89 = 0 then 'no_common'
                    when event_id % 83 = 0 then 'no_ts' end reason
        from (
            select *, '{' || case when event_id % 89 <> 0 then common || ',' else '' end
                   || rtrim(body || case when event_id % 50 = 0 then '"start":{"entry":"icon"},' else '' end, ',')
                   || case when event_id % 83 <> 0 then ',"ts":' || ts else '' end || '}' line
            from (
                select *, '"common":{"mid":"' || mid || '","vc":"' || vc || '","ch":"' || ch
                          || '","ar":"' || ar || '","is_new":"' || is_new || '"}' common,
                       '"page":{"page_id":"' || page_id || '",'
                       || coalesce('"last_page_id":"' || last_page_id || '",', '')
                       || '"item":"' || item || '","item_type":"sku_id","during_time":'
                       || during_time || '},"displays":['
                       || case n_displays when 0 then ''
                          when 1 then '{"item":"' || item || '","item_type":"sku_id"}'
                          else '{"item":"' || item || '","item_type":"sku_id"},{"item":"'
                               || (cast(item as int) + 1) || '","item_type":"sku_id"}' end
                       || '],' body
                from pl))"""),
    "clean": (("raw",), """
        select event_id, mid, vc, ch, ar, is_new, page_id, last_page_id, item, item_type,
               during_time, n_displays, ts,
               case when event_id % 50 = 0 then '{"entry":"icon"}' end "start", body
        from raw where reason is null"""),
    "clean_fixed": (("clean",), """
        select * replace (case when is_new = '1' and row_number() over (
                   partition by mid, is_new order by ts, event_id) > 1
               then '0' else is_new end as is_new)
        from clean"""),
    "shown": (("pl",), """
        select event_id, page_id, ts, cast(cast(item as int) + n as varchar) item, item_type
        from pl, (values (0), (1)) v(n) where n < n_displays"""),
    "oi": ((), """
        select o_orderkey id, cast(c_nationkey as bigint) province_id,
               o_orderstatus order_status, o_custkey user_id,
               cast(o_totalprice as decimal(16,2)) total_amount,
               cast(o_orderkey % 7 as decimal(16,2)) activity_reduce_amount,
               cast(o_orderkey % 5 as decimal(16,2)) coupon_reduce_amount,
               cast(cast(o_totalprice as decimal(16,2)) + o_orderkey % 7 + o_orderkey % 5
                    as decimal(16,2)) original_total_amount,
               cast(o_orderkey % 11 as decimal(16,2)) feight_fee,
               strftime(o_orderdate + to_hours(o_orderkey % 24), '%Y-%m-%d %H:%M:%S') create_time,
               epoch_ms(o_orderdate) + (o_orderkey % 24) * 3600000 create_ts
        from orders left join customer on o_custkey = c_custkey"""),
    "od": ((), """
        select l_orderkey * 10 + l_linenumber id, l_orderkey order_id, l_partkey sku_id,
               cast(l_extendedprice as decimal(16,2)) order_price,
               cast(l_quantity as bigint) sku_num, 'sku ' || l_partkey sku_name,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') create_time,
               cast(round(cast(l_extendedprice as decimal(16,2))
                    * (1 - cast(l_discount as decimal(3,2))), 2) as decimal(16,2)) split_total_amount,
               cast(l_linenumber % 3 as decimal(16,2)) split_activity_amount,
               cast(l_linenumber % 2 as decimal(16,2)) split_coupon_amount,
               epoch_ms(l_shipdate) create_ts, l_returnflag, l_linestatus
        from lineitem"""),
    "joined": (("oi", "od"), f"""
        select d.id detail_id, o.id order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
               o.province_id, o.order_status, o.user_id, o.total_amount,
               o.activity_reduce_amount, o.coupon_reduce_amount, o.original_total_amount,
               o.feight_fee, d.split_activity_amount, d.split_coupon_amount,
               d.split_total_amount, o.create_time, substr(o.create_time, 1, 10) create_date,
               substr(o.create_time, 12, 2) create_hour, o.create_ts
        from oi o join od d on o.id = d.order_id
         and d.create_ts between o.create_ts - {120 * DAY} and o.create_ts + {120 * DAY}"""),
    "du": ((), """
        select c_custkey id, case when c_custkey % 2 = 0 then 'F' else 'M' end gender,
               date '1960-01-01' + cast(c_custkey % 15000 as integer) birthday
        from customer"""),
    "dp": ((), """
        select n_nationkey id, n_name name, 'area-' || n_nationkey area_code,
               'CN-' || n_nationkey iso_code, r_name || '-' || n_nationkey iso_3166_2
        from nation left join region on n_regionkey = r_regionkey"""),
    "spu": ((), f"select distinct p_name spu_name, {_name_id('p_name')} id from part"),
    "tm": ((), f"select distinct p_brand tm_name, {_name_id('p_brand')} id from part"),
    "c3": ((), f"select distinct p_type name, {_name_id('p_type')} id from part"),
    "sku": (("spu", "tm", "c3"), """
        select p_partkey id, p_name || ' ' || p_size sku_name,
               cast(p_retailprice as decimal(16,2)) price, spu.id spu_id, tm.id tm_id,
               c3.id category3_id, spu_name, tm_name, c3.name category3_name
        from part join spu on p_name = spu_name join tm on p_brand = tm_name
        join c3 on p_type = c3.name"""),
    "wide": (("joined", "du", "dp", "sku"), """
        select j.* exclude (sku_name, create_ts), k.sku_name,
               cast(null as decimal(16,2)) split_feight_fee, cast(null as varchar) expire_time,
               cast(null as varchar) operate_time, dp.name province_name,
               dp.area_code province_area_code, dp.iso_code province_iso_code,
               dp.iso_3166_2 province_3166_2_code,
               cast(floor(date_diff('day', birthday, date '2024-01-31') / 365) as integer) user_age,
               du.gender user_gender, k.spu_id, k.tm_id, k.category3_id, k.spu_name, k.tm_name,
               k.category3_name, j.create_ts
        from joined j left join du on j.user_id = du.id left join dp on j.province_id = dp.id
        left join sku k on j.sku_id = k.id"""),
    "pay": ((), """
        select o_orderkey id, o_orderkey order_id, o_custkey user_id,
               cast(o_totalprice as decimal(16,2)) total_amount, 'order ' || o_orderkey subject,
               cast(1101 + o_orderkey % 3 as varchar) payment_type,
               strftime(moment, '%Y-%m-%d %H:%M:%S') create_time,
               strftime(moment + interval 1 minute, '%Y-%m-%d %H:%M:%S') callback_time,
               epoch_ms(moment) create_ts
        from (select *, o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 20) moment
              from orders where o_orderstatus = 'F')"""),
    "paid": (("joined", "pay"), """
        select j.*, p.id payment_id, p.create_time payment_create_time, p.create_ts paid_ts
        from pay p join joined j on p.order_id = j.order_id
         and j.create_ts between p.create_ts - 900000 and p.create_ts + 5000"""),
    "pr": (("pl", "shown", "joined", "paid", "od"), """
        select cast(item as bigint) sku_id, ts, 'click' k, null amount, null num, null id
        from pl where page_id = 'good_detail'
        union all select cast(item as bigint), ts, 'display', null, null, null from shown
        union all select event_id % 200, epoch_ms(date_trunc('second', ts)), 'favor', null, null, null
        from events where event_type = 'click' and event_id % 71 <> 0
        union all select event_id % 200, epoch_ms(date_trunc('second', ts)), 'cart', null, null, null
        from events where event_type = 'purchase' and event_id % 71 <> 0
        union all select sku_id, create_ts, 'order', split_total_amount, sku_num, order_id from joined
        union all select sku_id, paid_ts, 'paid', split_total_amount, null, order_id from paid
        union all select sku_id, create_ts, 'refund', split_total_amount, null, order_id
        from od where l_returnflag = 'R'
        union all select sku_id, create_ts,
               case when l_linestatus = 'F' then 'good' else 'comment' end, null, null, null
        from od where l_returnflag = 'A'"""),
    "ps": (("pr", "sku"), f"""
        select {_text('w')} stt, {_text(f'w + {DAY}')} edt, s.*, sku_name, price sku_price,
               spu_id, spu_name, tm_id, tm_name, category3_id, category3_name
        from (
            select {_window('ts', DAY)} w, sku_id,
                   count(*) filter (k = 'display') display_ct,
                   count(*) filter (k = 'click') click_ct,
                   count(*) filter (k = 'favor') favor_ct,
                   count(*) filter (k = 'cart') cart_ct,
                   cast(coalesce(sum(num), 0) as bigint) order_sku_num,
                   cast(coalesce(sum(amount) filter (k = 'order'), 0) as decimal(38,2)) order_amount,
                   count(distinct id) filter (k = 'order') order_ct,
                   cast(coalesce(sum(amount) filter (k = 'paid'), 0) as decimal(38,2)) payment_amount,
                   count(distinct id) filter (k = 'paid') paid_order_ct,
                   count(distinct id) filter (k = 'refund') refund_order_ct,
                   cast(coalesce(sum(amount) filter (k = 'refund'), 0) as decimal(38,2)) refund_amount,
                   count(*) filter (k in ('comment', 'good')) comment_ct,
                   count(*) filter (k = 'good') good_comment_ct, min(ts) ts
            from pr group by 1, 2) s
        left join sku on s.sku_id = sku.id"""),
    "vr": (("fixed", "uv", "bounce"), """
        select vc, ch, ar, is_new, 0 uv_ct, 1 pv_ct,
               case when last_page_id is null then 1 else 0 end sv_ct, 0 uj_ct,
               during_time dur_sum, ts from fixed
        union all select vc, ch, ar, is_new, 1, 0, 0, 0, 0, ts from uv
        union all select vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts from bounce"""),
    "vs": (("vr",), f"""
        select {_text('w')} stt, {_text(f'w + {HOUR}')} edt, * exclude (w) from (
            select {_window('ts', HOUR)} w, vc, ch, ar, is_new,
                   cast(sum(uv_ct) as bigint) uv_ct, cast(sum(pv_ct) as bigint) pv_ct,
                   cast(sum(sv_ct) as bigint) sv_ct, cast(sum(uj_ct) as bigint) uj_ct,
                   cast(sum(dur_sum) as bigint) dur_sum, min(ts) ts
            from vr group by all)"""),
    "pv": (("wide",), f"""
        select {_text('w')} stt, {_text(f'w + {DAY}')} edt, * exclude (w) from (
            select {_window('create_ts', DAY)} w, province_id, province_name,
                   province_area_code, province_iso_code, province_3166_2_code,
                   cast(sum(split_total_amount) as decimal(38,2)) order_amount,
                   count(distinct order_id) order_count
            from wide group by all)"""),
    "kw": (("pl",), f"""
        select item keyword, count(*) ct, 'SEARCH' "source", {_text('w')} stt,
               {_text(f'w + {HOUR}')} edt
        from (select item, {_window('ts // 1000 * 1000', HOUR)} w from pl
              where last_page_id = 'search')
        group by item, w"""),
    "chg": ((), """
        select 'shop' db, tbl, "offset", op, before, after from (
            select 'user_info' tbl, c_custkey * 3 "offset",
                   case when c_custkey % 10 = 0 then 'r' else 'c' end op, '{}' before,
                   '{"id":"' || c_custkey || '","name":"' || c_name || '","segment":"'
                   || c_mktsegment || '","nation":"' || c_nationkey || '"}' after from customer
            union all
            select 'user_info', c_custkey * 3 + 1, 'u',
                   '{"id":"' || c_custkey || '","name":"' || c_name || '","segment":"'
                   || c_mktsegment || '","nation":"' || c_nationkey || '"}',
                   '{"id":"' || c_custkey || '","name":"' || c_name || '","segment":"'
                   || lower(c_mktsegment) || '","nation":"' || c_nationkey || '"}'
            from customer where c_custkey % 7 = 0
            union all
            select 'user_info', c_custkey * 3 + 2, 'd',
                   '{"id":"' || c_custkey || '","name":"' || c_name || '","segment":"'
                   || case when c_custkey % 7 = 0 then lower(c_mktsegment) else c_mktsegment end
                   || '","nation":"' || c_nationkey || '"}', '{}'
            from customer where c_custkey % 31 = 0
            union all
            select 'order_info', o_orderkey, 'c', '{}', '{"id":"' || o_orderkey
                   || '","user_id":"' || o_custkey || '","order_status":"' || o_orderstatus || '"}'
            from orders
            union all
            select 'base_province', n_nationkey, 'c', '{}',
                   '{"id":"' || n_nationkey || '","name":"' || n_name || '"}' from nation
            union all
            select 'base_region', r_regionkey, 'c', '{}',
                   '{"id":"' || r_regionkey || '","name":"' || r_name || '"}' from region)"""),
    "norm": (("chg",), """
        select "offset", db as "database", tbl "tableName", before, after,
               case op when 'u' then 'update' when 'd' then 'delete' else 'insert' end "type"
        from chg"""),
    "cut_users": ((), """
        select "offset", 'user_info' "tableName", "type", 'dim_user_info' "sinkTable", id,
               '{"id":"' || id || '","name":"' || name || '","segment":"' || segment || '"}' after,
               name, segment
        from (
            select c_custkey * 3 "offset", 'insert' "type", c_custkey id, c_name name,
                   c_mktsegment segment from customer
            union all
            select c_custkey * 3 + 1, 'update', c_custkey, c_name, lower(c_mktsegment)
            from customer where c_custkey % 7 = 0)"""),
    "users_now": (("cut_users",), """
        select cast(id as varchar) id, name, segment from cut_users
        qualify row_number() over (partition by id order by "offset" desc) = 1"""),
    "tail": ((), """
        select 'capture.shop.user_info' topic, o "offset", '{"before":'
               || case when op = 'u' then plain else now end || ','
               || case when op = 'u' then '"after":' || now || ',' else '' end
               || '"source":{"db":"shop","table":"user_info"},"op":"' || op || '","ts_ms":' || o || '}' "value"
        from (
            select c_custkey * 3 + step o, case step when 1 then 'u' else 'd' end op,
                   '{"id":' || c_custkey || ',"name":"' || c_name || '","segment":"' || c_mktsegment
                   || '","nation":' || c_nationkey || '}' plain,
                   '{"id":' || c_custkey || ',"name":"' || c_name || '","segment":"'
                   || case when c_custkey % 7 = 0 then lower(c_mktsegment) else c_mktsegment end
                   || '","nation":' || c_nationkey || '}' now
            from customer, (values (1), (2)) v(step)
            where (step = 1 and c_custkey % 7 = 0) or (step = 2 and c_custkey % 31 = 0))"""),
    "views": ((), """
        select cast(user_id as varchar) id, epoch_us(ts) // 1000 ts, cast(floor(value * 100) as bigint) vc,
               event_id from events where event_type = 'view'"""),
    "clicks": ((), """
        select cast(user_id as varchar) id, epoch_us(ts) // 1000 ts, cast(floor(value * 100) as bigint) vc,
               event_id from events where event_type = 'click'"""),
}

_PAIR = """l.id l_id, l.ts l_ts, l.vc l_vc, l.event_id l_event_id,
           r.id r_id, r.ts r_ts, r.vc r_vc, r.event_id r_event_id"""
_NEAR = f"l.id = r.id and r.ts between l.ts - {HOUR} and l.ts + {HOUR}"
_FLAT = """event_id, mid, vc, ch, ar, is_new, page_id, last_page_id, item, item_type,
           during_time, n_displays, ts"""
_JOINED = """detail_id, order_id, sku_id, order_price, sku_num, sku_name, province_id, order_status,
    user_id, total_amount, activity_reduce_amount, coupon_reduce_amount, original_total_amount,
    feight_fee, split_activity_amount, split_coupon_amount, split_total_amount, create_time,
    create_date, create_hour"""
_VS = "stt, edt, vc, ch, ar, is_new, uv_ct, pv_ct, sv_ct, uj_ct, dur_sum, ts"
_PS = """stt, edt, sku_id, sku_name, sku_price, spu_id, spu_name, tm_id, tm_name, category3_id,
    category3_name, display_ct, click_ct, favor_ct, cart_ct, order_sku_num, order_amount, order_ct,
    payment_amount, paid_order_ct, refund_order_ct, refund_amount, comment_ct, good_comment_ct, ts"""
_SALES = "stt >= '1997-01-01 00:00:00' and stt < '1999-01-01 00:00:00'"
_VISIT = "stt >= '2024-01-15 00:00:00' and stt < '2024-01-16 00:00:00'"
_DETAIL = """select l_orderkey order_id, l_partkey sku_id, cast(l_quantity as bigint) sku_num
             from lineitem"""

# Tokens of a text t: runs, and the parts of runs that mix letters and digits.
def _tokens(text: str) -> str:
    runs = f"regexp_extract_all(lower({text}), '[a-z0-9]+')"
    mixed = f"list_filter({runs}, lambda x: regexp_matches(x, '[a-z]') and regexp_matches(x, '[0-9]'))"
    parts = f"flatten(list_transform({mixed}, lambda x: regexp_extract_all(x, '[a-z]+|[0-9]+')))"
    return f"unnest({runs} || {parts})"


_PHRASES = f"{bind.HAN_PHRASES}"
_TOTALS = """cast(sum(order_amount) as decimal(38,2)) order_amount"""
_RANK = "having sum(order_amount) > 0 order by order_amount desc,"

def _after(kept: str, reading: str, first: str) -> str:
    """Rows a that reading keeps alive for a day, and the rows b that come after and read them.

    A row lives through its readers as long as no two that follow each other are too far apart.
    """
    return f"""
        select k.event_id a, r.event_id b from (
            select k.event_id, k.id, k.ts, min_by(r.island, r.ts) island, min(r.ts) f from {kept} k
            join ({_islands(reading)}) r on k.id = r.id and r.ts {first} k.ts group by all) k
        join ({_islands(reading)}) r on k.id = r.id and k.island = r.island and r.ts {first} k.ts
        where k.f <= k.ts + {DAY}"""


def _islands(rows: str) -> str:
    return f"""
        select *, sum(new) over (partition by id order by ts) island from (
            select *, case when ts - lag(ts) over (partition by id order by ts) <= {DAY} then 0 else 1 end as new
            from {rows})"""


_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "src_topic": (("pl",), f"select {_FLAT} from pl"),
    "src_sql_table": (("pl",), f"""
        select item key_word, {_text('ts // 1000 * 1000')} rt from pl
        where last_page_id = 'search' and item is not null"""),
    "src_changes": (("tail",), """
        select 'capture.shop.user_info' topic, cast(-1 as bigint) "offset",
               '{"after":{"id":' || c_custkey || ',"name":"' || c_name || '","segment":"' || c_mktsegment
               || '","nation":' || c_nationkey
               || '},"source":{"db":"shop","table":"user_info"},"op":"r"}' "value" from customer
        union all select * from tail"""),
    "src_changes_tail": (("tail",), "select * from tail"),
    "changelog_table": ((), """
        select cast(c_custkey as varchar) id, c_name name,
               case when c_custkey % 7 = 0 then lower(c_mktsegment) else c_mktsegment end segment,
               cast(c_nationkey as varchar) nation
        from customer where c_custkey % 31 <> 0"""),
    "stream_changelog": ((), """
        select cast(c_custkey as varchar) id, c_name name,
               case when c_custkey % 7 = 0 then lower(c_mktsegment) else c_mktsegment end segment,
               cast(c_nationkey as varchar) nation
        from customer where c_custkey % 31 <> 0"""),
    "src_csv_lines": (("views", "clicks"), """
        select id, ts, vc from views union all select id, ts, vc from clicks"""),
    "dim_read": (("sku",), """
        select cast(id as varchar) id, sku_name, cast(price as varchar) price,
               cast(category3_id as varchar) category3_id, cast(spu_id as varchar) spu_id,
               cast(tm_id as varchar) tm_id from sku"""),
    "jdbc_rename": ((), """
        select c_custkey "cCustkey", c_name "cName", c_nationkey "cNationkey",
               cast(c_acctbal as decimal(16,2)) "cAcctbal", c_mktsegment "cMktsegment" from customer"""),
    "src_log_files": (("raw",), f"""
        select substr({_text('ts')}, 1, 10) log_day, "value" from raw"""),
    "sink_topic": (("raw",), """
        select '{' || common || ',' || body || '"ts":' || ts || '}' "value" from raw"""),
    "route_to_topics": ((), """
        select 'dwd_order_info' topic, '{"id":"' || o_orderkey || '","user_id":"' || o_custkey
               || '","order_status":"' || o_orderstatus || '"}' "value" from orders"""),
    "sink_stats": (("vs", "pl"), f"""
        select {_VS} from vs where edt <= (select {_text(f'max(ts) - {7 * HOUR}')} from pl)"""),
    "sink_drop_cols": (("pr",), """
        select sku_id, cast(k = 'display' as bigint) display_ct, cast(k = 'click' as bigint) click_ct,
               cast(k = 'favor' as bigint) favor_ct, cast(k = 'cart' as bigint) cart_ct,
               cast(coalesce(num, 0) as bigint) order_sku_num,
               cast(k in ('comment', 'good') as bigint) comment_ct,
               cast(k = 'good' as bigint) good_comment_ct,
               cast(case when k = 'order' then amount else 0 end as decimal(16,2)) order_amount,
               cast(case when k = 'paid' then amount else 0 end as decimal(16,2)) payment_amount,
               cast(case when k = 'refund' then amount else 0 end as decimal(16,2)) refund_amount
        from pr"""),
    "dim_upsert": (("users_now",), "select id, name, segment from users_now"),
    "dim_schema_from_rule": (("users_now",), "select id, name, segment from users_now"),
    "cdc_normalize": (("norm",), 'select * from norm'),
    "cdc_normalize_reads": (("chg",), """
        select "offset", db as "database", tbl "tableName", before, after,
               case op when 'u' then 'update' when 'd' then 'delete' when 'r' then 'read'
                    else 'insert' end "type"
        from chg"""),
    "cdc_drop_deletes": (("norm",), """select * from norm where "type" <> 'delete'"""),
    "rules_latest": ((), """
        select 'table_' || (o_custkey % 40) source_table,
               case o_orderstatus when 'F' then 'insert' when 'O' then 'update'
                    else 'delete' end operate_type,
               case when o_orderkey % 2 = 0 then 'kafka' else 'hbase' end sink_type,
               'sink_' || o_orderkey sink_table, 'id,name' sink_columns
        from orders
        qualify row_number() over (partition by source_table, operate_type
                                   order by o_orderkey desc) = 1"""),
    "stream_route_rule_change": ((), """
        select case o_orderkey % 2 when 0 then 'dwd_order_info' else 'dwd_order_ids' end topic,
               case o_orderkey % 2 when 0 then '{"id":"' || o_orderkey || '","user_id":"' || o_custkey
                   || '","order_status":"' || o_orderstatus || '"}' else '{"id":"' || o_orderkey || '"}' end "value"
        from orders"""),
    "stream_dim_from_new_rule": ((), """
        select cast(c_custkey as varchar) id, c_name "name",
               case c_custkey % 7 when 0 then lower(c_mktsegment) else c_mktsegment end segment
        from customer where c_custkey % 2 = 1 or c_custkey % 7 = 0"""),
    "cdc_route_fact": (("chg",), """
        select "offset", tbl "tableName", 'insert' "type", 'dwd_order_info' "sinkTable", after
        from chg where tbl = 'order_info'"""),
    "cdc_route_dim": (("cut_users",), """
        select "offset", "tableName", "type", "sinkTable", after from cut_users"""),
    "cdc_project": (("norm",), """
        select "tableName", "offset", "type",
               case when "tableName" = 'order_info' then regexp_replace(after, ',"order_status":"[^"]*"', '')
                    else regexp_replace(after, ',"segment":.*', '}') end after
        from norm"""),
    "dim_refresh": (("oi",), """
        select id, user_id, create_time, case when user_id % 2 = 0 then 'F' else 'M' end
               || case when create_time < '1998-01-01' then '0' else '1' end user_gender
        from oi"""),
    "log_dirty": (("raw",), """
        select event_id, "value", reason from raw where reason is not null"""),
    "log_clean": (("clean",), f'select {_FLAT}, "start" from clean'),
    "log_start": (("clean",), f'select {_FLAT}, "start" from clean where "start" is not null'),
    "log_page": (("clean",), f'select {_FLAT} from clean where "start" is null'),
    "log_display": (("clean",), """
        select event_id, cast(cast(item as int) + n as varchar) item, item_type, page_id, ts
        from clean, (values (0), (1)) v(n) where n < n_displays and "start" is null"""),
    "log_fanout": (("raw", "clean_fixed"), """
        with line as (
            select event_id, "start", page_id, item, n_displays, ts,
                   '{"common":{"mid":"' || mid || '","vc":"' || vc || '","ch":"' || ch
                   || '","ar":"' || ar || '","is_new":"' || is_new || '"},' || body
                   || '"ts":' || ts text
            from clean_fixed)
        select event_id, 'dwd_page_log' topic, text || '}' "value" from line where "start" is null
        union all
        select event_id, 'dwd_start_log', text || ',"start":' || "start" || '}'
        from line where "start" is not null
        union all
        select event_id, 'dwd_display_log', '{"item":"' || (cast(item as int) + n)
               || '","item_type":"sku_id","page_id":"' || page_id || '","ts":' || ts || '}'
        from line, (values (0), (1)) v(n) where n < n_displays and "start" is null
        union all
        select event_id, 'dirty_log', "value" from raw where reason is not null"""),
    "to_json": (("raw",), """
        select '{' || common || ',' || body || '"ts":' || ts || '}' "value" from raw"""),
    "new_visitor_fix": (("fixed",), "select event_id, mid, is_new from fixed"),
    "unique_visit": (("pl",), f"""
        select {_FLAT} from pl where last_page_id is null
        qualify row_number() over (partition by mid, ts // {DAY} order by ts, event_id) = 1"""),
    "bounce_matched": (("bounce",), """
        select event_id, mid, page_id, ts from bounce where bounce_kind = 'matched'"""),
    "bounce_timeout": (("bounce",), """
        select event_id, mid, page_id, ts from bounce where bounce_kind = 'timeout'"""),
    "bounce_detail": (("bounce", "pl"), f"""
        select {', '.join('pl.' + c.strip() for c in _FLAT.split(','))}, bounce_kind
        from bounce join pl using (event_id)"""),
    "order_parse": (("oi",), """
        select id, create_time, substr(create_time, 1, 10) create_date,
               substr(create_time, 12, 2) create_hour, create_ts from oi"""),
    "order_parse_dirty": (("oi",), """
        select id, 'on ' || create_time create_time from oi where id % 9 = 0"""),
    "order_flow_dirty": (("oi", "od", "pay"), """
        select input, cast(id as varchar) id, 'on ' || create_time create_time from (
            select 'order' input, id, create_time from oi
            union all select 'detail', id, create_time from od
            union all select 'payment', id, create_time from pay)
        where id % 9 = 0"""),
    "product_rows_dirty": ((), f"""
        select case event_type when 'click' then 'favor' else 'cart' end input,
               cast(event_id % 200 as varchar) sku_id,
               'on ' || {_text("epoch_ms(date_trunc('second', ts))")} create_time
        from events where event_type in ('click', 'purchase') and event_id % 71 = 0"""),
    "order_wide_join": (("joined",), f"select {_JOINED} from joined"),
    "order_wide": (("wide",), "select * exclude (create_ts) from wide"),
    "payment_wide": (("wide", "pay"), """
        select w.* exclude (create_time, create_date, create_hour, create_ts, expire_time,
                            operate_time, total_amount, order_id, user_id),
               w.create_time order_create_time, p.id payment_id, p.subject, p.payment_type,
               p.create_time payment_create_time, p.callback_time, p.total_amount, p.order_id,
               p.user_id
        from pay p join wide w on p.order_id = w.order_id
         and w.create_ts between p.create_ts - 900000 and p.create_ts + 5000"""),
    "sink_print": (("pl",), "select event_id, mid, page_id from pl"),
    "wide_coalesce": (("joined",), """
        select detail_id, order_status, create_time, create_date, coupon_reduce_amount, activity_reduce_amount,
               original_total_amount, feight_fee, total_amount, user_id, sku_id, sku_name, order_price, sku_num,
               case when detail_id % 15 > 0 then split_activity_amount end split_activity_amount,
               case when detail_id % 16 > 0 then split_coupon_amount end split_coupon_amount,
               case when detail_id % 17 > 0 then split_total_amount end split_total_amount
        from joined"""),
    "enrich": (("sku",), f"""
        select order_id, sku_id, sku_num, cast(price as varchar) price
        from ({_DETAIL}) left join (select * from sku where price < 950) k on sku_id = k.id"""),
    "enrich_user": (("oi", "du"), """
        select o.id, user_id, gender user_gender,
               cast(floor(date_diff('day', birthday, date '2024-01-31') / 365) as integer) user_age
        from oi o left join du on user_id = du.id"""),
    "enrich_province": (("oi", "dp"), """
        select o.id, province_id, name province_name, area_code province_area_code,
               iso_code province_iso_code, iso_3166_2 province_3166_2_code
        from oi o left join dp on province_id = dp.id"""),
    "enrich_sku": (("sku",), f"""
        select order_id, sku_id, sku_num, sku_name, price sku_price, spu_id, tm_id, category3_id
        from ({_DETAIL}) left join sku on sku_id = sku.id"""),
    "enrich_spu": (("sku",), f"""
        select order_id, sku_id, spu_id, spu_name from ({_DETAIL}) left join sku on sku_id = sku.id"""),
    "enrich_tm": (("sku",), f"""
        select order_id, sku_id, tm_id, tm_name from ({_DETAIL}) left join sku on sku_id = sku.id"""),
    "enrich_category3": (("sku",), f"""
        select order_id, sku_id, category3_id, category3_name
        from ({_DETAIL}) left join sku on sku_id = sku.id"""),
    "interval_join_pairs": (("views", "clicks"), f"""
        select {_PAIR} from views l join clicks r on {_NEAR}"""),
    "ttl_join_inner": (("views", "clicks"), f"""
        select {_PAIR} from views l join clicks r on {_NEAR}"""),
    "ttl_join_left": (("views", "clicks"), f"""
        select {_PAIR} from views l left join clicks r on {_NEAR}"""),
    "ttl_join_right": (("views", "clicks"), f"""
        select {_PAIR} from views l right join clicks r on {_NEAR}"""),
    "ttl_join_full": (("views", "clicks"), f"""
        select {_PAIR} from views l full join clicks r on {_NEAR}"""),
    "keyword_tokens": ((), f"""
        select p_partkey sku_id,
               {_tokens("p_name || ' ' || p_brand || ' ' || p_size || 'GB'")} keyword from part"""),
    "keyword_tokens_han": ((), f"""
        with t as (
            select p_partkey sku_id, p_name || ' ' || {_PHRASES}[p_partkey % 4 + 1] || {_PHRASES}[p_partkey % 3 + 1] title
            from part),
        r as (
            select row_number() over () rid, * from (
                select sku_id, unnest(regexp_extract_all(title, '[\\p{{Han}}]+')) run from t)),
        s as (select *, unnest(range(1, length(run) + 1)) pos from r),
        m as (
            select s.*, word from s join (select unnest({bind.HAN_WORDS}) word) w
            on substr(run, pos, length(word)) = word),
        covered as (select distinct rid, unnest(range(pos, pos + length(word))) pos from m)
        select sku_id, word keyword from m
        union all select sku_id, substr(run, pos, 1) from s anti join covered using (rid, pos)
        union all select sku_id, {_tokens('title')} from t"""),
    "keyword_token_counts": ((), f"""
        select keyword, count(*) ct from (select {_tokens('text')} keyword from documents)
        group by keyword"""),
    "keyword_search_rows": (("pl",), """
        select item key_word, ts from pl where last_page_id = 'search' and item is not null"""),
    "keyword_stats": (("kw",), "select * from kw"),
    "visitor_rows": (("vr",), """
        select vc, ch, ar, is_new, cast(uv_ct as bigint) uv_ct, cast(pv_ct as bigint) pv_ct,
               cast(sv_ct as bigint) sv_ct, cast(uj_ct as bigint) uj_ct,
               cast(dur_sum as bigint) dur_sum, ts from vr"""),
    "visitor_rows_literal": (("fixed", "vr"), """
        select vc, ch, ar, is_new, cast(uv_ct as bigint) uv_ct, cast(pv_ct as bigint) pv_ct,
               cast(sv_ct as bigint) sv_ct, cast(uj_ct as bigint) uj_ct,
               cast(dur_sum as bigint) dur_sum, ts
        from (
            select * from vr where pv_ct = 0
            union all
            select vc, ch, ar, is_new, 0, 1, case when last_page_id is null then 0 else 1 end, 0,
                   during_time, ts from fixed)"""),
    "visitor_stats": (("vs",), f"select {_VS} from vs"),
    "product_click": (("pl",), """
        select cast(item as bigint) sku_id, ts, cast(1 as bigint) click_ct
        from pl where page_id = 'good_detail'"""),
    "product_display": (("shown",), """
        select cast(item as bigint) sku_id, ts, cast(1 as bigint) display_ct from shown"""),
    "product_rows": (("pr",), """
        select sku_id, ts, cast(k = 'display' as bigint) display_ct, cast(k = 'click' as bigint) click_ct,
               cast(k = 'favor' as bigint) favor_ct, cast(k = 'cart' as bigint) cart_ct,
               cast(coalesce(num, 0) as bigint) order_sku_num,
               cast(k in ('comment', 'good') as bigint) comment_ct,
               cast(k = 'good' as bigint) good_comment_ct,
               cast(case when k = 'order' then amount else 0 end as decimal(16,2)) order_amount,
               cast(case when k = 'paid' then amount else 0 end as decimal(16,2)) payment_amount,
               cast(case when k = 'refund' then amount else 0 end as decimal(16,2)) refund_amount,
               case when id is not null then k end id_kind, id
        from pr"""),
    "product_stats": (("ps",), f"select {_PS} from ps"),
    "province_stats": (("pv",), "select * from pv"),
    "report_gmv": (("ps",), f"""
        select cast(coalesce(sum(order_amount), 0) as decimal(38,2)) order_amount
        from ps where {_SALES}"""),
    "report_trademark": (("ps",), f"""
        select tm_id, tm_name, {_TOTALS} from ps where {_SALES} group by all {_RANK} tm_id, tm_name
        limit 10"""),
    "report_trademark_series": (("ps",), f"""
        select string_agg(tm_name, ',' order by order_amount desc, tm_id) categories,
               string_agg(cast(order_amount as varchar), ',' order by order_amount desc, tm_id) data
        from (select tm_id, tm_name, {_TOTALS} from ps where {_SALES} group by all
              {_RANK} tm_id, tm_name limit 10)"""),
    "report_category3": (("ps",), f"""
        select category3_id, category3_name, {_TOTALS} from ps where {_SALES} group by all
        {_RANK} category3_id, category3_name limit 10"""),
    "report_spu": (("ps",), f"""
        select spu_id, spu_name, {_TOTALS}, cast(sum(order_ct) as bigint) order_ct
        from ps where {_SALES} group by all {_RANK} spu_id, spu_name limit 10"""),
    "report_province": (("pv",), f"""
        select province_name, order_amount from (
            select province_id, province_name, {_TOTALS} from pv where {_SALES} group by all)"""),
    "report_visitor": (("vs",), f"""
        select is_new, cast(sum(uv_ct) as bigint) uv_ct, cast(sum(pv_ct) as bigint) pv_ct,
               cast(sum(sv_ct) as bigint) sv_ct, cast(sum(uj_ct) as bigint) uj_ct,
               cast(sum(dur_sum) as bigint) dur_sum
        from vs where {_VISIT} group by is_new"""),
    # Rounding half-up by whole numbers: floor((2 * a * scale + b) / (2 * b)) / scale.
    "report_visitor_rates": (("vs",), f"""
        with s as (
            select is_new, sum(uv_ct)::bigint uv, sum(pv_ct)::bigint pv, sum(sv_ct)::bigint sv,
                   sum(uj_ct)::bigint uj, sum(dur_sum)::bigint dur
            from vs where {_VISIT} group by is_new),
        cell as (
            select is_new, 'visitors' "type", cast(uv as decimal(20,2)) v from s
            union all select is_new, 'pages', cast(pv as decimal(20,2)) from s
            union all select is_new, 'bounce_rate', case when uv = 0 or sv = 0 then 0 else
                cast((2 * uj * 10000 + sv) // (2 * sv) as decimal(20,2)) / 100 end from s
            union all select is_new, 'seconds_per_visit', case when uv = 0 or sv = 0 then 0 else
                cast((((2 * dur + sv) // (2 * sv)) + 50) // 100 as decimal(20,2)) / 10 end from s
            union all select is_new, 'pages_per_visit', case when uv = 0 or sv = 0 then 0 else
                cast((2 * pv * 100 + sv) // (2 * sv) as decimal(20,2)) / 100 end from s)
        select t."type",
               cast(coalesce(max(v) filter (is_new = '1'), 0) as decimal(20,2)) "new",
               cast(coalesce(max(v) filter (is_new <> '1'), 0) as decimal(20,2)) "old"
        from (values ('visitors'), ('pages'), ('bounce_rate'), ('seconds_per_visit'),
                     ('pages_per_visit')) t("type")
        left join cell on cell."type" = t."type" group by t."type" """),
    "report_hourly": (("vs",), f"""
        select cast(substr(stt, 12, 2) as integer) hr,
               cast(sum(case when is_new = '1' then uv_ct else 0 end) as bigint) new_uv,
               cast(sum(uv_ct) as bigint) uv_ct, cast(sum(pv_ct) as bigint) pv_ct,
               cast(sum(uj_ct) as bigint) uj_ct
        from vs where {_VISIT} group by hr order by hr"""),
    "report_hourly_filled": (("vs",), f"""
        select lpad(cast(h as varchar), 2, '0') hr,
               cast(coalesce(sum(uv_ct), 0) as bigint) uv_ct,
               cast(coalesce(sum(pv_ct), 0) as bigint) pv_ct,
               cast(coalesce(sum(case when is_new = '1' then uv_ct else 0 end), 0) as bigint) new_uv
        from range(24) r(h) left join (select * from vs where {_VISIT}) v
          on cast(substr(stt, 12, 2) as integer) = h
        group by h order by h"""),
    "report_keyword": (("kw",), f"""
        select keyword as name, cast(sum(ct * 10) as bigint) "value" from kw where {_VISIT}
        group by keyword order by sum(ct) desc, keyword limit 20"""),
    "stream_new_visitor_fix": (("fixed",), "select event_id, mid, is_new from fixed"),
    # An entry is given out when the watermark has passed its timeout.
    "stream_bounce_detail": (("bounce", "pl"), f"""
        select {', '.join('pl.' + c.strip() for c in _FLAT.split(','))}, bounce_kind
        from bounce join pl using (event_id)
        where pl.ts + {6 * HOUR} <= (select max(ts) - 14000 from pl)"""),
    "stream_visitor_stats": (("vs", "pl"), f"""
        select {_VS} from vs where edt <= (select {_text(f'max(ts) - {7 * HOUR}')} from pl)"""),
    "stream_product_stats": (("ps", "pr"), f"""
        select {_PS} from ps where edt <= (select {_text('max(ts) - 2000')} from pr)"""),
    "stream_order_wide": (("joined",), f"select {_JOINED} from joined"),
    "stream_province_stats": (("pv", "joined"), f"""
        select * from pv where edt <= (select {_text('max(create_ts) - 2000')} from joined)"""),
    "stream_keyword_stats": (("kw", "pl"), f"""
        select * from kw where edt <= (
            select {_text('max(ts // 1000 * 1000) - 2000')} from pl where last_page_id = 'search')"""),
    "stream_ttl_join_inner": (("views", "clicks"), f"""
        select {_PAIR} from views l join clicks r on {_NEAR}"""),
    "stream_ttl_join_left": (("views", "clicks"), f"""
        select {_PAIR} from views l left join clicks r on {_NEAR}
        where r.id is not null or l.ts + {HOUR} < (
            select least((select max(ts) from views), (select max(ts) from clicks)))"""),
    "stream_ttl_join_right": (("views", "clicks"), f"""
        select {_PAIR} from views l right join clicks r on {_NEAR}
        where l.id is not null or r.ts + {HOUR} < (
            select least((select max(ts) from views), (select max(ts) from clicks)))"""),
    "stream_ttl_join_full": (("views", "clicks"), f"""
        select {_PAIR} from views l full join clicks r on {_NEAR}
        where (l.id is not null and r.id is not null) or coalesce(l.ts, r.ts) + {HOUR} < (
            select least((select max(ts) from views), (select max(ts) from clicks)))"""),
    "stream_ttl_renewed_left": (("views", "clicks"), f"""
        select {_PAIR} from views l left join ({_after("views", "clicks", ">=")} union all
            select l.event_id a, r.event_id b from views l join clicks r
            on l.id = r.id and r.ts < l.ts and r.ts >= l.ts - {DAY}) p on l.event_id = p.a
        left join clicks r on r.event_id = p.b"""),
    "stream_ttl_renewed_full": (("views", "clicks"), f"""
        select {_PAIR} from views l
        full join ({_after("views", "clicks", ">=")} union all
            select b a, a b from ({_after("clicks", "views", ">")})) p on l.event_id = p.a
        full join clicks r on r.event_id = p.b"""),
    "stream_outer_changes": (("views", "clicks"), f"""
        with pair as (
            select l.event_id a, r.event_id b, l.ts lt, r.ts rt from views l join clicks r on {_NEAR}),
        alone as (
            select l.event_id a, null b, l.ts t, min(p.rt) f from views l left join pair p on l.event_id = p.a
            group by all having not coalesce(bool_or(p.rt < l.ts), false)
            union all
            select null, r.event_id, r.ts, min(p.lt) from clicks r left join pair p on r.event_id = p.b
            group by all having not coalesce(bool_or(p.lt <= r.ts), false)),
        change as (
            select 1 change, greatest(lt, rt) t, a, b from pair
            union all select 1, t, a, b from alone
            union all select -1, f, a, b from alone where f is not null)
        select cast(change as int) change, t "at", {_PAIR} from change c
        left join views l on l.event_id = c.a left join clicks r on r.event_id = c.b"""),
    "stream_restart": (("pl",), f"""
        select {_text('w')} stt, count(*) n from (select {_window('ts', HOUR)} w from pl)
        where w + {HOUR} <= (select max(ts) - 5000 from pl) group by w"""),
    "late_rows": (("pl",), f"""
        select {_text('w')} stt, count(*) n
        from (select {_window('ts', HOUR)} w, page_id from pl)
        where w + {HOUR} <= (select max(ts) - 5000 from pl)
          and (page_id <> 'error'
               or w + {HOUR} > (select max(ts) - 5000 from pl where page_id <> 'error'))
        group by w"""),
}


def _with(names: tuple[str, ...]) -> list[str]:
    """The expressions needed, each once and after those it needs itself."""
    ordered: list[str] = []
    for name in names:
        for inner in [*_with(_CTES[name][0]), name]:
            if inner not in ordered:
                ordered.append(inner)
    return ordered


def all_oracles() -> dict[str, str]:
    result = {}
    for name, (needs, body) in _SQL.items():
        parts = [f"{cte} as ({_CTES[cte][1]})" for cte in _with(needs)]
        text = f"select * from ({body})" if parts and body.lstrip().startswith("with") else body
        result[name] = ("with " + ",\n".join(parts) + "\n" + text) if parts else body
    result["stream_payment_wide"] = result["payment_wide"]
    result["stats_one_day_more"] = result["product_stats"]
    result["stats_visitor_day_more"] = result["visitor_stats"]
    result["stream_unique_visit"] = result["unique_visit"]
    sales_day = "stt >= '1998-02-08 00:00:00' and stt < '1998-02-09 00:00:00'"
    for name in [name for name in result if name.startswith("report_")]:
        result[f"{name}_default_day"] = result[name].replace(_SALES, sales_day)
    # A day without sales gives empty lists.
    result["report_trademark_series_default_day"] = (
        "select coalesce(categories, '') categories, coalesce(data, '') data from ("
        + result["report_trademark_series_default_day"] + ")")
    return result
