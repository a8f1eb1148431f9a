"""Rental input tables derived from the driver tables (FIXTURES.md section 2).

Each entry is fixture definition SQL that runs unchanged in Spark SQL and in
DuckDB. Table references are written ``{name}`` so Spark can bind them to
DataFrames (``spark.sql(text, name=df)``) and the DuckDB oracle to views.
"""

from __future__ import annotations

# fixed values: the driver tables each fixture reads
DRIVER_TABLES = ("customer", "orders", "lineitem", "part", "events")

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["xiaoqus"] = """
select c_custkey as id, case c_custkey % 9 when 0 then '北京市' when 1 then '上海市' when 2 then '深圳市' when 3 then '杭州市' when 4 then '广州市' when 5 then '天津市' when 6 then '南京市' when 7 then '武汉市' else '成都市' end as city, case when c_custkey % 25 = 0 then null else c_mktsegment end as block, concat('XQ', cast(c_custkey % 450 as varchar(9))) as name from {customer}
"""

FIXTURE_SQL["suites"] = """
select o_orderkey as id, o_custkey as xiaoqu_id, cast(1 + o_orderkey % 5 as int) as bedroom_num, cast(1 + o_orderkey % 2 as int) as toilet_num,
 cast(60 + o_orderkey % 80 as double) as area, case when o_orderstatus='F' then '有' when o_orderstatus='O' then '无' else null end as has_lift,
 case when o_orderpriority='1-URGENT' then '集中供暖' else '自采暖' end as heating, cast(1 + o_orderkey % 30 as varchar(9)) as floor,
 cast(o_orderdate as date) as ready_for_rent_date, cast(o_orderdate as date) as zhuangxiu_end_date,
 case when o_orderkey % 50 = 0 then '研发测试' when o_orderkey % 50 = 1 then '工作站' else concat('addr', cast(o_orderkey as varchar(12))) end as address,
 case when o_orderkey % 40 = 0 then '已下架' else '正常' end as status from {orders}
"""

FIXTURE_SQL["rooms"] = """
select l_orderkey as suite_id, concat(cast(l_orderkey as varchar(12)),'-',case l_linenumber when 1 then 'A' when 2 then 'B' when 3 then 'C' when 4 then 'D' when 5 then 'E' when 6 then 'F' else 'G' end) as code,
 cast(8 + l_quantity / 4 as double) as area, cast(6 + l_quantity / 4 as double) as living_area, case when l_partkey % 3 = 0 then cast(2.5 as double) else cast(0.0 as double) end as balcony_area, cast(0.0 as double) as terrace_area,
 case when l_suppkey % 4 = 0 then cast(3.0 as double) else cast(0.0 as double) end as toilet_area, cast(0.0 as double) as storeroom_area,
 case when l_suppkey % 4 = 0 then '有' else '无' end as has_toilet, case when l_suppkey % 4 = 1 then '有' else '无' end as has_shower, case when l_partkey % 3 = 0 then '有' else '无' end as has_balcony,
 case when l_partkey % 17 = 0 then '有' else '无' end as has_storeroom, case when l_partkey % 19 = 0 then '有' else '无' end as has_terrace,
 case l_partkey % 8 when 0 then '北' when 1 then '西' when 2 then '西北' when 3 then '东' when 4 then '东北' when 5 then '南' when 6 then '东南' else null end as face, case l_partkey % 10 when 0 then '非私有采光' when 1 then '无采光' else '私有采光' end as lighting, case when l_suppkey % 10 = 0 then '是' else '否' end as is_small_window,
 case l_suppkey % 12 when 0 then '狭长型' when 1 then '斜顶' when 2 then '其他' else '正常' end as shape, case when l_partkey % 2 = 0 then 'L型' else '' end as shape_note,
 case when l_partkey % 11 = 0 then '整租' else '合租' end as rent_type,
 case when l_orderkey % 2 = 0 then null else cast(l_extendedprice / 30 as double) end as price,
 case when l_orderkey % 2 = 0 then null else cast(l_shipdate as date) end as available_date,
 case when l_orderkey % 2 = 0 then '装修中' when l_returnflag='R' then '可出租' when l_returnflag='A' then '已出租' else '已下架' end as status,
 cast(case when l_partkey % 23 = 0 then l_shipdate end as date) as deleted_at from {lineitem}
"""

FIXTURE_SQL["f_bi_sfinfor_day"] = """
select o_orderkey as suite_id, cast(1 + o_orderkey % 4 as int) as before_room_num from {orders}
"""

FIXTURE_SQL["archive_ziroom"] = """
select event_id, case user_id % 8 when 0 then '北京' when 1 then '上海' when 2 then '深圳' when 3 then '杭州' when 4 then '广州' when 5 then '天津' when 6 then '南京' else '武汉' end as city,
 concat('XQ', cast(event_id % 180 as varchar(9))) as community_name, case when user_id % 3 = 0 then '地铁10号线BUILDING)' else '' end as business_district, '朝阳望京站' as business_district_block,
 cast(1 + event_id % 4 as varchar(9)) as bedroom_num, cast(8 + event_id % 12 as varchar(9)) as building_area, case when event_id % 3 = 0 then '独立阳台' else '' end as independent_balcon,
 cast(cast(floor(500 + value * 20) as int) as varchar(9)) as price, case event_id % 4 when 0 then '北' when 1 then '西' when 2 then '东' else '南' end as orientation,
 case when event_id % 5 = 0 then '独卫' else '' end as private_bathroom, case when event_type='error' then '风格3.0' else '风格4.0' end as style,
 case when event_type='signup' then '自如寓' else '友家合租' end as product_type, cast(ts as varchar(26)) as date_created from {events}
"""

FIXTURE_SQL["xiaoqurelations"] = """
select case c_custkey % 9 when 0 then '北京市' when 1 then '上海市' when 2 then '深圳市' when 3 then '杭州市' when 4 then '广州市' when 5 then '天津市' when 6 then '南京市' when 7 then '武汉市' else '成都市' end as city, concat('XQ', cast(c_custkey % 450 as varchar(9))) as jingdui, c_mktsegment as block, concat('XQ', cast((c_custkey + 9) % 450 as varchar(9))) as company from {customer} where c_custkey % 2 = 0
"""

FIXTURE_SQL["suite_decorations"] = """
select o_orderkey as suite_id, '完成' as suite_status, o_totalprice as decoration_budget, cast(1.0 as double) as furniture_budget, cast(1.0 as double) as appliance_budget, case when o_orderkey % 13 = 0 then null else cast(1.0 as double) end as allocation_budget, cast(1.0 as double) as operation_budget, cast(1.0 as double) as follow_operation_budget,
 case when o_orderkey % 3 = 0 then null else cast(5.0 as double) end as construction_material_budget,
 o_totalprice as decoration_amount, cast(1.0 as double) as furniture_amount, cast(1.0 as double) as appliance_amount, cast(1.0 as double) as allocation_amount, cast(1.0 as double) as operation_amount, cast(1.0 as double) as follow_operation_amount, cast(null as double) as construction_material_amount, o_totalprice as total_yuan,
 o_orderdate as measure_approve_pass_at, case when o_orderpriority='5-LOW' then '驳回' when o_orderpriority='2-HIGH' then '特批通过' else '审批通过' end as measure_approve_status,
 case when o_orderkey % 4 = 0 then cast(o_orderdate as date) end as supplier_end_date from {orders}
union all
select o_orderkey as suite_id, '完成' as suite_status, o_totalprice as decoration_budget, cast(1.0 as double) as furniture_budget, cast(1.0 as double) as appliance_budget, case when o_orderkey % 13 = 0 then null else cast(1.0 as double) end as allocation_budget, cast(1.0 as double) as operation_budget, cast(1.0 as double) as follow_operation_budget,
 case when o_orderkey % 3 = 0 then null else cast(5.0 as double) end as construction_material_budget,
 o_totalprice as decoration_amount, cast(1.0 as double) as furniture_amount, cast(1.0 as double) as appliance_amount, cast(1.0 as double) as allocation_amount, cast(1.0 as double) as operation_amount, cast(1.0 as double) as follow_operation_amount, cast(null as double) as construction_material_amount, o_totalprice as total_yuan,
 o_orderdate as measure_approve_pass_at, case when o_orderpriority='5-LOW' then '驳回' when o_orderpriority='2-HIGH' then '特批通过' else '审批通过' end as measure_approve_status,
 cast('2001-08-20' as date) as supplier_end_date from {orders} where o_orderkey % 6 = 0
"""

FIXTURE_SQL["contract_with_landlords"] = """
select o_orderkey as id, case when o_orderkey % 29 = 0 then null else o_orderkey end as suite_id, case when o_orderstatus='P' then '签约待确认' else '已签约' end as status, cast(o_orderdate as date) as sign_date,
 case when o_orderkey % 7 = 0 then '蓝鲸A' when o_orderkey % 7 = 1 then '其他' else '蛋壳A' end as type, cast(o_orderkey % 4 as int) as origin_bedroom_num, o_orderkey % 1000 as house_pricing_id, 36 as months, cast(o_orderkey % 60 as int) as free_days from {orders}
union all
select o_orderkey + 10000000 as id, case when o_orderkey % 29 = 0 then null else o_orderkey end as suite_id, case when o_orderstatus='P' then '签约待确认' else '已签约' end as status, cast(o_orderdate as date) as sign_date,
 case when o_orderkey % 7 = 0 then '蓝鲸A' when o_orderkey % 7 = 1 then '其他' else '蛋壳A' end as type, cast(o_orderkey % 4 as int) as origin_bedroom_num, (o_orderkey + 1) % 1000 as house_pricing_id, 36 as months, cast(o_orderkey % 60 as int) as free_days from {orders} where o_orderkey % 10 = 0
"""

FIXTURE_SQL["landlord_payment_schedules"] = """
select l_orderkey as contract_id, l_extendedprice / 10 as monthly_price, cast(l_shipdate as date) as date, cast('2001-12-31' as date) as end_date, cast(case when l_linenumber = 7 then l_shipdate end as date) as deleted_at from {lineitem}
"""

FIXTURE_SQL["house_pricing"] = """
select p_partkey as id, p_retailprice as sales_wish_sum_price_yuan from {part}
"""

FIXTURE_SQL["community_house_type"] = """
select case o_custkey % 9 when 0 then '北京市' when 1 then '上海市' when 2 then '深圳市' when 3 then '杭州市' when 4 then '广州市' when 5 then '天津市' when 6 then '南京市' when 7 then '武汉市' else '成都市' end as city, o_orderpriority as block, concat('XQ', cast(o_custkey % 450 as varchar(9))) as xiaoqu_name, cast(1 + o_orderkey % 7 as int) as bedroom_num, cast(40 + o_orderkey % 90 as double) as area, case when o_orderkey % 97 = 0 then null else o_totalprice / 100 end as price, cast(o_orderdate as date) as data_date from {orders}
"""
