"""Oracle SQL: the same questions as plain SQL text, runnable by DuckDB and Spark SQL.

The driver registers the star tables as views; crash-table queries carry
``CRASH_PREFIX`` as a CTE so they derive the same crash tables as
:mod:`roadlens.sources.fixtures`.  Ties are broken by key ascending, NULL
last, as in the engine; sums are cast to BIGINT (DuckDB sums integers as HUGEINT).
"""

from __future__ import annotations

CRASH_PREFIX = """q AS (SELECT l_orderkey o, l_linenumber n, l_partkey p, l_suppkey s, CAST(l_quantity AS INT) k,
             CAST(round(l_discount * 100) AS INT) d, CAST(round(l_tax * 100) AS INT) x,
             l_returnflag rf, l_linestatus ls FROM lineitem),
units AS (SELECT CASE WHEN p % 31 = 0 THEN NULL ELSE CAST(o AS VARCHAR(20)) END crash_id, CAST(n AS VARCHAR(20)) unit_nbr,
  CASE WHEN rf = 'R' THEN 'Y' ELSE 'N' END veh_hnr_fl,
  CASE p % 8 WHEN 0 THEN 'MOTORCYCLE' WHEN 1 THEN 'POLICE MOTORCYCLE' WHEN 2 THEN 'NA' WHEN 3 THEN 'NOT REPORTED'
    WHEN 4 THEN 'OTHER  (EXPLAIN IN NARRATIVE)' WHEN 5 THEN 'SEDAN' WHEN 6 THEN 'PICKUP' ELSE NULL END veh_body_styl_id,
  CASE WHEN p % 13 = 0 THEN 'NA' WHEN p % 13 = 12 THEN NULL ELSE 'MAKE_' || CAST(p % 13 AS VARCHAR(20)) END veh_make_id,
  CASE WHEN (s * 7 + n) % 14 = 0 THEN 'NA' WHEN (s * 7 + n) % 14 = 13 THEN NULL ELSE 'COLOR_' || CAST((s * 7 + n) % 14 AS VARCHAR(20)) END veh_color_id,
  CASE WHEN (p + s) % 32 = 0 THEN 'NA' WHEN (p + s) % 32 = 31 THEN NULL WHEN (p + s) % 32 IN (5, 6) THEN 'Unknown' ELSE 'ST_' || CAST((p + s) % 32 AS VARCHAR(20)) END veh_lic_state_id,
  CASE WHEN k % 4 = 3 THEN '3.0' ELSE CAST(k % 4 AS VARCHAR(20)) END tot_injry_cnt, CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(n % 2 AS VARCHAR(20)) END death_cnt,
  CASE WHEN s % 9 = 0 THEN 'UNDER INFLUENCE - ALCOHOL' ELSE 'NONE' END contrib_factr_1_id,
  CASE WHEN p % 10 = 0 THEN 'HAD BEEN DRINKING ALCOHOL' WHEN p % 10 = 1 THEN NULL ELSE 'NONE' END contrib_factr_2_id,
  CASE WHEN k % 25 = 0 THEN 'ALCOHOL' ELSE NULL END contrib_factr_p1_id,
  CASE WHEN k % 8 = 7 THEN 'DAMAGED 7 HIGHEST' WHEN k % 8 = 0 THEN NULL ELSE 'DAMAGED ' || CAST(k % 8 AS VARCHAR(20)) END veh_dmag_scl_1_id,
  CASE WHEN d % 8 = 7 THEN 'DAMAGED 7 HIGHEST' WHEN d % 8 = 0 THEN NULL ELSE 'DAMAGED ' || CAST(d % 8 AS VARCHAR(20)) END veh_dmag_scl_2_id,
  CASE rf WHEN 'A' THEN 'PROOF OF LIABILITY INSURANCE' WHEN 'N' THEN 'SURETY BOND' ELSE NULL END fin_resp_type_id
  FROM q),
primary_person AS (SELECT CASE WHEN s % 10 = 9 AND p % 3 = 0 THEN NULL ELSE CAST(o AS VARCHAR(20)) END crash_id, CAST(n AS VARCHAR(20)) unit_nbr, CAST(s % 9 + 1 AS VARCHAR(20)) prsn_nbr,
  CASE WHEN p % 10 < 7 THEN 'DRIVER' ELSE 'PEDESTRIAN' END prsn_type_id,
  CASE WHEN s % 10 < 6 THEN 'MALE' WHEN s % 10 < 9 THEN 'FEMALE' ELSE 'NA' END prsn_gndr_id,
  CASE WHEN k <= 18 THEN 'KILLED' WHEN k <= 40 THEN 'NOT INJURED' ELSE NULL END prsn_injry_sev_id,
  CASE WHEN d % 3 = 0 THEN 'NOT DEPLOYED' ELSE 'DEPLOYED, FRONT' END prsn_airbag_id,
  CASE (p + s + n) % 6 WHEN 0 THEN 'NA' WHEN 1 THEN 'UNKNOWN' ELSE 'ETHN_' || CAST((p + s + n) % 6 AS VARCHAR(20)) END prsn_ethnicity_id,
  CASE WHEN x <= 4 THEN 'CLASS C' WHEN x = 5 THEN 'UNLICENSED' WHEN x = 6 THEN 'OTHER/OUT OF STATE' WHEN x = 7 THEN 'CLASS A AND M' ELSE NULL END drvr_lic_cls_id,
  CASE WHEN p % 12 = 0 THEN NULL WHEN p % 12 = 1 THEN 'NA' ELSE 'ST_' || CAST(p % 12 AS VARCHAR(20)) END drvr_lic_state_id,
  CASE WHEN p % 11 = 0 THEN NULL ELSE CAST(75000 + (s * 3 + n) % 40 AS VARCHAR(20)) END drvr_zip
  FROM q),
damages AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderkey AS VARCHAR(20)) END crash_id, o_orderpriority damaged_property FROM orders WHERE o_orderstatus = 'P'),
charges AS (SELECT CAST(o AS VARCHAR(20)) crash_id, CAST(n AS VARCHAR(20)) unit_nbr, CAST(s % 9 + 1 AS VARCHAR(20)) prsn_nbr,
  CASE s % 3 WHEN 0 THEN 'SPEEDING - OVER LIMIT' WHEN 1 THEN 'UNSAFE SPEED' ELSE 'NO INSURANCE' END charge
  FROM q WHERE ls = 'O' AND rf <> 'R'),
endorse AS (SELECT CAST(o AS VARCHAR(20)) crash_id, CAST(n AS VARCHAR(20)) unit_nbr,
  CASE WHEN x < 3 THEN 'NONE' WHEN x < 6 THEN 'TANK VEHICLE' ELSE NULL END drvr_lic_endors_id FROM q),
restrict AS (SELECT CAST(o AS VARCHAR(20)) crash_id, CAST(n AS VARCHAR(20)) unit_nbr,
  CASE WHEN d < 5 THEN 'WITH CORRECTIVE LENSES' ELSE 'NONE' END drvr_lic_restric_id FROM q)"""

CRASH_SQL = {
    "a01": """select crash_id, count(*) male_death_count from primary_person where prsn_gndr_id='MALE' and prsn_injry_sev_id='KILLED' group by crash_id having count(*)>2""",
    "a02": """select count(*) count_two_wheeler_booked from (select distinct u.crash_id,u.unit_nbr from units u join (select distinct crash_id,unit_nbr from charges) b on u.crash_id=b.crash_id and u.unit_nbr=b.unit_nbr where veh_body_styl_id in ('MOTORCYCLE','POLICE MOTORCYCLE')) z""",
    "a03": """select veh_make_id, count(*) cnt from (select distinct u.crash_id,unit_nbr,veh_make_id from units u join (select crash_id from primary_person where prsn_type_id='DRIVER' and prsn_injry_sev_id='KILLED' and prsn_airbag_id='NOT DEPLOYED') p on u.crash_id=p.crash_id) z group by veh_make_id order by cnt desc, veh_make_id asc nulls last limit 5""",
    "a04": """with licensed as (select crash_id, count(*) n_people from primary_person where prsn_type_id = 'DRIVER' and drvr_lic_cls_id like '%CLASS%' group by crash_id), flags as (select crash_id, count(distinct coalesce(veh_hnr_fl, '')) n_flags from units group by crash_id) select cast(coalesce(sum(n_people * n_flags), 0) as bigint) count_licensed from licensed join flags using (crash_id)""",
    "a04_hnr": """select count(*) count_licensed from primary_person p join (select distinct crash_id,veh_hnr_fl from units where veh_hnr_fl='Y') u on p.crash_id=u.crash_id where prsn_type_id='DRIVER' and drvr_lic_cls_id like '%CLASS%'""",
    "a05": """select drvr_lic_state_id, count(drvr_lic_state_id) state_count from (select distinct crash_id, drvr_lic_state_id from primary_person p where not exists (select 1 from primary_person f where f.prsn_gndr_id='FEMALE' and f.crash_id=p.crash_id)) z group by drvr_lic_state_id order by state_count desc, drvr_lic_state_id asc nulls last limit 1""",
    "a06": """select veh_make_id, sum_cas from (select veh_make_id, sum_cas, row_number() over (order by sum_cas desc nulls last, veh_make_id) rn from (select veh_make_id, cast(sum(cast(tot_injry_cnt as decimal(20,4))+cast(death_cnt as decimal(20,4))) as bigint) sum_cas from (select distinct crash_id,veh_make_id,tot_injry_cnt,death_cnt from units where veh_make_id<>'NA') a group by veh_make_id) b) c where rn between 3 and 5""",
    "a07": """select prsn_ethnicity_id, veh_body_styl_id from (select *, row_number() over (partition by veh_body_styl_id order by cnt desc, prsn_ethnicity_id) rn from (select prsn_ethnicity_id, veh_body_styl_id, count(*) cnt from primary_person p join (select distinct crash_id,unit_nbr,veh_body_styl_id from units where veh_body_styl_id not in ('NA','OTHER  (EXPLAIN IN NARRATIVE)','NOT REPORTED')) u on p.crash_id=u.crash_id and p.unit_nbr=u.unit_nbr where prsn_ethnicity_id not in ('NA','UNKNOWN') group by prsn_ethnicity_id, veh_body_styl_id) a) b where rn=1""",
    "a08": """select drvr_zip, count(*) tot_count from (select distinct p.crash_id, drvr_zip from primary_person p join (select distinct crash_id from units where contrib_factr_1_id like '%ALCOHOL%' or contrib_factr_2_id like '%ALCOHOL%' or contrib_factr_p1_id like '%ALCOHOL%') a on p.crash_id=a.crash_id where drvr_zip is not null) z group by drvr_zip order by tot_count desc, drvr_zip limit 5""",
    "a09": """select count(*) count_no_damage from (select distinct crash_id from units u where (veh_dmag_scl_1_id in ('DAMAGED 5','DAMAGED 6','DAMAGED 7 HIGHEST') or veh_dmag_scl_2_id in ('DAMAGED 5','DAMAGED 6','DAMAGED 7 HIGHEST')) and fin_resp_type_id like '%INSURANCE%' and not exists (select 1 from damages d where d.crash_id=u.crash_id)) z""",
    "a10": """select veh_make_id, count(*) make_count from primary_person p join (select distinct crash_id,veh_make_id,unit_nbr,veh_color_id,veh_lic_state_id from units) u on p.crash_id=u.crash_id join (select crash_id from charges where charge like '%SPEED%') c on p.crash_id=c.crash_id join (select veh_color_id from (select veh_color_id,count(*) c from (select distinct crash_id,unit_nbr,veh_color_id from units where veh_color_id<>'NA') y group by 1 order by c desc, veh_color_id limit 10) tc) tc on u.veh_color_id=tc.veh_color_id join (select veh_lic_state_id from (select veh_lic_state_id,count(*) c from (select distinct crash_id,veh_lic_state_id from units where veh_lic_state_id<>'NA') y group by 1 order by c desc, veh_lic_state_id limit 25) ts) ts on u.veh_lic_state_id=ts.veh_lic_state_id where drvr_lic_cls_id like '%CLASS%' group by veh_make_id order by make_count desc, veh_make_id asc nulls last limit 5""",
    "v_death_sum": """select crash_id, cast(sum(cast(death_cnt as int)) as bigint) tot_death_count from (select distinct crash_id,unit_nbr,death_cnt from units) z group by crash_id having sum(cast(death_cnt as int))>2""",
    "v_male_death_crash_count": """select count(*) crash_count from (select crash_id, count(*) male_death_count from primary_person where prsn_gndr_id='MALE' and prsn_injry_sev_id='KILLED' group by crash_id having count(*)>2) z""",
    "v_male_deaths_ge2": """select crash_id, count(*) death_count from primary_person where prsn_gndr_id='MALE' and prsn_injry_sev_id='KILLED' group by crash_id having count(*)>=2""",
    "v_booked_crashes": """select count(*) crash_count from (select distinct u.crash_id from units u join charges c on u.crash_id=c.crash_id and u.unit_nbr=c.unit_nbr where veh_body_styl_id in ('MOTORCYCLE','POLICE MOTORCYCLE')) z""",
    "v_two_wheelers_all": """select count(*) unit_count from (select distinct crash_id,unit_nbr from units where contains(veh_body_styl_id,'MOTORCYCLE')) z""",
    "v_charge_rows": """select count(*) charge_rows from charges""",
    "v_bottom_makes": """with fatal as (select crash_id, count(*) n_fatal from primary_person where prsn_airbag_id = 'NOT DEPLOYED' and prsn_injry_sev_id = 'KILLED' and prsn_type_id = 'DRIVER' group by crash_id), cars as (select crash_id, veh_make_id, count(distinct coalesce(unit_nbr, '')) n_cars from units group by crash_id, veh_make_id) select veh_make_id, cast(sum(n_fatal * n_cars) as bigint) make_count from fatal join cars using (crash_id) group by veh_make_id order by make_count, veh_make_id nulls last limit 5""",
    "v_top_makes_in": """with fatal as (select distinct crash_id from primary_person where prsn_type_id='DRIVER' and prsn_injry_sev_id='KILLED' and prsn_airbag_id='NOT DEPLOYED'), vehicles as (select crash_id, unit_nbr, veh_make_id from units group by all) select veh_make_id, count(*) cnt from vehicles semi join fatal using (crash_id) group by veh_make_id order by cnt desc, veh_make_id nulls last limit 5""",
    "v_not_unlicensed": """with others as (select crash_id, count(*) n_people from primary_person where drvr_lic_cls_id <> 'UNLICENSED' and prsn_type_id = 'DRIVER' group by crash_id), flags as (select crash_id, count(distinct coalesce(veh_hnr_fl, '')) n_flags from units group by crash_id) select cast(coalesce(sum(n_people * n_flags), 0) as bigint) row_count from others join flags using (crash_id)""",
    "v_non_female_pairs": """with females as (select crash_id from primary_person where prsn_gndr_id = 'FEMALE' group by crash_id), pairs as (select crash_id, drvr_lic_state_id from primary_person where drvr_lic_cls_id <> 'OTHER/OUT OF STATE' group by crash_id, drvr_lic_state_id), kept as (select * from pairs p where (p.crash_id is not null or not exists (select 1 from females)) and not exists (select 1 from females f where f.crash_id is null) and not exists (select 1 from females f where f.crash_id = p.crash_id)) select count(*) pair_count from kept""",
    "v_non_female_state": """with females as (select crash_id from primary_person where prsn_gndr_id = 'FEMALE' group by crash_id), pairs as (select crash_id, drvr_lic_state_id from primary_person where drvr_lic_cls_id <> 'OTHER/OUT OF STATE' group by crash_id, drvr_lic_state_id), kept as (select * from pairs p where (p.crash_id is not null or not exists (select 1 from females)) and not exists (select 1 from females f where f.crash_id is null) and not exists (select 1 from females f where f.crash_id = p.crash_id)), counted as (select drvr_lic_state_id, count(*) state_count from kept group by drvr_lic_state_id), placed as (select *, row_number() over (order by state_count desc, drvr_lic_state_id nulls last) place from counted) select drvr_lic_state_id, state_count from placed where place = 1""",
    "v_rank_3_to_7": """with cars as (select crash_id, veh_make_id, cast(tot_injry_cnt as decimal(20,4)) hurt, cast(death_cnt as decimal(20,4)) dead from units where veh_make_id <> 'NA' group by crash_id, veh_make_id, tot_injry_cnt, death_cnt), totals as (select veh_make_id, cast(sum(hurt + dead) as bigint) sum_cas from cars group by veh_make_id), placed as (select *, row_number() over (order by sum_cas desc nulls last, veh_make_id) place from totals) select veh_make_id, sum_cas from placed where place between 3 and 7""",
    "v_zip_dedup_first": """with alcohol as (select distinct crash_id from units where concat_ws('|', contrib_factr_1_id, contrib_factr_2_id, contrib_factr_p1_id) like '%ALCOHOL%') select drvr_zip, count(distinct p.crash_id) tot_count from primary_person p semi join alcohol a on p.crash_id = a.crash_id where drvr_zip is not null group by drvr_zip order by tot_count desc, drvr_zip limit 5""",
    "v_no_damage_not_in": """select count(*) crash_count from (select distinct crash_id from units where crash_id not in (select crash_id from damages) and (veh_dmag_scl_1_id in ('DAMAGED 5','DAMAGED 6','DAMAGED 7 HIGHEST') or veh_dmag_scl_2_id in ('DAMAGED 5','DAMAGED 6','DAMAGED 7 HIGHEST')) and fin_resp_type_id like '%INSURANCE%') z""",
    "v_speeding_in": """with vehicles as (select distinct crash_id, veh_make_id, unit_nbr, veh_color_id, veh_lic_state_id from units), colours as (select veh_color_id from units where veh_color_id <> 'NA' group by veh_color_id order by count(distinct (crash_id, unit_nbr)) desc, veh_color_id limit 10), states as (select veh_lic_state_id from units where veh_lic_state_id not in ('Unknown', 'NA') group by veh_lic_state_id order by count(distinct struct_pack(c := crash_id)) desc, veh_lic_state_id limit 25), licensed as (select crash_id, count(*) n from primary_person where drvr_lic_cls_id like '%CLASS%' group by crash_id), speeding as (select crash_id, count(*) n from charges where charge like '%SPEED%' group by crash_id) select veh_make_id, cast(sum(l.n * s.n) as bigint) make_count from vehicles v join licensed l using (crash_id) join speeding s using (crash_id) semi join colours using (veh_color_id) semi join states using (veh_lic_state_id) group by veh_make_id order by make_count desc, veh_make_id nulls last limit 5""",
    "v_hnr_vehicles": """select count(*) vehicle_count from (select distinct u.crash_id,u.unit_nbr from units u join primary_person p on u.crash_id=p.crash_id and u.unit_nbr=p.unit_nbr where veh_hnr_fl='Y' and prsn_type_id='DRIVER' and drvr_lic_cls_id like '%CLASS%') z""",
}

STAR_SQL = {
    "s_having": """select l_orderkey, count(*) line_count from lineitem where l_returnflag='R' group by l_orderkey having count(*)>2""",
    "s_entities": """select count(*) entity_count from (select distinct l_orderkey,l_linenumber from lineitem join part on l_partkey=p_partkey where p_type='PROMO') z""",
    "s_topk": """select p_brand, count(*) cnt from (select distinct l_orderkey,p_brand from lineitem join part on l_partkey=p_partkey) z group by p_brand order by cnt desc, p_brand limit 5""",
    "s_semi": """select c_custkey from customer c where exists (select 1 from orders o where o.o_custkey=c.c_custkey and o_orderstatus='F')""",
    "s_anti": """select c_custkey from customer c where not exists (select 1 from orders o where o.o_custkey=c.c_custkey and o_orderstatus='F')""",
    "s_band": """select n_name, count(*) cust_count from customer join nation on c_nationkey=n_nationkey group by n_name order by cust_count desc, n_name limit 3 offset 2""",
    "s_top1": """select o_orderstatus, o_orderpriority from (select o_orderstatus,o_orderpriority,row_number() over (partition by o_orderstatus order by count(*) desc, o_orderpriority) rn from orders group by o_orderstatus,o_orderpriority) z where rn=1""",
    "s_first": """select user_id, event_type, event_id from (select user_id,event_type,event_id,row_number() over (partition by user_id,event_type order by ts,event_id) rn from events) z where rn=1""",
    "s_topn": """select l_returnflag, count(*) line_count from lineitem where l_suppkey in (select l_suppkey from (select l_suppkey,count(*) c from lineitem group by l_suppkey order by c desc, l_suppkey limit 10) t) group by l_returnflag""",
    "s_except": """select o_orderkey from orders except select l_orderkey from lineitem""",
}

UNIT_COLUMNS_SQL = (
    "crash_id, unit_nbr, veh_hnr_fl, veh_body_styl_id, veh_make_id, veh_color_id, veh_lic_state_id, "
    "CAST(CAST(tot_injry_cnt AS DECIMAL(20,4)) AS BIGINT) AS tot_injry_cnt, "
    "CAST(CAST(death_cnt AS DECIMAL(20,4)) AS BIGINT) AS death_cnt, "
    "contrib_factr_1_id, contrib_factr_2_id, contrib_factr_p1_id, veh_dmag_scl_1_id, veh_dmag_scl_2_id, "
    "fin_resp_type_id"
)

JOB_ANALYSES = ["a01", "a02", "a03", "a04", "a05", "a06", "a07", "a08", "a09", "a10"]

IO_SQL = {
    "o_csv_roundtrip": "select * from units",
    "o_csv_typed": f"select {UNIT_COLUMNS_SQL} from units",
    "o_csv_inferred": "select cast(crash_id as integer) crash_id, cast(unit_nbr as integer) unit_nbr, "
                      "cast(prsn_nbr as integer) prsn_nbr, cast(drvr_zip as integer) drvr_zip from primary_person",
    "o_csv_headers": "select * from units",
    "o_csv_bad_rows": "select 'damages' table_name, count(*) filter (damaged_property not in ('1-URGENT', '2-HIGH')) good_rows, "
                      "count(*) filter (damaged_property in ('1-URGENT', '2-HIGH')) bad_rows from damages",
    "o_not_in_parts": """with insured as (select distinct crash_id from units where (veh_dmag_scl_1_id in ('DAMAGED 5','DAMAGED 6','DAMAGED 7 HIGHEST') or veh_dmag_scl_2_id in ('DAMAGED 5','DAMAGED 6','DAMAGED 7 HIGHEST')) and fin_resp_type_id like '%INSURANCE%') select 'unknown' damaged_part, count(*) crash_count from insured where crash_id not in (select crash_id from damages where crash_id is null) union all select 'known', count(*) from insured where crash_id not in (select crash_id from damages where crash_id is not null) union all select 'none', count(*) from insured where crash_id not in (select crash_id from damages where damaged_property = '')""",
    "o_single_file": "select count(*) row_count, cast(1 as bigint) file_count from damages",
    "o_extra_tables": "select 'endorse' table_name, drvr_lic_endors_id code, count(*) row_count from endorse group by 2 "
                      "union all select 'restrict', drvr_lic_restric_id, count(*) from restrict group by 2",
    "o_sql_in": CRASH_SQL["v_top_makes_in"],
    "o_sql_not_in": CRASH_SQL["v_non_female_pairs"],
    "o_sql_cte": CRASH_SQL["v_bottom_makes"],
    "o_views": "select veh_hnr_fl, count(*) as unit_rows from units group by veh_hnr_fl",
    "o_sql_views": CRASH_SQL["a01"],
    "o_job_all": " union all ".join(
        f"select '{name}' as analysis, count(*) as row_count from ({CRASH_SQL[name]}) r_{name}"
        for name in JOB_ANALYSES
    ),
}


def with_crash_tables(sql: str) -> str:
    if sql.startswith("with "):
        return f"with {CRASH_PREFIX},\n{sql.removeprefix('with ')}"
    return f"with {CRASH_PREFIX}\n{sql}"


def all_oracles() -> dict[str, str]:
    out = {name: with_crash_tables(sql) for name, sql in {**CRASH_SQL, **IO_SQL}.items()}
    out.update(STAR_SQL)
    return out
