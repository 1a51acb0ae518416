"""SQL for the star, written from the meaning of the fixture, not from the plans."""

from __future__ import annotations

from collections.abc import Mapping

from tallymart.plans import codebook as codes


def _label(code: str, entries: Mapping[str, str]) -> str:
    cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in entries.items())
    return f"CASE {code} {cases} END"


def sk(*parts: str) -> str:
    text = " || '||' || ".join(f"coalesce(CAST({p} AS VARCHAR), 'NULL')" for p in parts)
    return f"CAST('0x' || substr(sha256({text}), 1, 15) AS BIGINT)"


_KEY = """CAST(o_custkey AS VARCHAR) AS dwelling_id,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS household_no,
  CAST(o_orderkey // 1000000 + 1 AS INTEGER) AS sequence_no,
  CAST(o_orderkey % 1000000 + 1 AS INTEGER) AS person_no,
  CAST(year(o_orderdate) AS INTEGER) AS survey_year"""

PERSON_KEY = "dwelling_id, household_no, sequence_no, person_no, survey_year"
PERSON_SK = sk("dwelling_id", "household_no", "sequence_no", "person_no", "survey_year")
DWELLING_SK = sk("dwelling_id", "survey_year")

_DWELLING_COLUMNS = """dwelling_id, household_no, sequence_no, person_no,
  complete_households, survey_year, dwelling_type, wall_material, floor_material,
  roof_material, urban_class, region, power, water, sewer, waste_collection,
  lacks_services, flood_risk, avalanche_risk, subsidence_risk, storm_risk, at_risk,
  damp, leaks, wall_cracks, floor_cracks, ceiling_faults, weight"""

_HOUSEHOLD = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"

DWELLING = f"""
dwelling_row AS (
  SELECT {_KEY},
  '5' AS complete_households,
  {_label('o_custkey % 6', codes.DWELLING_TYPE)} AS dwelling_type,
  {_label('o_custkey % 10', codes.WALL_MATERIAL)} AS wall_material,
  {_label('o_custkey % 8', codes.FLOOR_MATERIAL)} AS floor_material,
  {_label(f'(o_custkey + {_HOUSEHOLD}) % 8', codes.ROOF_MATERIAL)} AS roof_material,
  {_label('c_nationkey % 3', codes.URBAN_CLASS)} AS urban_class,
  CASE WHEN year(o_orderdate) = 1995 OR o_custkey % 17 = 0 THEN NULL
       ELSE {_label('n_regionkey + 1', codes.REGION)} END AS region,
  c_acctbal >= 0 AS power,
  CASE o_custkey % 3 WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS water,
  CASE WHEN o_custkey % 7 <> 0 THEN {_HOUSEHOLD} % 2 = 0 END AS sewer,
  TRUE AS waste_collection,
  c_acctbal < 0 OR o_custkey % 3 = 2 OR (o_custkey % 7 <> 0 AND {_HOUSEHOLD} % 2 = 1)
    AS lacks_services,
  (o_custkey + {_HOUSEHOLD}) % 5 = 0 AS flood_risk,
  o_custkey % 11 = 0 AS avalanche_risk,
  CAST(NULL AS BOOLEAN) AS subsidence_risk,
  c_mktsegment = 'BUILDING' AND o_custkey % 4 = 0 AS storm_risk,
  (o_custkey + {_HOUSEHOLD}) % 5 = 0 OR o_custkey % 11 = 0
    OR (c_mktsegment = 'BUILDING' AND o_custkey % 4 = 0) AS at_risk,
  CASE o_orderkey % 3 WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS damp,
  CASE o_orderkey % 4 WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS leaks,
  o_orderstatus = 'F' AS wall_cracks,
  CAST(NULL AS BOOLEAN) AS floor_cracks,
  CAST(NULL AS BOOLEAN) AS ceiling_faults,
  CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS weight
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
dwelling AS (
  SELECT {_DWELLING_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY dwelling_id, household_no, survey_year
      ORDER BY sequence_no, person_no) AS turn FROM dwelling_row)
  WHERE turn = 1),
first_household AS (
  SELECT {_DWELLING_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY dwelling_id, survey_year
      ORDER BY household_no) AS turn FROM dwelling)
  WHERE turn = 1)"""

GEOGRAPHY = """
town AS (
  SELECT CAST(n_regionkey AS INTEGER) AS dept_code, n_name AS town_name,
         CAST(n_nationkey AS INTEGER) AS town_code, 'excel' AS source
  FROM nation WHERE n_nationkey <> 24
  UNION ALL
  SELECT CAST(s_nationkey % 6 AS INTEGER), s_name, CAST(s_suppkey AS INTEGER), 'mysql'
  FROM supplier
  WHERE s_suppkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey <> 24)),
geography AS (
  SELECT dept_code, r_name AS dept_name, town_code, town_name, source
  FROM town LEFT JOIN region ON r_regionkey = dept_code)"""

MEMBER = f"""
member_row AS (
  SELECT {_KEY}, o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(trunc(o_totalprice / 5000) AS INTEGER) END AS age,
  CASE WHEN o_orderkey % 4 = 2 THEN CAST(o_custkey % 130 AS INTEGER) END AS birth_town_code
  FROM orders),
member AS (
  SELECT {PERSON_KEY},
  CASE o_orderstatus WHEN 'F' THEN 'Hombre' WHEN 'O' THEN 'Mujer' END AS sex,
  age,
  CASE WHEN age IS NULL THEN NULL WHEN age < 18 THEN '0-17' WHEN age < 30 THEN '18-29'
       WHEN age < 60 THEN '30-59' ELSE '60+' END AS age_band,
  {_label('o_orderkey % 7', codes.CIVIL_STATUS)} AS civil_status,
  {_label('o_custkey % 7', codes.ETHNICITY)} AS ethnicity,
  CAST(o_custkey AS VARCHAR) || '-' || substr(o_orderpriority, 1, 1) AS household_key,
  CAST(o_orderkey % 11 AS INTEGER) AS life_score,
  CAST(o_custkey % 11 AS INTEGER) AS income_score,
  CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 10 AS INTEGER) END AS health_score,
  CAST(o_orderkey % 9 AS INTEGER) AS safety_score,
  CAST(NULL AS INTEGER) AS work_score,
  {_label('o_orderkey % 4', codes.BIRTHPLACE)} AS birthplace,
  CASE WHEN o_orderkey % 4 = 2 THEN CAST(o_custkey % 5 AS INTEGER) END AS birth_dept_code,
  g.dept_name AS birth_dept,
  birth_town_code,
  g.town_name AS birth_town,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 4 = 3 END AS born_abroad,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 4 = 2 END AS born_elsewhere,
  o_orderkey % 4 IN (2, 3) AS migrant,
  CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS weight
  FROM member_row LEFT JOIN geography g ON g.town_code = birth_town_code)"""

_SUPPORT_COLUMNS = """literate, studying, level, grade, higher_years, not_studying_reason,
  school_type, school_shift, scholarship, scholarship_amount, scholarship_entity,
  subsidy, subsidy_amount, credit, credit_amount, any_support"""

EDUCATION = f"""
education_row AS (
  SELECT {_KEY},
  CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS literate,
  l_linestatus = 'F' AS studying,
  {_label('CAST(l_quantity AS INTEGER) % 14', codes.EDUCATION_LEVEL)} AS level,
  CAST(l_linenumber AS INTEGER) AS grade,
  CAST(nullif(l_suppkey % 7, 0) AS INTEGER) AS higher_years,
  {_label('CAST(l_quantity AS INTEGER) % 17', codes.NOT_STUDYING_REASON)} AS not_studying_reason,
  {_label('l_linenumber % 3', codes.SCHOOL_TYPE)} AS school_type,
  {_label('l_linenumber % 6', codes.SCHOOL_SHIFT)} AS school_shift,
  CASE WHEN l_returnflag = 'R' THEN TRUE
       WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL ELSE FALSE END AS scholarship,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(14,2))
       ELSE CAST(0 AS DECIMAL(14,2)) END AS scholarship_amount,
  CASE WHEN l_returnflag = 'R' THEN {_label('l_suppkey % 9', codes.SCHOLARSHIP_ENTITY)} END
    AS scholarship_entity,
  CAST(l_discount AS DECIMAL(4,2)) >= 0.05 AS subsidy,
  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2))
       AS DECIMAL(14,2)) AS subsidy_amount,
  CAST(l_tax AS DECIMAL(4,2)) >= 0.04 AS credit,
  CASE WHEN CAST(l_tax AS DECIMAL(4,2)) < 0.04 OR l_suppkey % 10 = 0
       THEN CAST(0 AS DECIMAL(14,2))
       ELSE CAST(CAST(l_quantity AS INTEGER) + 0.5 AS DECIMAL(14,2)) END AS credit_amount,
  l_returnflag = 'R' OR CAST(l_discount AS DECIMAL(4,2)) >= 0.05
    OR CAST(l_tax AS DECIMAL(4,2)) >= 0.04 AS any_support,
  CAST(NULL AS VARCHAR) AS household_key,
  CAST(CAST(l_quantity AS DECIMAL(14,2)) AS DOUBLE) AS weight,
  CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '2' END AS raw_literate,
  CASE l_linestatus WHEN 'F' THEN '1' ELSE '2' END AS raw_studying,
  CAST(CAST(l_quantity AS INTEGER) % 14 AS VARCHAR) AS raw_level,
  CAST(l_linenumber AS VARCHAR) || '.0' AS raw_grade,
  CASE WHEN l_suppkey % 7 = 0 THEN 'n/d' ELSE CAST(l_suppkey % 7 AS VARCHAR) END AS raw_years,
  CAST(CAST(l_quantity AS INTEGER) % 17 AS VARCHAR) AS raw_reason,
  CASE WHEN l_returnflag = 'R' THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR), '.', ',') END
    AS raw_amount,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_suppkey % 9 AS VARCHAR) END AS raw_entity,
  CASE WHEN CAST(l_discount AS DECIMAL(4,2)) >= 0.05 THEN '1' ELSE '2' END AS raw_subsidy,
  replace(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR), '.', ',')
    AS raw_subsidy_amount,
  CASE WHEN CAST(l_tax AS DECIMAL(4,2)) >= 0.04 THEN '1' ELSE '2' END AS raw_credit,
  replace(CAST(CAST(l_quantity AS DECIMAL(14,2)) AS VARCHAR), '.', ',') AS raw_weight
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
education AS (
  SELECT {PERSON_KEY}, {_SUPPORT_COLUMNS}, household_key, weight FROM (
    SELECT *, row_number() OVER (PARTITION BY {PERSON_KEY}
      ORDER BY raw_literate NULLS FIRST, raw_studying, raw_level, raw_grade, raw_years, raw_reason,
        raw_amount NULLS FIRST, raw_entity NULLS FIRST, raw_subsidy, raw_subsidy_amount, raw_credit,
        raw_weight) AS turn
    FROM education_row)
  WHERE turn = 1)"""

_PERSON_JOIN = " AND ".join(
    f"e.{k.strip()} = m.{k.strip()}" for k in PERSON_KEY.split(",")
)

PERSON = f"""
person AS (
  SELECT m.*, {', '.join('e.' + c.strip() for c in _SUPPORT_COLUMNS.split(','))},
         h.region, h.urban_class, h.at_risk, h.lacks_services
  FROM member m LEFT JOIN education e ON {_PERSON_JOIN}
  LEFT JOIN first_household h
    ON h.dwelling_id = m.dwelling_id AND h.survey_year = m.survey_year)"""

FACT = f"""
located AS (
  SELECT DISTINCT region FROM dwelling WHERE region IS NOT NULL),
dim_location AS (
  SELECT {sk('region')} AS location_sk,
         CAST(CASE region {' '.join(f"WHEN '{v}' THEN {k}" for k, v in codes.REGION.items())} END
              AS INTEGER) AS region_id,
         region FROM located),
fact AS (
  SELECT p.dwelling_id, p.household_no, p.sequence_no, p.person_no, p.survey_year,
    {sk('p.dwelling_id', 'p.household_no', 'p.sequence_no', 'p.person_no', 'p.survey_year')}
      AS person_sk,
    {sk('p.dwelling_id', 'p.survey_year')} AS dwelling_sk,
    CASE WHEN e.dwelling_id IS NOT NULL THEN
      {sk('e.dwelling_id', 'e.household_no', 'e.sequence_no', 'e.person_no', 'e.survey_year')} END
      AS education_sk,
    l.location_sk, p.survey_year AS time_sk,
    CAST(1 AS INTEGER) AS persons,
    CASE WHEN p.studying THEN 1 ELSE 0 END AS students,
    CASE WHEN p.scholarship THEN 1 ELSE 0 END AS scholars,
    CASE WHEN p.subsidy THEN 1 ELSE 0 END AS subsidised,
    CASE WHEN p.credit THEN 1 ELSE 0 END AS credited,
    CASE WHEN p.any_support THEN 1 ELSE 0 END AS supported,
    CASE WHEN h.at_risk THEN 1 ELSE 0 END AS persons_at_risk,
    CASE WHEN h.lacks_services THEN 1 ELSE 0 END AS persons_unserved,
    coalesce(p.scholarship_amount, CAST(0 AS DECIMAL(14,2))) AS scholarship_amount,
    coalesce(p.subsidy_amount, CAST(0 AS DECIMAL(14,2))) AS subsidy_amount,
    coalesce(p.credit_amount, CAST(0 AS DECIMAL(14,2))) AS credit_amount,
    p.weight
  FROM person p
  LEFT JOIN first_household h
    ON h.dwelling_id = p.dwelling_id AND h.survey_year = p.survey_year
  LEFT JOIN education e
    ON e.dwelling_id = p.dwelling_id AND e.household_no = p.household_no
   AND e.sequence_no = p.sequence_no AND e.person_no = p.person_no
   AND e.survey_year = p.survey_year
  LEFT JOIN dim_location l ON l.region = p.region)"""

DIMENSIONS = f"""
dim_person AS (
  SELECT {PERSON_SK} AS person_sk, {PERSON_KEY}, sex, age, age_band, civil_status, ethnicity,
    birthplace, birth_dept_code, birth_dept, birth_town_code, birth_town,
    born_abroad, born_elsewhere, migrant,
    life_score, income_score, health_score, safety_score, work_score, weight
  FROM person),
dim_dwelling AS (
  SELECT {DWELLING_SK} AS dwelling_sk, dwelling_id, survey_year,
    dwelling_type, wall_material, floor_material, roof_material, urban_class, region,
    power, water, sewer, waste_collection, lacks_services,
    flood_risk, avalanche_risk, subsidence_risk, storm_risk, at_risk,
    damp, leaks, wall_cracks, floor_cracks, ceiling_faults
  FROM first_household),
dim_education AS (
  SELECT {PERSON_SK} AS education_sk, {PERSON_KEY}, {_SUPPORT_COLUMNS} FROM education),
dim_time AS (
  SELECT DISTINCT survey_year AS time_sk, survey_year AS year,
    substr(CAST(survey_year AS VARCHAR), 1, 3) || '0s' AS decade,
    survey_year = 2000 AS is_current_year
  FROM person)"""


def _pct(part: str, whole: str) -> str:
    return f"round({part} * 100.0 / nullif({whole}, 0), 2)"


_SUMS = {
    "persons": "persons", "students": "students", "scholars": "scholars",
    "subsidised": "subsidised", "credited": "credited", "supported": "supported",
}

KPIS = f"""
yearly AS (
  SELECT survey_year,
    {', '.join(f'CAST(sum({c}) AS BIGINT) AS {n}' for n, c in _SUMS.items())},
    CAST(sum(scholarship_amount) AS DECIMAL(24,2)) AS scholarship_total,
    CAST(sum(subsidy_amount) AS DECIMAL(24,2)) AS subsidy_total,
    CAST(sum(credit_amount) AS DECIMAL(24,2)) AS credit_total
  FROM fact GROUP BY survey_year),
kpi_scholarships_yearly AS (
  SELECT *, {_pct('scholars', 'students')} AS scholarship_pct,
    {_pct('subsidised', 'students')} AS subsidy_pct,
    {_pct('supported', 'students')} AS support_pct,
    round((scholars - lag(scholars) OVER (ORDER BY survey_year)) * 100.0
      / nullif(lag(scholars) OVER (ORDER BY survey_year), 0), 2) AS scholar_growth_pct
  FROM yearly),
regional AS (
  SELECT survey_year, region_id, region, CAST(sum(persons) AS BIGINT) AS persons,
    CAST(sum(persons_at_risk) AS BIGINT) AS persons_at_risk,
    CAST(sum(persons_unserved) AS BIGINT) AS persons_unserved
  FROM fact JOIN dim_location USING (location_sk) GROUP BY 1, 2, 3),
kpi_living_conditions AS (
  SELECT *, {_pct('persons_at_risk', 'persons')} AS at_risk_pct,
    {_pct('persons_unserved', 'persons')} AS unserved_pct
  FROM regional)"""

CHAIN = [DWELLING, GEOGRAPHY, MEMBER, EDUCATION, PERSON, FACT, DIMENSIONS, KPIS]


def over(*parts: str, sql: str) -> str:
    """``sql`` after the named parts, or after all of them."""
    return "WITH " + ",".join(parts or CHAIN) + "\n" + sql


pct = _pct
