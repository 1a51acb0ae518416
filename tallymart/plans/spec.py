"""What each table holds: raw variables, keys, published column names."""

from __future__ import annotations

from tallymart.operators.project import Field
from tallymart.plans import codebook as codes

YEAR = "survey_year"
PERSON_KEY = ["dwelling_id", "household_no", "sequence_no", "person_no", YEAR]
HOUSEHOLD_KEY = ["dwelling_id", "household_no", YEAR]
DWELLING_KEY = ["dwelling_id", YEAR]
#: clean tables are partitioned by year and bucketed by these
PERSON_BUCKETS = PERSON_KEY[:4]

# The variable names are those of the survey files.

_PERSON_KEY_FIELDS = [
    Field("dwelling_id", "DIRECTORIO", required=True),
    Field("household_no", "SECUENCIA_ENCUESTA", "int", required=True),
    Field("sequence_no", "SECUENCIA_P", "int", required=True),
    Field("person_no", "ORDEN", "int", required=True),
    Field(YEAR, YEAR, "int", required=True),
]

DWELLING = [
    *_PERSON_KEY_FIELDS[:4],
    Field("complete_households", "CANT_HOG_COMPLETOS"),
    _PERSON_KEY_FIELDS[4],
    Field("dwelling_type", "P1070", "code", codes.DWELLING_TYPE),
    Field("wall_material", "P4005", "code", codes.WALL_MATERIAL),
    Field("floor_material", "P4015", "code", codes.FLOOR_MATERIAL),
    Field("roof_material", "P4567", "code", codes.ROOF_MATERIAL),
    Field("urban_class", "CLASE", "code", codes.URBAN_CLASS),
    Field("region", "REGION", "code", codes.REGION),
    Field("power", "P8520S1", "flag"),
    Field("water", "P8520S5", "flag"),
    Field("sewer", "P8520S3", "flag"),
    Field("waste_collection", "P8520S4", "flag"),
    Field("flood_risk", "P4065S1", "flag"),
    Field("avalanche_risk", "P4065S2", "flag"),
    Field("subsidence_risk", "P4065S3", "flag"),
    Field("storm_risk", "P4065S4", "flag"),
    Field("damp", "P1891S1", "flag"),
    Field("leaks", "P1891S2", "flag"),
    Field("wall_cracks", "P1891S3", "flag"),
    Field("floor_cracks", "P1891S4", "flag"),
    Field("ceiling_faults", "P1891S5", "flag"),
    Field("weight", "FEX_C", "number"),
]

DWELLING_COLUMNS = [
    "dwelling_id", "household_no", "sequence_no", "person_no",
    "complete_households", YEAR,
    "dwelling_type", "wall_material", "floor_material", "roof_material",
    "urban_class", "region",
    "power", "water", "sewer", "waste_collection", "lacks_services",
    "flood_risk", "avalanche_risk", "subsidence_risk", "storm_risk", "at_risk",
    "damp", "leaks", "wall_cracks", "floor_cracks", "ceiling_faults",
    "weight",
]

MEMBER = [
    *_PERSON_KEY_FIELDS,
    Field("sex", "P6020", "code", codes.SEX),
    Field("age", "P6040", "int"),
    Field("civil_status", "P5502", "code", codes.CIVIL_STATUS),
    Field("ethnicity", "P6080", "code", codes.ETHNICITY),
    Field("household_key", "LLAVEHOG"),
    Field("life_score", "P1895", "int"),
    Field("income_score", "P1896", "int"),
    Field("health_score", "P1897", "int"),
    Field("safety_score", "P1898", "int"),
    Field("work_score", "P1899", "int"),
    Field("birthplace_code", "P756"),
    Field("birthplace", "P756", "code", codes.BIRTHPLACE),
    Field("birth_dept_code", "P756S1", "int"),
    Field("birth_town_code", "P756S2", "int"),
    Field("weight", "FEX_C", "number"),
]

MEMBER_COLUMNS = [
    *PERSON_KEY,
    "sex", "age", "age_band", "civil_status", "ethnicity", "household_key",
    "life_score", "income_score", "health_score", "safety_score", "work_score",
    "birthplace",
    "birth_dept_code", "birth_dept", "birth_town_code", "birth_town",
    "born_abroad", "born_elsewhere", "migrant",
    "weight",
]

EDUCATION = [
    *_PERSON_KEY_FIELDS,
    Field("literate", "P6160", "flag"),
    Field("studying", "P8586", "flag"),
    Field("level", "P8587", "code", codes.EDUCATION_LEVEL),
    Field("grade", "P8587S1", "int"),
    Field("higher_years", "P6211", "int"),
    Field("not_studying_reason", "P6218", "code", codes.NOT_STUDYING_REASON),
    Field("school_type", "P5673", "code", codes.SCHOOL_TYPE),
    Field("school_shift", "P1101", "code", codes.SCHOOL_SHIFT),
    Field("scholarship", "P8610", "flag"),
    Field("scholarship_amount", "P8610S1", "money"),
    Field("scholarship_entity", "P6229", "code", codes.SCHOLARSHIP_ENTITY),
    Field("subsidy", "P8612", "flag"),
    Field("subsidy_amount", "P8612S1", "money"),
    Field("credit", "P8614", "flag"),
    Field("credit_amount", "P8614S1", "money"),
    Field("household_key", "LLAVEHOG"),
    Field("weight", "FEX_C", "number"),
]

SUPPORT_COLUMNS = [
    "literate", "studying", "level", "grade", "higher_years",
    "not_studying_reason", "school_type", "school_shift",
    "scholarship", "scholarship_amount", "scholarship_entity",
    "subsidy", "subsidy_amount", "credit", "credit_amount", "any_support",
]

EDUCATION_COLUMNS = [*PERSON_KEY, *SUPPORT_COLUMNS, "household_key", "weight"]

PLACE_COLUMNS = ["region", "urban_class", "at_risk", "lacks_services"]

PERSON_COLUMNS = [*MEMBER_COLUMNS, *SUPPORT_COLUMNS, *PLACE_COLUMNS]

# Names the geography sources use, after name normalising, and ours.
DEPARTMENT_NAMES = {
    "codigo_deapartamento": "dept_code",
    "codigo_departamento": "dept_code",
    "nombre_departamento": "dept_name",
    "codigopais": "country_code",
}
SHEET_TOWN_NAMES = {
    "codigo_departamento": "dept_code",
    "nombre_departamento": "dept_name",
    "codigo_municipio": "short_town_code",
    "nombre_municipio": "town_name",
    "municipio_id": "town_code",
}
DATABASE_TOWN_NAMES = {
    "codigodepartamento": "dept_code",
    "nombremunicipio": "town_name",
    "municipio_id": "town_code",
}

# Names under which reports know the published columns.
PUBLISHED_NAMES = {
    "dwelling_id": "directorio",
    "household_no": "secuencia_encuesta",
    "sequence_no": "secuencia_p",
    "person_no": "orden",
    "survey_year": "anio_encuesta",
    "person_sk": "sk_persona",
    "dwelling_sk": "sk_vivienda",
    "education_sk": "sk_educacion",
    "location_sk": "sk_ubicacion",
    "time_sk": "sk_tiempo",
    "year": "anio",
    "decade": "decada",
    "is_current_year": "es_anio_actual",
    "dwelling_type": "tipo_vivienda",
    "wall_material": "material_paredes",
    "floor_material": "material_pisos",
    "roof_material": "material_techo",
    "urban_class": "clase_geografica",
    "power": "energia_electrica",
    "water": "acueducto",
    "sewer": "alcantarillado",
    "waste_collection": "recoleccion_basuras",
    "lacks_services": "sin_servicios_basicos",
    "flood_risk": "riesgo_inundacion",
    "avalanche_risk": "riesgo_avalancha",
    "subsidence_risk": "riesgo_hundimiento",
    "storm_risk": "riesgo_tormenta",
    "at_risk": "vivienda_en_riesgo",
    "damp": "problema_humedades",
    "leaks": "problema_goteras",
    "wall_cracks": "problema_grietas_paredes",
    "floor_cracks": "problema_grietas_piso",
    "ceiling_faults": "problema_cielorrasos",
    "sex": "sexo",
    "age": "edad",
    "age_band": "rango_edad",
    "civil_status": "estado_civil",
    "ethnicity": "raza",
    "birthplace": "lugar_nacimiento",
    "birth_dept_code": "cod_dept_nacimiento",
    "birth_dept": "nombre_dept_nacimiento",
    "birth_town_code": "cod_mun_nacimiento",
    "birth_town": "nombre_mun_nacimiento",
    "born_abroad": "nacio_en_otro_pais",
    "born_elsewhere": "nacio_en_otro_municipio",
    "migrant": "es_migrante",
    "life_score": "satisfaccion_vida",
    "income_score": "satisfaccion_ingresos",
    "health_score": "satisfaccion_salud",
    "safety_score": "satisfaccion_seguridad",
    "work_score": "satisfaccion_trabajo",
    "weight": "factor_expansion",
    "literate": "sabe_leer_escribir",
    "studying": "actualmente_estudia",
    "level": "nivel_educativo",
    "grade": "grado_aprobado",
    "higher_years": "anios_estudios_superiores",
    "not_studying_reason": "razon_no_estudiar",
    "school_type": "tipo_establecimiento",
    "school_shift": "jornada_educativa",
    "scholarship": "recibio_beca",
    "scholarship_amount": "valor_beca",
    "scholarship_entity": "entidad_beca",
    "subsidy": "recibio_subsidio",
    "subsidy_amount": "valor_subsidio",
    "credit": "recibio_credito",
    "credit_amount": "valor_credito",
    "any_support": "recibio_apoyo_educativo",
    "persons": "total_personas",
}
PUBLISHED_FACT_NAMES = {
    "students": "total_estudiante",
    "scholars": "total_becados",
    "subsidised": "total_subsidiados",
    "credited": "total_credito",
    "supported": "total_apoyo",
    "persons_at_risk": "total_en_riesgo",
    "persons_unserved": "total_sin_servicios",
    "scholarship_amount": "monto_beca",
    "subsidy_amount": "monto_subsidio",
    "credit_amount": "monto_credito",
}
PUBLISHED_KPI_NAMES = {
    "students": "total_estudiantes",
    "scholars": "total_becados",
    "subsidised": "total_subsidiados",
    "credited": "total_credito",
    "supported": "total_con_apoyo",
    "scholarship_total": "monto_total_becas",
    "subsidy_total": "monto_total_subsidios",
    "credit_total": "monto_total_creditos",
    "scholarship_pct": "margen_cobertura_becas_pct",
    "subsidy_pct": "margen_cobertura_subsidios_pct",
    "support_pct": "margen_cobertura_apoyo_total_pct",
    "scholar_growth_pct": "crecimiento_becas_pct",
    "persons_at_risk": "personas_en_vivienda_riesgo",
    "persons_unserved": "personas_sin_servicios_basicos",
    "at_risk_pct": "pct_en_riesgo",
    "unserved_pct": "pct_sin_servicios",
}
PUBLISHED_TABLES = {
    "dim_time": ("dim_tiempo", {}),
    "dim_location": ("dim_ubicacion", {}),
    "dim_person": ("dim_persona", {}),
    "dim_dwelling": ("dim_vivienda", {}),
    "dim_education": ("dim_educacion", {}),
    "fact_survey": ("fac_encuesta", PUBLISHED_FACT_NAMES),
    "kpi_scholarships_yearly": ("kpi_becas_anuales", PUBLISHED_KPI_NAMES),
    "kpi_living_conditions": ("kpi_condiciones_vida_region", PUBLISHED_KPI_NAMES),
}
