"""SQL for the independent engine that checks the results: shared fragments of the star."""

from __future__ import annotations


def rounded(expr: str, digits: int) -> str:
    """Half-up rounding of a double by its shortest decimal form, as Spark rounds."""
    return f"CAST(round(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return f"CASE WHEN {whole} <> 0 THEN {rounded(f'CAST({part} AS DOUBLE) * 100.0 / CAST({whole} AS DOUBLE)', digits)} END"


MONTH_LIST = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre']"

PARTS = """parts AS (
  SELECT p_partkey, p_size, CASE p_partkey % 9
    WHEN 0 THEN 'covid-19, virus identificado (u07.1) '
    WHEN 1 THEN 'J' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '9'
    WHEN 2 THEN 'i' || lpad(CAST(p_size AS VARCHAR), 2, '0')
    WHEN 3 THEN 'C' || lpad(CAST(p_size AS VARCHAR), 2, '0')
    WHEN 4 THEN 'X' || lpad(CAST(p_size AS VARCHAR), 2, '0')
    WHEN 5 THEN ' accidente ' || p_name
    WHEN 7 THEN 'W' || lpad(CAST(p_size AS VARCHAR), 2, '0')
    WHEN 8 THEN p_type END AS caudef
  FROM part)"""

RECORDS = PARTS + """, records AS (
  SELECT year(o_orderdate) AS anoreg, month(o_orderdate) AS mesreg, c_nationkey AS depocu,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE','MACHINERY') THEN 1 WHEN c_mktsegment IN ('BUILDING','HOUSEHOLD') THEN 2 ELSE 9 END AS sexo,
    CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE p_size * 2 END AS edadif,
    upper(trim(caudef)) AS caudef
  FROM lineitem JOIN parts ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

CAUSE_CASE = """CASE
    WHEN contains(caudef, 'COVID') OR contains(caudef, 'U07') THEN 'COVID'
    WHEN contains(caudef, 'RESPIRAT') OR regexp_matches(caudef, 'J[0-9]{2}') THEN 'RESP'
    WHEN contains(caudef, 'CARDIO') OR regexp_matches(caudef, 'I[0-9]{2}') THEN 'CARDIO'
    WHEN contains(caudef, 'CANCER') OR contains(caudef, 'NEOPLAS') OR regexp_matches(caudef, 'C[0-9]{2}') THEN 'CANCER'
    WHEN contains(caudef, 'ACCIDENT') OR contains(caudef, 'VIOLENT') OR contains(caudef, 'HOMICID') OR regexp_matches(caudef, '[VXY][0-9]{2}') THEN 'EXTERNA'
    WHEN caudef IS NULL OR caudef = '' THEN 'DESCONOCIDA' ELSE 'OTRA' END"""

FACT_A = RECORDS + f""", fact_a AS (
  SELECT id_tiempo_mes, id_geografia, id_perfil, id_causa, count(*) AS cantidad_fallecidos, 'A' AS fuente FROM (
    SELECT anoreg || '-' || lpad(CAST(mesreg AS VARCHAR), 2, '0') AS id_tiempo_mes, 'N-' || depocu AS id_geografia,
      CASE sexo WHEN 1 THEN 'H' WHEN 2 THEN 'M' ELSE 'A' END || '-' ||
      CASE WHEN edadif IS NULL THEN 'Todas' WHEN edadif < 15 THEN '0-14' WHEN edadif < 65 THEN '15-64' ELSE '65+' END AS id_perfil,
      {CAUSE_CASE} AS id_causa FROM records)
  GROUP BY 1, 2, 3, 4)"""

DAILY = """daily AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS date_reported, r_name AS country,
    CASE WHEN o_orderkey % 13 = 0 THEN CAST('nan' AS DOUBLE) WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey % 7 AS DOUBLE) END AS new_deaths
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

FACT_S = DAILY + """, fact_s AS (
  SELECT substr(date_reported, 1, 7) AS id_tiempo_mes, CASE country WHEN 'AMERICA' THEN 'AM-NA' ELSE 'EU-NA' END AS id_geografia,
    'A-Todas' AS id_perfil, 'COVID' AS id_causa,
    CAST(sum(CASE WHEN new_deaths IS NULL OR isnan(new_deaths) THEN 0 ELSE new_deaths END) AS BIGINT) AS cantidad_fallecidos,
    CASE country WHEN 'AMERICA' THEN 'B' ELSE 'C' END AS fuente
  FROM daily WHERE country IN ('AMERICA', 'EUROPE') AND date_reported >= '1996-01-01'
  GROUP BY 1, 2, 6 HAVING sum(CASE WHEN new_deaths IS NULL OR isnan(new_deaths) THEN 0 ELSE new_deaths END) > 0)"""

FACT = FACT_A + ", " + FACT_S + ", fact AS (SELECT * FROM fact_a UNION ALL SELECT * FROM fact_s)"

EVENTS = """civil AS (
  SELECT year(o_orderdate) AS anio, month(o_orderdate) AS mes_numero, CASE
    WHEN o_orderpriority = '1-URGENT' THEN 'NACIMIENTO'
    WHEN o_orderpriority = '2-HIGH' THEN 'DEFUNCIONES'
    WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN 'Matrimonio civil'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'MATRIMONIO NOTARIAL'
    WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN 'Otros'
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'DIVORCIO'
    WHEN o_orderstatus = 'F' THEN 'ADOPCION' ELSE 'Inscripción tardía' END AS evento, count(*) AS cantidad
  FROM orders GROUP BY 1, 2, 3)"""

EVENT_CASE = """CASE WHEN contains(upper(evento), 'NACIMIENTO') THEN 'Nacimientos' WHEN contains(upper(evento), 'DEFUNCI') THEN 'Defunciones'
    WHEN contains(upper(evento), 'MATRIMONIO') THEN 'Matrimonios' WHEN contains(upper(evento), 'DIVORCIO') THEN 'Divorcios'
    WHEN contains(upper(evento), 'ADOPCION') THEN 'Adopciones' ELSE evento END"""

CONTEXT = EVENTS + f""", ctx AS (
  SELECT anio || '-' || lpad(CAST(mes_numero AS VARCHAR), 2, '0') AS id_tiempo_mes, {EVENT_CASE} AS tipo_evento,
    CAST(sum(cantidad) AS BIGINT) AS cantidad, 'RENAP' AS fuente
  FROM civil WHERE evento NOT IN ('TOTAL GENERAL', 'Total', 'AJUSTE (FILAS FALTANTES EN IMAGEN)', 'Otros') GROUP BY 1, 2)"""

TIME = f"""dim_t AS (
  SELECT strftime(m, '%Y-%m') AS id_tiempo_mes, CAST(year(m) AS BIGINT) AS anio, CAST(month(m) AS BIGINT) AS mes,
    list_extract({MONTH_LIST}, CAST(month(m) AS INTEGER)) AS nombre_mes,
    CASE WHEN strftime(m, '%Y-%m') < '1998-03' THEN 'Pre-COVID' ELSE 'Pandemia' END AS periodo
  FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate)) + INTERVAL 11 MONTH, INTERVAL 1 MONTH)) AS m FROM orders))"""

PLACE = """dim_g AS (
  SELECT 'N-' || n_nationkey AS id_geografia, r_name AS pais, CAST(n_nationkey AS BIGINT) AS id_departamento, n_name AS nombre_departamento
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL VALUES ('AM-NA', 'AMERICA', 99, 'Nacional'), ('EU-NA', 'EUROPE', 0, 'Nacional'))"""

PROFILE = """dim_p AS (
  SELECT l || '-' || b AS id_perfil, s AS sexo, b AS rango_edad
  FROM (VALUES ('H', 'Hombre'), ('M', 'Mujer'), ('A', 'Ambos')) sx(l, s), (VALUES ('0-14'), ('15-64'), ('65+'), ('Todas')) bd(b))"""

CAUSE = """dim_c AS (
  SELECT 'INACIF-' || id AS id_causa, CASE WHEN contains(lower(nombre), 'covid') THEN 'COVID-19' WHEN contains(lower(nombre), 'respirat') THEN 'Enfermedad Respiratoria'
      WHEN contains(lower(nombre), 'cardio') THEN 'Enfermedad Cardiovascular'
      WHEN contains(lower(nombre), 'violent') OR contains(lower(nombre), 'accident') OR contains(lower(nombre), 'homicid') THEN 'Causa Externa' ELSE 'Otra' END AS categoria_general,
    nombre AS nombre_causa, contains(lower(nombre), 'covid') AS es_covid
  FROM (SELECT p_size * 10 + length(p_type) AS id, min(CASE p_size % 5 WHEN 0 THEN 'paro Cardiorespiratorio ' WHEN 1 THEN 'Homicidio ' WHEN 2 THEN 'Sospecha COVID ' ELSE '' END || p_type) AS nombre FROM part GROUP BY 1)
  UNION ALL VALUES ('RESP', 'Enfermedad Respiratoria', 'Enfermedades del sistema respiratorio', false),
    ('COVID', 'COVID-19', 'COVID-19 (U07.1 o U07.2)', true), ('CARDIO', 'Enfermedad Cardiovascular', 'Enfermedades del sistema circulatorio', false),
    ('CANCER', 'Cáncer', 'Tumores (neoplasias)', false), ('EXTERNA', 'Causa Externa', 'Causas externas de mortalidad', false),
    ('OTRA', 'Otra', 'Otras causas de muerte', false), ('DESCONOCIDA', 'Desconocida', 'Causa no especificada', false))"""


def with_star(body: str, *parts: str) -> str:
    return "WITH " + ", ".join(parts) + " " + body
