"""Queries of the portfolio operators with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbra.functions import dates, identifiers, labels, numbers, text
from lumbra.functions.numbers import exact_sum
from lumbra.operators import cohorts, filters, flows, identity, parsing, publications, ranking, reconcile, resolve, rules, series, snapshots, units
from lumbra.plans import problems
from lumbra.session import checkpointed, small, table
from lumbra.sources import files
from lumbra.streaming import landing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
C = F.col


def query(sql: str | None = None):
    """Registers a query under its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _dsum(x: str, scale: int = 4) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(24,{scale}))) AS DOUBLE)"


_END = "last_day(CAST(strptime(CAST({} AS VARCHAR) || '01', '%Y%m%d') AS DATE))"

# ---------------------------------------------------------------- positions and flows
_KEYS = ["periodo", "rut_compania"]


def _lines(s: SparkSession, d: str) -> DataFrame:
    """Derivative lines of current publications, each filed line once."""
    raw = table(s, d, "fact_derivado").select("periodo_informacion", "fecha_descarga", "zip_origen", "source_file", "line_no", "rut_compania", "folio_operacion", "producto", "contraparte_nombre", "moneda", "fecha_vencimiento", "nocional_m", "mtm_activo_m", "mtm_pasivo_m").distinct()
    pubs = publications.ranked([table(s, d, "fact_derivado")])
    return publications.current(raw, pubs).withColumn("periodo", C("periodo_informacion"))


_PUBS = """pubs AS (SELECT *, row_number() OVER (PARTITION BY periodo_informacion ORDER BY fecha_descarga DESC NULLS LAST, filas DESC, zip_origen DESC) AS recencia FROM (
  SELECT periodo_informacion, zip_origen, max(fecha_descarga) AS fecha_descarga, count(*) AS filas FROM fact_derivado GROUP BY 1, 2))"""
_LINES = _PUBS + """,
lines AS (SELECT DISTINCT periodo_informacion AS periodo, periodo_informacion, f.fecha_descarga, zip_origen, source_file, line_no, rut_compania, folio_operacion, producto, contraparte_nombre, moneda, fecha_vencimiento, nocional_m, mtm_activo_m, mtm_pasivo_m
  FROM fact_derivado f WHERE (periodo_informacion, zip_origen) IN (SELECT (periodo_informacion, zip_origen) FROM pubs WHERE recencia = 1))"""


@query("WITH " + _PUBS + " SELECT periodo_informacion, zip_origen, fecha_descarga, CAST(filas AS BIGINT) AS filas, CAST(recencia AS INT) AS recencia FROM pubs")
def current_publication(s, d):
    return publications.ranked([table(s, d, "fact_derivado")])


@query("WITH " + _LINES + f""" SELECT periodo, rut_compania, folio_operacion, min(producto) AS producto, min(moneda) AS moneda, max(fecha_vencimiento) AS fecha_vencimiento,
  {_dsum('coalesce(nocional_m, 0)', 4)} AS nocional_m, {_dsum('coalesce(mtm_activo_m, 0) - coalesce(mtm_pasivo_m, 0)', 4)} AS mtm_neto_m, count(*) AS items
  FROM lines WHERE folio_operacion IS NOT NULL AND folio_operacion <> '' GROUP BY 1, 2, 3""")
def positions(s, d):
    return flows.positions(_lines(s, d), _KEYS, ["producto", "moneda"])


def _snap(s: SparkSession, d: str) -> DataFrame:
    """Clean monthly positions with their attributes, one whole row each."""
    v = snapshots.clean_positions(table(s, d, "v_posicion"), ("producto", "contraparte_grupo", "contraparte_nombre", "mtm_neto_m"))
    return v.withColumn("folio_operacion", C("folio_operacion").cast("string")).withColumn("nocional_m", F.round("nocional_m", 2)).withColumn("mtm_neto_m", F.round("mtm_neto_m", 2))


_NF = "NULLS FIRST"
_SNAP = f"""seen AS (SELECT periodo, rut_compania, CAST(TRY_CAST(regexp_replace(folio_operacion, '\\s+', '', 'g') AS BIGINT) AS VARCHAR) AS folio_operacion, producto, upper(trim(contraparte_key)) AS contraparte_key, contraparte_grupo,
  contraparte_nombre, upper(trim(moneda)) AS moneda, fecha_vencimiento, nocional_m AS filed, round(nocional_m, 2) AS nocional_m, mtm_neto_m AS net, round(mtm_neto_m, 2) AS mtm_neto_m, coalesce(fecha_descarga, DATE '1900-01-01') AS got FROM v_posicion),
snap AS (SELECT * EXCLUDE (filed, net, got) FROM (SELECT * FROM seen QUALIFY got = max(got) OVER (PARTITION BY rut_compania, periodo)) WHERE folio_operacion IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY periodo, rut_compania, folio_operacion ORDER BY moneda {_NF}, contraparte_key {_NF}, fecha_vencimiento {_NF}, filed {_NF}, producto {_NF}, contraparte_grupo {_NF}, contraparte_nombre {_NF}, net {_NF}) = 1)"""
_T = 202508
#: Each month against the calendar month before: one full join gives the state of a position, least distances on either side the rolls.
_FLOW = f"WITH {_SNAP}" + f""",
calendar AS (SELECT DISTINCT periodo AS mes, CASE periodo % 100 WHEN 1 THEN periodo - 89 ELSE periodo - 1 END AS previo FROM snap WHERE previo IN (SELECT periodo FROM snap)),
state AS (
  SELECT coalesce(a.mes, b.mes) AS mes, coalesce(a.rut_compania, b.rut_compania) AS rut, coalesce(a.folio_operacion, b.folio_operacion) AS folio, a.x, b.y, coalesce(a.x, b.y) AS z
  FROM (SELECT mes, rut_compania, folio_operacion, snap AS x FROM snap JOIN calendar ON periodo = mes) a
  FULL JOIN (SELECT mes, rut_compania, folio_operacion, snap AS y FROM snap JOIN calendar ON periodo = previo) b ON a.mes = b.mes AND a.rut_compania = b.rut_compania AND a.folio_operacion = b.folio_operacion),
close_by AS (
  SELECT o.mes, o.rut, o.folio AS gone, c.folio AS come, abs(c.x.nocional_m - o.y.nocional_m) AS gap, abs(o.y.nocional_m) AS base
  FROM state o JOIN state c ON o.mes = c.mes AND o.rut = c.rut AND o.x IS NULL AND c.y IS NULL AND o.y.contraparte_key = c.x.contraparte_key AND o.y.producto = c.x.producto AND o.y.nocional_m <> 0
  WHERE abs(c.x.nocional_m - o.y.nocional_m) <= 0.10 * abs(o.y.nocional_m)),
swap AS (
  SELECT mes, rut, gone, come, gap / base AS rel FROM close_by
  WHERE (mes, rut, gone, come) IN (SELECT (mes, rut, gone, min(struct_pack(g := gap, k := come)).k) FROM close_by GROUP BY mes, rut, gone)
    AND (mes, rut, gone, come) IN (SELECT (mes, rut, min(struct_pack(g := gap, k := gone)).k, come) FROM close_by GROUP BY mes, rut, come)),
flujo AS (
  SELECT s.mes AS periodo, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 'ACTIVE' WHEN w.rel IS NOT NULL THEN 'ROLL' WHEN x IS NOT NULL THEN 'NEW' WHEN y.fecha_vencimiento <= {_END.format('s.mes')} THEN 'MATURITY' ELSE 'UNWIND' END AS categoria,
    s.rut AS rut_compania, s.folio AS folio_operacion, z.producto AS producto, z.contraparte_key AS contraparte_key, z.contraparte_grupo AS contraparte_grupo, z.contraparte_nombre AS contraparte_nombre, z.moneda AS moneda,
    z.fecha_vencimiento AS fecha_vencimiento, x.nocional_m AS nocional_m, y.nocional_m AS nocional_prev_m, z.mtm_neto_m AS mtm_neto_m, CASE WHEN x IS NULL THEN w.come WHEN y IS NULL THEN w.gone END AS folio_par, w.rel AS dif_rel_nocional
  FROM state s LEFT JOIN swap w ON w.mes = s.mes AND w.rut = s.rut AND ((x IS NULL AND w.gone = s.folio) OR (y IS NULL AND w.come = s.folio)))"""


def _flow(s: SparkSession, d: str) -> DataFrame:
    """Flows of every month that has the one before."""
    return flows.classify(*flows.month_pairs(checkpointed(_snap(s, d))))


@query(_FLOW + " SELECT * FROM flujo")
def flow_classify(s, d):
    return _flow(s, d)


@query(_FLOW + f""" SELECT periodo, categoria, count(*) AS operaciones, 100.0 * count(*) / sum(count(*)) OVER (PARTITION BY periodo) AS pct, {_dsum('coalesce(nocional_m, nocional_prev_m, 0)')} AS nocional_m, count(DISTINCT contraparte_grupo) AS grupos FROM flujo GROUP BY 1, 2""")
def flow_summary(s, d):
    g = _flow(s, d).groupBy("periodo", "categoria").agg(F.count(F.lit(1)).alias("operaciones"), exact_sum(F.coalesce("nocional_m", "nocional_prev_m", F.lit(0.0))).alias("nocional_m"), F.count_distinct("contraparte_grupo").alias("grupos"))
    return g.withColumn("pct", 100.0 * C("operaciones") / F.sum("operaciones").over(Window.partitionBy("periodo")))


@query(_FLOW + " SELECT periodo, producto, categoria, count(*) AS operaciones FROM flujo GROUP BY ALL")
def flow_by_product(s, d):
    return _flow(s, d).groupBy("periodo", "producto", "categoria").agg(F.count(F.lit(1)).alias("operaciones"))


@query(_FLOW + " SELECT mes AS periodo, universo, clasificadas, distintas FROM (SELECT mes, count(*) AS universo FROM (SELECT mes, rut_compania, folio_operacion FROM snap JOIN calendar ON periodo = mes UNION SELECT mes, rut_compania, folio_operacion FROM snap JOIN calendar ON periodo = previo) GROUP BY 1) JOIN (SELECT periodo AS mes, count(*) AS clasificadas, count(DISTINCT (rut_compania, folio_operacion)) AS distintas FROM flujo GROUP BY 1) USING (mes)")
def flow_verify(s, d):
    """Of each month: positions of both snapshots, flows, and distinct positions among them; all three are equal."""
    now, before = flows.month_pairs(checkpointed(_snap(s, d)))
    key = ["periodo", "rut_compania", "folio_operacion"]
    v = now.select(*key).union(before.select(*key)).distinct().groupBy("periodo").agg(F.count(F.lit(1)).alias("universo"))
    f = flows.classify(now, before).groupBy("periodo").agg(F.count(F.lit(1)).alias("clasificadas"), F.count_distinct(F.struct("rut_compania", "folio_operacion")).alias("distintas"))
    return v.join(f, "periodo")


@query(_FLOW + f""" SELECT periodo, {_dsum('coalesce(nocional_prev_m, 0)', 4)} AS apertura, {_dsum("CASE WHEN categoria = 'NEW' THEN coalesce(nocional_m, 0) ELSE 0 END", 4)} AS nuevas, {_dsum("CASE WHEN categoria = 'ROLL' THEN coalesce(nocional_m, 0) ELSE 0 END", 4)} AS roll_entra,
  {_dsum("CASE WHEN categoria = 'ROLL' THEN coalesce(nocional_prev_m, 0) ELSE 0 END", 4)} AS roll_sale, {_dsum("CASE WHEN categoria = 'MATURITY' THEN nocional_prev_m ELSE 0 END", 4)} AS vencidas, {_dsum("CASE WHEN categoria = 'UNWIND' THEN nocional_prev_m ELSE 0 END", 4)} AS deshechas,
  {_dsum("CASE WHEN categoria = 'ACTIVE' THEN nocional_m - nocional_prev_m ELSE 0 END", 4)} AS cambio_activas, {_dsum('coalesce(nocional_m, 0)', 4)} AS cierre FROM flujo GROUP BY 1""")
def flow_waterfall(s, d):
    return flows.cascade(_flow(s, d))


@query("WITH r AS (SELECT DISTINCT periodo, rut_compania FROM v_posicion), n AS (SELECT rut_compania, CAST(CASE periodo % 100 WHEN 12 THEN periodo + 89 ELSE periodo + 1 END AS INT) AS periodo FROM r) SELECT periodo, rut_compania FROM n WHERE periodo IN (SELECT periodo FROM r) EXCEPT SELECT periodo, rut_compania FROM r")
def reporter_gap(s, d):
    """Companies that reported the month before and not this one, of every month that has the one before."""
    now, before = flows.month_pairs(table(s, d, "v_posicion").select("periodo", "rut_compania").distinct())
    return before.join(now, ["periodo", "rut_compania"], "left_anti")


# ---------------------------------------------------------------- dimensions and enrichment
@query("WITH x AS (SELECT o_custkey, o_orderpriority, o_orderdate FROM orders WHERE o_orderpriority IS NOT NULL) SELECT o_custkey, max(struct_pack(a := o_orderdate, b := o_orderpriority)).b AS o_orderpriority FROM x GROUP BY 1")
def dim_company_latest(s, d):
    return publications.latest_attribute(table(s, d, "orders"), "o_custkey", "o_orderpriority", "o_orderdate")


@query("SELECT contraparte_key, contraparte_nombre, grupo, operaciones FROM (SELECT upper(trim(contraparte_key)) AS contraparte_key, min(contraparte_nombre) AS contraparte_nombre, min(contraparte_grupo) AS grupo, count(*) AS operaciones FROM v_posicion GROUP BY 1)")
def dim_counterparty(s, d):
    return table(s, d, "v_posicion").groupBy(F.upper(F.trim("contraparte_key")).alias("contraparte_key")).agg(F.min("contraparte_nombre").alias("contraparte_nombre"), F.min("contraparte_grupo").alias("grupo"), F.count(F.lit(1)).alias("operaciones"))


@query("SELECT instrumento_id, min(tipo_instrumento) AS tipo, max(emisor_nombre) AS emisor, min(fecha_vencimiento) AS vence, count(*) AS filas FROM v_renta_fija_clasificada GROUP BY 1")
def dim_instrument(s, d):
    return table(s, d, "v_renta_fija_clasificada").groupBy("instrumento_id").agg(F.min("tipo_instrumento").alias("tipo"), F.max("emisor_nombre").alias("emisor"), F.min("fecha_vencimiento").alias("vence"), F.count(F.lit(1)).alias("filas"))


@query("WITH " + _LINES + """ SELECT zip_origen, source_file, line_no, l.rut_compania, coalesce(c.nombre, CAST(l.rut_compania AS VARCHAR)) AS compania, s.valor AS usd FROM lines l LEFT JOIN dim_compania c ON c.rut_compania = l.rut_compania
  LEFT JOIN serie_cierre s ON s.periodo = l.periodo AND s.serie = 'USD'""")
def enrich_equi(s, d):
    names = small(table(s, d, "dim_compania").select("rut_compania", "nombre"))
    usd = small(table(s, d, "serie_cierre").where("serie = 'USD'").select("periodo", C("valor").alias("usd")))
    got = _lines(s, d).join(names, "rut_compania", "left").join(usd, "periodo", "left")
    return got.select("zip_origen", "source_file", "line_no", "rut_compania", F.coalesce("nombre", C("rut_compania").cast("string")).alias("compania"), "usd")


@query("SELECT l_orderkey, l_linenumber, l_returnflag, o_totalprice, 'R' AS rama FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag, NULL, 'X' FROM lineitem WHERE l_returnflag <> 'R'")
def two_branch_detail(s, d):
    li, o = table(s, d, "lineitem"), table(s, d, "orders").select("o_orderkey", "o_totalprice")
    a = li.where("l_returnflag = 'R'").join(o, C("o_orderkey") == C("l_orderkey")).select("l_orderkey", "l_linenumber", "l_returnflag", "o_totalprice", F.lit("R").alias("rama"))
    b = li.where("l_returnflag <> 'R'").select("l_orderkey", "l_linenumber", "l_returnflag", F.lit("X").alias("rama"))
    return a.unionByName(b, allowMissingColumns=True)


@query("WITH e AS (SELECT DISTINCT evento_id, ts FROM evento_mesa WHERE ts IS NOT NULL), u AS (SELECT fecha, max(valor) AS valor FROM serie_cierre WHERE serie = 'USD' GROUP BY 1) SELECT e.evento_id, CAST(e.ts AS DATE) AS dia, u.valor FROM e ASOF LEFT JOIN u ON CAST(e.ts AS DATE) >= u.fecha")
def asof_fx(s, d):
    e = table(s, d, "evento_mesa").where("ts IS NOT NULL").select("evento_id", "ts").distinct()
    return series.value_as_of(e, table(s, d, "serie_cierre").where("serie = 'USD'"), "ts").select("evento_id", F.to_date("ts").alias("dia"), "valor")


@query("SELECT CAST(year(ts) * 100 + month(ts) AS INT) AS periodo, CAST(max(ts) AS DATE) AS fecha, max(struct_pack(a := CAST(ts AS DATE), b := value)).b AS valor FROM events WHERE value IS NOT NULL GROUP BY 1")
def month_close(s, d):
    return series.month_close(table(s, d, "events"), "ts", "value")


@query("WITH " + _SNAP + ", edge AS (SELECT min(periodo) AS a, max(periodo) AS z FROM snap) SELECT x.rut_compania, x.folio_operacion, x.nocional_m AS primero, y.nocional_m AS ultimo FROM snap x JOIN snap y ON x.rut_compania = y.rut_compania AND x.folio_operacion = y.folio_operacion WHERE x.periodo = (SELECT a FROM edge) AND y.periodo = (SELECT z FROM edge)")
def history_one_to_one(s, d):
    """First snapshot against the last, one row a position in each, which is asserted."""
    v = checkpointed(_snap(s, d))
    edge = v.agg(F.min("periodo").alias("a"), F.max("periodo").alias("z"))  # one row
    key = ["rut_compania", "folio_operacion"]
    side = lambda at, name: publications.only_once(v.join(F.broadcast(edge), C("periodo") == C(at)).select(*key, C("nocional_m").alias(name)), key)
    return side("a", "primero").join(side("z", "ultimo"), key)


@query("SELECT c_custkey, f.p AS primero, f.d AS desde, l.p AS ultimo, l.d AS hasta FROM (SELECT o_custkey AS c_custkey, min(struct_pack(d := o_orderdate, k := o_orderkey, p := o_orderpriority)) AS f, max(struct_pack(d := o_orderdate, k := o_orderkey, p := o_orderpriority)) AS l FROM orders GROUP BY 1)")
def first_and_last(s, d):
    r = F.struct(C("o_orderdate").alias("d"), C("o_orderkey").alias("k"), C("o_orderpriority").alias("p"))
    g = table(s, d, "orders").groupBy(C("o_custkey").alias("c_custkey")).agg(F.min(r).alias("f"), F.max(r).alias("l"))
    return g.select("c_custkey", C("f.p").alias("primero"), C("f.d").alias("desde"), C("l.p").alias("ultimo"), C("l.d").alias("hasta"))


@query(f"SELECT coalesce(a.m, b.m) AS periodo, a.v AS pedido, b.v AS enviado FROM (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS m, {_dsum('o_totalprice')} AS v FROM orders GROUP BY 1) a FULL JOIN (SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS m, {_dsum('l_extendedprice')} AS v FROM lineitem GROUP BY 1) b ON a.m = b.m")
def outer_periods(s, d):
    a = table(s, d, "orders").groupBy(dates.period_of(C("o_orderdate")).alias("periodo")).agg(exact_sum(C("o_totalprice")).alias("pedido"))
    return a.join(table(s, d, "lineitem").groupBy(dates.period_of(C("l_shipdate")).alias("periodo")).agg(exact_sum(C("l_extendedprice")).alias("enviado")), "periodo", "full")


_REGISTRY = "SELECT TRY_CAST(regexp_extract(entidad_id, '^RUT (\\\\d+)-', 1) AS BIGINT) AS rut, min(entidad_nombre) AS nombre FROM contrapartes WHERE entidad_tipo_id = 'RUT' GROUP BY 1"


@query(f"""WITH ids AS (SELECT rut FROM cmf_v2024 UNION SELECT rut_compania FROM cmf_v2024 UNION SELECT emisor_rut FROM v_renta_fija_clasificada), reg AS ({_REGISTRY.replace(chr(92) * 2, chr(92))}), com AS (SELECT rut_compania AS rut, min(nombre) AS nombre FROM dim_compania GROUP BY 1), emi AS (SELECT emisor_rut AS rut, min(emisor_nombre) AS nombre FROM v_renta_fija_clasificada GROUP BY 1)
  SELECT ids.rut, coalesce(reg.nombre, com.nombre, emi.nombre) AS nombre, CASE WHEN reg.nombre IS NOT NULL THEN 'registro' WHEN com.nombre IS NOT NULL THEN 'compania' WHEN emi.nombre IS NOT NULL THEN 'emisor' END AS fuente FROM ids LEFT JOIN reg USING (rut) LEFT JOIN com USING (rut) LEFT JOIN emi USING (rut) WHERE ids.rut IS NOT NULL""")
def priority_lookup(s, d):
    """Names of tax ids from three sources, the registry before the companies before the issuers' own, with the source."""
    n, b = table(s, d, "cmf_v2024"), table(s, d, "v_renta_fija_clasificada")
    ids = n.select("rut").union(n.select("rut_compania")).union(b.select("emisor_rut")).where("rut IS NOT NULL").distinct()
    named = lambda df, rut, name, alias: df.select(rut.alias("rut"), name.alias("x")).where("rut IS NOT NULL").groupBy("rut").agg(F.min("x").alias(alias))
    reg = named(table(s, d, "contrapartes").where("entidad_tipo_id = 'RUT'"), F.regexp_extract("entidad_id", r"^RUT (\d+)-", 1).try_cast("bigint"), C("entidad_nombre"), "registro")
    got = ids.join(reg, "rut", "left").join(small(named(table(s, d, "dim_compania"), C("rut_compania"), C("nombre"), "compania")), "rut", "left").join(named(b, C("emisor_rut"), C("emisor_nombre"), "emisor"), "rut", "left")
    sources = ["registro", "compania", "emisor"]
    return got.select("rut", F.coalesce(*sources).alias("nombre"), F.coalesce(*[F.when(C(x).isNotNull(), F.lit(x)) for x in sources]).alias("fuente"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > (SELECT CAST(last_day(CAST(min(o_orderdate) AS DATE)) AS TIMESTAMP) FROM orders)")
def scalar_subquery(s, d):
    o = table(s, d, "orders")
    first = o.agg(F.last_day(F.to_date(F.min("o_orderdate"))).cast("timestamp_ntz" if dict(o.dtypes)["o_orderdate"] == "timestamp_ntz" else "timestamp").alias("_c"))
    return o.join(F.broadcast(first), C("o_orderdate") > C("_c")).select("o_orderkey", "o_orderdate")  # one row


@query("WITH held AS (SELECT DISTINCT periodo, upper(trim(moneda)) AS moneda, producto FROM v_posicion WHERE nocional_m > 2000000 AND moneda IS NOT NULL AND producto IS NOT NULL) SELECT m.periodo, m.moneda, p.producto FROM (SELECT DISTINCT periodo, moneda FROM held) m JOIN (SELECT DISTINCT periodo, producto FROM held) p ON m.periodo = p.periodo WHERE (m.periodo, m.moneda, p.producto) NOT IN (SELECT (periodo, moneda, producto) FROM held)")
def whitespace_holes(s, d):
    """Pairs of currency and product, both held in large amounts in a month, that aren't held together in it."""
    v = table(s, d, "v_posicion").where((C("nocional_m") > 2_000_000) & C("producto").isNotNull() & C("moneda").isNotNull()).select("periodo", F.upper(F.trim("moneda")).alias("moneda"), "producto").distinct()
    rows = v.groupBy("periodo").agg(F.collect_set("moneda").alias("m"), F.collect_set("producto").alias("p"))  # two short lists of codes a month
    return rows.select("periodo", F.explode("m").alias("moneda"), "p").select("periodo", "moneda", F.explode("p").alias("producto")).join(v, ["periodo", "moneda", "producto"], "left_anti")


# ---------------------------------------------------------------- aggregation
@query(f"SELECT count(*) AS filas, count(DISTINCT l_orderkey) AS pedidos, count(DISTINCT l_suppkey) AS proveedores, {_dsum('l_extendedprice')} AS valor, min(l_shipdate) AS desde, max(l_shipdate) AS hasta FROM lineitem")
def kpi_row(s, d):
    return table(s, d, "lineitem").agg(F.count(F.lit(1)).alias("filas"), F.count_distinct("l_orderkey").alias("pedidos"), F.count_distinct("l_suppkey").alias("proveedores"), exact_sum(C("l_extendedprice")).alias("valor"), F.min("l_shipdate").alias("desde"), F.max("l_shipdate").alias("hasta"))


def _vp4() -> str:
    return problems.ORACLE["p4_converted"].replace("SELECT tabla, zip_origen, source_file, line_no, monto, unidad, origen_unidad,", ", v AS (SELECT DISTINCT tabla, zip_origen, source_file, line_no,") + ")"


_STOCK = _vp4() + ", " + _LINES.replace("lines AS (SELECT DISTINCT", "filed AS (SELECT DISTINCT") + f""",
bond AS (SELECT DISTINCT periodo_informacion, zip_origen, source_file, line_no, rut_compania, ambito, tipo_instrumento FROM v_renta_fija_clasificada),
stock AS (
  SELECT periodo_informacion AS periodo, rut_compania, CASE WHEN tipo_instrumento LIKE 'CLEAS%' THEN 'Real Estate' ELSE 'Renta Fija' END AS clase, CASE WHEN ambito = 'EXTRANJERO' THEN 'renta fija extranjera' ELSE 'renta fija local' END AS fuente, {_dsum('monto_norma')} AS monto
  FROM bond JOIN v USING (zip_origen, source_file, line_no) WHERE tabla = 'v_renta_fija_clasificada' GROUP BY ALL
  UNION ALL SELECT periodo, rut_compania, 'Derivados', 'derivados', {_dsum('coalesce(mtm_activo_m, 0) - coalesce(mtm_pasivo_m, 0)')} FROM filed WHERE producto <> 'PACTO' GROUP BY ALL)"""


def _stock(s: SparkSession, d: str) -> DataFrame:
    """Stock of every period, company, class and source in thousands of pesos: each filed line of current publications once; leasing counts as real estate only."""
    b = table(s, d, "v_renta_fija_clasificada").distinct()
    rows = b.select(F.lit("v_renta_fija_clasificada").alias("tabla"), "periodo_informacion", "zip_origen", "source_file", "line_no", C("valor_final").alias("monto"), C("unidad_valor").alias("unidad_col"), C("valor_texto").alias("texto"), "glosa", "rut_compania", "ambito", "tipo_instrumento")
    bonds = units.in_norm_units(units.with_units(rows), table(s, d, "serie_cierre"))
    kind, source = labels.prefix_class(C("tipo_instrumento"), {"CLEAS": "Real Estate"}, "Renta Fija"), F.when(C("ambito") == "EXTRANJERO", "renta fija extranjera").otherwise("renta fija local")
    key = ["periodo", "rut_compania", "clase", "fuente"]
    bonds = bonds.select(C("periodo_informacion").alias("periodo"), "rut_compania", kind.alias("clase"), source.alias("fuente"), C("monto_norma").alias("v"))
    net = _lines(s, d).where("producto <> 'PACTO'").select("periodo", "rut_compania", F.lit("Derivados").alias("clase"), F.lit("derivados").alias("fuente"), (F.coalesce("mtm_activo_m", F.lit(0.0)) - F.coalesce("mtm_pasivo_m", F.lit(0.0))).alias("v"))
    return bonds.unionByName(net).groupBy(*key).agg(exact_sum(C("v")).alias("monto"))


@query(_STOCK + " SELECT * FROM stock")
def stock_by_class(s, d):
    return _stock(s, d)


@query(_STOCK + f""", t AS (SELECT periodo, rut_compania, {_dsum("CASE WHEN clase = 'Renta Fija' THEN monto ELSE 0 END")} AS renta_fija, {_dsum("CASE WHEN clase = 'Derivados' THEN monto ELSE 0 END")} AS derivados, {_dsum("monto")} AS total FROM stock GROUP BY ALL),
  c AS (SELECT periodo_informacion AS periodo, rut_compania, {_dsum("valor_final")} AS declarado FROM ({problems.ORACLE["p2_loaded_control"]}) JOIN (SELECT DISTINCT periodo_informacion, rut_compania, zip_origen, source_file, line_no FROM parsed_record) USING (zip_origen, source_file, line_no) GROUP BY ALL)
  SELECT periodo, rut_compania, renta_fija, derivados, total, declarado, (total / nullif(declarado, 0) - 1) * 100 AS dif_pct FROM t FULL JOIN c USING (periodo, rut_compania)""")
def stock_declared(s, d):
    """Stock of each company and period, a column a class, against the total that its control lines declare."""
    wide = ranking.pivoted(_stock(s, d), ["periodo", "rut_compania"], "clase", ["Renta Fija", "Derivados"], C("monto")).withColumnsRenamed({"Renta Fija": "renta_fija", "Derivados": "derivados"})
    told = parsing.loaded_control(table(s, d, "parsed_record"), ("periodo_informacion", "rut_compania")).groupBy(C("periodo_informacion").alias("periodo"), "rut_compania").agg(exact_sum(C("valor_final")).alias("declarado"))
    got = wide.join(told, ["periodo", "rut_compania"], "full")
    return got.withColumn("dif_pct", (F.try_divide(C("total"), F.nullif("declarado", F.lit(0.0))) - 1) * 100)


_STATUS = ["F", "O", "P", "Z"]


@query("SELECT o_orderpriority, " + ", ".join(f"{_dsum(f'''CASE WHEN o_orderstatus = '{v}' THEN o_totalprice ELSE 0 END''')} AS \"{v}\"" for v in _STATUS) + f", {_dsum('o_totalprice')} AS total FROM orders GROUP BY 1")
def stock_pivot(s, d):
    return ranking.pivoted(table(s, d, "orders"), ["o_orderpriority"], "o_orderstatus", _STATUS, C("o_totalprice"))


@query(f"WITH l AS (SELECT l_orderkey, {_dsum('l_extendedprice')} AS v FROM lineitem GROUP BY 1) SELECT o_orderkey, o_totalprice AS declarado, v AS informado, 100 * (v - o_totalprice) / nullif(o_totalprice, 0) AS dif_pct FROM orders LEFT JOIN l ON l_orderkey = o_orderkey")
def declared_diff(s, d):
    own = table(s, d, "lineitem").groupBy("l_orderkey").agg(exact_sum(C("l_extendedprice")).alias("informado"))
    got = table(s, d, "orders").join(own, C("o_orderkey") == C("l_orderkey"), "left")
    return got.select("o_orderkey", C("o_totalprice").alias("declarado"), "informado", F.try_divide(100 * (C("informado") - C("o_totalprice")), C("o_totalprice")).alias("dif_pct"))


@query(f"SELECT n_name, s_name, grouping(n_name) * 2 + grouping(s_name) AS nivel, {_dsum('s_acctbal')} AS saldo FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY ROLLUP (n_name, s_name)")
def subtotal_rollup(s, d):
    j = table(s, d, "supplier").join(small(table(s, d, "nation")), C("n_nationkey") == C("s_nationkey"))
    return j.rollup("n_name", "s_name").agg(F.grouping_id().cast("bigint").alias("nivel"), exact_sum(C("s_acctbal")).alias("saldo"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def having_duplicates(s, d):
    return table(s, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT " + ", ".join(f"count({c}) AS {c}" for c in ("fecha_descarga", "folio_operacion", "nocional_m", "glosa", "clasificacion_riesgo")) + " FROM fact_derivado")
def coverage_counts(s, d):
    return table(s, d, "fact_derivado").agg(*[F.count(c).alias(c) for c in ("fecha_descarga", "folio_operacion", "nocional_m", "glosa", "clasificacion_riesgo")])


@query("SELECT min(nocional_m) AS minimo, max(nocional_m) AS maximo, min(fecha_vencimiento) AS desde, max(fecha_vencimiento) AS hasta FROM fact_derivado")
def range_minmax(s, d):
    return table(s, d, "fact_derivado").agg(F.min("nocional_m").alias("minimo"), F.max("nocional_m").alias("maximo"), F.min("fecha_vencimiento").alias("desde"), F.max("fecha_vencimiento").alias("hasta"))


@query("SELECT DISTINCT producto FROM fact_derivado WHERE producto IS NOT NULL")
def distinct_values(s, d):
    return table(s, d, "fact_derivado").select("producto").where("producto IS NOT NULL").distinct()


@query("SELECT count(DISTINCT (rut_compania, folio_operacion)) AS pares, count(DISTINCT folio_operacion) AS folios FROM fact_derivado")
def distinct_tuple(s, d):
    return table(s, d, "fact_derivado").agg(F.count_distinct(F.struct("rut_compania", "folio_operacion")).alias("pares"), F.count_distinct("folio_operacion").alias("folios"))


@query("SELECT n_name, median(x) AS mediana, quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.75) AS p75, stddev_samp(x) AS desvio, max(x) - min(x) AS rango, count(*) AS n FROM (SELECT n_name, l_extendedprice / l_quantity AS x FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey) WHERE x > 0 GROUP BY 1")
def price_dispersion(s, d):
    """Quantiles, deviation and spread of prices by nation; only positive prices, as they are shown on a log scale."""
    j = table(s, d, "lineitem").join(small(table(s, d, "supplier")), C("s_suppkey") == C("l_suppkey")).join(small(table(s, d, "nation")), C("n_nationkey") == C("s_nationkey"))
    j = j.select("n_name", (C("l_extendedprice") / C("l_quantity")).alias("x")).where("x > 0")
    q = ranking.quantiles(j, ["n_name"], "x", {"mediana": 0.5, "p25": 0.25, "p75": 0.75})
    return q.join(j.groupBy("n_name").agg(F.stddev_samp("x").alias("desvio"), (F.max("x") - F.min("x")).alias("rango"), F.count(F.lit(1)).alias("n")), "n_name")


@query("SELECT l_returnflag, CAST(sum(CAST(l_discount * l_quantity AS DECIMAL(20,4))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(20,4))) AS DOUBLE) AS tasa, CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_discount * l_quantity AS DECIMAL(20,4)) END) AS DOUBLE) / nullif(CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(20,4)) END) AS DOUBLE), 0) AS tasa_viva FROM lineitem GROUP BY 1")
def weighted_rate(s, d):
    part = lambda keep: F.try_divide(exact_sum(F.when(keep, C("l_discount") * C("l_quantity")), 4), exact_sum(F.when(keep, C("l_quantity")), 4))
    return table(s, d, "lineitem").groupBy("l_returnflag").agg(part(F.lit(True)).alias("tasa"), part(C("l_linestatus") == "O").alias("tasa_viva"))


_MATRIX = f"m AS (SELECT s_nationkey AS banco, c_nationkey AS cliente, {_dsum('l_extendedprice')} AS monto, count(*) AS n, min(l_shipdate) AS desde, max(l_shipdate) AS hasta FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2)"


def _matrix(s: SparkSession, d: str) -> DataFrame:
    j = table(s, d, "lineitem").join(table(s, d, "orders"), C("o_orderkey") == C("l_orderkey")).join(table(s, d, "customer").select("c_custkey", "c_nationkey"), C("c_custkey") == C("o_custkey"))
    j = j.join(small(table(s, d, "supplier").select("s_suppkey", "s_nationkey")), C("s_suppkey") == C("l_suppkey"))
    return j.groupBy(C("s_nationkey").alias("banco"), C("c_nationkey").alias("cliente")).agg(exact_sum(C("l_extendedprice")).alias("monto"), F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("desde"), F.max("l_shipdate").alias("hasta"))


@query("WITH " + _MATRIX + " SELECT * FROM m")
def competitor_matrix(s, d):
    return _matrix(s, d)


@query("SELECT s_nationkey AS banco, c_nationkey AS cliente, l_returnflag AS producto, o_orderpriority AS clase, coalesce(nullif(" + _dsum("CASE WHEN l_linestatus = 'O' THEN l_extendedprice ELSE 0 END") + ", 0), " + _dsum("l_extendedprice * l_discount") + ") AS monto, count(*) AS n, min(l_shipdate) AS desde, max(l_shipdate) AS hasta FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3, 4")
def competitor_detail(s, d):
    """The matrix by four keys; where there is no open amount, the other measure stands in."""
    j = table(s, d, "lineitem").join(table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), C("o_orderkey") == C("l_orderkey")).join(table(s, d, "customer").select("c_custkey", "c_nationkey"), C("c_custkey") == C("o_custkey"))
    j = j.join(small(table(s, d, "supplier").select("s_suppkey", "s_nationkey")), C("s_suppkey") == C("l_suppkey"))
    amount = F.coalesce(F.nullif(exact_sum(F.when(C("l_linestatus") == "O", C("l_extendedprice")).otherwise(F.lit(0.0))), F.lit(0.0)), exact_sum(C("l_extendedprice") * C("l_discount")))
    return j.groupBy(C("s_nationkey").alias("banco"), C("c_nationkey").alias("cliente"), C("l_returnflag").alias("producto"), C("o_orderpriority").alias("clase")).agg(amount.alias("monto"), F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("desde"), F.max("l_shipdate").alias("hasta"))


@query("WITH g AS (SELECT o_custkey AS cliente, " + _dsum("l_extendedprice") + " AS valor, count(DISTINCT l_returnflag) AS productos, count(DISTINCT l_suppkey) AS bancos FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY valor, cliente) AS rn, count(*) OVER () AS n FROM g) SELECT cliente, valor, productos, bancos, CASE WHEN rn <= 1 + (n - 1) / 3.0 THEN 1 WHEN rn <= 1 + (n - 1) * 2 / 3.0 THEN 2 ELSE 3 END AS tercil, CASE WHEN bancos <= 2 THEN 'Cautivo' WHEN bancos <= 5 THEN 'Selectivo' ELSE 'Multibanco' END AS apertura FROM r")
def customer_segments(s, d):
    """Customers by tercile of value, number of products and number of banks."""
    j = table(s, d, "lineitem").join(table(s, d, "orders").select("o_orderkey", "o_custkey"), C("o_orderkey") == C("l_orderkey"))
    g = j.groupBy(C("o_custkey").alias("cliente")).agg(exact_sum(C("l_extendedprice")).alias("valor"), F.count_distinct("l_returnflag").alias("productos"), F.count_distinct("l_suppkey").alias("bancos"))
    return ranking.tercile(g, "valor", "cliente").withColumn("apertura", labels.band(C("bancos"), ((2, "Cautivo"), (5, "Selectivo"), (None, "Multibanco")), "right"))


@query("WITH " + _MATRIX + " SELECT cliente, banco, monto FROM m QUALIFY row_number() OVER (PARTITION BY cliente ORDER BY monto DESC, banco) = 1")
def main_competitor(s, d):
    return ranking.top_value(_matrix(s, d).select("cliente", "banco", "monto"), ["cliente"], "banco", "monto")


@query("WITH " + _MATRIX + " SELECT cliente, banco, monto / CAST(sum(CAST(monto AS DECIMAL(20,2))) OVER (PARTITION BY cliente) AS DOUBLE) AS parte FROM m")
def share_of_row(s, d):
    m = _matrix(s, d)
    return m.select("cliente", "banco", (C("monto") / F.sum(C("monto").cast("decimal(20,2)")).over(Window.partitionBy("cliente")).cast("double")).alias("parte"))


@query("WITH " + _MATRIX + ", g AS (SELECT cliente, " + f"{_dsum('CASE WHEN banco = 3 THEN monto ELSE 0 END')} AS propio, {_dsum('CASE WHEN banco <> 3 THEN monto ELSE 0 END')} AS otros FROM m GROUP BY 1) SELECT cliente, propio, otros, CASE WHEN propio > 0 THEN 'con nosotros' WHEN otros > 0 THEN 'OPORTUNIDAD' ELSE 'inactivo' END AS estado FROM g")
def whitespace_status(s, d):
    g = _matrix(s, d).groupBy("cliente").agg(exact_sum(F.when(C("banco") == 3, C("monto")).otherwise(F.lit(0.0))).alias("propio"), exact_sum(F.when(C("banco") != 3, C("monto")).otherwise(F.lit(0.0))).alias("otros"))
    return g.withColumn("estado", F.when(C("propio") > 0, "con nosotros").when(C("otros") > 0, "OPORTUNIDAD").otherwise("inactivo"))


@query("SELECT producto, moneda, record_type, count(*) AS n, count(nocional_m) AS con_monto FROM fact_derivado GROUP BY 1, 2, 3")
def null_groups(s, d):
    return table(s, d, "fact_derivado").groupBy("producto", "moneda", "record_type").agg(F.count(F.lit(1)).alias("n"), F.count("nocional_m").alias("con_monto"))


@query("SELECT zip_origen, source_file, CAST(substr(max(CASE WHEN starts_with(raw, '3') THEN raw END), 2, 6) AS INT) AS declarado, count(DISTINCT CASE WHEN starts_with(raw, '2') THEN line_no END) AS contado FROM parsed_record WHERE formato = 'C' AND length(raw) = 138 AND (NOT starts_with(raw, '3') OR regexp_matches(raw, '^3[0-9]{6} ')) GROUP BY 1, 2")
def control_total(s, d):
    trailer = C("raw").startswith("3")
    p = table(s, d, "parsed_record").where((C("formato") == "C") & (F.char_length("raw") == 138) & (~trailer | parsing.CONTROL.matches(C("raw"))))
    total = parsing._number(parsing.CONTROL.values(C("raw"), "3")["TOTAL_REGISTROS"], False)
    return p.groupBy("zip_origen", "source_file").agg(F.max(F.when(trailer, total)).cast("int").alias("declarado"), F.count_distinct(F.when(C("raw").startswith("2"), C("line_no"))).alias("contado"))


@query(f"""WITH q AS (SELECT DISTINCT zip_origen, source_file, line_no FROM fact_cuarentena), r AS ({problems.ORACLE["p2_found"]})
  SELECT CASE WHEN raw IS NULL OR trim(raw) = '' THEN 'vacia' WHEN starts_with(raw, '#') THEN 'comentario' WHEN lower(raw) = 'lei,estado_lei,nombre_legal,pais,categoria,estado_entidad' THEN 'encabezado' WHEN r.line_no IS NOT NULL THEN 'rechazada' WHEN q.line_no IS NOT NULL THEN 'cuarentena' ELSE 'cargada' END AS destino, formato, count(*) AS lineas
  FROM parsed_record p LEFT JOIN q ON q.zip_origen = p.zip_origen AND q.source_file = p.source_file AND q.line_no = p.line_no LEFT JOIN r ON r.zip_origen = p.zip_origen AND r.source_file = p.source_file AND r.line_no = p.line_no GROUP BY 1, 2""")
def line_accounting(s, d):
    """Where every delivered line went: no record, rejected, quarantined by a check, or loaded."""
    p, key = table(s, d, "parsed_record"), ["zip_origen", "source_file", "line_no"]
    split = parsing.split_rows(p)
    bad = split.where("_motivo IS NOT NULL").select(*key, F.lit(True).alias("_bad")).distinct()
    held = table(s, d, "fact_cuarentena").select(*key, F.lit(True).alias("_held")).distinct()
    r = C("raw")
    to = F.when(r.isNull() | (F.trim(r) == ""), "vacia").when(r.startswith("#"), "comentario").when(F.lower(r) == parsing.HEADER, "encabezado")
    to = to.when(C("_bad"), "rechazada").when(C("_held"), "cuarentena").otherwise("cargada")
    return p.join(bad, key, "left").join(held, key, "left").groupBy(to.alias("destino"), "formato").agg(F.count(F.lit(1)).alias("lineas"))


@query("SELECT 'producto' AS eje, producto AS valor, count(*) AS n FROM fact_derivado GROUP BY 2 UNION ALL SELECT 'veredicto', veredicto, count(*) FROM fact_derivado GROUP BY 2 UNION ALL SELECT 'periodo', CAST(periodo_informacion AS VARCHAR), count(*) FROM fact_derivado GROUP BY 2")
def run_counters(s, d):
    f = table(s, d, "fact_derivado").select("producto", "veredicto", C("periodo_informacion").cast("string").alias("periodo"))
    axes = ["producto", "veredicto", "periodo"]
    long = f.select(F.explode(F.array(*[F.struct(F.lit(a).alias("eje"), C(a).alias("valor")) for a in axes])).alias("x")).select("x.*")
    return long.groupBy("eje", "valor").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT control, izquierda, derecha, abs(izquierda - derecha) <= 0.01 AS iguales FROM (
  SELECT 'pedidos con cliente' AS control, (SELECT {_dsum("o_totalprice")} FROM orders) AS izquierda, (SELECT {_dsum("o_totalprice")} FROM orders JOIN customer ON c_custkey = o_custkey) AS derecha
  UNION ALL SELECT 'lineas con pedido', (SELECT CAST(count(*) AS DOUBLE) FROM lineitem), (SELECT CAST(count(*) AS DOUBLE) FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
  UNION ALL SELECT 'pedidos contra lineas', (SELECT {_dsum("o_totalprice")} FROM orders), (SELECT {_dsum("l_extendedprice")} FROM lineitem))""")
def cross_sheet_identity(s, d):
    """Totals that two sources should agree on; the last pair doesn't."""
    o, li, cu = table(s, d, "orders"), table(s, d, "lineitem"), table(s, d, "customer")
    total = lambda df, c: df.agg(exact_sum(C(c)).alias("x"))
    n = lambda df: df.agg(F.count(F.lit(1)).alias("x"))
    controls = {
        "pedidos con cliente": (total(o, "o_totalprice"), total(o.join(cu.select("c_custkey"), C("c_custkey") == C("o_custkey")), "o_totalprice")),
        "lineas con pedido": (n(li), n(li.select("l_orderkey").join(o.select("o_orderkey"), C("o_orderkey") == C("l_orderkey")))),
        "pedidos contra lineas": (total(o, "o_totalprice"), total(li, "l_extendedprice")),
    }
    return rules.agreement(controls, 0.01)


@query("WITH c AS (SELECT nombre_id, nombre, count(*) AS n FROM cmf_v2024 GROUP BY 1, 2), k AS (SELECT letra, nombre, sum(1) AS n FROM cmf_v2024 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY letra ORDER BY n DESC, nombre) AS rn FROM k) SELECT letra, string_agg(nombre, ' | ' ORDER BY rn) AS frecuentes FROM r WHERE rn <= 4 GROUP BY 1")
def names_joined(s, d):
    n = table(s, d, "cmf_v2024").groupBy("letra", "nombre").agg(F.count(F.lit(1)).alias("n"))
    top = n.withColumn("rn", F.row_number().over(Window.partitionBy("letra").orderBy(F.desc("n"), "nombre"))).where("rn <= 4")
    return top.groupBy("letra").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "nombre"))), lambda x: x["nombre"]), " | ").alias("frecuentes"))


# ---------------------------------------------------------------- cohorts
_OPS = "ops AS (SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS origen, CAST(max(greatest(year(o_orderdate) * 100 + month(o_orderdate), year(l_shipdate) * 100 + month(l_shipdate))) AS INT) AS ultima, any_value(o_totalprice) AS monto FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate), shots AS (SELECT DISTINCT origen AS foto FROM ops)"


def _ops(s: SparkSession, d: str) -> DataFrame:
    li = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.max(dates.period_of(C("l_shipdate"))).alias("_s"))
    j = table(s, d, "orders").join(li, C("l_orderkey") == C("o_orderkey"))
    return j.select("o_orderkey", dates.period_of(C("o_orderdate")).alias("origen"), F.greatest(dates.period_of(C("o_orderdate")), "_s").alias("ultima"), C("o_totalprice").alias("monto"))


_COHORT = "WITH " + _OPS + f", base AS (SELECT origen, {_dsum('monto')} AS originado FROM ops GROUP BY 1), viva AS (SELECT origen, foto, count(*) AS vivas, {_dsum('monto')} AS vivo FROM ops JOIN shots ON foto >= origen AND ultima >= foto GROUP BY 1, 2), m AS (SELECT b.origen, s.foto, b.originado, coalesce(vivas, 0) AS vivas, coalesce(vivo, 0) AS vivo, CAST((s.foto // 100 - b.origen // 100) * 12 + s.foto % 100 - b.origen % 100 AS INT) AS meses FROM base b JOIN shots s ON s.foto >= b.origen LEFT JOIN viva v ON v.origen = b.origen AND v.foto = s.foto)"


def _cohort_matrix(s: SparkSession, d: str) -> DataFrame:
    ops = _ops(s, d)
    return cohorts.survival_matrix(ops, ops.select(C("origen").alias("foto")).distinct(), ["origen"])


@query(_COHORT + " SELECT *, CASE WHEN originado > 0 THEN vivo / originado * 100 END AS pct FROM m")
def cohort_matrix(s, d):
    return _cohort_matrix(s, d)


@query(_COHORT + f""", f AS (SELECT 0 AS k, {_dsum('vivo')} / {_dsum('originado')} AS f FROM m WHERE meses = 0 UNION ALL SELECT a.meses, {_dsum('a.vivo')} / nullif({_dsum('b.vivo')}, 0) FROM m a JOIN m b ON a.origen = b.origen AND b.meses = a.meses - 1 GROUP BY 1)
  SELECT k, 100 * product(f) OVER (ORDER BY k) AS curva FROM f WHERE k < coalesce((SELECT min(k) FROM f WHERE f IS NULL), 9999)""")
def survival_curve(s, d):
    return cohorts.chained_survival(_cohort_matrix(s, d))


@query("WITH " + _OPS + f" SELECT origen, count(*) AS operaciones, {_dsum('monto')} AS originado, count(CASE WHEN ultima >= 199807 THEN 1 END) AS vivas, {_dsum('CASE WHEN ultima >= 199807 THEN monto ELSE 0 END')} AS vivo FROM ops GROUP BY 1")
def cohort_summary(s, d):
    alive = C("ultima") >= 199807
    return _ops(s, d).groupBy("origen").agg(F.count(F.lit(1)).alias("operaciones"), exact_sum(C("monto")).alias("originado"), F.count(F.when(alive, 1)).alias("vivas"), exact_sum(F.when(alive, C("monto")).otherwise(F.lit(0.0))).alias("vivo"))


# ---------------------------------------------------------------- windows and order
_SUPP = f"g AS (SELECT l_suppkey AS clave, {_dsum('l_extendedprice')} AS valor FROM lineitem GROUP BY 1)"


def _supp(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").groupBy(C("l_suppkey").cast("string").alias("clave")).agg(exact_sum(C("l_extendedprice")).alias("valor"))


@query("WITH g AS (SELECT CAST(clave AS VARCHAR) AS clave, valor FROM (SELECT l_suppkey AS clave, " + f"{_dsum('l_extendedprice')} AS valor FROM lineitem GROUP BY 1)), r AS (SELECT *, CASE WHEN valor > 0 THEN row_number() OVER (ORDER BY CASE WHEN valor > 0 THEN valor END DESC NULLS LAST, clave) END AS puesto, 100 * valor / (SELECT {_dsum('valor')} FROM g) AS parte FROM g), v AS (SELECT * FROM r WHERE puesto <= 5 OR clave = '77') SELECT clave, valor, CAST(puesto AS INT) AS puesto, parte FROM v UNION ALL SELECT 'Resto', {_dsum('valor')}, NULL, NULL FROM r WHERE clave NOT IN (SELECT clave FROM v) UNION ALL SELECT 'Total', {_dsum('valor')}, NULL, 100 FROM r")
def rank_pinned(s, d):
    return ranking.pinned_top(_supp(s, d), "clave", "valor", 5, "77")


_MONTH = f"m AS (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS periodo, o_orderpriority AS clave, {_dsum('o_totalprice')} AS valor FROM orders GROUP BY 1, 2)"


def _month(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").groupBy(dates.period_of(C("o_orderdate")).alias("periodo"), C("o_orderpriority").alias("clave")).agg(exact_sum(C("o_totalprice")).alias("valor"))


@query("WITH " + _MONTH + " SELECT periodo, clave, CAST(row_number() OVER (PARTITION BY periodo ORDER BY valor DESC, clave) AS INT) AS puesto FROM m QUALIFY clave = '1-URGENT'")
def rank_by_period(s, d):
    return ranking.positive_rank(_month(s, d), "valor", "clave", ["periodo"]).where("clave = '1-URGENT'").select("periodo", "clave", "puesto")


@query("WITH " + _MONTH + f", t AS (SELECT periodo, {_dsum('valor')} AS total FROM m GROUP BY 1) SELECT t.periodo, t.total, lag(t.total) OVER (ORDER BY t.periodo) AS anterior, d.total AS diciembre FROM t LEFT JOIN t d ON d.periodo = (t.periodo // 100 - 1) * 100 + 12")
def mom_change(s, d):
    t = _month(s, d).groupBy("periodo").agg(exact_sum(C("valor")).alias("total"))
    dec = t.select(C("periodo").alias("_d"), C("total").alias("diciembre"))
    w = Window.partitionBy(F.lit(1)).orderBy("periodo")  # one row a month
    return t.withColumn("anterior", F.lag("total").over(w)).join(small(dec), C("_d") == (F.floor(C("periodo") / 100) - 1) * 100 + 12, "left").drop("_d")


@query("WITH " + _SUPP + ", r AS (SELECT *, row_number() OVER (ORDER BY valor, clave) AS rn, count(*) OVER () AS n FROM g) SELECT clave, CASE WHEN rn <= 1 + (n - 1) / 3.0 THEN 1 WHEN rn <= 1 + (n - 1) * 2 / 3.0 THEN 2 ELSE 3 END AS tercil FROM r")
def segments(s, d):
    g = table(s, d, "lineitem").groupBy(C("l_suppkey").alias("clave")).agg(exact_sum(C("l_extendedprice")).alias("valor"))
    return ranking.tercile(g, "valor", "clave").select("clave", "tercil")


@query("SELECT l_orderkey, l_linenumber, l_suppkey, nullif(l_discount, 0) AS descuento, l_extendedprice FROM lineitem ORDER BY descuento DESC NULLS LAST, l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey LIMIT 50")
def topk_nulls_last(s, d):
    li = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.nullif("l_discount", F.lit(0.0)).alias("descuento"), "l_extendedprice")
    return li.orderBy(F.desc_nulls_last("descuento"), F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_suppkey").limit(50)


@query("SELECT o_orderpriority, count(*) AS n, CAST(coalesce(nullif(list_position(['5-LOW', '1-URGENT', '3-MEDIUM'], o_orderpriority), 0), 4) AS BIGINT) AS lugar FROM orders GROUP BY 1")
def order_by_domain(s, d):
    g = table(s, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    lugar = labels.domain_position(C("o_orderpriority"), ["5-LOW", "1-URGENT", "3-MEDIUM"])
    return g.withColumn("lugar", lugar).orderBy("lugar", "o_orderpriority")


@query("WITH " + _MONTH + " SELECT periodo, clave, valor, CAST(sum(CAST(valor AS DECIMAL(20,2))) OVER (PARTITION BY clave) AS DOUBLE) AS total_clave FROM m")
def order_by_group_total(s, d):
    m = _month(s, d)
    return m.withColumn("total_clave", F.sum(C("valor").cast("decimal(20,2)")).over(Window.partitionBy("clave")).cast("double")).orderBy(F.desc("total_clave"), "clave", "periodo")


@query("SELECT nombre, count(*) AS n FROM cmf_v2024 GROUP BY 1 ORDER BY n DESC, nombre LIMIT 25")
def most_common(s, d):
    return table(s, d, "cmf_v2024").groupBy("nombre").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "nombre").limit(25)


@query("SELECT evento_id, ts, tipo_evento FROM (SELECT *, row_number() OVER (PARTITION BY rut_compania, folio_operacion ORDER BY ts NULLS LAST, evento_id) AS rn FROM evento_mesa) WHERE rn = 1")
def stable_dedupe(s, d):
    w = Window.partitionBy("rut_compania", "folio_operacion").orderBy(F.asc_nulls_last("ts"), "evento_id")
    return table(s, d, "evento_mesa").withColumn("_r", F.row_number().over(w)).where("_r = 1").select("evento_id", "ts", "tipo_evento")


# ---------------------------------------------------------------- set operations
@query("SELECT s_suppkey AS id, s_name AS nombre, NULL AS segmento FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
def union_by_name(s, d):
    a = table(s, d, "supplier").select(C("s_suppkey").alias("id"), C("s_name").alias("nombre"))
    b = table(s, d, "customer").select(C("c_custkey").alias("id"), C("c_name").alias("nombre"), C("c_mktsegment").alias("segmento"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT n, 'ambos' AS donde FROM (SELECT s_nationkey AS n FROM supplier INTERSECT SELECT c_nationkey FROM customer) UNION ALL SELECT n, 'solo clientes' FROM (SELECT c_nationkey AS n FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL SELECT n, 'alguno' FROM (SELECT s_nationkey AS n FROM supplier UNION SELECT c_nationkey FROM customer)")
def set_ops(s, d):
    a, b = table(s, d, "supplier").select(C("s_nationkey").alias("n")), table(s, d, "customer").select(C("c_nationkey").alias("n"))
    tag = lambda df, x: df.withColumn("donde", F.lit(x))
    return tag(a.intersect(b), "ambos").union(tag(b.subtract(a), "solo clientes")).union(tag(a.union(b).distinct(), "alguno"))


# ---------------------------------------------------------------- predicates
_CHOSEN = {"estado": (["F", "P"], ["F", "O", "P"]), "prioridad": (["1-URGENT"], ["1-URGENT"]), "precio": (1000, 200000, 0, 10**9), "mesa": (["A"], ["A", "B"])}
_PHYSICAL = {"estado": "o_orderstatus", "prioridad": "o_orderpriority", "precio": "o_totalprice"}


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_totalprice BETWEEN 1000 AND 200000")
def filter_elision(s, d):
    """Selections by the names that users see; one that chooses everything is no predicate, one without a column is left out."""
    return filters.narrowed(table(s, d, "orders"), filters.renamed(_CHOSEN, _PHYSICAL))[0].select("o_orderkey")


@query("SELECT 'mesa' AS filtro")
def filter_omitted(s, d):
    """The selections that the view has no column for."""
    return s.createDataFrame([(x,) for x in filters.narrowed(table(s, d, "orders"), filters.renamed(_CHOSEN, _PHYSICAL))[1]], "filtro string")


_SHOWN = ["zip_origen", "source_file", "line_no"]


@query("SELECT DISTINCT zip_origen, source_file, line_no FROM fact_derivado WHERE producto IN ('SWAP', 'FORWARD') AND fecha_vencimiento BETWEEN DATE '2026-01-01' AND DATE '2029-12-31' AND nocional_m BETWEEN 1000 AND 5000000 AND contains(lower(contraparte_nombre), 'banco') AND clasificacion_riesgo IS NOT NULL AND folio_operacion IS NOT NULL")
def derivative_filters(s, d):
    chosen = {
        "producto": (["SWAP", "FORWARD"], ["SWAP", "FORWARD", "PACTO", "OPCION", "FUTURO"]), "vencimiento": (date(2026, 1, 1), date(2029, 12, 31), date(2000, 1, 1), date(2100, 1, 1)), "nocional": (1000.0, 5e6, 0.0, 1e15),
        "contraparte": " BANCO ", "calificada": True, "con_folio": True, "veredicto": (["pass", "unverified", "quarantine"], ["pass", "unverified", "quarantine"]), "glosa": "", "con_descarga": None,
    }
    return filters.selected(table(s, d, "fact_derivado"), "fact_derivado", chosen)[0].select(*_SHOWN).distinct()


@query("SELECT DISTINCT zip_origen, source_file, line_no FROM v_renta_fija_clasificada WHERE ambito IN ('LOCAL') AND fecha_vencimiento BETWEEN DATE '2026-01-01' AND DATE '2040-12-31' AND tir_mercado IS NULL AND contains(lower(emisor_nombre), 'emisora b')")
def bond_filters(s, d):
    chosen = {"ambito": (["LOCAL"], ["LOCAL", "EXTRANJERO"]), "vencimiento": (date(2026, 1, 1), date(2040, 12, 31), date(2000, 1, 1), date(2100, 1, 1)), "con_tir": False, "emisor": "Emisora B"}
    return filters.selected(table(s, d, "v_renta_fija_clasificada"), "v_renta_fija_clasificada", chosen)[0].select(*_SHOWN).distinct()


@query("SELECT folio_operacion, periodo, rut_compania, categoria, nocional_m FROM fact_flujo WHERE categoria IN ('NEW', 'UNWIND') AND folio_par IS NULL AND nocional_m BETWEEN 0 AND 1000000")
def flow_filters(s, d):
    chosen = {"categoria": (["NEW", "UNWIND"], ["NEW", "UNWIND", "ROLL", "ACTIVE", "MATURITY"]), "pareada": False, "nocional": (0.0, 1e6, -1e15, 1e15)}
    got = filters.selected(table(s, d, "fact_flujo"), "fact_flujo", chosen)[0]
    return filters.arranged(got, ["folio_operacion", "periodo", "rut_compania"], {"producto", "contraparte_key", "contraparte_grupo", "contraparte_nombre", "moneda", "fecha_vencimiento", "nocional_prev_m", "mtm_neto_m", "folio_par", "dif_rel_nocional"})


@query("SELECT c_custkey FROM customer WHERE contains(lower(c_name), 'auto') OR contains(lower(c_mktsegment), 'auto')")
def text_search(s, d):
    return table(s, d, "customer").where(text.any_contains(["c_name", "c_mktsegment"], "AUTO")).select("c_custkey")


@query("SELECT tipo_instrumento, CASE WHEN tipo_instrumento LIKE 'BE%' THEN 'bono' WHEN tipo_instrumento LIKE 'B%' THEN 'otro bono' WHEN tipo_instrumento LIKE 'D%' THEN 'deposito' ELSE 'resto' END AS clase, count(*) AS n FROM v_renta_fija_clasificada GROUP BY 1, 2")
def prefix_class(s, d):
    cls = labels.prefix_class(C("tipo_instrumento"), {"BE": "bono", "B": "otro bono", "D": "deposito"}, "resto")
    return table(s, d, "v_renta_fija_clasificada").groupBy("tipo_instrumento", cls.alias("clase")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT registro_id FROM cmf_v2024 WHERE nacionalidad IS DISTINCT FROM 'CL'")
def null_safe_filter(s, d):
    return table(s, d, "cmf_v2024").where(~C("nacionalidad").eqNullSafe("CL")).select("registro_id")


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def sql_gate(s, d):
    table(s, d, "orders").createOrReplaceTempView("orders")
    return filters.gated(s, "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1", {"orders"})


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'F'")
def intent_sql(s, d):
    return s.sql("SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_totalprice > :least AND o_orderstatus = :status", args={"least": 250000, "status": "F"}, orders=table(s, d, "orders"))


#: Questions by intent, each one statement with parameters; the tables are views given by name.
INTENTS: dict[str, str] = {
    "total": "SELECT count(*) AS n, CAST(sum(CAST(nocional_m AS DECIMAL(28,4))) AS DOUBLE) AS monto FROM {posiciones} WHERE periodo = :periodo",
    "mayores": "SELECT contraparte_grupo, CAST(sum(CAST(nocional_m AS DECIMAL(28,4))) AS DOUBLE) AS monto FROM {posiciones} WHERE periodo = :periodo GROUP BY contraparte_grupo ORDER BY monto DESC NULLS LAST, contraparte_grupo LIMIT :n",
    "por_producto": "SELECT producto, count(*) AS n, CAST(sum(CAST(nocional_m AS DECIMAL(28,4))) AS DOUBLE) AS monto FROM {posiciones} WHERE periodo = :periodo GROUP BY producto",
    "evolucion": "SELECT periodo, CAST(sum(CAST(nocional_m AS DECIMAL(28,4))) AS DOUBLE) AS monto FROM {posiciones} WHERE contraparte_grupo = :grupo GROUP BY periodo",
    "vencen": "SELECT rut_compania, folio_operacion, fecha_vencimiento, nocional_m FROM {posiciones} WHERE periodo = :periodo AND fecha_vencimiento BETWEEN :desde AND :hasta",
    "detalle": "SELECT periodo, rut_compania, producto, nocional_m FROM {posiciones} WHERE folio_operacion = :folio",
}


def answer(s: SparkSession, intent: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """The table that answers an intent; parameters are bound, never put into the text."""
    return s.sql(INTENTS[intent], args=args, **tables)


_ASKED: dict[str, dict] = {
    "total": {"periodo": _T}, "mayores": {"periodo": _T, "n": 5}, "por_producto": {"periodo": _T}, "evolucion": {"grupo": "Grupo Fersantogó"},
    "vencen": {"periodo": _T, "desde": date(2025, 9, 1), "hasta": date(2026, 9, 1)}, "detalle": {"folio": "5001049"},
}


def _intent(name: str):
    def run(s: SparkSession, d: str) -> DataFrame:
        return answer(s, name, {"posiciones": _snap(s, d)}, **_ASKED[name])

    text_ = INTENTS[name].replace("{posiciones}", "snap").replace("DECIMAL(28,4)", "DECIMAL(24,4)")
    for k, v in _ASKED[name].items():
        text_ = text_.replace(f":{k}", f"DATE '{v}'" if isinstance(v, date) else repr(v))
    return run, f"WITH {_SNAP} {text_}"


for _name in INTENTS:
    QUERIES[f"intent_{_name}"], ORACLE[f"intent_{_name}"] = _intent(_name)


# ---------------------------------------------------------------- scalar functions
_F = "(SELECT DISTINCT zip_origen, source_file, line_no, {} FROM fact_derivado)"


def _scalar(cols: Callable[[], dict[str, Column]], keys: tuple = ("zip_origen", "source_file", "line_no"), name: str = "fact_derivado"):
    return lambda s, d: table(s, d, name).select(*keys, *[c.alias(n) for n, c in cols().items()]).distinct()


def _register(name: str, f, sql: str | None) -> None:
    QUERIES[name] = f
    if sql:
        ORACLE[name] = sql


_KEY3 = "zip_origen, source_file, line_no"
_register("currency_map", _scalar(lambda: {"moneda": text.currency(C("moneda"))}), f"SELECT DISTINCT {_KEY3}, CASE upper(trim(moneda)) WHEN 'PROM' THEN 'USD' WHEN '$$' THEN 'CLP' WHEN '' THEN NULL ELSE upper(trim(moneda)) END AS moneda FROM fact_derivado")
_register("month_end", _scalar(lambda: {"cierre": dates.period_end(C("periodo_informacion")), "anterior": dates.months_back(C("periodo_informacion"))}), f"SELECT DISTINCT {_KEY3}, {_END.format('periodo_informacion')} AS cierre, CAST(CASE WHEN periodo_informacion % 100 = 1 THEN periodo_informacion - 89 ELSE periodo_informacion - 1 END AS INT) AS anterior FROM fact_derivado")
_register(
    "day_math",
    _scalar(lambda: {"dias": F.datediff("fecha_vencimiento", "fecha_operacion"), "meses": dates.months_apart(C("fecha_operacion"), C("fecha_vencimiento")), "anos": dates.tenor_years(C("fecha_operacion"), C("fecha_vencimiento")), "trimestre": dates.bucket(C("fecha_vencimiento"), "quarter"), "mas_seis": F.add_months("fecha_operacion", 6), "periodo": dates.period_of(C("fecha_operacion")), "siglo": dates.century_fixed(C("fecha_vencimiento"), C("fecha_operacion"))}),
    f"SELECT DISTINCT {_KEY3}, CAST(date_diff('day', fecha_operacion, fecha_vencimiento) AS INT) AS dias, CAST((year(fecha_vencimiento) - year(fecha_operacion)) * 12 + month(fecha_vencimiento) - month(fecha_operacion) AS INT) AS meses, date_diff('day', fecha_operacion, fecha_vencimiento) / 365.25 AS anos, CAST(date_trunc('quarter', fecha_vencimiento) AS DATE) AS trimestre, CAST(fecha_operacion + INTERVAL 6 MONTH AS DATE) AS mas_seis, CAST(year(fecha_operacion) * 100 + month(fecha_operacion) AS INT) AS periodo, CAST(CASE WHEN fecha_vencimiento < fecha_operacion THEN fecha_vencimiento + INTERVAL 1200 MONTH ELSE fecha_vencimiento END AS DATE) AS siglo FROM fact_derivado",
)
_YEARS = "(date_diff('day', fecha_operacion, fecha_vencimiento) / 365.25)"
_DAYS = "date_diff('day', fecha_operacion, fecha_vencimiento)"
_register(
    "tenor_band",
    _scalar(lambda: {"tramo": labels.band(dates.tenor_years(C("fecha_operacion"), C("fecha_vencimiento")), labels.MATURITY), "original": labels.band(F.datediff("fecha_vencimiento", "fecha_operacion"), labels.ORIGINAL, "right")}),
    f"SELECT DISTINCT {_KEY3}, CASE WHEN {_YEARS} < 0 THEN 'vencido' WHEN {_YEARS} < 0.25 THEN '0-3m' WHEN {_YEARS} < 1 THEN '3-12m' WHEN {_YEARS} < 2 THEN '1-2a' WHEN {_YEARS} < 5 THEN '2-5a' WHEN {_YEARS} < 10 THEN '5-10a' WHEN {_YEARS} IS NOT NULL THEN '10a+' END AS tramo, CASE WHEN {_DAYS} <= 31 THEN 'Hasta 1M' WHEN {_DAYS} <= 92 THEN '1-3M' WHEN {_DAYS} <= 183 THEN '3-6M' WHEN {_DAYS} <= 366 THEN '6-12M' WHEN {_DAYS} <= 731 THEN '1-2A' WHEN {_DAYS} <= 1827 THEN '2-5A' WHEN {_DAYS} <= 3653 THEN '5-10A' WHEN {_DAYS} <= 7305 THEN '10-20A' WHEN {_DAYS} IS NOT NULL THEN 'Más de 20A' END AS original FROM fact_derivado",
)
_FOLD = "translate(upper(replace(coalesce({}, ''), 'ß', 'SS')), 'ÁÉÍÓÚÜÑÀÈÌÒÙÂÊÎÔÛÃÕÇÄËÏÖ', 'AEIOUUNAEIOUAEIOUAOCAEIO')"
_ENDS = "|".join(sorted(text.ENDINGS, key=lambda e: (-len(e), e)))
_register("name_normalize", lambda s, d: table(s, d, "contrapartes").select("entidad_id", text.name_key(C("entidad_nombre")).alias("clave")).distinct(), f"SELECT DISTINCT entidad_id, regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace({_FOLD.format('entidad_nombre')}, '\\b\\d{{6,}}-?[0-9K]?\\b', ' ', 'g'), '[^A-Z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g')), '([^ ])( ({_ENDS}))+$', '\\1') AS clave FROM contrapartes")
_register("mod11_check", lambda s, d: table(s, d, "cmf_v2024").select("registro_id", identifiers.mod11_valid(C("rut"), C("verificador")).alias("valido")).distinct(), "SELECT DISTINCT registro_id, coalesce(CASE WHEN rut > 0 THEN CASE x WHEN 11 THEN '0' WHEN 10 THEN 'K' ELSE CAST(x AS VARCHAR) END END = upper(trim(verificador)), false) AS valido FROM (SELECT *, 11 - list_sum(list_transform(range(0, length(CAST(rut AS VARCHAR))), lambda i: CAST(reverse(CAST(rut AS VARCHAR))[i + 1] AS INT) * (2 + i % 6))) % 11 AS x FROM cmf_v2024)")
_register("mod97_check", lambda s, d: table(s, d, "cmf_v2024").where("lei IS NOT NULL").select("registro_id", identifiers.lei_valid(C("lei")).alias("valido")).distinct(), "SELECT DISTINCT registro_id, regexp_matches(lei, '^[A-Z0-9]{18}[0-9]{2}$') AND CAST(regexp_replace(list_reduce(list_transform(string_split(upper(lei), ''), lambda c: CASE WHEN regexp_matches(c, '[A-Z]') THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), lambda a, b: CAST((CAST(a AS BIGINT) * CASE WHEN length(b) = 2 THEN 100 ELSE 10 END + CAST(b AS BIGINT)) % 97 AS VARCHAR)), '', '') AS BIGINT) = 1 AS valido FROM cmf_v2024 WHERE lei IS NOT NULL")
_RATES = "CASE producto WHEN 'SWAP' THEN 'icp_clp' WHEN 'FUTURO' THEN 'SOFR +' WHEN 'PACTO' THEN 'Fijo' WHEN 'OPCION' THEN '' ELSE 'FIJA' END || coalesce(' ' || replace(CAST(CAST(tasa_precio_contrato AS DECIMAL(10,2)) AS VARCHAR), '.', ','), ' s/i')"


def _rates(s: SparkSession, d: str) -> DataFrame:
    word = F.when(C("producto") == "SWAP", "icp_clp").when(C("producto") == "FUTURO", "SOFR +").when(C("producto") == "PACTO", "Fijo").when(C("producto") == "OPCION", "").otherwise("FIJA")
    rate = F.concat(F.lit(" "), F.replace(C("tasa_precio_contrato").cast("decimal(10,2)").cast("string"), F.lit("."), F.lit(",")))
    return table(s, d, "fact_derivado").select(F.concat(word, F.coalesce(rate, F.lit(" s/i"))).alias("t"), F.lit("TASA 1,5").alias("otra")).distinct()


@query(f"""SELECT t, v AS tasa, tipo, CASE WHEN tipo LIKE '%FIJA%' OR tipo LIKE '%FIJO%' THEN true WHEN regexp_matches(tipo, 'ICP|LIBOR|SOFR|TAB|VAR|CAMARA|TPM|EURIBOR') THEN false END AS fija, coalesce(v, 1.5) AS primera, CASE WHEN v IS NOT NULL THEN 't' ELSE 'otra' END AS origen
  FROM (SELECT t, TRY_CAST(replace(nullif(regexp_extract(t, '(-?\\d+(?:[.,]\\d+)?)', 1), ''), ',', '.') AS DOUBLE) AS v, nullif(upper(trim(regexp_replace(t, '[^A-Za-z_]+', ' ', 'g'))), '') AS tipo FROM (SELECT DISTINCT {_RATES} AS t FROM fact_derivado))""")
def rate_text_split(s, d):
    """Number, words and kind of rates written as text, and the first number of two columns with its origin."""
    first = numbers.first_rate(["t", "otra"])
    return _rates(s, d).select("t", numbers.rate_value(C("t")).alias("tasa"), numbers.rate_label(C("t")).alias("tipo"), numbers.is_fixed(numbers.rate_label(C("t"))).alias("fija"), first["valor"].alias("primera"), first["origen"].alias("origen"))
_FAMILY_SQL = "CASE WHEN i LIKE '%swap promesa%' THEN 'Swap UF/CLP' WHEN i LIKE 'CCS%' THEN 'CCS' WHEN i LIKE 'Forward FX%' THEN 'Forward FX' WHEN i = 'Forward UF' THEN 'Forward UF' WHEN i LIKE 'IRS%' THEN 'IRS' WHEN i IN ('Opcion', 'Futuro', 'Pacto') THEN i ELSE 'Otro derivado' END"
_INSTRUMENT_SQL = "CASE producto WHEN 'SWAP' THEN CASE WHEN m = 'UF' THEN 'UF/CLP (swap promesa)' WHEN m = 'CLP' THEN 'IRS CLP' ELSE 'CCS ' || m || '/CLP' END WHEN 'FORWARD' THEN CASE WHEN m = 'UF' THEN 'Forward UF' ELSE 'Forward FX ' || coalesce(m, '?') END WHEN 'OPCION' THEN 'Opcion' WHEN 'FUTURO' THEN 'Futuro' WHEN 'PACTO' THEN 'Pacto' END"


@query(f"SELECT DISTINCT i AS instrumento, {_FAMILY_SQL} AS familia FROM (SELECT {_INSTRUMENT_SQL} AS i FROM (SELECT producto, CASE upper(trim(moneda)) WHEN 'PROM' THEN 'USD' WHEN '$$' THEN 'CLP' WHEN '' THEN NULL ELSE upper(trim(moneda)) END AS m FROM fact_derivado))")
def family_labels(s, d):
    """Family of each instrument, by the first rule of a table that fits its name."""
    m = text.currency(C("moneda"))
    swap = F.when(m == "UF", "UF/CLP (swap promesa)").when(m == "CLP", "IRS CLP").otherwise(F.concat(F.lit("CCS "), m, F.lit("/CLP")))
    forward = F.when(m == "UF", "Forward UF").otherwise(F.concat(F.lit("Forward FX "), F.coalesce(m, F.lit("?"))))
    names = F.when(C("producto") == "SWAP", swap).when(C("producto") == "FORWARD", forward).when(C("producto") == "OPCION", "Opcion").when(C("producto") == "FUTURO", "Futuro").when(C("producto") == "PACTO", "Pacto")
    return table(s, d, "fact_derivado").select(names.alias("instrumento")).distinct().withColumn("familia", labels.first_match(C("instrumento"), labels.FAMILIES, "Otro derivado"))


_register("period_token", lambda s, d: table(s, d, "fact_derivado").select(F.regexp_extract("source_file", "^([a-z])(\\d{6})", 1).alias("letra"), F.regexp_extract("source_file", "\\.(\\d+)$", 1).alias("rut"), dates.period_token(F.regexp_extract("source_file", "(\\d{6})", 1)).alias("periodo"), dates.period_token(F.lit("231231")).alias("cierre"), dates.period_token(F.lit("999999")).alias("nada")).distinct(), "SELECT DISTINCT regexp_extract(source_file, '^([a-z])(\\d{6})', 1) AS letra, regexp_extract(source_file, '\\.(\\d+)$', 1) AS rut, CAST(regexp_extract(source_file, '(\\d{6})', 1) AS INT) AS periodo, 202312 AS cierre, CAST(NULL AS INT) AS nada FROM fact_derivado")
_register("first_nonzero_origin", lambda s, d: table(s, d, "fact_derivado").select("zip_origen", "source_file", "line_no", numbers.first_nonzero(["mtm_activo_m", "mtm_pasivo_m"])[0].alias("valor"), numbers.first_nonzero(["mtm_activo_m", "mtm_pasivo_m"])[1].alias("origen")).distinct(), f"SELECT DISTINCT {_KEY3}, coalesce(nullif(mtm_activo_m, 0), nullif(mtm_pasivo_m, 0), mtm_activo_m, mtm_pasivo_m) AS valor, CASE WHEN nullif(mtm_activo_m, 0) IS NOT NULL THEN 'mtm_activo_m' WHEN nullif(mtm_pasivo_m, 0) IS NOT NULL THEN 'mtm_pasivo_m' WHEN mtm_activo_m IS NOT NULL THEN 'mtm_activo_m' WHEN mtm_pasivo_m IS NOT NULL THEN 'mtm_pasivo_m' END AS origen FROM fact_derivado")
_register(
    "rate_math",
    lambda s, d: table(s, d, "v_renta_fija_clasificada").select("zip_origen", "source_file", "line_no", numbers.breakeven(C("tir_mercado"), F.lit(5.0)).alias("breakeven"), F.round(numbers.bullet_duration(F.lit(10.0), C("tir_mercado"), F.lit(4.0)), 6).alias("duracion"), numbers.percent_over(C("valor_final"), F.lit(1000.0)).alias("sobre"), numbers.least_positive(C("valor_final"), F.lit(50000.0)).alias("menor"), numbers.relative_difference(C("valor_final"), F.lit(1000.0)).alias("dif"), numbers.compound_difference(C("tir_mercado"), F.lit(3.0)).alias("sobre_tasa"), F.round(numbers.implied_growth(C("valor_final"), F.lit(1000.0), F.datediff("fecha_vencimiento", F.lit("2025-01-01").cast("date"))), 6).alias("crecimiento")).distinct(),
    f"SELECT DISTINCT {_KEY3}, CASE WHEN tir_mercado <> 0 OR 5.0 <> 0 THEN ((1 + 5.0 / 100) / (1 + tir_mercado / 100) - 1) * 100 END AS breakeven, round(CASE WHEN abs(y) < 1e-9 THEN 10 / (1 + y) ELSE ((1 + y) / y - (1 + y + 10 * (0.04 - y)) / (0.04 * (pow(1 + y, 10) - 1) + y)) / (1 + y) END, 6) AS duracion, (valor_final / 1000 - 1) * 100 AS sobre, least(CASE WHEN valor_final > 0 THEN valor_final END, 50000) AS menor, abs(valor_final - 1000) / 1000 AS dif, ((1 + tir_mercado / 100) / 1.03 - 1) * 100 AS sobre_tasa, round(CASE WHEN valor_final > 0 AND fecha_vencimiento > DATE '2025-01-01' THEN (pow(valor_final / 1000, 365.0 / date_diff('day', DATE '2025-01-01', fecha_vencimiento)) - 1) * 100 END, 6) AS crecimiento FROM (SELECT *, coalesce(nullif(tir_mercado, 0), 4.0) / 100 AS y FROM v_renta_fija_clasificada)",
)
_register("amount_cl", lambda s, d: table(s, d, "fact_derivado").where("nocional_texto IS NOT NULL").select("nocional_texto", numbers.spanish_amount(F.regexp_extract("nocional_texto", "([0-9.,]*[0-9])", 1)).cast("double").alias("monto")).distinct(), "SELECT DISTINCT nocional_texto, CAST(TRY_CAST(replace(replace(regexp_extract(nocional_texto, '([0-9.,]*[0-9])', 1), '.', ''), ',', '.') AS DECIMAL(20,4)) AS DOUBLE) AS monto FROM fact_derivado WHERE nocional_texto IS NOT NULL")
_register("month_label", lambda s, d: table(s, d, "fact_derivado").select("periodo_informacion", text.month_label(C("periodo_informacion")).alias("etiqueta"), text.month_title(C("periodo_informacion")).alias("titulo")).distinct(), "SELECT DISTINCT periodo_informacion, ['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic'][periodo_informacion % 100] || '-' || (periodo_informacion // 100) AS titulo, ['ene','feb','mar','abr','may','jun','jul','ago','sep','oct','nov','dic'][periodo_informacion % 100] || '-' || lpad(CAST(periodo_informacion // 100 % 100 AS VARCHAR), 2, '0') AS etiqueta FROM fact_derivado")
_register("pair_canonical", lambda s, d: table(s, d, "fact_derivado").select(text.currency(C("moneda")).alias("a")).where("a IS NOT NULL").distinct().select("a", text.pair(C("a"), F.lit("USD")).alias("par")), "WITH x AS (SELECT DISTINCT CASE upper(trim(moneda)) WHEN 'PROM' THEN 'USD' WHEN '$$' THEN 'CLP' WHEN '' THEN NULL ELSE upper(trim(moneda)) END AS a FROM fact_derivado WHERE moneda IS NOT NULL) SELECT a, CASE WHEN a IN ('UF', 'USD') THEN a || '/USD' ELSE 'USD/' || a END AS par FROM x WHERE a IS NOT NULL")
_register("slug", lambda s, d: table(s, d, "fact_derivado").select("zip_origen", text.slug(C("zip_origen")).alias("slug")).distinct(), "SELECT DISTINCT zip_origen, regexp_replace(zip_origen, '[^A-Za-z0-9]+', '_', 'g') AS slug FROM fact_derivado")
_register("flag_list", lambda s, d: table(s, d, "orders").select("o_orderkey", text.flags({"final": F.when(C("o_orderstatus") == "F", "S"), "caro": F.when(C("o_totalprice") > 200000, "S").otherwise("N")}).alias("marcas")), "SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'F' THEN 'final' END, CASE WHEN o_totalprice > 200000 THEN 'caro' END) AS marcas FROM orders")
_LEG_A = {"SWAP": "ICP CLP", "FORWARD": "fija", "PACTO": "tab nominal", "OPCION": "Sofr", "FUTURO": "libor 6m"}
_LEG_B = {"USD": "VAR", "UF": "FIJA", "EUR": "CPTFEMU", "CLP": "CLP TNA"}
_CASES = lambda c, m: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in m.items()) + " END"
_ANY_LEG = lambda p: f"coalesce(starts_with(upper(a), '{p}'), false) OR coalesce(starts_with(upper(b), '{p}'), false)"


@query(f"SELECT a, b, CASE WHEN a IS NULL AND b IS NULL THEN 'SIN_DETERMINAR' WHEN {_ANY_LEG('ICP')} THEN 'Camara' WHEN {_ANY_LEG('TAB')} THEN 'TAB' WHEN {_ANY_LEG('SOFR')} THEN 'SOFR' WHEN {_ANY_LEG('LIBO')} THEN 'LIBOR' WHEN {_ANY_LEG('CLP TNA')} THEN 'CLP TNA' WHEN {_ANY_LEG('CPTFEMU')} THEN 'Euribor/CPTFEMU' WHEN coalesce(upper(a) = 'VAR', false) OR coalesce(upper(b) = 'VAR', false) THEN 'Variable s/d' WHEN upper(a) = 'FIJA' AND upper(b) = 'FIJA' THEN 'Fija contra Fija' ELSE 'SIN_DETERMINAR' END AS indice FROM (SELECT DISTINCT {_CASES('producto', _LEG_A)} AS a, {_CASES('upper(trim(moneda))', _LEG_B)} AS b FROM fact_derivado UNION SELECT NULL, NULL)")
def index_label(s, d):
    """Floating index of two legs, in every combination that products and currencies give."""
    of = lambda c, m: reduce(lambda a, kv: a.when(c == kv[0], kv[1]), m.items(), F.when(F.lit(False), F.lit(None).cast("string")))
    legs = table(s, d, "fact_derivado").select(of(C("producto"), _LEG_A).alias("a"), of(F.upper(F.trim("moneda")), _LEG_B).alias("b"))
    legs = legs.union(s.createDataFrame([(None, None)], "a string, b string")).distinct()
    return legs.withColumn("indice", text.floating_index(C("a"), C("b")))
_register("fixed_width_roundtrip", lambda s, d: table(s, d, "orders").select("o_orderkey", F.concat(F.lpad(C("o_orderkey").cast("string"), 10, "0"), F.rpad("o_orderstatus", 5, " "), F.lpad((C("o_totalprice") * 100).cast("decimal(20,0)").cast("string"), 17, "0"), F.date_format("o_orderdate", "yyyyMMdd")).alias("raw")).select("o_orderkey", numbers.filed_number(F.substring("raw", 1, 10), 10).alias("clave"), text.clean(F.substring("raw", 11, 5)).alias("estado"), numbers.filed_number(F.substring("raw", 16, 17), 17, 2).cast("double").alias("precio"), dates.filed_date(F.substring("raw", 33, 8)).alias("fecha")), "SELECT o_orderkey, o_orderkey AS clave, o_orderstatus AS estado, CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS DOUBLE) AS precio, CAST(o_orderdate AS DATE) AS fecha FROM orders")
_WORDS = "list_distinct(list_filter(string_split_regex(regexp_replace(upper(coalesce({}, '')), '[^A-Z0-9 ]', ' ', 'g'), ' +'), lambda w: length(w) > 2 AND NOT list_contains([" + ", ".join(f"'{w}'" for w in text.EMPTY_WORDS) + "], w)))"
_INITIALS = "list_aggregate(list_transform(list_filter(string_split_regex(regexp_replace(upper(nombre), '[^A-Z0-9 ]', ' ', 'g'), ' +'), lambda w: w <> '' AND NOT list_contains([" + ", ".join(f"'{w}'" for w in text.ACRONYM_SKIP) + "], w)), lambda w: w[1]), 'string_agg', '')"
_TOKENS = f"""SELECT DISTINCT nombre, coalesce(sigla, '') AS sigla, array_to_string(list_sort(ws), ' ') AS palabras, list_has_any(ws, ['SEGUROS', 'GENERALES']) OR length(list_filter(ws, lambda w: length(w) >= 4 AND contains('GENERALESSEGUROS', w))) > 0
  OR contains(array_to_string(list_sort(ws), ''), 'SEGUROS') OR contains(array_to_string(list_sort(ws), ''), 'GENERALES') OR length(sigla) >= 3 AND list_contains(['SEGUROS', 'GENERALES'], sigla) AS igual FROM (SELECT nombre, {_WORDS.format('nombre')} AS ws, {_INITIALS} AS sigla FROM dim_compania)"""
_register("token_match", lambda s, d: table(s, d, "dim_compania").select("nombre", text.acronym(C("nombre")).alias("sigla"), F.array_join(F.array_sort(text.content_words(C("nombre"))), " ").alias("palabras"), text.same_name(C("nombre"), F.lit("Seguros Generales")).alias("igual")).distinct(), _TOKENS)


# ---------------------------------------------------------------- rules
@query("""WITH x AS (SELECT DISTINCT o_orderkey, o_totalprice, o_orderstatus FROM orders), c AS (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN abs(o_totalprice - 150000) <= greatest(150000 * 0.5, 1) END AS a,
  CASE WHEN o_totalprice <= 200000 * (1 + 1e-6) THEN true WHEN o_totalprice > 400000 THEN false END AS b FROM x)
  SELECT o_orderkey, CASE WHEN NOT coalesce(a, true) OR NOT coalesce(b, true) THEN 'quarantine' WHEN coalesce(a, false) OR coalesce(b, false) THEN 'pass' ELSE 'unverified' END AS veredicto, concat_ws(';', CASE WHEN NOT a THEN 'cerca' END, CASE WHEN NOT b THEN 'tope' END) AS motivos FROM c""")
def verdict_rules(s, d):
    o = table(s, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").distinct()
    near = rules.check("cerca", C("o_orderstatus") != "P", F.lit(150000.0), C("o_totalprice"), relative=0.5, absolute=1.0)
    cap = rules.bounded("tope", F.lit(True), C("o_totalprice"), F.lit(200000.0), 2.0)
    return rules.judged(o, [near, cap]).select("o_orderkey", "veredicto", "motivos")


@query("SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(abs(l_extendedprice - 365 * l_quantity) <= abs(365 * l_quantity) * 0.02, false) AS b365, CASE WHEN abs(l_extendedprice - 360 * l_quantity) <= abs(360 * l_quantity) * 0.02 THEN 'b360' WHEN abs(l_extendedprice - 365 * l_quantity) <= abs(365 * l_quantity) * 0.02 THEN 'b365' ELSE 'b360' END AS base FROM lineitem")
def rule_two_bases(s, d):
    a, b = [rules.check(f"b{n}", F.lit(True), C("l_quantity") * n, C("l_extendedprice"), relative=0.02) for n in (360, 365)]
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.coalesce(b["ok"], F.lit(False)).alias("b365"), rules.first_fitting("b", [a, b])["rule"].alias("base"))


# ---------------------------------------------------------------- resolution and reconciliation
@query("""WITH cat AS (SELECT n_name AS entity, n_nationkey AS rut FROM nation), x AS (SELECT s_suppkey, s_nationkey FROM supplier) SELECT s_suppkey, entity AS entidad, CASE WHEN entity IS NULL THEN 'unresolved' ELSE 'rut' END AS metodo, CASE WHEN entity IS NULL THEN 0.0 ELSE 1.0 END AS confianza FROM x LEFT JOIN cat ON rut = s_nationkey""")
def resolve_exact(s, d):
    rows = table(s, d, "supplier").select("s_suppkey", C("s_nationkey").alias("rut"), C("s_name").alias("name"), F.lit(None).cast("string").alias("identifier"))
    cat = table(s, d, "nation").select(C("n_name").alias("entity"), C("n_nationkey").alias("rut"), F.lit(None).cast("string").alias("alias"), F.lit(None).cast("string").alias("identifier"))
    return resolve.cascade(rows, cat, ["s_suppkey"])


_KEYED = lambda c: f"regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace({_FOLD.format(c)}, '\\b\\d{{6,}}-?[0-9K]?\\b', ' ', 'g'), '[^A-Z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g')), '([^ ])( ({_ENDS}))+$', '\\1')"


@query(f"""WITH x AS (SELECT DISTINCT registro_id, rut, {_KEYED('nombre')} AS n, lei FROM cmf_v2024), c AS (SELECT entidad_id AS e, TRY_CAST(regexp_extract(entidad_id, '^RUT (\\d+)-', 1) AS BIGINT) AS rut, {_KEYED('entidad_nombre')} AS n, CASE WHEN entidad_tipo_id = 'LEI' THEN substr(entidad_id, 5, 20) END AS lei FROM contrapartes),
  r AS (SELECT rut, min(e) AS er FROM c WHERE rut IS NOT NULL GROUP BY 1), a AS (SELECT n, min(e) AS ea FROM c WHERE n <> '' GROUP BY 1), i AS (SELECT lei, min(e) AS ei FROM c WHERE lei <> '' GROUP BY 1)
  SELECT registro_id, coalesce(er, ea, ei) AS entidad, CASE WHEN er IS NOT NULL THEN 'rut' WHEN ea IS NOT NULL THEN 'alias' ELSE 'identifier' END AS metodo FROM x LEFT JOIN r USING (rut) LEFT JOIN a USING (n) LEFT JOIN i USING (lei) WHERE coalesce(er, ea, ei) IS NOT NULL""")
def resolve_steps(s, d):
    """Filed records that the exact steps resolve: tax id, then alias, then identifier."""
    rows = table(s, d, "cmf_v2024").select("registro_id", "rut", C("nombre").alias("name"), C("lei").alias("identifier")).distinct()
    cat = table(s, d, "contrapartes").select(C("entidad_id").alias("entity"), F.regexp_extract("entidad_id", r"^RUT (\d+)-", 1).try_cast("bigint").alias("rut"), C("entidad_nombre").alias("alias"), F.when(C("entidad_tipo_id") == "LEI", F.substring("entidad_id", 5, 20)).alias("identifier"))
    return resolve.exact(rows, cat, ["registro_id"]).select("registro_id", "entidad", "metodo")


@query()
def resolve_fuzzy(s, d):
    """Filed names against the known identities, by alias, identifier and similarity."""
    rows = table(s, d, "cmf_v2024").select("registro_id", F.lit(None).cast("bigint").alias("rut"), C("nombre").alias("name"), C("lei").alias("identifier")).distinct()
    cat = table(s, d, "contrapartes").select(C("entidad_id").alias("entity"), F.lit(None).cast("bigint").alias("rut"), C("entidad_nombre").alias("alias"), F.when(C("entidad_tipo_id") == "LEI", F.substring("entidad_id", 5, 20)).alias("identifier"))
    return resolve.cascade(rows, cat, ["registro_id"])


@query("""WITH a AS (SELECT o_orderkey AS a_id, o_custkey AS k, CAST(o_orderdate AS DATE) AS ad FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_orderkey AS b_id, o_custkey AS k, CAST(o_orderdate AS DATE) AS bd FROM orders WHERE o_orderstatus = 'O'),
  c AS (SELECT a_id, b_id, CAST(abs(date_diff('day', ad, bd)) AS INT) AS dias FROM a JOIN b USING (k) WHERE abs(date_diff('day', ad, bd)) <= 5) SELECT a_id, b_id, dias FROM (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY dias, b_id) AS x, row_number() OVER (PARTITION BY b_id ORDER BY dias, a_id) AS y FROM c) WHERE x = 1 AND y = 1""")
def recon_interval(s, d):
    o = table(s, d, "orders")
    a = o.where("o_orderstatus = 'F'").select(C("o_orderkey").alias("a_id"), C("o_custkey").alias("k"), C("o_orderdate").alias("ad"))
    b = o.where("o_orderstatus = 'O'").select(C("o_orderkey").alias("b_id"), C("o_custkey").alias("k"), C("o_orderdate").alias("bd"))
    return reconcile.one_to_one(a, b, ["k"], "a_id", "b_id", "ad", "bd", 5)


@query("SELECT coalesce(a.p, b.p) AS paquete, a.n AS izquierda, b.n AS derecha, a.n = b.n AS iguales FROM (SELECT o_orderpriority AS p, count(DISTINCT o_custkey) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a FULL JOIN (SELECT o_orderpriority AS p, count(DISTINCT o_custkey) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON a.p = b.p")
def package_match(s, d):
    g = lambda st, n: table(s, d, "orders").where(C("o_orderstatus") == st).groupBy(C("o_orderpriority").alias("paquete")).agg(F.count_distinct("o_custkey").alias(n))
    return g("F", "izquierda").join(g("O", "derecha"), "paquete", "full").withColumn("iguales", C("izquierda") == C("derecha"))


_MOD11 = "CASE x WHEN 11 THEN '0' WHEN 10 THEN 'K' ELSE CAST(x AS VARCHAR) END"
_LEI_OK = "regexp_matches(l, '^[A-Z0-9]{18}[0-9]{2}$') AND CAST(list_reduce(list_transform(string_split(l, ''), lambda c: CASE WHEN regexp_matches(c, '[A-Z]') THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), lambda a, b: CAST((CAST(a AS BIGINT) * CASE WHEN length(b) = 2 THEN 100 ELSE 10 END + CAST(b AS BIGINT)) % 97 AS VARCHAR)) AS BIGINT) = 1"


@query(f"""WITH b AS (SELECT registro_id, coalesce(rut, 0) AS r, upper(trim(coalesce(verificador, ''))) AS v, nullif(nullif(upper(trim(coalesce(lei, ''))), ''), '0') AS l, trim(coalesce(nombre, '')) AS n FROM cmf_v2024),
  k AS (SELECT *, 11 - list_sum(list_transform(range(0, length(CAST(r AS VARCHAR))), lambda i: CAST(reverse(CAST(r AS VARCHAR))[i + 1] AS INT) * (2 + i % 6))) % 11 AS x,
    regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace({_FOLD.format('n')}, '\\b\\d{{6,}}-?[0-9K]?\\b', ' ', 'g'), '[^A-Z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g')), '([^ ])( ({_ENDS}))+$', '\\1') AS norm FROM b),
  t AS (SELECT *, CASE WHEN r > 0 THEN CASE WHEN {_MOD11} = v THEN 'RUT' ELSE 'RUT invalido' END WHEN l IS NOT NULL THEN CASE WHEN {_LEI_OK} THEN 'LEI' ELSE 'LEI invalido' END ELSE 'Sin RUT ni LEI' END AS tipo FROM k),
  e AS (SELECT *, CASE WHEN starts_with(tipo, 'RUT') THEN tipo || ' ' || r || '-' || coalesce(nullif(v, ''), '?') WHEN starts_with(tipo, 'LEI') THEN tipo || ' ' || l ELSE 'NOMBRE ' || coalesce(nullif(norm, ''), '(vacio)') END AS entidad FROM t),
  f AS (SELECT entidad, n AS usual FROM (SELECT entidad, n, count(*) AS c FROM e GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY entidad ORDER BY c DESC, n) = 1),
  m AS (SELECT norm, count(DISTINCT l) AS leis FROM e WHERE l IS NOT NULL AND r = 0 GROUP BY 1)
  SELECT registro_id, tipo, entidad, usual AS nombre, concat_ws(';', CASE WHEN tipo = 'LEI invalido' THEN 'lei_invalido' END, CASE WHEN tipo = 'RUT invalido' THEN 'rut_invalido' END, CASE WHEN tipo = 'Sin RUT ni LEI' THEN 'sin_identificador' END, CASE WHEN starts_with(tipo, 'LEI') AND leis > 1 THEN 'nombre_con_varios_lei' END) AS alertas
  FROM e JOIN f USING (entidad) LEFT JOIN m USING (norm)""")
def legal_id(s, d):
    """Legal identity of every filed record, by tax id, LEI or name, and what is odd about it."""
    return identity.identified(table(s, d, "cmf_v2024"), ["registro_id"])


# ---------------------------------------------------------------- composites
@query(f"WITH {_SNAP} SELECT periodo, coalesce(contraparte_grupo, 'SIN RESOLVER') AS grupo, CAST(date_trunc('month', fecha_vencimiento) AS DATE) AS mes, {_dsum('nocional_m')} AS monto FROM snap WHERE fecha_vencimiento >= {_END.format('periodo')} AND fecha_vencimiento < {_END.format('periodo')} + INTERVAL 12 MONTH GROUP BY 1, 2, 3")
def roll_off(s, d):
    """What matures within twelve months of each month's close."""
    close = dates.period_end(C("periodo"))
    v = _snap(s, d).where((C("fecha_vencimiento") >= close) & (C("fecha_vencimiento") < F.add_months(close, 12)))
    return v.groupBy("periodo", F.coalesce("contraparte_grupo", F.lit("SIN RESOLVER")).alias("grupo"), dates.bucket(C("fecha_vencimiento"), "month").alias("mes")).agg(exact_sum(C("nocional_m")).alias("monto"))


@query(f"WITH {_SNAP}, e AS (SELECT periodo, contraparte_grupo, {_dsum('nocional_m')} AS monto, count(*) AS n FROM snap GROUP BY 1, 2) SELECT e.*, s.valor AS usd, monto / s.valor / 1000 AS mm_usd FROM e LEFT JOIN serie_cierre s ON s.periodo = e.periodo AND s.serie = 'USD'")
def evolution_monthly(s, d):
    e = _snap(s, d).groupBy("periodo", "contraparte_grupo").agg(exact_sum(C("nocional_m")).alias("monto"), F.count(F.lit(1)).alias("n"))
    usd = small(table(s, d, "serie_cierre").where("serie = 'USD'").select("periodo", C("valor").alias("usd")))
    return e.join(usd, "periodo", "left").withColumn("mm_usd", C("monto") / C("usd") / 1000)


@query(f"SELECT producto, {_dsum('CASE WHEN periodo = 202501 THEN nocional_m ELSE 0 END', 4)} AS \"202501\", {_dsum('CASE WHEN periodo = 202508 THEN nocional_m ELSE 0 END', 4)} AS \"202508\", {_dsum('CASE WHEN periodo = 199901 THEN nocional_m ELSE 0 END', 4)} AS \"199901\", {_dsum('nocional_m', 4)} AS total FROM v_posicion GROUP BY 1")
def comparison_missing_period(s, d):
    sums = [exact_sum(F.when(C("periodo") == p, C("nocional_m")).otherwise(F.lit(0.0)), 4).alias(str(p)) for p in (202501, 202508, 199901)]
    return table(s, d, "v_posicion").groupBy("producto").agg(*sums, exact_sum(C("nocional_m"), 4).alias("total"))


@query("SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS mes, c_mktsegment, n_name, count(*) AS n, " + f"{_dsum('o_totalprice')} AS monto FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3")
def origination(s, d):
    j = table(s, d, "orders").join(table(s, d, "customer"), C("c_custkey") == C("o_custkey")).join(small(table(s, d, "nation")), C("n_nationkey") == C("c_nationkey"), "left")
    return j.groupBy(dates.period_of(C("o_orderdate")).alias("mes"), "c_mktsegment", "n_name").agg(F.count(F.lit(1)).alias("n"), exact_sum(C("o_totalprice")).alias("monto"))


@query(f"WITH {_SNAP} SELECT periodo, CASE WHEN moneda IN ('UF', 'USD', 'EUR') THEN moneda || '/CLP' WHEN moneda = 'CLP' OR moneda = '$$' THEN 'CLP/CLP' WHEN moneda = 'PROM' THEN 'USD/CLP' ELSE 'CLP/' || moneda END AS par, producto, {_dsum('abs(nocional_m)')} AS flujo, count(*) AS n FROM snap WHERE moneda IS NOT NULL AND moneda <> '' GROUP BY ALL")
def currency_flow(s, d):
    """Gross notional of each month by pair of currencies, in canonical order, and product."""
    v = _snap(s, d).withColumn("_c", text.currency(C("moneda"))).where("_c IS NOT NULL")
    return v.groupBy("periodo", text.pair(C("_c"), F.lit("CLP")).alias("par"), "producto").agg(exact_sum(F.abs("nocional_m")).alias("flujo"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_SNAP}, b AS (SELECT periodo, rut_compania, contraparte_grupo, {_dsum('nocional_m')} AS monto FROM snap GROUP BY 1, 2, 3), t AS (SELECT *, CAST(sum(CAST(monto AS DECIMAL(24,4))) OVER (PARTITION BY periodo, rut_compania) AS DOUBLE) AS total FROM b),
  v AS (SELECT periodo, rut_compania, {_dsum('nocional_m')} AS monto FROM snap WHERE fecha_vencimiento <= {_END.format('periodo')} + INTERVAL 3 MONTH GROUP BY 1, 2),
  p AS (SELECT periodo, rut_compania, {_dsum("CASE WHEN producto = 'PACTO' THEN nocional_m ELSE 0 END")} AS pactos, {_dsum('nocional_m')} AS total FROM snap GROUP BY 1, 2),
  u AS (SELECT 'concentracion' AS alerta, periodo, rut_compania, contraparte_grupo AS detalle, 100 * monto / total AS medida, monto / total AS peso FROM t WHERE total > 0 AND monto / total >= 0.1 UNION ALL SELECT 'vencimientos', periodo, rut_compania, NULL, monto, monto / 1e7 FROM v WHERE monto > 1000000
    UNION ALL SELECT 'pactos', periodo, rut_compania, NULL, 100 * pactos / total, pactos / total FROM p WHERE total > 0 AND pactos / total >= 0.05)
  SELECT * EXCLUDE (peso), CASE WHEN peso >= 0.4 THEN 1 WHEN peso >= 0.2 THEN 2 ELSE 3 END AS prioridad FROM u""")
def alerts_union(s, d):
    """Three kinds of alerts of every month, each from its own aggregate, with a priority by weight."""
    v = checkpointed(_snap(s, d))
    key = ["periodo", "rut_compania"]
    none = F.lit(None).cast("string")
    b = v.groupBy(*key, "contraparte_grupo").agg(exact_sum(C("nocional_m")).alias("monto"))
    b = b.withColumn("total", F.sum(C("monto").cast("decimal(24,4)")).over(Window.partitionBy(*key)).cast("double"))
    a = b.where((C("total") > 0) & (C("monto") / C("total") >= 0.1)).select(F.lit("concentracion").alias("alerta"), *key, C("contraparte_grupo").alias("detalle"), (100 * C("monto") / C("total")).alias("medida"), (C("monto") / C("total")).alias("_w"))
    soon = v.where(C("fecha_vencimiento") <= F.add_months(dates.period_end(C("periodo")), 3)).groupBy(*key).agg(exact_sum(C("nocional_m")).alias("medida")).where("medida > 1000000")
    soon = soon.select(F.lit("vencimientos").alias("alerta"), *key, none.alias("detalle"), "medida", (C("medida") / 1e7).alias("_w"))
    p = v.groupBy(*key).agg(exact_sum(F.when(C("producto") == "PACTO", C("nocional_m")).otherwise(F.lit(0.0))).alias("x"), exact_sum(C("nocional_m")).alias("total"))
    p = p.where((C("total") > 0) & (C("x") / C("total") >= 0.05)).select(F.lit("pactos").alias("alerta"), *key, none.alias("detalle"), (100 * C("x") / C("total")).alias("medida"), (C("x") / C("total")).alias("_w"))
    return a.unionByName(soon).unionByName(p).withColumn("prioridad", F.when(C("_w") >= 0.4, 1).when(C("_w") >= 0.2, 2).otherwise(3)).drop("_w")


@query("SELECT ambito, tipo_instrumento, CASE WHEN ambito = 'EXTRANJERO' OR moneda NOT IN ('UF', 'CLP') THEN 'fuera' ELSE 'local' END AS lugar, count(*) AS n FROM (SELECT ambito, tipo_instrumento, upper(trim(moneda)) AS moneda FROM v_renta_fija_clasificada) GROUP BY 1, 2, 3")
def home_foreign(s, d):
    cur = F.upper(F.trim("moneda"))
    where = F.when((C("ambito") == "EXTRANJERO") | ~cur.isin("UF", "CLP"), "fuera").otherwise("local")
    return table(s, d, "v_renta_fija_clasificada").groupBy("ambito", "tipo_instrumento", where.alias("lugar")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT l_returnflag AS rama, CAST(date_trunc('month', l_shipdate) AS DATE) AS mes, {_dsum('l_extendedprice')} AS monto FROM lineitem GROUP BY 1, 2")
def concat_periods(s, d):
    """One scan grouped by month in place of a loop over months."""
    return table(s, d, "lineitem").groupBy(C("l_returnflag").alias("rama"), F.to_date(F.trunc("l_shipdate", "month")).alias("mes")).agg(exact_sum(C("l_extendedprice")).alias("monto"))


# ---------------------------------------------------------------- event windows
@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS desde, CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS hasta, tipo_evento AS tipo, count(*) AS n FROM evento_mesa WHERE ts IS NOT NULL GROUP BY 1, 2, 3")
def event_windows(s, d):
    w = landing.event_windows(table(s, d, "evento_mesa"))
    return w.select(C("desde").cast("timestamp_ntz").alias("desde"), C("hasta").cast("timestamp_ntz").alias("hasta"), "tipo", "n")


_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


@query("SELECT table_name AS tabla, column_name AS columna, CASE data_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _TYPES.items()) + " ELSE lower(data_type) END AS tipo FROM information_schema.columns WHERE table_name IN ('region', 'nation', 'supplier', 'customer', 'part', 'orders', 'fact_derivado', 'v_posicion', 'cmf_v2024')")
def data_dictionary(s, d):
    return files.dictionary(s, {n: table(s, d, n) for n in ("region", "nation", "supplier", "customer", "part", "orders", "fact_derivado", "v_posicion", "cmf_v2024")})