"""Further portfolio queries: measures, labels, ordering, rules and reconciliation, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbra.functions import dates, identifiers, labels, numbers
from lumbra.functions.numbers import exact_sum
from lumbra.operators import filters, ranking, reconcile, rules
from lumbra.session import small, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
C = F.col


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _dsum(x: str, scale: int = 4) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(24,{scale}))) AS DOUBLE)"


@query(f"SELECT rut_compania, {_dsum('coalesce(mtm_activo_m, 0) + coalesce(mtm_pasivo_m, 0)', 4)} AS total FROM fact_derivado GROUP BY 1")
def declared_total(s, d):
    return table(s, d, "fact_derivado").groupBy("rut_compania").agg(exact_sum(F.coalesce("mtm_activo_m", F.lit(0.0)) + F.coalesce("mtm_pasivo_m", F.lit(0.0)), 4).alias("total"))


@query(f"SELECT rut_compania, {_dsum('''CASE WHEN producto = 'SWAP' THEN nocional_m ELSE 0 END''', 4)} AS \"SWAP\", {_dsum('''CASE WHEN producto = 'FORWARD' THEN nocional_m ELSE 0 END''', 4)} AS \"FORWARD\", {_dsum('''CASE WHEN producto <> 'PACTO' THEN nocional_m ELSE 0 END''', 4)} AS total_sin_pactos, count(DISTINCT folio_operacion) AS operaciones, {_dsum('coalesce(mtm_activo_m, 0) - coalesce(mtm_pasivo_m, 0)', 4)} AS mtm FROM fact_derivado GROUP BY 1")
def notional_by_family(s, d):
    part = lambda keep: exact_sum(F.when(keep, C("nocional_m")).otherwise(F.lit(0.0)), 4)
    mtm = exact_sum(F.coalesce("mtm_activo_m", F.lit(0.0)) - F.coalesce("mtm_pasivo_m", F.lit(0.0)), 4)
    return table(s, d, "fact_derivado").groupBy("rut_compania").agg(*[part(C("producto") == p).alias(p) for p in ("SWAP", "FORWARD")], part(C("producto") != "PACTO").alias("total_sin_pactos"), F.count_distinct("folio_operacion").alias("operaciones"), mtm.alias("mtm"))


@query("SELECT periodo, count(DISTINCT rut_compania) AS companias, count(DISTINCT upper(trim(contraparte_key))) AS contrapartes FROM v_posicion GROUP BY 1")
def distinct_counterparties(s, d):
    return table(s, d, "v_posicion").groupBy("periodo").agg(F.count_distinct("rut_compania").alias("companias"), F.count_distinct(F.upper(F.trim("contraparte_key"))).alias("contrapartes"))


@query("SELECT contraparte_key, max(struct_pack(p := periodo, n := contraparte_nombre)).n AS nombre, min(struct_pack(p := periodo, n := contraparte_nombre)).n AS primero FROM v_posicion GROUP BY 1")
def latest_name_per_entity(s, d):
    r = F.struct("periodo", "contraparte_nombre")
    return table(s, d, "v_posicion").groupBy("contraparte_key").agg(F.max(r)["contraparte_nombre"].alias("nombre"), F.min(r)["contraparte_nombre"].alias("primero"))


@query("WITH t AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice * (1 - l_discount) AS neto FROM lineitem) SELECT l_orderkey, l_linenumber, l_suppkey, neto, neto > 50000 AS grande FROM t")
def cte_reuse(s, d):
    t = table(s, d, "lineitem").withColumn("neto", C("l_extendedprice") * (1 - C("l_discount")))
    return t.select("l_orderkey", "l_linenumber", "l_suppkey", "neto", (C("neto") > 50000).alias("grande"))


@query("SELECT columna, filas, CASE WHEN filas = 0 THEN 'ninguna' WHEN columna IN ('nocional_m', 'mtm_activo_m') THEN 'suma' ELSE 'conteo' END AS agregacion FROM (UNPIVOT (SELECT count(nocional_m) AS nocional_m, count(mtm_activo_m) AS mtm_activo_m, count(moneda) AS moneda, count(glosa) AS glosa FROM fact_derivado) ON COLUMNS(*) INTO NAME columna VALUE filas)")
def chart_catalog(s, d):
    """Which aggregations are legal for which columns that hold anything; one pass over the table."""
    cols = ["nocional_m", "mtm_activo_m", "moneda", "glosa"]
    one = table(s, d, "fact_derivado").agg(*[F.count(c).alias(c) for c in cols])
    long = one.unpivot([], cols, "columna", "filas")
    return long.withColumn("agregacion", F.when(C("filas") == 0, "ninguna").when(C("columna").isin("nocional_m", "mtm_activo_m"), "suma").otherwise("conteo"))


@query("SELECT rut_compania, nombre, regexp_replace(regexp_replace(nombre, ' S\\.A\\.$', ''), '^(Compañía de )?Seguros (de Vida|Generales) ', '') AS corto FROM dim_compania")
def display_names(s, d):
    return table(s, d, "dim_compania").select("rut_compania", "nombre", F.regexp_replace(F.regexp_replace("nombre", " S\\.A\\.$", ""), "^(Compañía de )?Seguros (de Vida|Generales) ", "").alias("corto"))


@query("SELECT rut_compania, dv, CAST(x AS VARCHAR) AS esperado FROM (SELECT rut_compania, dv, CASE y WHEN 11 THEN '0' WHEN 10 THEN 'K' ELSE CAST(y AS VARCHAR) END AS x FROM (SELECT *, 11 - list_sum(list_transform(range(0, length(CAST(rut_compania AS VARCHAR))), lambda i: CAST(reverse(CAST(rut_compania AS VARCHAR))[i + 1] AS INT) * (2 + i % 6))) % 11 AS y FROM dim_compania))")
def company_digit(s, d):
    return table(s, d, "dim_compania").select("rut_compania", "dv", identifiers.mod11_digit(C("rut_compania")).alias("esperado"))


@query("SELECT DISTINCT record_type, CASE record_type WHEN '2' THEN 'opcion' WHEN '3' THEN 'forward' WHEN '4' THEN 'futuro' WHEN '5' THEN 'swap' WHEN '6' THEN 'pacto' END AS instrumento FROM fact_derivado")
def code_map(s, d):
    m = F.create_map(*[F.lit(x) for kv in {"2": "opcion", "3": "forward", "4": "futuro", "5": "swap", "6": "pacto"}.items() for x in kv])
    return table(s, d, "fact_derivado").select("record_type").distinct().select("record_type", F.try_element_at(m, F.ltrim(F.trim("record_type"), F.lit("0"))).alias("instrumento"))


@query("SELECT doc_id, regexp_matches(upper(text), 'EFEC|CASH|DEPO|DINER') AS efectivo FROM documents")
def cash_class(s, d):
    return table(s, d, "documents").select("doc_id", F.upper("text").rlike("EFEC|CASH|DEPO|DINER").alias("efectivo"))


@query("SELECT DISTINCT zip_origen, source_file, line_no, coalesce(mtm_activo_m, 0) - coalesce(mtm_pasivo_m, 0) AS neto, nocional_m / 1000 AS mm, (tasa_precio_contrato - 4) * 100 AS spread_pb FROM fact_derivado")
def measures(s, d):
    return table(s, d, "fact_derivado").select("zip_origen", "source_file", "line_no", (F.coalesce("mtm_activo_m", F.lit(0.0)) - F.coalesce("mtm_pasivo_m", F.lit(0.0))).alias("neto"), (C("nocional_m") / 1000).alias("mm"), ((C("tasa_precio_contrato") - 4) * 100).alias("spread_pb")).distinct()


@query(f"SELECT o_orderpriority, o_orderstatus, {_dsum('o_totalprice')} AS monto, CAST(sum(sum(CAST(o_totalprice AS DECIMAL(20,2)))) OVER (PARTITION BY o_orderpriority) AS DOUBLE) AS fila, CAST(sum(sum(CAST(o_totalprice AS DECIMAL(20,2)))) OVER (PARTITION BY o_orderstatus) AS DOUBLE) AS columna FROM orders GROUP BY 1, 2")
def margins(s, d):
    g = table(s, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(exact_sum(C("o_totalprice")).alias("monto"))
    total = lambda c: F.sum(C("monto").cast("decimal(20,2)")).over(Window.partitionBy(c)).cast("double")
    return g.withColumn("fila", total("o_orderpriority")).withColumn("columna", total("o_orderstatus")).orderBy(F.desc("fila"), F.desc("columna"))


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 20")
def order_by_magnitude(s, d):
    return table(s, d, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc(F.abs("c_acctbal")), "c_custkey").limit(20)


@query("SELECT count(*) AS mostradas, (SELECT count(*) FROM customer) > 100 AS tope FROM (SELECT * FROM customer LIMIT 100)")
def limit_cap(s, d):
    """The number of rows shown under a cap of 100, and whether the cap was reached: one row more than the cap tells."""
    n = table(s, d, "customer").limit(101).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.least("n", F.lit(100).cast("bigint")).alias("mostradas"), (C("n") > 100).alias("tope"))


@query(f"WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, {_dsum('o_totalprice')} AS v FROM orders GROUP BY 1) SELECT mes, v, v - lag(v) OVER (ORDER BY mes) AS cambio, exp(sum(ln(v / 1e6)) OVER (ORDER BY mes ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) AS producto FROM m")
def lag_and_product(s, d):
    m = table(s, d, "orders").groupBy(F.to_date(F.trunc("o_orderdate", "month")).alias("mes")).agg(exact_sum(C("o_totalprice")).alias("v"))
    w = Window.partitionBy(F.lit(1)).orderBy("mes")  # one row a month
    return m.withColumn("cambio", C("v") - F.lag("v").over(w)).withColumn("producto", F.product(C("v") / 1e6).over(w.rowsBetween(-2, 0)))


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) * 100 + month(o_orderdate) BETWEEN (SELECT min(year(o_orderdate) * 100 + month(o_orderdate)) + 1 FROM orders) AND 199612")
def window_filter(s, d):
    o = table(s, d, "orders").withColumn("p", dates.period_of(C("o_orderdate")))
    first = o.agg((F.min("p") + 1).alias("desde"))
    return o.join(F.broadcast(first), C("p").between(C("desde"), F.lit(199612))).select("o_orderkey")  # one row


@query("SELECT DISTINCT zip_origen, source_file, line_no, CASE WHEN abs(plazo - meses) <= 1 THEN 'pass' WHEN abs(plazo - meses) > 1 THEN 'quarantine' ELSE 'unverified' END AS veredicto FROM (SELECT *, CAST(floor(date_diff('day', fecha_operacion, fecha_vencimiento) / 30.4375) AS DOUBLE) AS plazo, (year(fecha_vencimiento) - year(fecha_operacion)) * 12 + month(fecha_vencimiento) - month(fecha_operacion) AS meses FROM fact_derivado)")
def rule_tenor(s, d):
    f = table(s, d, "fact_derivado").select("zip_origen", "source_file", "line_no", "fecha_operacion", "fecha_vencimiento").distinct()
    declared = F.floor(F.datediff("fecha_vencimiento", "fecha_operacion") / 30.4375)
    c = rules.check("plazo", F.lit(True), dates.months_apart(C("fecha_operacion"), C("fecha_vencimiento")), declared, absolute=1.0)
    return rules.judged(f, [c]).select("zip_origen", "source_file", "line_no", "veredicto")


@query("SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN p_retailprice IS NULL OR l_extendedprice = 0 OR l_quantity < 5 THEN 'unverified' WHEN abs(l_extendedprice / l_quantity - p_retailprice) <= abs(p_retailprice) * 0.25 THEN 'pass' ELSE 'quarantine' END AS veredicto FROM lineitem LEFT JOIN part ON p_partkey = l_partkey")
def rule_unit_price(s, d):
    """The price that a line implies against the listed one; fewer than five units decide nothing."""
    j = table(s, d, "lineitem").join(table(s, d, "part").select("p_partkey", "p_retailprice"), C("p_partkey") == C("l_partkey"), "left")
    c = rules.unit_price("precio", F.lit(True), C("l_extendedprice"), C("l_quantity"), C("p_retailprice"), relative=0.25, least=5.0)
    return rules.judged(j, [c]).select("l_orderkey", "l_linenumber", "l_suppkey", "veredicto")


@query("SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_returnflag = 'N' THEN CASE WHEN l_extendedprice <= least(l_quantity * 2000, l_quantity * 1500) + 1 THEN 'pass' ELSE 'quarantine' END ELSE CASE WHEN abs(l_extendedprice - least(l_quantity * 2000, l_quantity * 1500)) <= 1 THEN 'pass' ELSE 'quarantine' END END AS veredicto FROM lineitem")
def rule_least_of_two(s, d):
    """Owned: the lesser of two appraisals within 1; leased: at most that and 1."""
    li = table(s, d, "lineitem")
    least = F.least(C("l_quantity") * 2000, C("l_quantity") * 1500)
    own = rules.check("propio", C("l_returnflag") != "N", least, C("l_extendedprice"), absolute=1.0)
    over = F.greatest(C("l_extendedprice") - least, F.lit(0.0))
    leased = rules.check("leasing", C("l_returnflag") == "N", F.lit(0.0), over, absolute=1.0)
    return rules.judged(li, [own, leased]).select("l_orderkey", "l_linenumber", "l_suppkey", "veredicto")


_CLASS = "CASE WHEN tipo_instrumento LIKE 'BE%' THEN 'empresa' WHEN tipo_instrumento LIKE 'BB%' OR tipo_instrumento LIKE 'BS%' OR tipo_instrumento LIKE 'BU%' THEN 'banco' WHEN tipo_instrumento LIKE 'BT%' OR tipo_instrumento LIKE 'BR%' THEN 'estado' WHEN tipo_instrumento LIKE 'D%' THEN 'deposito' WHEN tipo_instrumento LIKE 'LH%' THEN 'hipotecaria' ELSE 'otro' END"
_CLASSES = {"BE": "empresa", "BB": "banco", "BS": "banco", "BU": "banco", "BT": "estado", "BR": "estado", "D": "deposito", "LH": "hipotecaria"}


@query(f"SELECT periodo_informacion AS periodo, rut_compania, clase, tipo_instrumento, instrumento_id, valor_final, emisor_nombre FROM (SELECT DISTINCT *, {_CLASS} AS clase FROM v_renta_fija_clasificada) QUALIFY row_number() OVER (PARTITION BY periodo_informacion, rut_compania, clase ORDER BY valor_final DESC NULLS LAST, instrumento_id, zip_origen, source_file, line_no) <= 3")
def class_detail(s, d):
    """The three largest lines of each company, period and class. Only the best three of a task's rows of a group are shuffled."""
    b = table(s, d, "v_renta_fija_clasificada").distinct().withColumn("clase", labels.prefix_class(C("tipo_instrumento"), _CLASSES, "otro"))
    w = Window.partitionBy("periodo_informacion", "rut_compania", "clase").orderBy(F.desc_nulls_last("valor_final"), "instrumento_id", "zip_origen", "source_file", "line_no")
    return b.withColumn("_r", F.row_number().over(w)).where("_r <= 3").select(C("periodo_informacion").alias("periodo"), "rut_compania", "clase", "tipo_instrumento", "instrumento_id", "valor_final", "emisor_nombre")


@query("SELECT DISTINCT zip_origen, source_file, line_no, CASE WHEN moneda IS NULL THEN NULL WHEN upper(trim(moneda)) IN ('CLP', '$$') THEN 'VENTA' ELSE 'COMPRA' END AS direccion FROM fact_derivado WHERE producto = 'FORWARD'")
def ops_direction(s, d):
    cur = F.upper(F.trim("moneda"))
    way = F.when(cur.isin("CLP", "$$"), "VENTA").when(cur.isNotNull(), "COMPRA")
    return table(s, d, "fact_derivado").where("producto = 'FORWARD'").select("zip_origen", "source_file", "line_no", way.alias("direccion")).distinct()


@query("WITH a AS (SELECT o_orderkey AS x, o_custkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders), b AS (SELECT o_orderkey AS y, o_custkey AS k, CAST(o_orderdate + INTERVAL 2 DAY AS DATE) AS d FROM orders WHERE o_orderkey % 5 <> 0), c AS (SELECT x, y, CAST(abs(date_diff('day', a.d, b.d)) AS INT) AS dias FROM a JOIN b USING (k) WHERE abs(date_diff('day', a.d, b.d)) <= 3) SELECT x, y, dias, x = y AS misma FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY dias, y) AS r, row_number() OVER (PARTITION BY y ORDER BY dias, x) AS q FROM c) WHERE r = 1 AND q = 1")
def book_reconciliation(s, d):
    o = table(s, d, "orders")
    a = o.select(C("o_orderkey").alias("x"), C("o_custkey").alias("k"), C("o_orderdate").alias("da"))
    b = o.where("o_orderkey % 5 <> 0").select(C("o_orderkey").alias("y"), C("o_custkey").alias("k"), F.date_add("o_orderdate", 2).alias("db"))
    return reconcile.one_to_one(a, b, ["k"], "x", "y", "da", "db", 3).withColumn("misma", C("x") == C("y"))


@query("SELECT l_orderkey, CASE WHEN m <= 2 THEN 'Cautivo' WHEN m <= 5 THEN 'Selectivo' ELSE 'Multibanco' END AS apertura, m FROM (SELECT l_orderkey, count(DISTINCT l_suppkey) AS m FROM lineitem GROUP BY 1)")
def segment_labels(s, d):
    g = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("m"))
    return g.withColumn("apertura", labels.band(C("m"), ((2, "Cautivo"), (5, "Selectivo"), (None, "Multibanco")), "right"))


@query("SELECT evento_id, tipo_evento, ts FROM evento_mesa WHERE ts IS NOT NULL ORDER BY ts DESC, evento_id LIMIT 15")
def topn_alerts(s, d):
    return table(s, d, "evento_mesa").where("ts IS NOT NULL").select("evento_id", "tipo_evento", "ts").orderBy(F.desc("ts"), "evento_id").limit(15)


@query("SELECT folio_operacion, TRY_CAST(trim(folio_operacion) AS DOUBLE) AS numero FROM (SELECT DISTINCT folio_operacion FROM v_posicion)")
def num_tolerant(s, d):
    return table(s, d, "v_posicion").select("folio_operacion").distinct().select("folio_operacion", numbers.tolerant(C("folio_operacion")).alias("numero"))


@query("SELECT rut_compania, pos, periodo FROM (SELECT rut_compania, periodo, row_number() OVER (PARTITION BY rut_compania ORDER BY periodo) AS pos FROM (SELECT DISTINCT rut_compania, periodo FROM v_posicion)) WHERE pos IN (1, 2)")
def first_two_deliveries(s, d):
    w = Window.partitionBy("rut_compania").orderBy("periodo")
    return table(s, d, "v_posicion").select("rut_compania", "periodo").distinct().withColumn("pos", F.row_number().over(w).cast("bigint")).where("pos <= 2")


@query(f"SELECT periodo, moneda, {_dsum('nocional_m', 4)} AS monto FROM (SELECT periodo, upper(trim(moneda)) AS moneda, nocional_m FROM v_posicion) GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY periodo ORDER BY monto DESC NULLS LAST, moneda) <= 3")
def top_currencies(s, d):
    """The three currencies of most notional of each month."""
    g = table(s, d, "v_posicion").groupBy("periodo", F.upper(F.trim("moneda")).alias("moneda")).agg(exact_sum(C("nocional_m"), 4).alias("monto"))
    w = Window.partitionBy("periodo").orderBy(F.desc_nulls_last("monto"), F.asc_nulls_last("moneda"))
    return g.withColumn("_r", F.row_number().over(w)).where("_r <= 3").drop("_r")


@query("SELECT o_orderkey FROM orders WHERE false")
def nothing_chosen(s, d):
    return filters.narrowed(table(s, d, "orders"), {"o_orderstatus": filters.among("o_orderstatus", [], ["F"])})[0].select("o_orderkey")


@query(f"SELECT s_nationkey, clave, valor, CAST(puesto AS INT) AS puesto FROM (SELECT s_nationkey, CAST(s_suppkey AS VARCHAR) AS clave, s_acctbal AS valor, CASE WHEN s_acctbal > 0 THEN row_number() OVER (PARTITION BY s_nationkey ORDER BY CASE WHEN s_acctbal > 0 THEN s_acctbal END DESC NULLS LAST, CAST(s_suppkey AS VARCHAR)) END AS puesto FROM supplier)")
def positive_rank(s, d):
    g = table(s, d, "supplier").select("s_nationkey", C("s_suppkey").cast("string").alias("clave"), C("s_acctbal").alias("valor"))
    return ranking.positive_rank(g, "valor", "clave", ["s_nationkey"])


@query("SELECT s_suppkey, n_name FROM (SELECT s_suppkey, s_acctbal, coalesce(n_name, 'UNRESOLVED::' || s_nationkey) AS n_name FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) ON n_nationkey = s_nationkey) WHERE n_name NOT LIKE 'UNRESOLVED::%' AND s_acctbal >= 0")
def resolved_only(s, d):
    """Rows whose entity was resolved; the nations of one region are left unresolved here."""
    j = table(s, d, "supplier").join(small(table(s, d, "nation").where("n_regionkey <> 0")), C("n_nationkey") == C("s_nationkey"), "left")
    named = j.withColumn("n_name", F.coalesce("n_name", F.concat(F.lit("UNRESOLVED::"), C("s_nationkey").cast("string"))))
    return named.where(~C("n_name").startswith("UNRESOLVED::") & (C("s_acctbal") >= 0)).select("s_suppkey", "n_name")