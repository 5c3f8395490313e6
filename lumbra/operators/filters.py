"""Predicates built from selections, and a gate for SQL from users."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbra.functions.text import any_contains


def among(column: str, chosen: Iterable, universe: Iterable) -> Column | None:
    """column IN chosen; no predicate if all are chosen, a false one if none is."""
    chosen, universe = list(chosen), set(universe)
    if not chosen:
        return F.lit(False)
    return None if universe <= set(chosen) else F.col(column).isin(chosen)


def between(column: str, low, high, least, most) -> Column | None:
    """column BETWEEN low AND high; no predicate if that is the whole range."""
    return None if low <= least and high >= most else F.col(column).between(F.lit(low), F.lit(high))


def renamed(predicates: dict, aliases: dict[str, str]) -> dict:
    """Selections under the physical names that a view has for them: (name, chosen, universe) or (name, low, high, least, most) become predicates.

    aliases: name of the filter -> column of the view; a name that isn't in it is the column's."""
    make = {2: among, 4: between}
    return {aliases.get(n, n): make[len(args)](aliases.get(n, n), *args) for n, args in predicates.items()}


@dataclass(frozen=True)
class Spec:
    """A filter that users see: its name, the column of the fact, and its kind: among, between, contains or present."""

    name: str
    column: str
    kind: str = "among"


def _specs(**kinds: str) -> tuple[Spec, ...]:
    """name=column for each kind, as `kind="name:column name:column"`; a name without a column is its own."""
    return tuple(Spec(n, c or n, k) for k, names in kinds.items() for n, _, c in (x.partition(":") for x in names.split()))


#: Filters of each fact.
FACT_FILTERS: dict[str, tuple[Spec, ...]] = {
    "fact_derivado": _specs(
        among="periodo:periodo_informacion compania:rut_compania producto moneda clasificacion:clasificacion_riesgo veredicto codigo:record_type archivo:zip_origen", between="operacion:fecha_operacion vencimiento:fecha_vencimiento descarga:fecha_descarga nocional:nocional_m activo:mtm_activo_m pasivo:mtm_pasivo_m tasa:tasa_precio_contrato",
        contains="contraparte:contraparte_nombre glosa folio:folio_operacion", present="con_folio:folio_operacion con_nocional:nocional_m calificada:clasificacion_riesgo con_descarga:fecha_descarga",
    ),
    "v_renta_fija_clasificada": _specs(
        among="periodo:periodo_informacion compania:rut_compania ambito tipo:tipo_instrumento moneda clasificacion:clasificacion_riesgo unidad:unidad_valor", between="vencimiento:fecha_vencimiento valor:valor_final tir:tir_mercado",
        contains="emisor:emisor_nombre instrumento:instrumento_id glosa", present="con_tir:tir_mercado con_emisor:emisor_rut",
    ),
    "v_posicion": _specs(among="periodo compania:rut_compania producto grupo:contraparte_grupo moneda", between="vencimiento:fecha_vencimiento nocional:nocional_m neto:mtm_neto_m items", contains="contraparte:contraparte_nombre", present="resuelta:contraparte_grupo con_vencimiento:fecha_vencimiento"),
    "fact_flujo": _specs(among="periodo categoria compania:rut_compania producto grupo:contraparte_grupo moneda", between="vencimiento:fecha_vencimiento nocional:nocional_m previo:nocional_prev_m diferencia:dif_rel_nocional", contains="contraparte:contraparte_nombre", present="pareada:folio_par"),
}


def selection(specs: tuple[Spec, ...], chosen: dict) -> tuple[dict[str, Column | None], list[str]]:
    """(predicates by filter, unknown names): chosen has by name the arguments of the filter's kind: (chosen, universe) for among,
    (low, high, least, most) for between, a text for contains (blank: no predicate), true or false for present (null: none)."""
    known = {s.name: s for s in specs}
    out: dict[str, Column | None] = {}
    for name, arg in chosen.items():
        if name not in known:
            continue
        c, kind = known[name].column, known[name].kind
        if kind == "among":
            out[name] = among(c, *arg)
        elif kind == "between":
            out[name] = between(c, *arg)
        elif kind == "contains":
            out[name] = any_contains([c], arg.strip()) if arg and arg.strip() else None
        else:
            out[name] = None if arg is None else F.col(c).isNotNull() if arg else F.col(c).isNull()
    return out, sorted(set(chosen) - set(known))


def selected(df: DataFrame, fact: str, chosen: dict) -> tuple[DataFrame, list[str]]:
    """(rows of a fact that the selections leave, names of those without a filter or a column here)."""
    made, unknown = selection(FACT_FILTERS[fact], chosen)
    columns = {s.name: s.column for s in FACT_FILTERS[fact]}
    live = [p for n, p in made.items() if p is not None and columns[n] in df.columns]
    omitted = sorted([*unknown, *(n for n, p in made.items() if p is not None and columns[n] not in df.columns)])
    return (df.where(reduce(lambda a, b: a & b, live)) if live else df), omitted


def arranged(df: DataFrame, first: Iterable[str], hidden: Iterable[str] = ()) -> DataFrame:
    """df with the columns `first` ahead, as far as it has them, the others behind in their order, those hidden left out."""
    lead = [c for c in first if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead and c not in set(hidden)])


def narrowed(df: DataFrame, predicates: dict[str, Column | None]) -> tuple[DataFrame, list[str]]:
    """(df, omitted): all predicates whose column df has; the others are reported, not applied."""
    held = {c: p for c, p in predicates.items() if p is not None}
    omitted = sorted(c for c in held if c not in df.columns)
    live = [p for c, p in held.items() if c in df.columns]
    return (df.where(reduce(lambda a, b: a & b, live)) if live else df), omitted


# Logical operators that a query may have, and groups of functions that neither read files nor run code of others.
_OPERATORS = frozenset(
    "Project Filter Aggregate Join Sort GlobalLimit LocalLimit Offset Distinct SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedWith UnresolvedHaving UnresolvedRelation "
    "Union Except Intersect WithWindowDefinition OneRowRelation LocalRelation UnresolvedInlineTable Generate Pivot Unpivot LateralJoin".split()
)
_FUNCTION_GROUPS = frozenset(
    f"{g}_funcs" for g in "math agg generator datetime array string map predicate bitwise window json conversion lambda conditional url hash struct collection".split()
)


def _each(seq) -> list:
    out, it = [], seq.iterator()
    while it.hasNext():
        out.append(it.next())
    return out


def gated(spark: SparkSession, sql: str, allowed: set[str]) -> DataFrame:
    """Result of one query that reads only allowed tables and calls only built-in functions of harmless groups.

    The parsed plan is walked, subqueries and common table expressions included, before anything is resolved: an operator
    or function that isn't listed, a path read as a table, a script, or a name that is neither allowed nor a common table
    expression in scope raises ValueError, as text that doesn't parse as one statement does."""
    state = spark._jsparkSession.sessionState()
    registry, ident = state.functionRegistry(), spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
    allowed = {a.lower() for a in allowed}

    def refuse(what: str) -> None:
        raise ValueError(f"not allowed: {what}")

    def expression(e) -> None:
        if e.getClass().getSimpleName() == "UnresolvedFunction":
            name = e.nameParts().mkString(".").lower()
            known = registry.lookupFunction(ident(name)) if e.nameParts().size() == 1 else None
            if known is None or known.isEmpty() or known.get().getSource() != "built-in" or known.get().getGroup() not in _FUNCTION_GROUPS:
                refuse(f"function {name}")
        for c in _each(e.children()):
            expression(c)

    def operator(p, scope: frozenset) -> None:
        kind = p.getClass().getSimpleName()
        if kind not in _OPERATORS:
            refuse(kind)
        if kind == "UnresolvedRelation":
            name = p.multipartIdentifier().mkString(".").lower()
            if p.multipartIdentifier().size() != 1 or name not in allowed | scope:
                refuse(f"table {name}")
        for e in _each(p.expressions()):
            expression(e)
        for q in _each(p.innerChildren()):  # common table expressions see those before them, subqueries what their query sees
            operator(q, scope)
            if kind == "UnresolvedWith":
                scope = scope | {q.alias().lower()}
        for q in _each(p.children()):
            operator(q, scope)

    try:
        plan = state.sqlParser().parsePlan(sql)
    except Exception as e:  # the parser's own kinds of errors come from the JVM
        raise ValueError("not one query") from e
    operator(plan, frozenset())
    return spark.sql(sql)
