"""Ad-hoc SQL over layers: guarded statements, modes, caps, dry runs."""

from __future__ import annotations

import re

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

from marblework.operators.joins import column_rows
from marblework.operators.profile import column_kinds
from marblework.operators.rollup import answer, capped, unpivoted

#: The nodes of a parsed plan that a read is made of; any other refuses the statement.
NODES = {
    "Project", "Filter", "Aggregate", "Join", "LateralJoin", "SubqueryAlias", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Distinct", "Union", "Intersect", "Except",
    "UnresolvedRelation", "UnresolvedWith", "UnresolvedHaving", "UnresolvedSubqueryColumnAliases", "UnresolvedInlineTable", "ResolvedInlineTable", "OneRowRelation",
    "LocalRelation", "Generate", "WithWindowDefinition", "Window", "Pivot", "Unpivot", "UnresolvedHint", "Sample", "RepartitionByExpression", "Deduplicate",
}
#: What the parser leaves open in expressions of a read; any other unresolved one refuses the statement.
OPEN_EXPRESSIONS = {
    "UnresolvedAttribute", "UnresolvedStar", "UnresolvedStarExceptOrReplace", "UnresolvedRegex", "UnresolvedAlias", "MultiAlias", "UnresolvedFunction", "UnresolvedGenerator",
    "UnresolvedExtractValue", "UnresolvedOrdinal", "UnresolvedNamedLambdaVariable", "UnresolvedWindowExpression",
}
#: Groups of Spark's built-in functions that only compute from their arguments, and single ones of other groups.
FUNCTION_GROUPS = {
    "agg_funcs", "array_funcs", "bitwise_funcs", "collection_funcs", "conditional_funcs", "conversion_funcs", "csv_funcs", "date_funcs", "datetime_funcs", "generator_funcs", "hash_funcs",
    "json_funcs", "lambda_funcs", "map_funcs", "math_funcs", "operator_funcs", "predicate_funcs", "string_funcs", "struct_funcs", "url_funcs", "window_funcs", "xml_funcs",
}
FUNCTIONS = {"typeof", "equal_null", "nullifzero", "zeroifnull", "monotonically_increasing_id"}
LAYERS, MODES = ("raw", "clean", "mart"), ("schema", "preview", "profile", "sql")
MAX_ROWS, EXCERPT = 500, 300


def _walk(spark: SparkSession, tree: JavaObject):
    """Every node and expression of a parsed plan, wherever it stands: in lists, options, pairs or maps of another."""
    gateway = spark.sparkContext._gateway
    is_a = lambda x, name: is_instance_of(gateway, x, name)
    work = [tree]
    while work:
        x = work.pop()
        if not isinstance(x, JavaObject):
            continue
        if is_a(x, "org.apache.spark.sql.types.DataType"):
            continue
        if is_a(x, "org.apache.spark.sql.catalyst.trees.TreeNode"):
            yield x
        if is_a(x, "scala.collection.Iterable"):
            items = x.iterator()
        elif is_a(x, "scala.Product"):
            items = x.productIterator()
        else:
            continue
        while items.hasNext():
            work.append(items.next())


def _function_group(spark: SparkSession, name: str) -> str | None:
    """The group of a built-in function; null for functions that a session or a catalog adds or replaces."""
    jvm = spark._jvm
    identifier = jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name)
    analysis = getattr(jvm.org.apache.spark.sql.catalyst.analysis, "FunctionRegistry$")
    builtin = getattr(analysis, "MODULE$").builtin().lookupFunction(identifier)
    here = spark._jsparkSession.sessionState().functionRegistry().lookupFunction(identifier)
    if builtin.isEmpty() or here.isEmpty() or builtin.get().getClassName() != here.get().getClassName():
        return None
    return builtin.get().getGroup()


def check(spark: SparkSession, sql: str, names: set[str]) -> str:
    """The statement without a closing semicolon; an error unless it is one read over the given names.

    Spark parses it, and the parsed plan is walked, not the text: each of its nodes
    must belong to a read, each function, however it is quoted, must be a built-in
    one that only computes, and each relation must be declared or be a common table
    that hides nothing.
    """
    sql = sql.strip().rstrip(";").strip()
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:
        if isinstance(e, ParseException) or "ParseException" in str(e):
            raise ValueError(f"no valid SQL: {str(e).strip().splitlines()[0] if str(e).strip() else sql[:60]}") from e
        raise
    asked, own, called = set(), set(), set()
    for x in _walk(spark, plan):
        kind = x.getClass().getSimpleName().rstrip("$")
        if is_instance_of(spark.sparkContext._gateway, x, "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan"):
            if kind not in NODES:
                raise ValueError(f"not allowed: {kind}")
            if kind == "UnresolvedRelation":
                asked.add(x.multipartIdentifier().mkString(".").lower())
            elif kind == "UnresolvedWith":
                relations = x.cteRelations().iterator()
                while relations.hasNext():
                    own.add(relations.next()._1().lower())
        elif x.getClass().getPackage().getName().endswith("catalyst.analysis"):
            if kind not in OPEN_EXPRESSIONS:
                raise ValueError(f"not allowed: {kind}")
            if kind == "UnresolvedFunction":
                called.add(x.nameParts().mkString(".").lower())
            elif kind == "UnresolvedGenerator":
                called.add(x.name().unquotedString().lower())
    if refused := sorted(f for f in called if f not in FUNCTIONS and _function_group(spark, f) not in FUNCTION_GROUPS):
        raise ValueError(f"functions not allowed: {refused}")
    declared = {n.lower() for n in names}
    if unknown := asked - own - declared:
        raise ValueError(f"not declared: {sorted(unknown)}")
    if hiding := {n for n in asked & own - declared if not re.fullmatch(r"\w+", n) or spark.catalog.tableExists(n)}:
        raise ValueError(f"a common table hides a table: {sorted(hiding)}")
    return sql


def guarded(spark: SparkSession, sql: str, frames: dict[str, DataFrame]) -> DataFrame:
    """A read over declared DataFrames and nothing else.

    The DataFrames are temporary views while Spark binds the statement; views of
    the same names are put back afterwards.
    """
    sql = check(spark, sql, set(frames))
    before = {name: spark.table(name) for name in frames if name in {t.name for t in spark.catalog.listTables() if t.isTemporary}}
    try:
        for name, df in frames.items():
            df.createOrReplaceTempView(name)
        return spark.sql(sql)
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)


def layer_query(spark: SparkSession, frames: dict[str, DataFrame], sql: str, limit: int = 20) -> tuple[DataFrame, DataFrame]:
    """(rows, truncated): at most ``limit`` and MAX_ROWS rows; the cap is part of the plan."""
    return capped(guarded(spark, sql, frames), min(limit or MAX_ROWS, MAX_ROWS))


def layer_answer(spark: SparkSession, frames: dict[str, DataFrame], sql: str, limit: int = 20) -> dict:
    """{"columns", "rows", "total_count", "truncated"} of a guarded statement, from one job; at most MAX_ROWS rows come."""
    df = guarded(spark, sql, frames)
    return {"columns": df.columns, **answer(df, min(limit or MAX_ROWS, MAX_ROWS))}


def pick(layers: dict[str, dict[tuple[int, str], DataFrame]], layer: str, year: int | None = None, table: str | None = None) -> DataFrame:
    """A layer's table: that of the year (the last one if none is named) and of the name (the first by name)."""
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}, not {layer}")
    found = {k: df for k, df in layers.get(layer, {}).items() if year in (None, k[0]) and table in (None, k[1])}
    if not found:
        raise ValueError(f"no {layer} for year {year} and table {table}")
    return found[min(found, key=lambda k: (-k[0], k[1]))]


def ask(spark: SparkSession, layers: dict[str, dict[tuple[int, str], DataFrame]], layer: str = "clean", mode: str = "schema", year: int | None = None, table: str | None = None, sql: str | None = None, limit: int = 20) -> DataFrame:
    """Any question about a layer: its schema, its first rows, its columns' profile (raw only), or SQL over it as ``data``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode}")
    if mode == "profile" and layer != "raw":
        raise ValueError("profile is for the raw layer")
    df = pick(layers, layer, year, table)
    if mode == "schema":
        return column_rows(df)
    if mode == "preview":
        return capped(df, min(limit or MAX_ROWS, MAX_ROWS))[0]
    if mode == "profile":
        return column_kinds(unpivoted(df, df.columns, "n"))
    if not sql:
        raise ValueError("mode sql needs a statement")
    return layer_query(spark, {"data": df}, sql, limit)[0]


def dry_run(spark: SparkSession, frames: dict[str, DataFrame], sql: str) -> dict:
    """{"ok", "schema", "plan" (an excerpt), "error"} of a statement that is bound and not run; frames may be empty ones."""
    try:
        df = guarded(spark, sql, frames)
    except (ValueError, AnalysisException) as e:
        return {"ok": False, "schema": [], "plan": None, "error": str(e).split("\n")[0]}
    return {"ok": True, "schema": [(f.name, f.dataType.simpleString()) for f in df.schema], "plan": df._jdf.queryExecution().optimizedPlan().treeString()[:EXCERPT], "error": None}
