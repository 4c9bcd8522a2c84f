"""Read-only SQL over the published views.

A text passes two gates before anything runs. The parsed text may hold query nodes only, name
the views and its own common table expressions only, and call built-in functions only.
After Spark has resolved the names, every relation must be one of the views and every
expression one of Spark's own, without those that call methods or user code. What is
checked are nodes of a plan, so comments, quotes and line breaks hide nothing.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from yearbook.errors import YearbookError
from yearbook.sources.schemas import VIEWS

_DESCRIBE = re.compile(r"\s*desc(?:ribe)?\s+(?:table\s+)?([A-Za-z_][A-Za-z_0-9]*)\s*;?\s*", re.IGNORECASE)

_CATALYST = "org.apache.spark.sql.catalyst."
# What does something, or hides what it does, anywhere in a parsed text.
_KINDS = (f"{_CATALYST}plans.logical.Command", f"{_CATALYST}plans.logical.ParsedStatement")
_NAMES = re.compile(r"Insert|Command|ExecuteImmediate|CompoundBody|Script|Create|Drop|Merge|Update|Delete|Call$|UnresolvedIdentifier")
# Built-in functions that run any Java method, and the expressions behind them and behind user code.
_METHODS = {"reflect", "java_method", "try_reflect"}
_FOREIGN = re.compile(r"Reflect|UDF|UDAF|UDTF|UserDefined|Aggregator|External")
# Table functions that make rows from their arguments.
_ROW_MAKERS = {
    "range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack", "json_tuple",
    "variant_explode", "variant_explode_outer",
}
# Leaves of a resolved plan that read nothing.
_OWN_ROWS = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef"}


def _items(sequence: JavaObject) -> Iterator:
    for i in range(sequence.size()):
        yield sequence.apply(i)


def _below(node: JavaObject) -> Iterator[JavaObject]:
    """The inputs of a plan node, its common table expressions and its subqueries."""
    yield from _items(node.children())
    yield from _items(node.innerChildren())


def _plans(node: JavaObject) -> Iterator[JavaObject]:
    """The nodes of a plan."""
    yield node
    for child in _below(node):
        yield from _plans(child)


def _expressions(node: JavaObject) -> Iterator[JavaObject]:
    """The expressions of a plan node, and what they are made of."""

    def of(expression: JavaObject) -> Iterator[JavaObject]:
        yield expression
        for child in _items(expression.children()):
            yield from of(child)

    for expression in _items(node.expressions()):
        yield from of(expression)


def _kind(node: JavaObject) -> str:
    return node.getClass().getSimpleName().rstrip("$")


@functools.cache
def _built_in(spark: SparkSession) -> frozenset[str]:
    registry = spark._jvm.org.apache.spark.sql.catalyst.analysis.FunctionRegistry.functionSet()
    return frozenset(f.funcName().lower() for f in _items(registry.toSeq())) - _METHODS


def _check_parsed(spark: SparkSession, root: JavaObject, refusal: YearbookError) -> None:
    kinds = [spark._jvm.java.lang.Class.forName(k) for k in _KINDS]
    nodes = list(_plans(root))
    known = {v.lower() for v in VIEWS}
    for node in nodes:
        if any(k.isInstance(node) for k in kinds) or _NAMES.search(_kind(node)):
            raise refusal
        if _kind(node) == "UnresolvedWith":
            known |= {child.alias().lower() for child in _items(node.innerChildren()) if _kind(child) == "SubqueryAlias"}
    for node in nodes:
        if _kind(node) == "UnresolvedRelation":
            parts = [p.lower() for p in _items(node.multipartIdentifier())]
            if len(parts) != 1 or parts[0] not in known:
                raise YearbookError(f"not one of the views: {'.'.join(parts)}")
        if _kind(node) == "UnresolvedTableValuedFunction":
            _check_function([p.lower() for p in _items(node.name())], _ROW_MAKERS)
        for expression in _expressions(node):
            if _NAMES.search(_kind(expression)):
                raise refusal
            if _kind(expression) == "UnresolvedFunction":
                _check_function([p.lower() for p in _items(expression.nameParts())], _built_in(spark))
        if _kind(node) == "Generate":
            _check_generator(node.generator())


def _check_generator(generator: JavaObject) -> None:
    if _kind(generator) == "UnresolvedGenerator":
        if generator.name().database().isDefined():
            raise YearbookError(f"not a function that queries may call: {generator.name().unquotedString()}")
        _check_function([generator.name().funcName().lower()], _ROW_MAKERS)


def _check_function(parts: list[str], allowed: frozenset[str] | set[str]) -> None:
    if len(parts) != 1 or parts[0] not in allowed:
        raise YearbookError(f"not a function that queries may call: {'.'.join(parts)}")


def _check_resolved(node: JavaObject) -> None:
    name = node.getClass().getName()
    if _kind(node) == "View":
        if node.desc().identifier().table().lower() not in {v.lower() for v in VIEWS}:
            raise YearbookError(f"not one of the views: {node.desc().identifier().table()}")
        return  # what a view reads is its own matter
    leaf = node.children().size() == 0
    if not name.startswith(_CATALYST) or (leaf and _kind(node) not in _OWN_ROWS):
        raise YearbookError(f"queries may read the views only, not {_kind(node)}")
    for expression in _expressions(node):
        if not expression.getClass().getName().startswith(_CATALYST) or _FOREIGN.search(_kind(expression)):
            raise YearbookError(f"not an expression that queries may use: {_kind(expression)}")
    for child in _below(node):
        _check_resolved(child)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """Run one query over the views. Anything else is refused, before anything runs."""
    described = _DESCRIBE.fullmatch(text)
    if described:
        if described.group(1).lower() not in {v.lower() for v in VIEWS}:
            raise YearbookError(f"not one of the views: {described.group(1)}")
        return spark.sql(f"DESCRIBE TABLE {described.group(1)}")
    refusal = YearbookError(f"not a single query: {text.strip()[:80]}")
    try:
        root = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except (ParseException, Py4JJavaError) as broken:
        raise refusal from broken
    _check_parsed(spark, root, refusal)
    found = spark.sql(text)
    _check_resolved(found._jdf.queryExecution().analyzed())
    return found
