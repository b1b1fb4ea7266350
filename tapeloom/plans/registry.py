"""Registry of named queries and the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.plans.standins import VIEWS, duck_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
DIGITS = 4


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to a few digits, without negative zeros, and times without zone: two engines then agree."""
    out = df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c, t in df.dtypes if t == "double"})
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in out.dtypes if t == "timestamp"})


def oracle(body: str, doubles: str = "", digits: int = DIGITS) -> str:
    """DuckDB SQL: the stand-in views that ``body`` names, then the body with its double columns rounded."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                need(VIEWS[name])
                needed.append(name)

    need(body)
    views = [f"{n} as ({duck_view(n)})" for n in needed]
    body = body.strip()
    if body.lower().startswith("with "):
        head, body = body[5:], ""
        depth, at = 0, 0
        for m in re.finditer(r"[()]|\bselect\b", head, flags=re.IGNORECASE):  # the select outside all brackets
            depth += {"(": 1, ")": -1}.get(m[0], 0)
            if depth == 0 and m[0].lower() == "select":
                at = m.start()
                break
        views.append(head[:at].rstrip().rstrip(","))
        body = head[at:]
    replace = ", ".join(f"round({c}::double, {digits}) + 0.0 as {c}" for c in doubles.split())
    body = f"select * replace ({replace}) from ({body}) final_rows" if replace else body
    return (f"with {', '.join(views)} " if views else "") + body


def duck(text: str) -> str:
    """Spark SQL expressions as DuckDB writes them."""
    for ours, theirs in (("max_by(", "arg_max("), ("min_by(", "arg_min("), ("struct(", "row(")):
        text = text.replace(ours, theirs)
    return text


#: Endings of the names of columns that aren't doubles.
_OTHERS = ("_count", "_symbol", "_signal", "_regime", "_exchange", "_label", "_level", "_side", "_ts", "_date", "_at", "_sk", "_etf", "_group", "_status", "_trend", "_mentions", "_eligible", "_ready", "_instrument", "_option_type", "_location", "_direction", "_name", "_key", "_type", "_asset", "_enabled", "_order", "_state", "_family", "_id", "_minutes", "_has", "_cex")


def doubles_of(*defs: dict[str, str]) -> str:
    """Names of the columns that are doubles, by how the names end."""
    return " ".join(n for d in defs for n in d if not n.endswith(_OTHERS) and n not in ("symbol", "exchange"))


def added(df: DataFrame, defs: dict[str, str]) -> DataFrame:
    """The frame with columns by Spark SQL text."""
    return df.selectExpr("*", *[f"{t} as {n}" for n, t in defs.items()])


def added_sql(source: str, defs: dict[str, str]) -> str:
    return f"select *, {', '.join(f'{duck(t)} as {n}' for n, t in defs.items())} from {source}"


def grouped(df: DataFrame, keys: list[str], defs: dict[str, str]) -> DataFrame:
    """Groups with aggregates by Spark SQL text."""
    return df.groupBy(*keys).agg(*[F.expr(t).alias(n) for n, t in defs.items()])


def grouped_sql(source: str, keys: list[str], defs: dict[str, str]) -> str:
    return f"select {', '.join(keys)}, {', '.join(f'{duck(t)} as {n}' for n, t in defs.items())} from {source} group by {', '.join(keys)}"


def query(name: str, sql: str | None = None, doubles: str = "", digits: int = DIGITS) -> Callable[[Query], Query]:
    """Register a function as query ``name``; its doubles are rounded. sql: DuckDB text over tables and stand-ins."""

    def wrap(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir), digits)
        if sql is not None:
            SQL[name] = oracle(sql, doubles, digits)
        return f

    return wrap
