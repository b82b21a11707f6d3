"""How fast variants of a query are, and what the optimizer makes of them."""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession


def one_query(text: str) -> str:
    """A single SELECT or WITH without its semicolon; anything else is refused."""
    bare = re.sub(r"--[^\n]*|/\*.*?\*/", " ", text, flags=re.S).strip().rstrip(";").strip()
    if ";" in bare or not re.match(r"(select|with)\b", bare, re.I):
        raise ValueError("only one SELECT or WITH statement can be measured")
    return bare


def variants(text: str) -> dict[str, str]:
    """The query as it is, and with NOT IN (subquery) of one column as NOT EXISTS, which differs where the subquery holds nulls.

    Comma joins need no variant: the optimizer turns them into inner joins on their equalities.
    """
    query = one_query(text)
    out = {"original": query}
    m = re.search(r"([\w.]+)\s+NOT\s+IN\s*\(\s*SELECT\s+(\w+)\s+FROM\s+(\w+)(\s+WHERE\s+[^()]*)?\)", query, re.I)
    if m:
        also = f" AND ({m[4].strip()[5:].strip()})" if m[4] else ""
        out["not_exists"] = query[: m.start()] + f"NOT EXISTS (SELECT 1 FROM {m[3]} x WHERE x.{m[2]} = {m[1]}{also})" + query[m.end() :]
    return out


def count_of(spark: SparkSession, query: str) -> DataFrame:
    """The number of rows of a query; the optimizer drops an ORDER BY that the count does not need."""
    return spark.sql(f"SELECT count(*) AS rows FROM ({query})")


def measured(spark: SparkSession, text: str, database: str = "spark", repeat: int = 1) -> DataFrame:
    """database, variant, status, runtime_ms, row_count, plan_node, total_size, error of each variant."""
    rows = []
    for name, query in variants(text).items():
        try:
            df = count_of(spark, query)
            best, n = float("inf"), 0
            for _ in range(repeat):
                start = time.perf_counter()
                n = df.first()[0]
                best = min(best, (time.perf_counter() - start) * 1000)
            plan = spark.sql(query)._jdf.queryExecution()
            node = re.sub(r"\W.*", "", plan.executedPlan().treeString().lstrip("*(0123456789) +-:"), flags=re.S)
            rows.append((database, name, "OK", round(best, 3), n, node, str(plan.optimizedPlan().stats().sizeInBytes()), ""))
        except Exception as e:
            rows.append((database, name, "ERROR", None, None, None, None, str(e)[:500]))
    return spark.createDataFrame(rows, "database string, variant string, status string, runtime_ms double, row_count long, plan_node string, total_size string, error string")
