"""What the query modules share: tables, prepared frames, and pieces of SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import fold_name, is_absent, strip_space
from ..operators import entities as E
from ..operators import relations as R

Query = Callable[[SparkSession, str], DataFrame]

#: The articles of the test tables are on this domain.
DOMAIN = "openpedia.example"
AS_OF = 2025


class Registry:
    """Collects queries by the name of their function, and the SQL given with them."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = expand(sql)
            return f

        return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def joined(c: str) -> Column:
    """An array as one string, for results that SQL can compare."""
    return F.array_join(c, "|")


def signed(spark: SparkSession, d: str) -> DataFrame:
    """Edges by folded names with an enforced relationship: edge_id, source, target, relationship."""
    e = table(spark, d, "global_network_edges")
    return e.select("edge_id", fold_name(F.col("source")).alias("source"), fold_name(F.col("target")).alias("target"), R.enforce_relationship(F.col("relationship")).alias("relationship"))


def vertex_types(spark: SparkSession, d: str) -> DataFrame:
    """(v, type) of the nodes, the type of the node with the least id for a name."""
    n = table(spark, d, "global_network_nodes").select(fold_name(F.col("standard_name")).alias("v"), "node_id", E.normalize_type(F.col("type")).alias("type")).filter("v <> ''")
    return n.groupBy("v").agg(F.min_by("type", "node_id").alias("type"))


def alias_variants(spark: SparkSession, d: str) -> DataFrame:
    """(entry, canonical, variant): the aliases of nodes as variants of their names."""
    n = table(spark, d, "global_network_nodes").filter(strip_space("standard_name") != "")
    rows = n.select(F.col("node_id").alias("entry"), F.col("standard_name").alias("canonical"), F.explode(E.strings(F.col("aliases"))).alias("variant"))
    return rows.filter(~is_absent(F.col("variant")))


# ---- SQL

WS = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
ABSENT = "('', 'unknown', 'n/a', 'none', 'null')"


def expand(sql: str) -> str:
    """SQL with every strip(x) written out: DuckDB has no trim for all Unicode whitespace."""
    while (at := sql.rfind("strip(")) >= 0 and (at == 0 or not (sql[at - 1].isalnum() or sql[at - 1] == "_")):
        depth, end = 1, at + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = sql[:at] + f"regexp_replace({sql[at + 6 : end - 1]}, '^[{WS}]+|[{WS}]+$', '', 'g')" + sql[end:]
    return sql


def fold(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '[{WS}]+', ' ', 'g')))"


def absent(c: str) -> str:
    return f"coalesce({fold(c)} IN {ABSENT}, true)"


def rel(c: str) -> str:
    return f"CASE WHEN lower(strip({c})) IN ('alliance', 'rivalry', 'other') THEN lower(strip({c})) ELSE 'other' END"


def node_type(c: str) -> str:
    t = f"lower(strip(coalesce({c}, '')))"
    listed = ", ".join(f"'{x}'" for x in E.NODE_TYPES)
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in E.TYPE_FALLBACK.items())
    return f"CASE WHEN {t} IN ({listed}) THEN {t} ELSE CASE {t} {cases} ELSE 'other' END END"


def text_set(c: str) -> str:
    """Distinct non-empty values in order, as one string."""
    return f"coalesce(array_to_string(list_sort(list(DISTINCT {c}) FILTER (WHERE {c} <> '')), '|'), '')"


def longest(c: str, order: str) -> str:
    return f"first(coalesce({c}, '') ORDER BY length(coalesce({c}, '')) DESC, {order})"


EDGES = f"""e0 AS (SELECT edge_id, {fold('source')} AS s, {fold('target')} AS t, {rel('relationship')} AS rel FROM global_network_edges),
e AS (SELECT * FROM e0 WHERE s <> '' AND t <> '' AND s <> t)"""
TYPES = f"""ty AS (SELECT {fold('standard_name')} AS v, first({node_type('type')} ORDER BY node_id) AS type FROM global_network_nodes
WHERE {fold('standard_name')} <> '' GROUP BY 1)"""


def layer(name: str, relationship: str | None) -> str:
    where = f"WHERE rel = '{relationship}'" if relationship else ""
    return f"{name} AS (SELECT least(s, t) AS a, greatest(s, t) AS b, count(*) AS m FROM e {where} GROUP BY 1, 2)"


def both(name: str, of: str) -> str:
    return f"{name} AS (SELECT a AS v, b AS w, m FROM {of} UNION ALL SELECT b, a, m FROM {of})"


def degree(name: str, of: str) -> str:
    return f"{name} AS (SELECT v, CAST(sum(m) AS BIGINT) AS degree, count(*) AS neighbours FROM {of} GROUP BY v)"
