"""Queries of network analytics on the alliance and rivalry layers of the edge table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import census as C
from ..operators import stats as S
from ..operators.graph import centrality as Z
from ..operators.graph import clustering as K
from ..operators.graph import layers as L
from ..operators.graph import local as N
from ..operators.graph import traversal as T
from ..functions.names import fold_name
from ..operators.joins import shuffled
from ..scratch import Scratch
from .common import EDGES, TYPES, Registry, both, degree, fold, layer, signed, table, vertex_types

_r = Registry()
LAYERS = ("alliance", "rivalry")
_A = f"WITH RECURSIVE {EDGES}, {layer('l', 'alliance')}, {both('bw', 'l')}, {degree('dg', 'bw')}"
_AR = f"WITH RECURSIVE {EDGES}, {layer('la', 'alliance')}, {both('ba', 'la')}, {degree('da', 'ba')}, {layer('lr', 'rivalry')}, {both('br', 'lr')}, {degree('dr', 'br')}"
_SIGNED = f"""{_AR}, sg AS (SELECT coalesce(da.v, dr.v) AS v, coalesce(da.neighbours, 0) AS d_pos, coalesce(dr.neighbours, 0) AS d_neg FROM da FULL JOIN dr ON da.v = dr.v),
sd AS (SELECT *, d_pos + d_neg AS total, d_pos - d_neg AS difference, d_pos * d_neg AS product FROM sg)"""


def _of(sql: str, name: str) -> str:
    """The SQL of the alliance layer for another."""
    return sql.replace("rel = 'alliance'", f"rel = '{name}'")


def _each_layer(sql: str | None = None, shared: bool = False):
    """Registers a query of one layer for both, a column `layer` first; its SQL is that of the alliance layer. shared: it takes Folded tables, not a folder."""

    def add(f: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, d: str) -> DataFrame:
            of = folded(spark, d) if shared else d
            parts = [f(spark, of, name) for name in LAYERS]
            return reduce(DataFrame.unionByName, [p.select(F.lit(name).alias("layer"), *p.columns) for name, p in zip(LAYERS, parts)])

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        both_sql = sql and " UNION ALL ".join(f"SELECT '{name}' AS layer, * FROM ({_of(sql, name)})" for name in LAYERS)
        return _r.query(both_sql)(run)

    return add


def _layer(spark: SparkSession, d: str, name: str | None = "alliance") -> DataFrame:
    return L.layer(signed(spark, d), name)


def _signed(spark: SparkSession, d: str) -> DataFrame:
    return L.signed_degrees(_layer(spark, d), _layer(spark, d, "rivalry"))


def _vertices(spark: SparkSession, d: str) -> DataFrame:
    """All organisations: nodes, and ends of edges that are no node."""
    ends = L.both_ways(_layer(spark, d, None)).select("v")
    return vertex_types(spark, d).select("v").union(ends).distinct()


@dataclass
class Folded:
    """The edges and types of a folder by folded names, written once for all the layers that a query takes from them; names are numbered once for all of them.

    in_order: numbers follow the names, which components and sweeps need and centralities do not.
    """

    scratch: Scratch
    edges: DataFrame
    types: DataFrame
    in_order: bool = True

    def layer(self, name: str | None, kept: bool = True) -> DataFrame:
        """kept: the rows are written as well, for those that read them by names."""
        return self._numbered(L.layer(self.edges, name), F.col("relationship") == name if name else F.lit(True), kept)

    def published(self, name: str | None) -> DataFrame:
        return self._numbered(_between_published(self.edges, self.types, name), F.col("published") & (F.col("relationship") == name if name else F.col("relationship") != "other"), False)

    def _numbered(self, layer: DataFrame, of: Column, kept: bool) -> DataFrame:
        if self._ends is None or kept:
            layer = self.scratch.save(layer)
            layer._skein_rows = layer  # what is numbered later is these rows
        if self._ends is not None:
            names, n, ends = self._ends
            edges = self.scratch.save(ends.filter(of).groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.count(F.lit(1)).alias("m")))
            layer._skein_numbers = N.Numbered(names, edges, n, edges.count())
        return layer

    @cached_property
    def _ends(self) -> tuple[DataFrame, int, DataFrame] | None:
        """(v, id) of the ends of edges, how many there are, and the edges by numbers (x, y, relationship, published: whether both ends are); none where there are too many for one task."""
        rows = self.edges.filter("source <> '' and target <> '' and source <> target").select("source", "target", "relationship")
        if not N.is_small(rows, N.NUMBERED_EDGES):
            return None
        names = L.both_ways(rows.select(F.col("source").alias("a"), F.col("target").alias("b"), F.lit(1).alias("m"))).select("v").distinct()
        names = names.join(shuffled(entities(self.types).select("v", F.lit(True).alias("own"))), "v", "left").select("v", F.monotonically_increasing_id().alias("id"), F.coalesce("own", F.lit(False)).alias("own"))
        listed = self.scratch.save(names)  # written once, so the numbers stay
        n = listed.count()
        if self.in_order:
            listed = self.scratch.save(N.numbers_of(listed.drop("id"), n).select("v", "id", "own"))
        ends = rows.join(shuffled(listed.toDF("source", "x", "own_x")), "source").join(shuffled(listed.toDF("target", "y", "own_y")), "target")
        return listed.select("v", "id"), n, self.scratch.save(ends.select("x", "y", "relationship", (F.col("own_x") & F.col("own_y")).alias("published")))


def folded(spark: SparkSession, d: str, in_order: bool = True) -> Folded:
    scratch = Scratch(spark, "folded")
    return Folded(scratch, scratch.save(signed(spark, d)), scratch.save(vertex_types(spark, d)), in_order)


@_each_layer(f"{_A} SELECT a, b, m FROM l")
def layer_edges(spark: SparkSession, d: str, name: str) -> DataFrame:
    return _layer(spark, d, name)


@_each_layer(f"{_A} SELECT v, degree, neighbours FROM dg")
def layer_degree(spark: SparkSession, d: str, name: str) -> DataFrame:
    return L.degrees(_layer(spark, d, name))


@_each_layer(f"{_A}, {TYPES}, u AS (SELECT v FROM ty UNION SELECT s FROM e UNION SELECT t FROM e) SELECT v FROM u WHERE v NOT IN (SELECT v FROM dg)")
def layer_isolates(spark: SparkSession, d: str, name: str) -> DataFrame:
    return L.isolates(_vertices(spark, d), _layer(spark, d, name))


@_each_layer(f"{_A} SELECT count(*) AS n_nodes, CAST(sum(degree) / 2 AS BIGINT) AS n_edges, round(sum(degree) / (count(*) * (count(*) - 1)), 6) AS density, round(avg(degree), 6) AS mean_degree, median(degree) AS median_degree, max(degree) AS max_degree FROM dg")
def layer_density(spark: SparkSession, d: str, name: str) -> DataFrame:
    return L.degree_summary(_layer(spark, d, name))


_TRI = "tr AS (SELECT x.v, count(*) AS n FROM bw x JOIN bw y ON x.v = y.v AND x.w < y.w JOIN bw z ON z.v = x.w AND z.w = y.w GROUP BY 1), lc AS (SELECT dg.v, neighbours, coalesce(n, 0) AS triangles FROM dg LEFT JOIN tr USING (v) WHERE neighbours >= 2)"


@_each_layer(f"{_A}, {_TRI} SELECT v, neighbours, triangles, round(2 * triangles / (neighbours * (neighbours - 1)), 6) AS clustering FROM lc")
def local_clustering(spark: SparkSession, d: str, name: str) -> DataFrame:
    return K.local_clustering(_layer(spark, d, name))


@_each_layer(f"{_A}, {_TRI} SELECT round(sum(triangles) / sum(neighbours * (neighbours - 1) / 2), 6) AS transitivity, round(avg(triangles / (neighbours * (neighbours - 1) / 2)), 6) AS mean_local_clustering FROM lc")
def transitivity(spark: SparkSession, d: str, name: str) -> DataFrame:
    return K.clustering_summary(_layer(spark, d, name))


@_each_layer(f"{_A} SELECT round(corr(x.degree, y.degree), 6) AS degree_assortativity FROM (SELECT v, w, unnest(range(m)) FROM bw) b JOIN dg x ON b.v = x.v JOIN dg y ON b.w = y.v")
def degree_assortativity(spark: SparkSession, d: str, name: str) -> DataFrame:
    return K.degree_assortativity(_layer(spark, d, name))


_MIX = "mx AS (SELECT coalesce(x.type, 'unknown') AS type_a, coalesce(y.type, 'unknown') AS type_b, CAST(sum(m) AS BIGINT) AS n FROM bw LEFT JOIN ty x ON bw.v = x.v LEFT JOIN ty y ON bw.w = y.v GROUP BY 1, 2)"


@_each_layer(f"{_A}, {TYPES}, {_MIX} SELECT type_a, type_b, n, round(n / (SELECT sum(n) FROM mx), 6) AS share FROM mx")
def type_mixing_matrix(spark: SparkSession, d: str, name: str) -> DataFrame:
    return K.mixing(_layer(spark, d, name), vertex_types(spark, d))


@_each_layer(f"{_A}, {TYPES}, {_MIX}, rw AS (SELECT type_a, sum(n) AS s FROM mx GROUP BY 1), x AS (SELECT sum(s) AS n, sum(CAST(s AS DOUBLE) * s) AS q FROM rw), o AS (SELECT sum(n) FILTER (type_a = type_b) AS own FROM mx) SELECT round((own / n - q / (n * n)) / (1 - q / (n * n)), 6) AS type_assortativity FROM x, o")
def type_assortativity(spark: SparkSession, d: str, name: str) -> DataFrame:
    return K.type_assortativity(_layer(spark, d, name), vertex_types(spark, d))


_CC = "rc AS (SELECT v, v AS r FROM dg UNION SELECT bw.w, rc.r FROM rc JOIN bw ON bw.v = rc.v), cc AS (SELECT v, min(r) AS component FROM rc GROUP BY 1)"
_SIZES = "cz AS (SELECT component, count(*) AS n_nodes FROM cc GROUP BY 1), ce AS (SELECT component, CAST(sum(m) AS BIGINT) AS n_edges FROM l JOIN cc ON a = v GROUP BY 1), big AS (SELECT component FROM cz ORDER BY n_nodes DESC, component LIMIT 1)"


@_each_layer(f"{_A}, {_CC} SELECT v, component FROM cc")
def connected_components(spark: SparkSession, d: str, name: str) -> DataFrame:
    return T.components(_layer(spark, d, name))


@_each_layer(f"{_A}, {_CC}, {_SIZES} SELECT component, n_nodes, n_edges, round(2 * n_edges / (n_nodes * (n_nodes - 1)), 6) AS density FROM cz JOIN ce USING (component)")
def component_sizes(spark: SparkSession, d: str, name: str) -> DataFrame:
    edges = _layer(spark, d, name)
    return T.component_sizes(edges, T.components(edges))


@_each_layer(f"{_A}, {_CC}, {_SIZES} SELECT a, b, m FROM l JOIN cc ON a = v WHERE component IN (SELECT component FROM big)")
def largest_component(spark: SparkSession, d: str, name: str) -> DataFrame:
    edges = _layer(spark, d, name)
    return T.largest_component(edges, T.components(edges))


def _hub(edges: DataFrame) -> str:
    row = L.degrees(edges).orderBy(F.desc("neighbours"), "v").first()
    return row["v"] if row else ""


@_each_layer(f"{_A}, bf AS (SELECT v, 0 AS distance FROM (SELECT v FROM dg ORDER BY neighbours DESC, v LIMIT 1) UNION SELECT bw.w, distance + 1 FROM bf JOIN bw USING (v) WHERE distance < 60) SELECT v, min(distance) AS distance FROM bf GROUP BY 1")
def bfs_levels(spark: SparkSession, d: str, name: str) -> DataFrame:
    edges = _layer(spark, d, name)
    return T.distances(edges, _hub(edges))


@_each_layer()
def pseudo_diameter(spark: SparkSession, d: str, name: str) -> DataFrame:
    edges = _layer(spark, d, name)
    giant = T.largest_component(edges, T.components(edges))
    return spark.createDataFrame([(T.pseudo_diameter(giant, _hub(giant)),)], "pseudo_diameter int")


def _kcore_sql(rounds: int = 40) -> str:
    steps = ["c0 AS MATERIALIZED (SELECT v, neighbours AS core FROM dg)"]
    for k in range(1, rounds + 1):
        steps.append(f"c{k} AS MATERIALIZED (SELECT v, max(least(x, n)) AS core FROM (SELECT bw.v, c{k - 1}.core AS x, row_number() OVER (PARTITION BY bw.v ORDER BY c{k - 1}.core DESC) AS n FROM bw JOIN c{k - 1} ON bw.w = c{k - 1}.v) GROUP BY 1)")
    return f"{_A}, {', '.join(steps)}, core AS (SELECT v, CAST(core AS BIGINT) AS core FROM c{rounds})"


@_each_layer(_kcore_sql() + " SELECT v, core FROM core")
def kcore(spark: SparkSession, d: str, name: str) -> DataFrame:
    return T.core_numbers(_layer(spark, d, name))


@_each_layer(_kcore_sql().replace(", c0 AS", f", {TYPES}, c0 AS", 1) + ", q AS (SELECT core, coalesce(type, 'unknown') AS type, count(*) AS n FROM core LEFT JOIN ty USING (v) GROUP BY 1, 2), p AS (SELECT *, n / sum(n) OVER (PARTITION BY core) AS part FROM q) SELECT core, type, n, round(part, 6) AS share, round(coalesce(sum(part) OVER (PARTITION BY core ORDER BY type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS \"offset\" FROM p")
def kcore_composition(spark: SparkSession, d: str, name: str) -> DataFrame:
    return T.core_composition(T.core_numbers(_layer(spark, d, name)), vertex_types(spark, d))


def _pagerank_sql(vertices: str, rounds: int = 90) -> str:
    steps = [f"nm AS MATERIALIZED ({vertices})", "r0 AS MATERIALIZED (SELECT v, 1.0::DOUBLE / (SELECT count(*) FROM nm) AS r FROM nm)"]
    for k in range(1, rounds + 1):
        p = f"r{k - 1}"
        steps.append(
            f"r{k} AS MATERIALIZED (SELECT nm.v, 0.15 / (SELECT count(*) FROM nm) + 0.85 * (coalesce(g.got, 0) + (SELECT coalesce(sum(r), 0) FROM {p} WHERE v NOT IN (SELECT v FROM dg)) / (SELECT count(*) FROM nm)) AS r "
            f"FROM nm LEFT JOIN (SELECT bw.w AS v, sum({p}.r * bw.m / dg.degree) AS got FROM bw JOIN {p} ON bw.v = {p}.v JOIN dg ON dg.v = bw.v GROUP BY 1) g ON nm.v = g.v)"
        )
    return f"{', '.join(steps)}"


@_each_layer(f"{_A}, {_pagerank_sql('SELECT v FROM dg')} SELECT v, round(r, 7) AS pagerank FROM r90")
def pagerank(spark: SparkSession, d: str, name: str) -> DataFrame:
    return Z.pagerank(_layer(spark, d, name)).select("v", F.round("pagerank", 7).alias("pagerank"))


@_each_layer(f"{_A}, {TYPES}, {_pagerank_sql('SELECT v FROM ty UNION SELECT s FROM e UNION SELECT t FROM e')} SELECT v, round(r, 7) AS pagerank FROM r90 WHERE v IN (SELECT v FROM dg)")
def pagerank_with_isolates(spark: SparkSession, d: str, name: str) -> DataFrame:
    """On all organisations, those without an edge left out afterwards: the ranks differ, as their number is larger."""
    edges = _layer(spark, d, name)
    ranks = Z.pagerank(edges, _vertices(spark, d))
    return ranks.join(L.degrees(edges).select("v"), "v", "left_semi").select("v", F.round("pagerank", 7).alias("pagerank"))


def _betweenness_sql(edges: str, value: str, steps: int = 26) -> str:
    """Paths counted level by level from every vertex of `edges` (v, w, m), and dependencies summed on the way back: bt (v, value)."""
    ctes = ["p0 AS MATERIALIZED (SELECT DISTINCT v AS s, v, 1.0::DOUBLE AS n FROM {e})"]
    for k in range(1, steps + 1):
        seen = " ".join(f"AND NOT EXISTS (SELECT 1 FROM p{j} q WHERE q.s = p.s AND q.v = x.w)" for j in (k - 1, k - 2) if j >= 0)
        ctes.append(f"p{k} AS MATERIALIZED (SELECT p.s, x.w AS v, sum(p.n * x.m) AS n FROM p{k - 1} p JOIN {{e}} x ON x.v = p.v WHERE true {seen} GROUP BY 1, 2)")
    ctes.append(f"d{steps} AS MATERIALIZED (SELECT s, v, 0.0::DOUBLE AS need FROM p{steps})")
    for k in range(steps - 1, 0, -1):
        ctes.append(f"d{k} AS MATERIALIZED (SELECT p.s, p.v, coalesce(sum(p.n * x.m / q.n * (1 + d.need)), 0) AS need FROM p{k} p LEFT JOIN ({{e}} x JOIN p{k + 1} q ON q.v = x.w JOIN d{k + 1} d ON d.s = q.s AND d.v = q.v) ON x.v = p.v AND q.s = p.s GROUP BY 1, 2)")
    scores = " UNION ALL ".join(f"SELECT v, need FROM d{k}" for k in range(1, steps + 1))
    size = "(SELECT count(DISTINCT v) FROM {e})"
    ctes.append(f"bt AS (SELECT x.v, coalesce(sum(need), 0) / greatest(({size} - 1) * ({size} - 2), 1) AS {value} FROM (SELECT DISTINCT v FROM {{e}}) x LEFT JOIN ({scores}) y USING (v) GROUP BY 1)")
    return ", ".join(ctes).replace("{e}", edges)


def entities(types: DataFrame) -> DataFrame:
    """(v, type) of the organisations of a canonical type: what is published."""
    return types.filter("type <> 'other'")


def _between_published(edges: DataFrame, types: DataFrame, name: str | None) -> DataFrame:
    """The edges of a layer, or of both, between published organisations."""
    rows = edges.filter("relationship <> 'other'")
    names = entities(types).select("v")
    for end in ("source", "target"):
        rows = rows.join(shuffled(names.toDF(end)), end, "left_semi")
    return L.layer(rows, name)


_PUBLISHED = f"""{EDGES}, {TYPES}, en AS MATERIALIZED (SELECT v FROM ty WHERE type <> 'other'),
pe AS MATERIALIZED (SELECT DISTINCT least(s, t) AS a, greatest(s, t) AS b, rel FROM e WHERE rel <> 'other' AND s IN (SELECT v FROM en) AND t IN (SELECT v FROM en))"""
VIEWS = {"alliance": "rel = 'alliance'", "rivalry": "rel = 'rivalry'", "combined": "true"}


def published_sql(view: str) -> str:
    return f"WITH {_PUBLISHED}, px AS MATERIALIZED (SELECT DISTINCT a, b FROM pe WHERE {VIEWS[view]}), pb AS MATERIALIZED (SELECT a AS v, b AS w, 1 AS m FROM px UNION ALL SELECT b, a, 1 FROM px), {_betweenness_sql('pb', 'betweenness')} SELECT '{view}' AS view, en.v, round(coalesce(betweenness, 0), 6) AS betweenness FROM en LEFT JOIN bt USING (v)"


@_r.query(" UNION ALL ".join(f"SELECT * FROM ({published_sql(view)})" for view in VIEWS))
def betweenness(spark: SparkSession, d: str) -> DataFrame:
    """Of each published organisation, on the simple graphs between published ones; 0 where it has no edge."""
    f, out = folded(spark, d), []
    names = entities(f.types).select("v")
    for view, name in (("alliance", "alliance"), ("rivalry", "rivalry"), ("combined", None)):
        rows = names.join(shuffled(Z.betweenness(f.published(name))), "v", "left")
        out.append(rows.select(F.lit(view).alias("view"), "v", F.round(F.coalesce("betweenness", F.lit(0.0)), 6).alias("betweenness")))
    return reduce(DataFrame.unionByName, out)


@_r.query(f"SELECT v, betweenness FROM ({published_sql('combined')}) ORDER BY betweenness DESC, v LIMIT 5")
def top_betweenness(spark: SparkSession, d: str) -> DataFrame:
    """The five organisations that are most between others."""
    f = folded(spark, d)
    rows = entities(f.types).select("v").join(shuffled(Z.betweenness(f.published(None))), "v", "left").select("v", F.round(F.coalesce("betweenness", F.lit(0.0)), 6).alias("betweenness"))
    return C.top(rows, 5, F.desc("betweenness"), F.asc("v"))


_MULTI = f"{_A}, {_betweenness_sql('bw', 'betweenness')}"


@_each_layer(f"{_MULTI} SELECT v, round(betweenness, 6) AS betweenness FROM bt")
def betweenness_multigraph(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Parallel edges as paths of their own, on the layer without isolates."""
    return Z.betweenness(_layer(spark, d, name), collapse_parallel=False).select("v", F.round("betweenness", 6).alias("betweenness"))


_ALL = "SELECT v FROM ty UNION SELECT s FROM e UNION SELECT t FROM e"


@_each_layer(f"{_MULTI}, {TYPES} SELECT v, round(betweenness * ((SELECT count(*) FROM dg) - 1) * ((SELECT count(*) FROM dg) - 2) / (((SELECT count(*) FROM ({_ALL})) - 1) * ((SELECT count(*) FROM ({_ALL})) - 2)), 7) AS betweenness FROM bt")
def betweenness_with_isolates(spark: SparkSession, d: str, name: str) -> DataFrame:
    """On the view that keeps isolates, those left out afterwards: paths are the same, the number they are scaled by is of all organisations."""
    all_of_them, edges = _vertices(spark, d).count(), _layer(spark, d, name)
    linked = L.degrees(edges).count()
    scale = max(linked - 1, 0) * max(linked - 2, 0) / max((all_of_them - 1) * (all_of_them - 2), 1)
    return Z.betweenness(edges, collapse_parallel=False).select("v", F.round(F.col("betweenness") * scale, 7).alias("betweenness"))


@_each_layer(_kcore_sql() + f", {_betweenness_sql('bw', 'betweenness')} SELECT core.v, core, round(betweenness, 6) AS betweenness FROM core JOIN bt USING (v) WHERE core = (SELECT max(core) FROM core)")
def innermost_core(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The members of the innermost core, those most between others first."""
    edges = _layer(spark, d, name)
    cores = T.core_numbers(edges)
    most = cores.agg(F.max("core").alias("core"))  # one row
    members = cores.join(F.broadcast(most), "core", "left_semi").join(shuffled(Z.betweenness(edges, collapse_parallel=False)), "v")
    return members.select("v", "core", F.round("betweenness", 6).alias("betweenness")).orderBy(F.desc("betweenness"), "v")


def _measures(edges: DataFrame) -> DataFrame:
    """(v, degree, betweenness, pagerank, core) of the edges of a layer."""
    return Z.measures(edges).select("v", "degree", F.round("betweenness", 6).alias("betweenness"), F.round("pagerank", 7).alias("pagerank"), "core")


def _metrics(f: Folded, name: str) -> DataFrame:
    """(v, type, degree, betweenness, pagerank, core) of a layer."""
    rows = _measures(f.layer(name, kept=False)).join(shuffled(f.types), "v", "left")
    return rows.select("v", F.coalesce("type", F.lit("unknown")).alias("type"), "degree", "betweenness", "pagerank", "core")


_METRICS = _kcore_sql().replace(", c0 AS", f", {TYPES}, c0 AS", 1) + f", {_pagerank_sql('SELECT v FROM dg')}, {_betweenness_sql('bw', 'betweenness')}, mt AS (SELECT dg.v, coalesce(type, 'unknown') AS type, degree, round(betweenness, 6) AS betweenness, round(r, 7) AS pagerank, core FROM dg JOIN bt USING (v) JOIN r90 USING (v) JOIN core USING (v) LEFT JOIN ty USING (v))"


def records(spark: SparkSession, d: str) -> DataFrame:
    """(v, description, mentioned_in, time_period) of the nodes, those of the least id for a name."""
    n = table(spark, d, "global_network_nodes").select(fold_name(F.col("standard_name")).alias("v"), "node_id", F.coalesce("context", F.lit("")).alias("description"), F.size(F.coalesce("source_articles", F.array().cast("array<string>"))).alias("mentioned_in"), F.coalesce("time_period", F.lit("")).alias("time_period"))
    return n.filter("v <> ''").groupBy("v").agg(F.min_by(F.struct("description", "mentioned_in", "time_period"), "node_id").alias("n")).select("v", "n.*")


RECORDS_SQL = f"nd AS (SELECT {fold('standard_name')} AS v, first(coalesce(context, '') ORDER BY node_id) AS description, first(coalesce(len(source_articles), 0) ORDER BY node_id) AS mentioned_in, first(coalesce(time_period, '') ORDER BY node_id) AS time_period FROM global_network_nodes WHERE {fold('standard_name')} <> '' GROUP BY 1)"
_OWN = f"ow AS (SELECT DISTINCT {fold('standard_name')} AS v FROM global_network_nodes JOIN articles ON {fold('title')} = {fold('standard_name')} WHERE {fold('standard_name')} <> '')"


def _master_sql(betweenness_of: bool = True) -> str:
    parts = []
    for name in LAYERS:
        k = name[0]
        parts.append(f"m{k} AS (SELECT * FROM ({_of(_METRICS, name)} SELECT v, degree, betweenness, pagerank FROM mt))")
    deg = "coalesce(ma.degree, 0)", "coalesce(mr.degree, 0)"
    combined = published_sql("combined")
    return f"""WITH {EDGES}, {TYPES}, {RECORDS_SQL}, {_OWN}, {', '.join(parts)}, vs AS ({_ALL}), dt AS (SELECT v, count(*) AS n FROM (SELECT s AS v FROM e UNION ALL SELECT t FROM e) GROUP BY 1), bc AS ({combined})
SELECT vs.v, coalesce(type, 'unknown') AS type, coalesce(description, '') AS description, CAST(ow.v IS NOT NULL AS INTEGER) AS has_own_source, coalesce(mentioned_in, 0) AS mentioned_in, coalesce(time_period, '') AS time_period,
coalesce(ma.betweenness, 0) AS betweenness_alliance, coalesce(mr.betweenness, 0) AS betweenness_rivalry, coalesce(bc.betweenness, 0) AS betweenness_combined, {deg[0]} AS degree_alliance, {deg[1]} AS degree_rivalry, coalesce(dt.n, 0) AS degree_total,
coalesce(ma.pagerank, 0) AS pagerank_alliance, coalesce(mr.pagerank, 0) AS pagerank_rivalry FROM vs LEFT JOIN ty USING (v) LEFT JOIN nd USING (v) LEFT JOIN ow USING (v) LEFT JOIN ma USING (v) LEFT JOIN mr USING (v) LEFT JOIN dt USING (v) LEFT JOIN bc USING (v)"""


@_r.query(_master_sql())
def master_frame(spark: SparkSession, d: str) -> DataFrame:
    """One row per organisation: its record, and its metrics in both layers, 0 where it is not in one."""
    f = folded(spark, d)
    titles = table(spark, d, "articles").select(fold_name(F.col("title")).alias("v")).distinct().withColumn("own", F.lit(1))
    own_records = f.scratch.save(records(spark, d))
    own = own_records.select("v").join(shuffled(titles), "v").select("v", "own")
    total = f.scratch.save(L.degrees(L.layer(f.edges)).select("v", F.col("degree").alias("degree_total")))
    out = f.types.select("v").union(total.select("v")).distinct()  # nodes, and ends of edges that are no node
    combined = Z.betweenness(f.published(None)).select("v", F.round("betweenness", 6).alias("betweenness_combined"))
    for side in (f.types, own_records, own, combined, total):
        out = out.join(shuffled(side), "v", "left")
    for name in LAYERS:
        m = _measures(f.layer(name, kept=False))
        out = out.join(shuffled(m.select("v", *[F.col(c).alias(f"{c}_{name}") for c in ("degree", "betweenness", "pagerank")])), "v", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("mentioned_in", *(f"{m}_{n}" for m in ("betweenness", "degree", "pagerank") for n in LAYERS), "betweenness_combined", "degree_total")}
    text = {c: F.coalesce(c, F.lit("")) for c in ("description", "time_period")}
    return out.withColumns(zero | text | {"type": F.coalesce("type", F.lit("unknown")), "has_own_source": F.coalesce("own", F.lit(0))}).select(
        "v", "type", "description", "has_own_source", "mentioned_in", "time_period", "betweenness_alliance", "betweenness_rivalry", "betweenness_combined",
        "degree_alliance", "degree_rivalry", "degree_total", "pagerank_alliance", "pagerank_rivalry",
    )


@_r.query()
def layer_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The table of metrics of both layers, a row per layer and metric."""
    f, out = folded(spark, d), None
    for name in LAYERS:
        edges = f.layer(name)
        labels = f.scratch.save(T.components(edges))
        sizes = T.component_sizes(edges, labels)
        parts = sizes.agg(F.count(F.lit(1)).alias("components"), F.max_by(F.struct("n_nodes", "n_edges", "density"), F.col("n_nodes")).alias("g")).select("components", F.col("g.n_nodes").alias("lcc_nodes"), F.col("g.n_edges").alias("lcc_edges"), F.col("g.density").alias("lcc_density"))
        giant = T.largest_component(edges, labels)
        most = _measures(edges).agg(F.max("betweenness").alias("max_betweenness"), F.max("pagerank").alias("max_pagerank"), F.max("core").alias("max_core"))
        rows = L.degree_summary(edges).crossJoin(parts).crossJoin(K.clustering_summary(edges)).crossJoin(K.degree_assortativity(edges)).crossJoin(most).withColumn("pseudo_diameter", F.lit(T.diameter(edges, _hub(giant))))  # one row each; sweeps do not leave the component of the hub
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in rows.columns])).alias("x")
        part = rows.select(F.lit(name).alias("layer"), cells).select("layer", "x.metric", "x.value")
        out = part if out is None else out.unionByName(part)
    return out


def _importance_sql(metrics: tuple[str, ...]) -> str:
    cells = ", ".join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_samp({m}), 6) AS {m}_std, round(stddev_samp({m}) / sqrt(count(*)), 6) AS {m}_se, {f'CAST(sum({m}) AS BIGINT)' if m == 'degree' else f'round(sum({m}), {4 if m == "pagerank" else 6})'} AS {m}_sum" for m in metrics)
    return f"SELECT type, count(*) AS n, {cells} FROM mt GROUP BY 1"


@_each_layer(f"{_METRICS} {_importance_sql(('degree', 'betweenness', 'pagerank'))}", shared=True)
def type_importance(spark: SparkSession, f: Folded, name: str) -> DataFrame:
    # ranks settle to a tolerance, so their sums are told in fewer digits
    return S.importance(_metrics(f, name), "type", ["degree", "betweenness", "pagerank"]).withColumn("pagerank_sum", F.round("pagerank_sum", 4))


@_each_layer(f"{_A}, {TYPES} SELECT coalesce(type, 'unknown') AS type, count(*) AS n, round(avg(degree), 6) AS degree_mean, round(stddev_samp(degree), 6) AS degree_std, round(stddev_samp(degree) / sqrt(count(*)), 6) AS degree_se, CAST(sum(degree) AS BIGINT) AS degree_sum FROM dg LEFT JOIN ty USING (v) GROUP BY 1")
def type_degree_importance(spark: SparkSession, d: str, name: str) -> DataFrame:
    rows = L.degrees(_layer(spark, d, name)).join(vertex_types(spark, d), "v", "left").withColumn("type", F.coalesce("type", F.lit("unknown")))
    return S.importance(rows, "type", ["degree"])


@_each_layer(f"{_METRICS}, rk AS (SELECT v, row_number() OVER (ORDER BY pagerank DESC, v) AS rank_p, row_number() OVER (ORDER BY betweenness DESC, v) AS rank_b FROM mt) SELECT v, rank_p, rank_b, rank_p + rank_b AS combined FROM rk ORDER BY combined, v LIMIT 11", shared=True)
def combined_rank(spark: SparkSession, f: Folded, name: str) -> DataFrame:
    """The eleven organisations with the least sum of their ranks by PageRank and betweenness."""
    ranked = L.positions(_metrics(f, name), {"pagerank": "rank_p", "betweenness": "rank_b"})
    return ranked.select("v", "rank_p", "rank_b", (F.col("rank_p") + F.col("rank_b")).alias("combined")).orderBy("combined", "v").limit(11)


@_each_layer(f"{_A} SELECT v, degree, round(1.0 + 10.0 * (degree - (SELECT min(degree) FROM dg)) / ((SELECT max(degree) - min(degree) FROM dg) + 1), 6) AS size FROM dg")
def display_sizes(spark: SparkSession, d: str, name: str) -> DataFrame:
    return C.scaled(L.degrees(_layer(spark, d, name)).select("v", "degree"), "degree")


@_each_layer(f"{_A} SELECT v, degree FROM dg ORDER BY degree DESC, v LIMIT 10")
def top_degree(spark: SparkSession, d: str, name: str) -> DataFrame:
    return C.top(L.degrees(_layer(spark, d, name)).select("v", "degree"), 10, F.desc("degree"), F.asc("v"))


@_r.query(f"{_SIGNED} SELECT v, d_pos, d_neg, total, difference, product FROM sd")
def signed_degree(spark: SparkSession, d: str) -> DataFrame:
    return _signed(spark, d)


@_r.query(f"{_SIGNED} SELECT v, d_pos, d_neg, product FROM sd ORDER BY product DESC, v LIMIT 15")
def controversy_topk(spark: SparkSession, d: str) -> DataFrame:
    return C.top(_signed(spark, d).select("v", "d_pos", "d_neg", "product"), 15, F.desc("product"), F.asc("v"))


@_r.query(f"{_AR} SELECT a, b FROM la INTERSECT SELECT a, b FROM lr")
def contradictory_pairs(spark: SparkSession, d: str) -> DataFrame:
    return L.contradictory(_layer(spark, d), _layer(spark, d, "rivalry"))


@_r.query(f"{_AR} SELECT a, b FROM la INTERSECT SELECT a, b FROM lr ORDER BY a, b LIMIT 20")
def contradictory_first(spark: SparkSession, d: str) -> DataFrame:
    return C.top(L.contradictory(_layer(spark, d), _layer(spark, d, "rivalry")), 20, F.asc("a"), F.asc("b"))


@_r.query(f"{_AR} SELECT v FROM da UNION SELECT v FROM dr")
def signed_vertices(spark: SparkSession, d: str) -> DataFrame:
    return L.both_layers(_layer(spark, d), _layer(spark, d, "rivalry"))


@_r.query(f"{_SIGNED} SELECT v, d_pos, d_neg, CASE WHEN d_neg = 0 THEN 'cooperator' ELSE 'antagonist' END AS role FROM sd WHERE (d_neg = 0 AND d_pos >= 5) OR (d_pos = 0 AND d_neg >= 5)")
def pure_roles(spark: SparkSession, d: str) -> DataFrame:
    s = _signed(spark, d)
    role: Column = F.when((F.col("d_neg") == 0) & (F.col("d_pos") >= 5), "cooperator").when((F.col("d_pos") == 0) & (F.col("d_neg") >= 5), "antagonist")
    return s.select("v", "d_pos", "d_neg", role.alias("role")).filter("role is not null")


_RANKS = f"""{_AR}, bo AS (SELECT v, da.degree AS m1, dr.degree AS m2 FROM da JOIN dr USING (v) WHERE da.degree > 0 OR dr.degree > 0),
rk AS (SELECT v, row_number() OVER (ORDER BY m1 DESC, v) AS rank_1, row_number() OVER (ORDER BY m2 DESC, v) AS rank_2 FROM bo)"""


def _ranks(spark: SparkSession, d: str) -> DataFrame:
    return L.rank_changes(L.degrees(_layer(spark, d)), L.degrees(_layer(spark, d, "rivalry")), "degree")


@_r.query(f"{_RANKS} SELECT v, rank_1, rank_2, rank_2 - rank_1 AS delta, greatest(rank_1, rank_2) AS max_rank FROM rk")
def role_rank_delta(spark: SparkSession, d: str) -> DataFrame:
    return _ranks(spark, d)


@_r.query(f"{_RANKS} SELECT v, rank_1, rank_2, abs(rank_2 - rank_1) AS delta, greatest(rank_1, rank_2) AS max_rank FROM rk ORDER BY max_rank, delta, v LIMIT 15")
def persistence_rank(spark: SparkSession, d: str) -> DataFrame:
    return _ranks(spark, d).withColumn("delta", F.abs("delta")).orderBy("max_rank", "delta", "v").limit(15)


def _rank_pair_sql(tail: str) -> str:
    parts = ", ".join(f"b{n[0]} AS MATERIALIZED (SELECT * FROM ({_of(_A, n)}, sb AS (SELECT v, w, 1 AS m FROM bw), {_betweenness_sql('sb', 'betweenness')} SELECT v, round(betweenness, 9) AS m1 FROM bt))" for n in LAYERS)
    return f"WITH {parts}, bo AS (SELECT v, ba.m1 AS m1, br.m1 AS m2 FROM ba JOIN br USING (v) WHERE ba.m1 > 0 OR br.m1 > 0), rk AS (SELECT v, row_number() OVER (ORDER BY m1 DESC, v) AS rank_1, row_number() OVER (ORDER BY m2 DESC, v) AS rank_2 FROM bo), dl AS (SELECT v, rank_1, rank_2, rank_2 - rank_1 AS delta, greatest(rank_1, rank_2) AS max_rank FROM rk) {tail}"


@_r.query(_rank_pair_sql("SELECT * FROM dl"))
def role_rank_betweenness(spark: SparkSession, d: str) -> DataFrame:
    """Ranks by betweenness in the two layers, of organisations in both that are between others in one."""
    first, second = (Z.betweenness(_layer(spark, d, n)).select("v", F.round("betweenness", 9).alias("betweenness")) for n in LAYERS)
    return L.rank_changes(first, second, "betweenness")


@_r.query(_rank_pair_sql("SELECT 'lost' AS side, v, delta FROM (SELECT * FROM dl ORDER BY delta DESC, v LIMIT 10) UNION ALL SELECT 'won', v, delta FROM (SELECT * FROM dl ORDER BY delta, v LIMIT 10)"))
def rank_delta_ends(spark: SparkSession, d: str) -> DataFrame:
    """The organisations whose rank falls and rises most from the alliance to the rivalry layer."""
    rows = role_rank_betweenness(spark, d).select("v", "delta")
    return C.top(rows, 10, F.desc("delta"), F.asc("v")).select(F.lit("lost").alias("side"), "v", "delta").unionByName(C.top(rows, 10, F.asc("delta"), F.asc("v")).select(F.lit("won").alias("side"), "v", "delta"))


@_r.query(f"{_SIGNED}, {TYPES} SELECT coalesce(type, 'unknown') AS type, count(*) AS n, CAST(sum(d_pos) AS BIGINT) AS d_pos, CAST(sum(d_neg) AS BIGINT) AS d_neg, round(sum(d_pos) / sum(total), 6) AS share FROM sd LEFT JOIN ty USING (v) WHERE total > 0 GROUP BY 1")
def alliance_share(spark: SparkSession, d: str) -> DataFrame:
    return S.alliance_share(_signed(spark, d), vertex_types(spark, d))


@_r.query()
def alliance_share_ci(spark: SparkSession, d: str) -> DataFrame:
    s, t = _signed(spark, d), vertex_types(spark, d)
    return S.alliance_share(s, t).join(S.alliance_share_interval(s, t).drop("n"), "type")


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """The types at the ends of each edge, counted per layer."""
    t = vertex_types(spark, d)
    e = signed(spark, d).filter("relationship <> 'other' and source <> '' and target <> '' and source <> target")
    x = F.coalesce("tx", F.lit("unknown"))
    y = F.coalesce("ty", F.lit("unknown"))
    rows = e.join(t.toDF("source", "tx"), "source", "left").join(t.toDF("target", "ty"), "target", "left")
    return rows.groupBy(F.col("relationship").alias("layer"), F.least(x, y).alias("type_a"), F.greatest(x, y).alias("type_b")).agg(F.count(F.lit(1)).alias("n"))


@_r.query()
def assortativity_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    b = S.bootstrap_assortativity(_cells(spark, d))
    lo, hi = S.normal_interval(F.col("mean"), F.col("se"))
    return b.select("layer", "mean", "se", lo.alias("ci_lo"), hi.alias("ci_hi"))


@_r.query()
def assortativity_test(spark: SparkSession, d: str) -> DataFrame:
    return S.z_test(S.bootstrap_assortativity(_cells(spark, d)), "alliance", "rivalry")


QUERIES, SQL = _r.queries, _r.sql
