"""Correlation, distance, projection, imputation, clustering and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (DAYS, DIMS, EMBEDDINGS, MONTHS, TYPES, USER_DAYS, USER_TYPES,
                            USER_WEEKDAYS, WEEKDAYS, embedding_wide, long_sql, part_months,
                            part_months_sql, user_days, user_types, user_weekdays, with_ctes)
from catalog.registry import query, r, rounded
from tessella.operators import cca, cluster, correlate, neighbors, project

T_COLS = [f"t_{t}" for t in TYPES]


def pair_sql(left: str = "l", right: str = "l", same: bool = True, value: str = "corr(a.value, b.value)",
             name: str = "r", places: int = 6, strict: bool = False) -> str:
    test = ("WHERE a.col_id < b.col_id" if strict else "WHERE a.col_id <= b.col_id") if same else ""
    return f"""SELECT a.col_id AS x_id, b.col_id AS y_id, {r(value, places)} AS {name}, count(*) AS n
FROM (SELECT * FROM {left} WHERE value IS NOT NULL) a
JOIN (SELECT * FROM {right} WHERE value IS NOT NULL) b ON a.row_id = b.row_id {test} GROUP BY 1, 2"""


def ordered(df):
    """Pairs with the smaller name first, as the SQL lists them."""
    swap = F.col("x_id") > F.col("y_id")
    return df.withColumns({"x_id": F.when(swap, F.col("y_id")).otherwise(F.col("x_id")),
                           "y_id": F.when(swap, F.col("x_id")).otherwise(F.col("y_id"))})


EM_LONG = [EMBEDDINGS, long_sql("l", "em", "vec_id", DIMS)]
UD_LONG = [USER_DAYS, long_sql("l", "ud", "user_id", DAYS)]


@query("column_correlations", with_ctes(*EM_LONG, pair_sql()))
def _(spark, sf):
    return rounded(ordered(correlate.column_correlations(embedding_wide(spark, sf))))


@query("column_correlations_with_gaps", with_ctes(*UD_LONG, pair_sql()))
def _(spark, sf):
    return rounded(ordered(correlate.column_correlations(user_days(spark, sf))))


def ranked_sql(out: str, source: str, keys: str, value: str) -> str:
    return f"""{out} AS (SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY {value})
  + (count(*) OVER (PARTITION BY {keys}, {value}) - 1) / 2.0 AS rk_{value} FROM {source})"""


@query("column_correlations_spearman", with_ctes(
    USER_TYPES, f"full_ut AS (SELECT user_id, {', '.join(f'coalesce({c}, 0) AS {c}' for c in T_COLS)} FROM ut)",
    long_sql("l0", "full_ut", "user_id", T_COLS), ranked_sql("l1", "l0", "col_id", "value"),
    "l AS (SELECT row_id, col_id, rk_value AS value FROM l1)", pair_sql()))
def _(spark, sf):
    df = user_types(spark, sf).na.fill(0.0)  # no events: nothing spent
    return rounded(ordered(correlate.column_correlations(df, "spearman")))


GAP_COLS = DAYS


@query("column_correlations_spearman_with_gaps", with_ctes(
    USER_DAYS, long_sql("l", "ud", "user_id", GAP_COLS),
    """p AS (SELECT a.col_id AS x_id, b.col_id AS y_id, a.value AS x, b.value AS y
  FROM l a JOIN l b ON a.row_id = b.row_id
  WHERE a.col_id <= b.col_id AND a.value IS NOT NULL AND b.value IS NOT NULL)""",
    ranked_sql("p1", "p", "x_id, y_id", "x"), ranked_sql("p2", "p1", "x_id, y_id", "y"),
    f"SELECT x_id, y_id, {r('corr(rk_x, rk_y)')} AS r, count(*) AS n FROM p2 GROUP BY 1, 2"))
def _(spark, sf):
    df = user_days(spark, sf).select("user_id", *GAP_COLS)
    return rounded(ordered(correlate.column_correlations(df, "spearman")))


@query("column_correlations_kendall", with_ctes(
    part_months_sql("bm", "p_brand"), long_sql("l", "bm", "p_brand", MONTHS),
    """v AS (SELECT * FROM l WHERE value IS NOT NULL)""",
    """d AS (SELECT a.row_id AS i, b.row_id AS j, a.col_id, sign(a.value - b.value) AS s
  FROM v a JOIN v b ON a.col_id = b.col_id WHERE a.row_id < b.row_id)""",
    """t AS (SELECT a.col_id AS x_id, b.col_id AS y_id, sum(a.s * b.s) AS s, sum(abs(a.s)) AS tx,
  sum(abs(b.s)) AS ty FROM d a JOIN d b ON a.i = b.i AND a.j = b.j
  WHERE a.col_id <= b.col_id GROUP BY 1, 2)""",
    """n AS (SELECT a.col_id AS x_id, b.col_id AS y_id, count(*) AS n FROM v a JOIN v b
  ON a.row_id = b.row_id GROUP BY 1, 2)""",
    f"SELECT t.x_id, t.y_id, {r('s / sqrt(tx * ty)')} AS r, n FROM t JOIN n ON t.x_id = n.x_id AND t.y_id = n.y_id"))
def _(spark, sf):
    df = part_months(spark, sf, "p_brand")
    return rounded(ordered(correlate.column_correlations(df, "kendall")))


@query("column_distances", with_ctes(*EM_LONG, pair_sql(
    value="sqrt(sum((a.value - b.value) * (a.value - b.value)))", name="distance", strict=True)))
def _(spark, sf):
    return rounded(ordered(correlate.column_distances(embedding_wide(spark, sf))))


@query("row_distances", with_ctes(
    part_months_sql("sm", "p_size"), long_sql("l0", "sm", "p_size", MONTHS),
    "l AS (SELECT col_id AS row_id, row_id AS col_id, value FROM l0)", pair_sql(
        value="sqrt(sum((a.value - b.value) * (a.value - b.value)) * 12 / count(*))",
        name="distance", strict=True, places=4)))
def _(spark, sf):
    return rounded(correlate.row_distances(part_months(spark, sf, "p_size")), 4)


@query("row_correlations_spearman", with_ctes(
    part_months_sql("sm", "p_brand"), long_sql("l0", "sm", "p_brand", MONTHS),
    ranked_sql("l1", "l0", "row_id", "value"),
    "l AS (SELECT col_id AS row_id, row_id AS col_id, rk_value AS value FROM l1)", pair_sql()))
def _(spark, sf):
    return rounded(correlate.row_correlations(part_months(spark, sf, "p_brand"), "spearman"))


BOTH = [USER_TYPES, USER_WEEKDAYS, long_sql("lx", "ut", "user_id", T_COLS),
        long_sql("ly", "uw", "user_id", WEEKDAYS)]


@query("cross_cor_columns", with_ctes(*BOTH, pair_sql("lx", "ly", same=False)))
def _(spark, sf):
    return rounded(correlate.integrate_cross_cor(user_types(spark, sf), user_weekdays(spark, sf)))


@query("cross_cor_wide", with_ctes(*BOTH, "p AS (" + pair_sql("lx", "ly", same=False) + ")",
                                   "SELECT y_id, " + ", ".join(
    f"max(CASE WHEN x_id = '{c}' THEN r END) AS {c}" for c in T_COLS) + " FROM p GROUP BY 1"))
def _(spark, sf):
    pairs = correlate.integrate_cross_cor(user_types(spark, sf), user_weekdays(spark, sf))
    return rounded(correlate.cross_cor_wide(pairs, names=T_COLS))


@query("cross_cor_rows", with_ctes(
    part_months_sql("bm", "p_brand"), part_months_sql("tm", "p_type"),
    long_sql("x0", "bm", "p_brand", MONTHS), long_sql("y0", "tm", "p_type", MONTHS),
    "lx AS (SELECT col_id AS row_id, row_id AS col_id, value FROM x0)",
    "ly AS (SELECT col_id AS row_id, row_id AS col_id, value FROM y0)",
    pair_sql("lx", "ly", same=False)))
def _(spark, sf):
    return rounded(correlate.integrate_cross_cor(
        part_months(spark, sf, "p_brand"), part_months(spark, sf, "p_type"), axis=1))


# pairs in both directions, medians per column
MEDIANS = [*EM_LONG, """w AS (SELECT a.col_id AS id, corr(a.value, b.value) AS r
  FROM l a JOIN l b ON a.row_id = b.row_id GROUP BY a.col_id, b.col_id)""",
           "md AS (SELECT id, median(r) AS m FROM w GROUP BY 1)"]


def medians(spark, sf):
    return correlate.median_correlations(correlate.column_correlations(embedding_wide(spark, sf)))


@query("median_correlations", with_ctes(*MEDIANS, f"SELECT id, {r('m')} AS median_cor FROM md"))
def _(spark, sf):
    return rounded(medians(spark, sf))


@query("correlation_summary", with_ctes(
    *MEDIANS, f"SELECT {r('avg(m)')} AS mean, {r('median(m)')} AS median FROM md"))
def _(spark, sf):
    return rounded(correlate.correlation_summary(medians(spark, sf)))


for which, order in (("highest", "m DESC"), ("lowest", "m"), ("closest_to_zero", "abs(m)")):
    @query(f"top_correlated_{which}", with_ctes(
        *MEDIANS, f"SELECT id, {r('m')} AS median_cor FROM md ORDER BY {order}, id LIMIT 10"))
    def _(spark, sf, which=which):
        return rounded(correlate.top_correlated(medians(spark, sf), which))


# --- projections: SQL has no eigenvectors; the tests compare with numpy ---

@query("project_pca_columns")
def _(spark, sf):
    return rounded(project.project_pca(embedding_wide(spark, sf), num_dims=5))


@query("project_pca_whiten")
def _(spark, sf):
    return rounded(project.project_pca(embedding_wide(spark, sf), num_dims=5, whiten=True))


@query("project_pca_rows")
def _(spark, sf):
    return rounded(project.project_pca(embedding_wide(spark, sf), target="rows", num_dims=5))


@query("pca_variance_columns")
def _(spark, sf):
    return rounded(project.pca_variance(embedding_wide(spark, sf)))


@query("pca_variance_rows")
def _(spark, sf):
    return rounded(project.pca_variance(embedding_wide(spark, sf), target="rows"))


@query("robust_pca")
def _(spark, sf):
    return rounded(project.robust_pca(embedding_wide(spark, sf)))


# --- neighbours ---

def _knn_sql(k: int, distance: str, combine: str) -> str:
    filled = ", ".join(
        f"{r(f'coalesce({m}, (SELECT v FROM im WHERE im.id = sm.p_size AND im.c = {m!r}))', 4)} AS {m}"
        for m in MONTHS)
    return with_ctes(
        part_months_sql("sm", "p_size", 7), long_sql("l", "sm", "p_size", MONTHS),
        "rg AS (SELECT col_id, max(value) - min(value) AS span FROM l GROUP BY 1)",
        "v AS (SELECT * FROM l JOIN rg USING (col_id) WHERE value IS NOT NULL)",
        f"""d AS (SELECT a.row_id AS id, b.row_id AS donor, {distance} AS dist
  FROM v a JOIN v b ON a.col_id = b.col_id WHERE a.row_id <> b.row_id GROUP BY 1, 2)""",
        """c AS (SELECT g.row_id AS id, g.col_id AS c, v.value, row_number() OVER (
    PARTITION BY g.row_id, g.col_id ORDER BY dist, donor) AS n
  FROM l g JOIN d ON d.id = g.row_id JOIN v ON v.row_id = d.donor AND v.col_id = g.col_id
  WHERE g.value IS NULL)""",
        f"im AS (SELECT id, c, {combine}(value) AS v FROM c WHERE n <= {k} GROUP BY 1, 2)",
        f"SELECT p_size, {filled} FROM sm")


@query("impute_knn", _knn_sql(
    5, "sqrt(sum((a.value - b.value) * (a.value - b.value)) * 12 / count(*))", "avg"))
def _(spark, sf):
    return rounded(neighbors.impute_knn(part_months(spark, sf, "p_size", 7), k=5), 4)


@query("impute_knn_gower", _knn_sql(5, "avg(abs(a.value - b.value) / a.span)", "median"))
def _(spark, sf):
    return rounded(neighbors.impute_knn(part_months(spark, sf, "p_size", 7), k=5, metric="gower",
                                        agg="median"), 4)


def _knn_graph_sql(cell: str) -> str:
    return f"""WITH e AS (SELECT CAST(vec_id AS VARCHAR) AS id, {cell} AS v
  FROM embeddings), d AS (SELECT a.id, b.id AS neighbor, list_distance(a.v, b.v) AS d
  FROM e a JOIN e b ON a.id <> b.id), n AS (SELECT *, row_number() OVER (
  PARTITION BY id ORDER BY d, neighbor) AS rank FROM d)
SELECT id, neighbor, rank, {r('d')} AS distance FROM n WHERE rank <= 5"""


@query("knn_graph", _knn_graph_sql("CAST(embedding AS DOUBLE[])"))
def _(spark, sf):
    found = neighbors.knn_graph(embedding_wide(spark, sf), k=5)
    return rounded(found.withColumn("rank", F.col("rank").cast("long")))


@query("knn_graph_offset", _knn_graph_sql(
    "list_transform(CAST(embedding AS DOUBLE[]), lambda x: x + 10000000)"))
def _(spark, sf):
    wide = embedding_wide(spark, sf)
    moved = wide.select(wide.columns[0], *[(F.col(c) + 1e7).alias(c) for c in wide.columns[1:]])
    found = neighbors.knn_graph(moved, k=5)
    return rounded(found.withColumn("rank", F.col("rank").cast("long")))


@query("knn_graph_default")
def _(spark, sf):
    df = part_months(spark, sf, "p_size")
    return rounded(neighbors.knn_graph(df, neighbors.layout_neighbors(df.count()), neighbors.layout_metric(df)))


# --- clustering and canonical correlation ---

@query("cluster_hclust")
def _(spark, sf):
    # no lines: nothing sold
    return cluster.cluster_hclust(part_months(spark, sf, "p_size").na.fill(0.0), num_clusters=4)


@query("integrate_cca")
def _(spark, sf):
    return rounded(cca.integrate_cca(user_types(spark, sf).na.fill(0.0),  # no events: nothing spent
                                     user_weekdays(spark, sf).na.fill(0.0)))
