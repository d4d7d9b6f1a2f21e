"""Projections, correlation and clustering where SQL has a closed form, and row-side summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (MONTHS, embedding_wide, long_sql, part_months, part_months_sql,
                            with_ctes)
from catalog.matrix import EM_LONG, ordered, pair_sql
from catalog.registry import query, r, rounded
from tessella.functions.gram import cross_sums, named, pearson
from tessella.operators import cca, cluster, correlate, neighbors, project

# two dimensions of all vectors: eigenvalues and eigenvectors of a 2 x 2 matrix are a formula
PAIR = """em AS (SELECT CAST(vec_id AS VARCHAR) AS vec_id, CAST(embedding[1] AS DOUBLE) AS x,
  CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)"""
EIGEN = """l AS (SELECT *, (a + b) / 2 + sqrt((a - b) * (a - b) / 4 + c * c) AS l1,
  (a + b) / 2 - sqrt((a - b) * (a - b) / 4 + c * c) AS l2 FROM s),
n AS (SELECT *, sqrt(c * c + (l1 - a) * (l1 - a)) AS len FROM l),
u AS (SELECT *, c / len AS u1, (l1 - a) / len AS u2 FROM n),
v AS (SELECT *, CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END AS s1,
  CASE WHEN abs(u2) >= abs(u1) THEN -sign(u2) ELSE sign(u1) END AS s2 FROM u)"""
MOMENTS = """s AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, var_samp(y) AS b,
  covar_samp(x, y) AS c FROM em)"""
FIRST, SECOND = "((x - mx) * u1 + (y - my) * u2) * s1", "((y - my) * u1 - (x - mx) * u2) * s2"


def vector_pair(spark, sf):
    wide = embedding_wide(spark, sf)
    return wide.select("vec_id", F.col("e0").alias("x"), F.col("e1").alias("y"))


@query("project_pca_pair", with_ctes(PAIR, MOMENTS, EIGEN,
                                     f"SELECT vec_id, {r(FIRST)} AS PC1, {r(SECOND)} AS PC2 FROM em, v"))
def _(spark, sf):
    return rounded(project.project_pca(vector_pair(spark, sf)))


@query("project_pca_pair_whitened", with_ctes(PAIR, MOMENTS, EIGEN, f"""SELECT vec_id,
  {r(f'{FIRST} / sqrt(l1)')} AS PC1, {r(f'{SECOND} / sqrt(l2)')} AS PC2 FROM em, v"""))
def _(spark, sf):
    return rounded(project.project_pca(vector_pair(spark, sf), whiten=True))


@query("project_pca_pair_random", with_ctes(PAIR, MOMENTS, EIGEN,
                                            f"SELECT vec_id, {r(FIRST)} AS PC1, {r(SECOND)} AS PC2 FROM em, v"))
def _(spark, sf):
    return rounded(project.project_pca(vector_pair(spark, sf), method="random"))


@query("pca_variance_pair", with_ctes(PAIR, "k AS (SELECT abs(corr(x, y)) AS k FROM em)", f"""SELECT
  'PC1' AS component, {r('1 + k')} AS variance, {r('50 * (1 + k)')} AS "percent", {r('50 * (1 + k)')} AS cumulative FROM k
UNION ALL SELECT 'PC2', {r('1 - k')}, {r('50 * (1 - k)')}, 100.0 FROM k"""))
def _(spark, sf):
    return rounded(project.pca_variance(vector_pair(spark, sf)))


# rows as features, two columns as observations: each row is (d, -d), so all variance is in one component
@query("project_pca_rows_pair", with_ctes(PAIR, "d AS (SELECT sqrt(sum((x - y) * (x - y)) / 2) AS d FROM em)", f"""SELECT
  'PC1' AS vec_id, {r('d / sqrt(2)')} AS size_x, {r('d / sqrt(2)')} AS size_y, true AS apart FROM d"""))
def _(spark, sf):
    found = project.project_pca(vector_pair(spark, sf), target="rows", num_dims=1)
    # both scores are equally large: which one is positive is up to rounding
    return rounded(found.select("vec_id", F.abs("x").alias("size_x"), F.abs("y").alias("size_y"),
                                (F.signum("x") == -F.signum("y")).alias("apart")))


@query("pca_variance_rows_pair", with_ctes(PAIR, """SELECT 'PC1' AS component,
  CAST(count(*) FILTER (x <> y) AS DOUBLE) AS variance, 100.0 AS "percent", 100.0 AS cumulative FROM em"""))
def _(spark, sf):
    return rounded(project.pca_variance(vector_pair(spark, sf), target="rows", num_dims=1))


@query("robust_pca_pair", with_ctes(
    PAIR, "p AS (SELECT median(x) AS px, median(y) AS py FROM em)",
    "q AS (SELECT median(abs(x - px)) / 0.674489750196082 AS qx, median(abs(y - py)) / 0.674489750196082 AS qy FROM em, p)",
    "z AS (SELECT vec_id, (x - px) / qx AS x, (y - py) / qy AS y FROM em, p, q)",
    """s AS (SELECT 0.0 AS mx, 0.0 AS my, avg(x * x / (x * x + y * y)) AS a, avg(y * y / (x * x + y * y)) AS b,
  avg(x * y / (x * x + y * y)) AS c FROM z)""", EIGEN,
    f"SELECT vec_id, {r(FIRST, 5)} AS PC1, {r(SECOND, 5)} AS PC2 FROM z, v"))
def _(spark, sf):
    return rounded(project.robust_pca(vector_pair(spark, sf)), 5)


@query("integrate_cca_pair", with_ctes(PAIR, "k AS (SELECT abs(corr(x, y)) AS k FROM em)", f"""SELECT
  {r('0.1 + 0.6 * i / 9')} AS penalty, {r('k')} AS correlation FROM k, range(10) AS t(i)"""))
def _(spark, sf):
    pair = vector_pair(spark, sf)
    found = cca.integrate_cca(pair.select("vec_id", "x"), pair.select("vec_id", "y"), permutations=2)
    return rounded(found.select("penalty", "correlation"))


def _column_graph_sql(distance: str) -> str:
    return with_ctes(*EM_LONG, f"""d AS (SELECT a.col_id AS id, b.col_id AS neighbor, {distance} AS d
  FROM l a JOIN l b ON a.row_id = b.row_id WHERE a.col_id <> b.col_id GROUP BY 1, 2)""",
                     "n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbor) AS rank FROM d)",
                     f"SELECT id, neighbor, rank, {r('d')} AS distance FROM n WHERE rank <= 5")


for metric, distance in (("euclidean", "sqrt(sum((a.value - b.value) * (a.value - b.value)))"),
                         ("cosine", "1 - sum(a.value * b.value) / (sqrt(sum(a.value * a.value)) * sqrt(sum(b.value * b.value)))")):
    @query(f"knn_graph_columns_{metric}", _column_graph_sql(distance))
    def _(spark, sf, metric=metric):
        found = neighbors.knn_graph(embedding_wide(spark, sf), 5, metric, target="columns")
        return rounded(found.withColumn("rank", F.col("rank").cast("long")))


@query("knn_graph_layout", with_ctes(
    part_months_sql("sm", "p_size"), long_sql("l0", "sm", "p_size", MONTHS),
    "l AS (SELECT * FROM l0 WHERE value IS NOT NULL)",
    """w AS (SELECT a.row_id AS id, corr(a.value, b.value) AS k FROM l a JOIN l b ON a.col_id = b.col_id
  GROUP BY a.row_id, b.row_id)""",
    "t AS (SELECT min(m) < 0 AS turned FROM (SELECT median(k) AS m FROM w GROUP BY id))",
    "k AS (SELECT least(500, least(count(*) - 1, greatest(5, round_even(count(*) / 10, 0)))) AS k FROM sm)",
    """d AS (SELECT a.row_id AS id, b.row_id AS neighbor, sum(a.value * b.value) AS dot, sum(a.value * a.value) AS la,
  sum(b.value * b.value) AS lb, sqrt(sum((a.value - b.value) * (a.value - b.value)) * 12 / count(*)) AS far
  FROM l a JOIN l b ON a.col_id = b.col_id WHERE a.row_id <> b.row_id GROUP BY 1, 2)""",
    """e AS (SELECT id, neighbor, CASE WHEN NOT turned THEN far WHEN la * lb > 0 THEN 1 - dot / (sqrt(la) * sqrt(lb))
  ELSE 1 END AS dist FROM d, t)""",
    "n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, neighbor) AS rank FROM e)",
    f"SELECT id, neighbor, rank, {r('dist', 5)} AS distance FROM n, k WHERE rank <= k"))
def _(spark, sf):
    df = part_months(spark, sf, "p_size")
    found = neighbors.knn_graph(df, neighbors.layout_neighbors(df.count()), neighbors.layout_metric(df))
    return rounded(found.withColumn("rank", F.col("rank").cast("long")), 5)


def three_blocks(spark, sf):
    """Column correlations from three blocks of columns."""
    df = embedding_wide(spark, sf)
    cols = df.columns[1:]
    sums = cross_sums(df, cols, block=24, pairs_per_pass=4)
    return named(sums.select("i", "j", pearson().alias("r"), F.col("n").cast("long").alias("n")), cols, cols)


@query("column_correlations_in_blocks", with_ctes(*EM_LONG, pair_sql()))
def _(spark, sf):
    return rounded(ordered(three_blocks(spark, sf).select("x_id", "y_id", "r", "n")))


# --- the row side of correlation summaries ---

ROW_MEDIANS = [part_months_sql("bm", "p_brand"), long_sql("l", "bm", "p_brand", MONTHS),
               """w AS (SELECT a.row_id AS id, corr(a.value, b.value) AS k FROM l a JOIN l b ON a.col_id = b.col_id
  GROUP BY a.row_id, b.row_id)""", "md AS (SELECT id, median(k) AS m FROM w GROUP BY 1)"]


def row_medians(spark, sf):
    return correlate.row_median_correlations(part_months(spark, sf, "p_brand"))


@query("row_median_correlations", with_ctes(*ROW_MEDIANS, f"SELECT id, {r('m')} AS median_cor FROM md"))
def _(spark, sf):
    return rounded(row_medians(spark, sf))


@query("row_correlation_summary", with_ctes(
    *ROW_MEDIANS, f"SELECT {r('avg(m)')} AS mean, {r('median(m)')} AS median FROM md"))
def _(spark, sf):
    return rounded(correlate.correlation_summary(row_medians(spark, sf)))


for which, order in (("highest", "m DESC"), ("lowest", "m"), ("closest_to_zero", "abs(m)")):
    @query(f"row_top_correlated_{which}", with_ctes(
        *ROW_MEDIANS, f"SELECT id, {r('m')} AS median_cor FROM md ORDER BY {order}, id LIMIT 10"))
    def _(spark, sf, which=which):
        return rounded(correlate.top_correlated(row_medians(spark, sf), which))


# --- average linkage: merge by merge in SQL, from lists of members ---

@query("cluster_hclust_merges", with_ctes(
    part_months_sql("sm", "p_size"), long_sql("l", "sm", "p_size", MONTHS),
    """d AS (SELECT a.row_id AS i, b.row_id AS j,
    sqrt(sum((coalesce(a.value, 0) - coalesce(b.value, 0)) * (coalesce(a.value, 0) - coalesce(b.value, 0)))) AS d
  FROM l a JOIN l b ON a.col_id = b.col_id WHERE a.row_id < b.row_id GROUP BY 1, 2)""",
    "f AS (SELECT i, j, row_number() OVER (ORDER BY d, i, j) AS n FROM d)",
    "c AS (SELECT p_size AS id, coalesce((SELECT i FROM f WHERE n = 1 AND j = p_size), p_size) AS root FROM sm)",
    """SELECT id, 'cluster_' || (dense_rank() OVER (ORDER BY root) - 1) AS cluster FROM c"""))
def _(spark, sf):
    df = part_months(spark, sf, "p_size").na.fill(0.0)  # no lines: nothing sold
    return cluster.hclust(df, df.count() - 1)
