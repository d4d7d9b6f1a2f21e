import numpy as np
import pandas as pd
import pytest
from helpers import ids, matrix, pair_table, to_pandas
from pyspark.sql import functions as F

from tessella.errors import EmptyResultError, NotUniqueError
from tessella.functions.gram import block_sums, cross_sums, gram_arrays
from tessella.functions import ranges
from tessella.operators import cca, cluster, correlate, neighbors, project, shape, transforms


def values(rows, cols, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(rows, cols)) @ rng.normal(size=(cols, cols)) + 100


# --- between columns ---

@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
@pytest.mark.parametrize("gaps", [0.0, 0.15])
def test_column_correlations_like_pandas(spark, method, gaps):
    data = values(40, 5)
    if method != "pearson":
        data = np.round(data)
    df, frame = matrix(spark, data, gaps)
    got = pair_table(correlate.column_correlations(df.repartition(3), method))
    if method == "kendall":
        want = pd.DataFrame({b: {a: tau_b(frame[a], frame[b]) for a in frame} for b in frame})
    else:
        want = frame.corr(method, min_periods=2)
    assert len(got) == 25
    for a in frame:
        for b in frame:
            assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-12)


def tau_b(x, y):
    both = x.notna() & y.notna()
    x, y = x[both].to_numpy(), y[both].to_numpy()
    i, j = np.triu_indices(len(x), 1)
    a, b = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
    return (a * b).sum() / np.sqrt(np.abs(a).sum() * np.abs(b).sum())


def test_kendall_over_several_blocks(spark):
    df, frame = matrix(spark, np.round(values(30, 3)))
    rows = correlate._kendall(df, "id", list(frame.columns), None, range_rows=7)
    for r in rows.collect():
        a, b = frame.columns[r["i"]], frame.columns[r["j"]]
        assert r["r"] == pytest.approx(tau_b(frame[a], frame[b]))
        assert r["n"] == 30


@pytest.mark.parametrize("range_rows", [5, 20, 1000])
def test_ranks_from_ranges(spark, range_rows):
    """Values of which one makes up a third, ties and gaps, ranges of a few rows."""
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(size=(90, 4)) + rng.normal(size=(90, 1)), 1)
    x[rng.random((90, 4)) < 0.33] = 0.0
    x[:, 3] = rng.normal(size=90)
    df, frame = matrix(spark, x, 0.1)
    cols = list(frame.columns)
    df = df.union(df.limit(0)).repartition(3)
    for kind, run in (("spearman", lambda *a: correlate._spearman_with_gaps(df, *a, range_rows)),
                      ("kendall", lambda *a: correlate._kendall(df, "id", *a, range_rows))):
        for xs, ys in ((cols, None), (cols[:3], cols[2:])):
            got = {(xs[r["i"]], (ys or xs)[r["j"]]): (r["r"], r["n"]) for r in run(xs, ys).collect()}
            wanted = [(a, b) for i, a in enumerate(xs) for b in (ys or xs[i:])]
            assert set(got) == set(wanted)
            for a, b in wanted:
                both = frame[[a, b]].dropna() if a != b else frame[[a]].dropna()
                own = both[a], both[b]
                r = tau_b(*own) if kind == "kendall" else own[0].rank().corr(own[1].rank())
                assert got[a, b] == (pytest.approx(r), len(both))


def test_inversions():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 17, 64, 100):
        x = rng.integers(0, max(1, n), n)
        assert ranges.inversions(x) == sum(x[i] > x[j] for i in range(n) for j in range(i + 1, n))


def test_close_columns_keep_their_distance(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(0, 1e6, 400)
    x = np.stack([base, base + rng.normal(0, 1e-3, 400), rng.normal(0, 1e6, 400), base], axis=1)
    df, frame = matrix(spark, x, 0.02)
    got = pair_table(correlate.column_distances(df), "distance")
    for i, a in enumerate(frame):
        for b in list(frame)[i + 1:]:
            d = (frame[a] - frame[b]).dropna()
            assert got[a, b] == pytest.approx(np.sqrt((d ** 2).sum() * len(frame) / len(d)), rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("method,block_rows", [("pearson", 7), ("spearman", 100)])
def test_row_medians_without_pairs(spark, method, block_rows):
    x = values(26, 6)
    x[3] = x[4]
    x[5] = 1.0  # constant: no correlation at all
    df, frame = matrix(spark, x, 0.1)
    got = {r["id"]: r["median_cor"] for r in correlate.row_median_correlations(df, method, block_rows=block_rows).collect()}
    want = correlate.median_correlations(correlate.row_correlations(df, method, block_rows=9)).collect()
    assert set(got) == set(frame.index)
    for r in want:
        assert got[r["id"]] == (None if r["median_cor"] is None else pytest.approx(r["median_cor"], abs=1e-12))
    assert got["r0005"] is None


def test_constant_columns_have_no_correlation(spark):
    df, _ = matrix(spark, [[0.1, 1.0], [0.1, 2.0], [0.1, 4.0]])
    got = pair_table(correlate.column_correlations(df))
    assert got["c0", "c1"] is None and got["c0", "c0"] is None
    assert got["c1", "c1"] == pytest.approx(1.0)


def test_cross_sums_block_by_block(spark):
    df, frame = matrix(spark, values(25, 7), 0.1)
    cols = list(frame.columns)

    def table(**options):
        out = cross_sums(df, cols, shift=False, **options).orderBy("i", "j").toPandas()
        return out[["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"]].to_numpy()

    whole = table()
    assert len(whole) == 28
    for options in ({"block": 3}, {"block": 3, "pairs_per_pass": 2}, {"block": 2, "pairs_per_pass": 1}):
        assert np.allclose(whole, table(**options))
    # three blocks make six pairs: a task hands over that many rows, and the sum as many
    assert block_sums(df, cols, block=3).count() == 6
    arrays = gram_arrays(df, cols, shift=False, block=3)
    for i, j, n, sx, sy, sxx, syy, sxy in whole:
        i, j = int(i), int(j)
        assert np.allclose([arrays[k][i, j] for k in ("n", "sx", "sy", "sxx", "syy", "sxy")], [n, sx, sy, sxx, syy, sxy])
        assert np.allclose([arrays[k][j, i] for k in ("n", "sx", "sy", "sxx", "syy", "sxy")], [n, sy, sx, syy, sxx, sxy])
    two = cross_sums(df, cols[:4], cols[4:], block=2, pairs_per_pass=1).count()
    assert two == 12


def test_cross_sums_keep_keys_apart(spark):
    df, frame = matrix(spark, values(20, 3))
    keyed = df.withColumn("k", F.substring("id", -1, 1).cast("int") % 2)
    got = cross_sums(keyed, list(frame.columns), keys=["k"], shift=False)
    odd = frame[[int(i[-1]) % 2 == 1 for i in frame.index]]
    cell = got.where("k = '1' and i = 0 and j = 2").first()
    assert cell["sxy"] == pytest.approx((odd["c0"] * odd["c2"]).sum())
    assert cell["n"] == len(odd)


def test_distances(spark):
    df, frame = matrix(spark, values(12, 4), 0.1)
    d = frame.to_numpy()
    by_row = pair_table(correlate.row_distances(df, block_rows=5), "distance")
    by_col = pair_table(correlate.column_distances(df), "distance")

    def scaled(a, b):
        both = ~np.isnan(a) & ~np.isnan(b)
        return np.sqrt(((a - b)[both] ** 2).sum() * len(a) / both.sum())

    assert by_row["r0001", "r0007"] == pytest.approx(scaled(d[1], d[7]), rel=1e-9)
    assert by_col["c1", "c3"] == pytest.approx(scaled(d[:, 1], d[:, 3]), rel=1e-6)
    assert len(by_row) == 12 * 11


# --- between rows and across matrices ---

@pytest.mark.parametrize("method", ["pearson", "spearman"])
@pytest.mark.parametrize("gaps", [0.0, 0.2])
def test_row_correlations_over_blocks(spark, method, gaps):
    df, frame = matrix(spark, np.round(values(14, 9, 1)), gaps)
    want = frame.T.corr(method, min_periods=2)
    got = pair_table(correlate.row_correlations(df, method, block_rows=4))
    assert len(got) == 14 * 14
    for a in frame.index:
        for b in frame.index:
            if np.isnan(want.loc[a, b]):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)


def test_repeated_ids_are_refused(spark):
    df, _ = matrix(spark, values(3, 3))
    with pytest.raises(NotUniqueError):
        correlate.row_correlations(df.union(df))


@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_cross_cor_of_columns(spark, method):
    x, fx = matrix(spark, np.round(values(20, 3, 1)), 0.05, 1)
    y, fy = matrix(spark, np.round(values(25, 2, 2)), cols=["c0", "z"])
    got = to_pandas(correlate.cross_cor_wide(correlate.integrate_cross_cor(x, y, method=method)))
    assert list(got.index) == ["c0", "z"] and list(got.columns) == ["c0", "c1", "c2"]
    shared = fx.index
    for a in fx:
        for b in fy:
            want = (tau_b(fx[a], fy.loc[shared, b]) if method == "kendall" else
                    pd.concat([fx[a].rename("a"), fy.loc[shared, b].rename("b")],
                              axis=1).dropna().corr(method).iloc[0, 1])
            assert got.loc[b, a] == pytest.approx(want, abs=1e-12)


def test_cross_cor_of_rows(spark):
    x, fx = matrix(spark, values(6, 8, 1))
    y, fy = matrix(spark, values(5, 8, 2), prefix="y")
    got = to_pandas(correlate.cross_cor_wide(
        correlate.integrate_cross_cor(x, y, axis=1, block_rows=3), axis=1))
    assert got.shape == (6, 5)
    assert got.loc["r0002", "y0003"] == pytest.approx(np.corrcoef(fx.iloc[2], fy.iloc[3])[0, 1])


def test_cross_cor_reports_shared_ids(spark):
    x, _ = matrix(spark, values(5, 2))
    y, _ = matrix(spark, values(4, 2))
    z, _ = matrix(spark, values(4, 2), prefix="other")
    with pytest.warns(UserWarning, match="4 of 5"):
        correlate.integrate_cross_cor(x, y, check=True)
    with pytest.raises(EmptyResultError):
        correlate.integrate_cross_cor(x, z, check=True)
    with pytest.raises(EmptyResultError):
        correlate.integrate_cross_cor(x, y.toDF("id", "p", "q"), axis=1)


def test_median_correlations_include_the_diagonal(spark):
    df, frame = matrix(spark, values(30, 4))
    got = correlate.median_correlations(correlate.column_correlations(df))
    want = frame.corr().median()
    for r in got.collect():
        assert r["median_cor"] == pytest.approx(want[r["id"]])
    top = correlate.top_correlated(got, "lowest", k=2).collect()
    assert [r["id"] for r in top] == list(want.sort_values().index[:2])
    assert correlate.correlation_summary(got).first()["mean"] == pytest.approx(want.mean())


def brute_correlated(frame, cutoff):
    r = frame.T.corr().abs().to_numpy()
    np.fill_diagonal(r, np.nan)
    mean = np.round(np.nanmean(r, axis=1), 12)
    gone = set()
    for i in range(len(r)):
        for j in range(i + 1, len(r)):
            if r[i, j] > cutoff:
                gone.add(i if mean[i] >= mean[j] else j)
    return [n for k, n in enumerate(frame.index) if k not in gone]


@pytest.mark.parametrize("block_rows", [None, 4])
def test_max_correlation(spark, block_rows):
    data = values(15, 6, 4)
    data[5], data[9], data[12] = data[0] * 2, data[0] + 1, -data[3]
    df, frame = matrix(spark, data)
    got = correlate.filter_rows_max_correlation(df, 0.9, block_rows=block_rows)
    assert ids(got) == brute_correlated(frame, 0.9)
    left = np.abs(frame.loc[ids(got)].T.corr().to_numpy())
    assert left[np.triu_indices(len(left), 1)].max() <= 0.9


def test_a_third_of_the_rows_being_copies(spark):
    data = values(60, 5, 6)
    data[::3] = data[0]
    df, _ = matrix(spark, data)
    kept = ids(correlate.filter_rows_max_correlation(df, 0.99, block_rows=16))
    assert sum(int(i[1:]) % 3 == 0 for i in kept) == 1


# --- projection ---

def numpy_pca(data, k, scale=False):
    z = data - data.mean(0)
    if scale:
        z = z / data.std(0, ddof=1)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    sign = np.sign(vt[np.arange(len(vt)), np.abs(vt).argmax(1)])
    return (u * s * sign)[:, :k], (s ** 2 / (len(data) - 1))


@pytest.mark.parametrize("scale", [False, True])
def test_pca_of_rows_as_observations(spark, scale):
    df, frame = matrix(spark, values(30, 6))
    scores, variance = numpy_pca(frame.to_numpy(), 3, scale)
    got = to_pandas(project.project_pca(df, num_dims=3, scale=scale))
    assert list(got.columns) == ["PC1", "PC2", "PC3"]
    assert np.allclose(got, scores, atol=1e-8)
    table = project.pca_variance(df, num_dims=6, scale=scale).toPandas()
    assert np.allclose(table["variance"], variance, atol=1e-8)
    assert table["cumulative"].iloc[-1] == pytest.approx(100)


def test_whitened_components_have_unit_variance(spark):
    df, _ = matrix(spark, values(30, 4))
    got = to_pandas(project.project_pca(df, num_dims=3, whiten=True))
    assert np.allclose(got.var(ddof=1), 1.0)
    turned = to_pandas(project.project_pca(df, target="rows", num_dims=2, whiten=True))
    assert np.allclose(turned.var(axis=1, ddof=1), 1.0)


@pytest.mark.parametrize("scale", [False, True])
def test_pca_of_columns_as_observations(spark, scale):
    df, frame = matrix(spark, values(40, 5))
    scores, variance = numpy_pca(frame.to_numpy().T, 4, scale)
    got = to_pandas(project.project_pca(df, target="rows", num_dims=4, scale=scale)).to_numpy()
    assert got.shape == (4, 5)
    # the sign rule differs: the largest score is positive
    scores = scores * np.sign(scores[np.abs(scores).argmax(0), np.arange(4)])
    assert np.allclose(got.T, scores, atol=1e-7)
    table = project.pca_variance(df, target="rows", num_dims=4, scale=scale).toPandas()
    assert np.allclose(table["variance"], variance[:4], rtol=1e-9)


def test_pca_refuses_missing_cells(spark):
    df, _ = matrix(spark, values(6, 3), 0.2)
    with pytest.raises(Exception, match="unable to perform PCA"):
        project.project_pca(df, num_dims=2).collect()


def test_robust_pca(spark):
    data = values(50, 4)
    data[7] = 1e4
    df, frame = matrix(spark, data)
    z = (data - np.median(data, 0))
    z = z / (np.median(np.abs(z), 0) / 0.674489750196082)
    u = z / np.linalg.norm(z, axis=1, keepdims=True)
    w, v = np.linalg.eigh(u.T @ u / len(u))
    v = v[:, ::-1][:, :2]
    v = v * np.sign(v[np.abs(v).argmax(0), [0, 1]])
    assert np.allclose(to_pandas(project.robust_pca(df)), z @ v, atol=1e-6)


# --- neighbours ---

def brute_impute(frame, k):
    x, out = frame.to_numpy(), frame.to_numpy().copy()
    for i, c in np.argwhere(np.isnan(x)):
        best = []
        for j in range(len(x)):
            both = ~np.isnan(x[i]) & ~np.isnan(x[j])
            if np.isnan(x[j, c]) or not both.any():
                continue
            best.append((np.sqrt(((x[i] - x[j])[both] ** 2).sum() * x.shape[1] / both.sum()), j))
        near = [x[j, c] for _, j in sorted(best)[:k]]
        out[i, c] = np.mean(near) if near else np.nanmean(x[:, c])
    return out


@pytest.mark.parametrize("block_rows", [None, 6])
def test_impute_knn(spark, block_rows):
    data = values(25, 5)
    df, frame = matrix(spark, data, 0.15)
    # a row with nothing to compare by takes the column means
    frame.iloc[3] = np.nan
    df = df.select("id", *[F.when(F.col("id") != "r0003", F.col(c)).alias(c) for c in frame])
    got = to_pandas(neighbors.impute_knn(df, k=4, block_rows=block_rows))
    assert np.allclose(got, brute_impute(frame, 4))


@pytest.mark.parametrize("block_rows", [None, 7])
def test_knn_graph(spark, block_rows):
    df, frame = matrix(spark, values(30, 4))
    d = np.linalg.norm(frame.to_numpy()[:, None] - frame.to_numpy()[None], axis=2)
    np.fill_diagonal(d, np.inf)
    got = neighbors.knn_graph(df, k=3, metric="euclidean", block_rows=block_rows).toPandas()
    assert len(got) == 90
    for _, row in got.iterrows():
        want = np.argsort(d[int(row["id"][1:])])[row["rank"] - 1]
        assert row["neighbor"] == f"r{want:04d}"


@pytest.mark.parametrize("n", [6, 7])
def test_negative_median_correlation(spark, n):
    seen = set()
    for seed in range(6):
        df, frame = matrix(spark, np.random.default_rng(seed).normal(size=(n, 40)) + seed / 2)
        if seed % 2:
            frame = frame + np.linspace(0, 4, 40)
            df, frame = matrix(spark, frame.to_numpy())
        want = bool(frame.T.corr().median().min() < 0)
        assert correlate.has_negative_median(df, block_rows=3) == want
        seen.add(want)
    assert seen == {True, False}


def test_knn_graph_settings(spark):
    assert [neighbors.layout_neighbors(n) for n in (3, 40, 200, 20_000)] == [2, 5, 20, 500]
    df, _ = matrix(spark, np.random.default_rng(0).normal(size=(20, 5)))
    got = neighbors.knn_graph(df, 5, neighbors.layout_metric(df)).toPandas()
    assert got.groupby("id").size().eq(5).all()


@pytest.mark.parametrize("offset", [1e6, 1e8])
def test_distances_do_not_cancel(spark, offset):
    x = np.random.default_rng(1).normal(size=(40, 6)) + offset * np.arange(6)
    x[1] = x[0] + 1e-3  # close for its length
    df, frame = matrix(spark, x)
    x = frame.to_numpy()
    want = np.linalg.norm(x[:, None] - x[None], axis=2)
    for row in correlate.row_distances(df, block_rows=16).collect():
        i, j = int(row["x_id"][1:]), int(row["y_id"][1:])
        assert row["distance"] == pytest.approx(want[i, j], rel=1e-9)
    for row in correlate.column_distances(df).collect():
        i, j = int(row["x_id"][1:]), int(row["y_id"][1:])
        assert row["distance"] == pytest.approx(np.linalg.norm(x[:, i] - x[:, j]), rel=1e-9)
    got = neighbors.knn_graph(df, 3, block_rows=16).toPandas()
    np.fill_diagonal(want, np.inf)
    near = np.argsort(want, axis=1)
    assert all(r["neighbor"] == f"r{near[int(r['id'][1:]), r['rank'] - 1]:04d}" for _, r in got.iterrows())


def test_cosine_keeps_rows_with_gaps_and_without_length(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 1.0), ("c", 0.0, 0.0), ("d", 1.0, 3.0)],
                               "id string, x double, y double")
    got = neighbors.knn_graph(df, 3, "cosine").toPandas()
    assert got.groupby("id").size().to_dict() == {"a": 3, "b": 3, "c": 3, "d": 3}
    assert (got[got["id"] == "c"]["distance"] == 1.0).all()


def test_neighbors_of_far_blocks_are_left_out(spark, monkeypatch):
    """Rows in clusters, a third of them equal: the same neighbours from fewer pairs of blocks."""
    rng = np.random.default_rng(9)
    x = rng.choice([-50.0, 50.0], (12, 4))[rng.integers(0, 12, 240)] + rng.normal(size=(240, 4))
    x[::3] = x[0]
    df, frame = matrix(spark, x)
    seen = []
    pruned = neighbors._pruned
    monkeypatch.setattr(neighbors, "_pruned", lambda *a: seen.append(pruned(*a)) or seen[-1])
    got = neighbors.knn_graph(df, 3, block_rows=15).toPandas().set_index(["id", "rank"]).sort_index()
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :3]  # ids are in the order of the rows
    want = frame.index.to_numpy()[order]
    assert got["neighbor"].tolist() == want.ravel().tolist()
    assert np.allclose(got["distance"], np.take_along_axis(d, order, axis=1).ravel(), atol=1e-9)
    (_, met, every), = seen
    assert met < 0.7 * every


@pytest.mark.parametrize("offset, n, k", [(0.0, 3000, 5), (1e7, 3000, 5), (0.0, 70, 66), (0.0, 9, 12)])
def test_neighbors_of_complete_rows(offset, n, k, monkeypatch):
    """The k nearest from one product and few differences: every seventh row the same, own rows left out."""
    x = np.random.default_rng(3).normal(size=(n, 8)) + offset
    x[::7] = x[0]
    some = x[2:n // 2]
    d = np.sqrt(((some[:, None] - x[None]) ** 2).sum(axis=2))
    d[np.arange(len(some)), np.arange(2, n // 2)] = np.inf
    near = np.argsort(d, axis=1, kind="stable")[:, :min(k, n - 1)]
    monkeypatch.setattr(neighbors, "DISTANCE_CELLS", 20 * n)
    i, j, got = neighbors._nearest_complete(some, x, np.arange(2, n // 2), k)
    assert i.tolist() == np.repeat(np.arange(len(some)), near.shape[1]).tolist()
    assert j.tolist() == near.ravel().tolist()
    assert got.tolist() == np.take_along_axis(d, near, axis=1).ravel().tolist()
    assert neighbors._nearest_complete(some * 1e200, x, np.arange(2, n // 2), k) is None


def test_complete_rows_are_not_compared_cell_by_cell(spark, monkeypatch):
    """The distances of all pairs are worked out only where a cell is missing."""
    monkeypatch.setattr(neighbors, "_euclidean", None)  # fails where it is called
    df, frame = matrix(spark, np.random.default_rng(5).normal(size=(40, 4)))
    d = np.linalg.norm(frame.to_numpy()[:, None] - frame.to_numpy()[None], axis=2)
    np.fill_diagonal(d, np.inf)
    got = neighbors.knn_graph(df, 3).toPandas().sort_values(["id", "rank"])
    assert got["neighbor"].tolist() == frame.index.to_numpy()[np.argsort(d, axis=1)[:, :3]].ravel().tolist()


def test_random_components_of_a_wide_matrix(spark):
    """Three strong directions among 40 columns, from 13 directions."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 3)) @ (rng.normal(size=(3, 40)) * 5) + rng.normal(size=(60, 40)) * 0.05 + 7
    df, frame = matrix(spark, x)
    for whiten in (False, True):
        got, want = (project.project_pca(df, num_dims=3, whiten=whiten, method=m).toPandas().set_index("id").sort_index()
                     for m in ("random", "exact"))
        assert np.allclose(got, want, atol=1e-4)
    got, want = (project.pca_variance(df, num_dims=3, method=m).toPandas() for m in ("random", "exact"))
    assert np.allclose(got.iloc[:, 1:], want.iloc[:, 1:], rtol=1e-4)
    with pytest.raises(ValueError):
        project.project_pca(df, method="other")


# --- clustering ---

def sequential_average_linkage(x, k):
    groups = {i: [i] for i in range(len(x))}
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    while len(groups) > k:
        best = min(((d[np.ix_(groups[a], groups[b])].mean(), a, b)
                    for a in groups for b in groups if a < b))
        groups[best[1]] += groups.pop(best[2])
    return sorted(sorted(g) for g in groups.values())


@pytest.mark.parametrize("small,block_rows", [(2048, None), (6, 9), (2, 16)])
def test_hclust(spark, small, block_rows):
    x = np.random.default_rng(8).normal(size=(40, 3))
    df, frame = matrix(spark, x)
    for k in (1, 3, 7) if small > 40 else (3,):  # rounds make one tree, wherever it is cut
        got = cluster.cluster_hclust(df, k, small=small, block_rows=block_rows).toPandas()
        made = got.groupby("clusters")["id"].apply(lambda s: sorted(int(i[1:]) for i in s))
        assert sorted(made) == sequential_average_linkage(x, k)
        # numbered by the smallest member
        assert [made[f"cluster_{i}"][0] for i in range(k)] == sorted(m[0] for m in made)


def test_hclust_with_ties_and_gaps(spark):
    x = np.array([[0.0], [0.0], [1.0], [1.0], [5.0], [6.0], [5.5], [20.0]])
    df, _ = matrix(spark, x)
    for small in (2048, 1, 3):
        got = {r["id"]: r["cluster"] for r in cluster.hclust(df, 3, small=small).collect()}
        assert list(got[f"r000{i}"] for i in range(8)) == ["cluster_0"] * 4 + ["cluster_1"] * 3 + ["cluster_2"]
    for bad in (None, float("nan"), float("inf")):
        rows = df.union(spark.createDataFrame([("x", bad)], "id string, c0 double"))
        with pytest.raises(ValueError):
            cluster.hclust(rows, 2)


def test_hclust_of_a_single_row(spark):
    df, _ = matrix(spark, [[1.0, 2.0]])
    assert cluster.hclust(df, 1).first()["cluster"] == "cluster_0"
    with pytest.raises(ValueError):
        cluster.hclust(df, 2)


# --- canonical correlation ---

def test_cca_finds_the_shared_signal(spark):
    rng = np.random.default_rng(1)
    signal = rng.normal(size=60)
    x = rng.normal(size=(60, 4))
    y = rng.normal(size=(60, 3))
    x[:, 1] += 3 * signal
    y[:, 2] += 3 * signal
    dx, fx = matrix(spark, x)
    dy, fy = matrix(spark, y)
    got = cca.integrate_cca(dx, dy, permutations=12).orderBy("penalty").toPandas()
    assert len(got) == 10
    assert (got["p_value"] == 0).all() and (got["z"] > 2).all()
    # the strictest penalty keeps one column of each side
    assert got["correlation"].iloc[0] == pytest.approx(np.corrcoef(x[:, 1], y[:, 2])[0, 1])
    again = cca.integrate_cca(dx, dy, permutations=12).orderBy("penalty").toPandas()
    assert np.allclose(got, again)


def test_cca_of_noise(spark):
    rng = np.random.default_rng(3)
    dx, _ = matrix(spark, rng.normal(size=(50, 4)))
    dy, _ = matrix(spark, rng.normal(size=(50, 4)))
    got = cca.integrate_cca(dx, dy, permutations=20).toPandas()
    assert (got["p_value"] > 0).any()
    assert (got["correlation"].abs() <= 1).all()


def test_soft_threshold_meets_its_bound():
    v = np.array([3.0, -1.0, 0.5, 0.2])
    for bound in (1.0, 1.2, 1.5, 5.0):
        s = cca.shrink_to(v, bound)
        assert np.linalg.norm(s) == pytest.approx(1)
        assert np.abs(s).sum() <= bound + 1e-5


# --- transforms and shape ---

def test_transforms(spark):
    df, frame = matrix(spark, np.abs(values(12, 4)), 0.1)
    assert np.allclose(to_pandas(transforms.transform_cpm(df)).sum(), 1e6)
    assert np.allclose(to_pandas(transforms.transform_log2(df)), np.log2(frame), equal_nan=True)
    assert np.allclose(to_pandas(transforms.transform_log2p(df)), np.log2(frame + 1), equal_nan=True)
    by_col = (frame - frame.mean()) / frame.std(ddof=0)
    assert np.allclose(to_pandas(transforms.transform_zscore(df)), by_col, equal_nan=True)
    by_row = frame.sub(frame.mean(axis=1), axis=0).div(frame.std(axis=1, ddof=0), axis=0)
    assert np.allclose(to_pandas(transforms.transform_zscore(df, axis=1)), by_row, equal_nan=True)
    assert (to_pandas(transforms.missing_indicator(df)) == frame.isna()).all().all()
    with pytest.raises(ValueError):
        transforms.transform_zscore(df, axis=2)


def test_edge_cells(spark):
    df, _ = matrix(spark, [[-1.0, 0.0], [-4.0, 0.0]])
    assert transforms.transform_log2p(df).orderBy("id").first()["c0"] is None
    assert transforms.transform_log2(df).orderBy("id").first()["c1"] is None
    assert transforms.transform_cpm(df).orderBy("id").first()["c1"] is None
    assert transforms.transform_zscore(df).orderBy("id").first()["c1"] is None
    signed = transforms.transform_signed_log2(df).orderBy("id").collect()
    assert signed[0]["c0"] == -1.0 and signed[0]["c1"] == 0.0


def test_transpose_twice_is_the_same(spark):
    df, frame = matrix(spark, values(5, 3), 0.1)
    turned = shape.transpose_data(df)
    assert np.allclose(to_pandas(turned), frame.T, equal_nan=True)
    assert np.allclose(to_pandas(shape.transpose_data(turned)), frame, equal_nan=True)


def test_pivot(spark):
    df, frame = matrix(spark, values(5, 3))
    long = shape.unpivot(df)
    assert long.count() == 15
    assert np.allclose(to_pandas(shape.pivot_wide(long, "col_id", "value")), frame)
    with pytest.raises(Exception, match="more than once"):
        shape.pivot_wide(long.union(long), "col_id", "value").collect()
