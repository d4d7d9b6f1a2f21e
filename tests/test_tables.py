import gzip

import numpy as np
import pyarrow as pa
import pyarrow.feather
import pytest
from helpers import ids, matrix, to_pandas

from tessella.errors import EmptyResultError
from tessella.operators import joins, profile
from tessella.plans import steps
from tessella.sources import readers, sampling, writers


# --- joins ---

@pytest.fixture(scope="module")
def tables(spark):
    a = spark.createDataFrame([("s1", 1.0), ("s2", 2.0), ("s3", 3.0)], "id string, x double")
    b = spark.createDataFrame([("s2", 20.0), ("s1", 10.0), ("s3", 30.0)], "id string, x double")
    short = spark.createDataFrame([("s2", 5.0)], "sample string, z double")
    return a, b, short


def test_merge_features(tables):
    a, b, short = tables
    got = joins.merge_features({"a": a, "b": b})
    assert got.columns == ["id", "a_x", "b_x"]
    assert sorted(map(tuple, got.collect())) == [("s1", 1, 10), ("s2", 2, 20), ("s3", 3, 30)]
    with pytest.raises(ValueError, match="overlap"):
        joins.merge_features({"a": a, "b": b}, include_column_prefix=False)
    with pytest.raises(Exception, match="do not match"):
        joins.merge_features({"a": a, "c": short}).collect()
    # also the other way round: the leading table lacks ids
    with pytest.raises(Exception, match="do not match"):
        joins.merge_features({"c": short, "a": a}).collect()
    loose = joins.merge_features({"a": a, "c": short}, allow_mismatched_indices=True)
    assert sorted(map(tuple, loose.collect())) == [("s1", 1, None), ("s2", 2, 5), ("s3", 3, None)]


def test_training_set(tables, spark, tmp_path):
    a, b, short = tables
    response = spark.createDataFrame([("s1", 1, None), ("s2", 2, 7.5)],
                                     "id string, d1 int, d2 double")
    got = joins.training_set({"a": a}, response, allow_mismatched_indices=True)
    assert got.columns == ["id", "a_x", "response_name", "response"]
    rows = {(r["id"], r["response_name"]): r["response"] for r in got.collect()}
    # rows without a response stay, for every response
    assert rows == {("s1", "d1"): 1.0, ("s2", "d1"): 2.0, ("s3", "d1"): None,
                    ("s1", "d2"): None, ("s2", "d2"): 7.5, ("s3", "d2"): None}
    path = writers.write_training_sets(got, str(tmp_path / "sets"))
    assert sorted(p.name for p in (tmp_path / "sets").glob("response_name=*")) == [
        "response_name=d1", "response_name=d2"]
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(Exception, match="do not match"):
        joins.training_set({"a": a}, response).collect()
    stranger = spark.createDataFrame([("q", 1.0)], "id string, d1 double")
    with pytest.raises(EmptyResultError):
        joins.training_set({"a": a}, stranger, allow_mismatched_indices=True, check_shared=True)


def test_single_training_set_and_annotation(tables):
    a, b, short = tables
    one = joins.single_training_set({"a": a}, short)
    assert one.columns == ["id", "x", "z"] and one.count() == 3
    assert [tuple(r) for r in joins.annotate(a, short).collect()] == [("s2", 2.0, 5.0)]
    left, right = joins.shared_rows(a, short)
    assert ids(left) == ids(right) == ["s2"]


# --- sources ---

TEXT = "sample,x,y,kind\na,1,NA,u\nb,,2.5,NA\nc,3,4,\n"


@pytest.mark.parametrize("name,sep,zipped", [("m.csv", ",", False), ("m.tsv", "\t", False),
                                             ("m.txt", "\t", False), ("m.csv.gz", ",", True),
                                             ("m.tab.gz", "\t", True)])
def test_text_files(spark, tmp_path, name, sep, zipped):
    data = TEXT.replace(",", sep).encode()
    path = tmp_path / name
    path.write_bytes(gzip.compress(data) if zipped else data)
    df = readers.load_matrix(spark, str(path), partitions=3)
    assert df.columns == ["sample", "x", "y", "kind"]
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields}["y"] == "double"
    assert [tuple(r) for r in df.orderBy("sample").collect()] == [
        ("a", 1, None, "u"), ("b", None, 2.5, None), ("c", 3, 4.0, None)]


def test_index_column_and_unknown_files(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("x,id\n1,a\n2,b\n")
    assert readers.load_csv(spark, str(path), index_col="id").columns == ["id", "x"]
    assert readers.load_csv(spark, str(path), index_col=1).columns == ["id", "x"]
    with pytest.raises(ValueError, match="unknown file type"):
        readers.load_matrix(spark, str(tmp_path / "m.docx"))
    with pytest.raises(FileNotFoundError):
        readers.load_matrix(spark, str(tmp_path / "none.csv"))


def test_ragged_lines_are_not_silent(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("id,x\na,1\nb,2,3\nc,4\n")
    with pytest.raises(Exception):
        readers.load_csv(spark, str(path), schema="id string, x double").collect()
    schema = spark.createDataFrame([], "id string, x double").schema
    assert [r["line"] for r in readers.rejected_lines(spark, str(path), schema).collect()] == ["b,2,3"]


def test_parquet_and_feather(spark, tmp_path):
    table = pa.table({"n": [1.0, float("nan"), None], "id": ["a", "b", "c"]})
    pa.feather.write_feather(table, str(tmp_path / "one.feather"), compression="lz4")
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(3):
        pa.feather.write_feather(table.slice(i, 1), str(folder / f"p{i}.feather"))
    for path in (tmp_path / "one.feather", folder):
        df = readers.load_feather(spark, str(path), index_col="id")
        assert [tuple(r) for r in df.orderBy("id").collect()] == [("a", 1.0), ("b", None), ("c", None)]
    writers.write_matrix(df, str(tmp_path / "m.parquet"))
    assert readers.load_matrix(spark, str(tmp_path / "m.parquet")).columns == ["id", "n"]
    assert readers.load_matrix(spark, str(tmp_path / "one.feather"), index_col="id").count() == 3


@pytest.mark.parametrize("zipped", [False, True])
def test_gmt(spark, tmp_path, zipped):
    text = "big\tdesc\ta\tb\tc\r\nsmall\tdesc\ta\tb\nbig2\td2\tq\tr\ts\tt\n".encode()
    path = tmp_path / ("sets.gmt.gz" if zipped else "sets.gmt")
    path.write_bytes(gzip.compress(text) if zipped else text)
    rows = {r["set_name"]: r["members"] for r in readers.load_gmt(spark, str(path), 2).collect()}
    assert rows == {"big": ["a", "b", "c"], "big2": ["q", "r", "s", "t"]}


def test_mapping_order(spark, tmp_path):
    from tessella.operators.aggregate import last_mapping
    path = tmp_path / "map.tsv"
    path.write_text("k\tv\n" + "".join(f"a\t{i}\n" for i in range(2000)) + "b\tx\n")
    mapping = readers.load_mapping(spark, str(path))
    got = {r[0]: r[1] for r in last_mapping(mapping, "k", "v").collect()}
    assert got == {"a": "1999", "b": "x"}


def test_metadata_typing(spark):
    rows = [(f"s{i}", "one", ["u", "v"][i % 2], str(i * 1.5), f"name{i}", f"long text {i % 27}")
            for i in range(30)]
    df = spark.createDataFrame(rows, "id string, same string, kind string, num string, "
                                     "label string, note string")
    got = readers.load_metadata(df)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [
        ("id", "string"), ("kind", "string"), ("num", "double"), ("note", "string")]


def test_samples(spark):
    df, _ = matrix(spark, np.arange(4000).reshape(2000, 2))
    part = sampling.sample_rows(df, 0.05, seed=3)
    assert part.count() == 100
    assert ids(part) == ids(sampling.sample_rows(df.repartition(7), 0.05, seed=3))
    assert ids(part) != ids(sampling.sample_rows(df, 0.05, seed=4))
    assert sampling.sample_rows(df, n=5000).count() == 2000
    assert sampling.sample_rows(df, n=7).count() == 7
    assert sampling.sample_rows(df, 0.0001).count() == 0
    copies = df.limit(1).select("id", "c0")
    many = copies.union(copies).union(copies).union(copies)
    assert sampling.sample_rows(many, 0.5).count() == 2
    wide, _ = matrix(spark, np.zeros((3, 10)))
    chosen = sampling.sample_columns(wide, 0.3)
    assert len(chosen.columns) == 4 and chosen.columns == sampling.sample_columns(wide, 0.3).columns
    shown = sampling.display_sample(wide, rows=2, columns=4)
    assert shown.count() == 2 and len(shown.columns) == 5


# --- profile ---

def test_profile(spark):
    rng = np.random.default_rng(4)
    df, frame = matrix(spark, np.round(rng.normal(size=(30, 5)) * 3), 0.1)
    tables = profile.profile(df)
    cells = frame.stack()
    values = tables["values"].first()
    assert values["median"] == cells.median() and values["q25"] == cells.quantile(0.25)
    assert values["mean"] == pytest.approx(cells.mean())
    signs = tables["signs"].first()
    assert signs["num_zero"] == (cells == 0).sum()
    assert signs["pct_missing"] == pytest.approx(100 * frame.isna().to_numpy().mean())
    assert tables["dimensions"].first().asDict() == {"num_rows": 30, "num_cols": 5}
    assert tables["column_types"].first().asDict() == {"type": "double", "num_cols": 5}
    assert tables["histogram"].agg({"n": "sum"}).first()[0] == len(cells)
    for side, axis in (("row", 1), ("column", 0)):
        for stat, want in (("mean", frame.mean(axis=axis)), ("median", frame.median(axis=axis)),
                           ("max", frame.max(axis=axis)), ("sd", frame.std(axis=axis)),
                           ("missing", frame.isna().sum(axis=axis))):
            got = tables[f"{side}_{stat}"].first()
            assert got["mean"] == pytest.approx(want.mean())
            assert got["median"] == pytest.approx(want.median())
            top = tables[f"{side}_{stat}_largest"].collect()
            assert top[0][stat] == pytest.approx(want.max())
            assert len(top) == min(10, len(want))


def test_top_rows_carry_their_annotation(spark):
    df, _ = matrix(spark, np.arange(12).reshape(6, 2))
    side = spark.createDataFrame([("r0005", "last"), ("r0000", "first")], "key string, note string")
    top = profile.profile_top(profile.row_profile(df, "mean"), k=2, annotation=side)
    assert [tuple(r) for r in top.collect()] == [("r0005", 10.5, "last")]


# --- chains ---

def screen_rows():
    """Readings per line and compound; one line is dropped, one reading missing, one slope negative."""
    rng = np.random.default_rng(12)
    rows = []
    for compound, spread in (("p", 9.0), ("q", 0.1), ("r", 5.0), ("s", 0.2)):
        for line in ("k1", "k2", "k3", "k4", "k5", "bad"):
            reading = float(np.round(10 + spread * rng.normal(), 3))
            slope = -1.0 if (compound, line) == ("r", "k2") else 1.0
            rows.append((line, compound, None if (compound, line) == ("q", "k1") else reading, slope, "x"))
    return rows


def test_screening_chain_like_pandas(spark):
    import pandas as pd
    rows = screen_rows()
    data = spark.createDataFrame(
        rows, "line string, compound string, reading double, slope double, plate string")
    actions = [
        {"filter_cols_name_in": {"names": ["compound", "reading", "slope"]}},
        {"filter_rows_name_not_in": {"names": ["bad"]}},
        {"filter_rows_col_not_na": {"id": "present", "col": "reading"}},
        {"filter_rows_col_gt": {"col": "slope", "value": 0}},
        {"filter_rows_group_size_ge": {"group": "compound", "size": 3}},
        {"filter_cols_name_not_in": {"names": ["slope"]}},
        {"filter_rows_group_func_ge": {"group": "compound", "col": "reading", "func": "mad",
                                       "quantile": 0.5}},
        {"pivot_wide": {"id": "final", "index": None, "columns": "compound", "values": "reading",
                        "reports": ["general_eda"]}},
    ]
    results = steps.run(spark, [{"name": "screen", "data": data, "actions": actions}])
    p = pd.DataFrame(rows, columns=["line", "compound", "reading", "slope", "plate"])
    p = p[(p["line"] != "bad") & p["reading"].notna() & (p["slope"] > 0)]
    mad = p.groupby("compound")["reading"].apply(lambda x: (x - x.median()).abs().median())
    p = p[p["compound"].isin(mad.index[mad >= mad.median()])]
    want = p.pivot(index="line", columns="compound", values="reading")
    got = to_pandas(results["final"])
    assert list(got.columns) == list(want.columns) == ["p", "r"]
    assert np.allclose(got, want, equal_nan=True)
    assert results["present"].count() == 19
    assert results["final/profile/dimensions"].first()["num_cols"] == 2
    assert results["screen/final"].columns == results["final"].columns


def test_branches_groups_and_references(spark, tmp_path):
    df, frame = matrix(spark, np.arange(1, 25).reshape(8, 3))
    (tmp_path / "s.gmt").write_text("s1\td\tr0000\tr0001\tr0002\ns2\td\tr0003\tr0004\n")
    first = {"name": "one", "data": df, "actions": [
        {"group": {"id": "logged", "actions": ["transform_cpm", "transform_log2p"]}},
        {"branch": [{"aggregate_gene_sets": {"id": "sets", "gmt": str(tmp_path / "s.gmt"),
                                             "min_size": 1, "func": "sum"}}]},
        {"branch": ["transpose_data"]},
        {"transform_zscore": {"axis": 1, "id": "scaled"}},
    ]}
    second = {"name": "two", "data": df, "actions": [
        {"integrate_cross_cor": {"id": "crossed", "dataset": "logged"}}]}
    # the reference is resolved whatever the order
    results = steps.run(spark, [second, first], persist_forks=True)
    logged = np.log2(frame / frame.sum() * 1e6 + 1)
    assert np.allclose(to_pandas(results["logged"]), logged)
    assert np.allclose(to_pandas(results["sets"]).loc["s2"], logged.iloc[3:5].sum())
    assert results["one_transpose_data"].count() == 3
    assert np.allclose(to_pandas(results["scaled"]).mean(axis=1), 0)
    assert np.allclose(to_pandas(results["crossed"]), [
        [frame[a].corr(logged[b]) for a in frame] for b in logged])


def test_chain_errors(spark):
    df, _ = matrix(spark, [[1.0, 2.0]])
    with pytest.raises(ValueError, match="unknown operator"):
        steps.run(spark, [{"name": "d", "data": df, "actions": ["no_such"]}])
    with pytest.raises(ValueError, match="used twice"):
        steps.run(spark, [{"name": "d", "data": df, "actions": [
            {"transform_log2": {"id": "a"}}, {"transform_log2": {"id": "a"}}]}])
    with pytest.raises(EmptyResultError):
        steps.run(spark, [{"name": "d", "data": df, "actions": [
            {"filter_rows_sum_gt": {"value": 99}}]}], check_empty=True)
    with pytest.raises(ValueError, match="circle"):
        steps.run(spark, [
            {"name": "a", "data": df, "actions": [{"integrate_cross_cor": {"dataset": "b"}}]},
            {"name": "b", "data": df, "actions": [{"integrate_cross_cor": {"dataset": "a"}}]}])


def test_feature_selection_and_integration(spark):
    df, frame = matrix(spark, np.random.default_rng(0).normal(size=(20, 4)) * [1, 5, 2, 9])
    response, _ = matrix(spark, np.random.default_rng(1).normal(size=(20, 2)), cols=["d1", "d2"])
    training = joins.training_set({"f": df}, response)
    chosen = steps.select_features_per_response(training, [{"min_variance": {"quantile": 0.5}}])
    assert {k: v.columns for k, v in chosen.items()} == {
        n: ["id", "f_c1", "f_c3", "response_name", "response"] for n in ("d1", "d2")}
    made = steps.integrate({"x": df, "y": response}, [
        {"cca": {"datasets": ["x", "y"], "permutations": 3}}, {"cross_cor": {"datasets": ["x", "y"]}}])
    assert made["cca_x_y"].count() == 10 and made["cross_cor_x_y"].count() == 8


def test_pivot_of_too_many_names(spark):
    from tessella.operators import shape
    df = spark.createDataFrame([("a", f"n{i}", 1.0) for i in range(5)], "id string, c string, v double")
    assert len(shape.pivot_wide(df, "c", "v", most_columns=5).columns) == 6
    with pytest.raises(ValueError):
        shape.pivot_wide(df, "c", "v", most_columns=4)
