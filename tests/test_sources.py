from pyspark.sql import functions as F, types as T

from sorrel.functions import fixed
from sorrel.operators import store, validate as va
from sorrel.sources import delimited as D, tables as tb


def write(path, text):
    path.write_bytes(text.encode("latin-1"))
    return str(path)


def test_prepared_tables(spark, tmp_path):
    movies = write(tmp_path / "movies.dat", "1::Amélie (2001)::Comedy|Romance\n2::No year::Drama\n")
    users = write(tmp_path / "users.dat", "1::M::25::7::33018\n2::F::18::3::52146\n")
    ratings = write(tmp_path / "ratings.dat", "1::1::4::981204417\n2::1::3::981204417\n")
    m = D.load_items(D.read_delimited(spark, movies, D.MOVIES), ["Comedy", "Drama", "Romance"])
    assert m.columns == ["MovieID", "Title", "Genres", "Year", "Comedy", "Drama", "Romance"]
    first = m.orderBy("MovieID").first()
    assert (first.Title, first.Year, first.Comedy, first.Drama) == ("Amélie (2001)", 2001.0, 1, 0)
    u = D.load_users(D.read_delimited(spark, users, D.USERS)).orderBy("UserID").collect()
    assert [(r.Gender_enc, r.Zip) for r in u] == [(1, "33018"), (0, "52146")]
    r = D.load_interactions(D.read_delimited(spark, ratings, D.RATINGS)).orderBy("UserID").collect()
    assert [x.Liked for x in r] == [1, 0]


def test_threshold_from_the_environment(spark, monkeypatch):
    monkeypatch.setenv("RATING_THRESHOLD", "3")
    df = spark.createDataFrame([(3,)], "Rating int")
    assert D.load_interactions(df).first().Liked == 1


def test_line_statistics_count_every_line(spark, tmp_path):
    a = write(tmp_path / "a.dat", "1::2::3::4\n1::2::3\n\n1::2::3::4\n")
    got = D.raw_file_stats(spark, a, 4).first()
    assert (got.n_lines, got.n_bad_fields) == (4, 2)


def test_every_line_is_a_row_or_rejected(spark, tmp_path):
    lines = ["1::1::4::981204417", "x::1::4::9", "1::1::4", "", "2::1::5::9::7", "3::1::five::9", '4::1::2::"9"', "  ", "5::7::::3", "é::1::1::1", "6::1::1::99999999999"]
    path, rejects = write(tmp_path / "r.dat", "\n".join(lines) + "\n"), str(tmp_path / "rejects")
    rows = sorted(tuple(r) for r in D.read_and_reject(spark, path, D.RATINGS, rejects).collect())
    bad = spark.read.json(rejects)
    assert rows == [(1, 1, 4, 981204417), (4, 1, 2, 9), (5, 7, None, 3), (6, 1, 1, 99999999999)]
    found = {r.line_no: (r.line, r.reason) for r in bad.collect()}
    assert found == {
        2: (lines[1], "UserID does not parse"), 3: (lines[2], "3 fields instead of 4"), 4: ("", "blank"), 5: (lines[4], "5 fields instead of 4"),
        6: (lines[5], "Rating does not parse"), 8: ("  ", "blank"), 10: ("é::1::1::1", "UserID does not parse"),
    }
    assert bad.select("file").distinct().count() == 1 and bad.first().file.endswith("r.dat")
    # rows are those of the plain scan
    plain = {tuple(r) for r in D.read_delimited(spark, path, D.RATINGS).collect()}
    assert set(rows) <= plain
    empty = D.read_checked(spark, write(tmp_path / "e.dat", ""), D.RATINGS)
    assert [df.count() for df in empty] == [0, 0]


def test_validation_reports_numbers_and_first_lines(spark, tmp_path):
    lines = ["1::1::4::981204417", "0::1::4::981204417", "x::1::4::981204417", "1::1::6::9", "1::1::4", "", "1::1::5::9", "1::1::0::9"]
    path = write(tmp_path / "ratings.dat", "\n".join(lines) + "\n")
    counts, first = D.validate_file(spark, path, D.RATINGS, va.rating_file_rules)
    assert tuple(counts.first()) == (2, 6)
    got = [(r.line_no, r.error) for r in first.collect()]
    assert got == [(2, "user"), (3, "UserID is not a number"), (4, "rating"), (5, "too few fields"), (6, "too few fields")]


def test_line_numbers_hold_when_a_file_is_split(spark, tmp_path):
    n = 4000
    path = write(tmp_path / "ratings.dat", "".join(f"{i}::1::{9 if i % 1000 == 0 else 4}::9\n" for i in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        _, first = D.validate_file(spark, path, D.RATINGS, va.rating_file_rules)
        assert D.read_lines(spark, path).select("block").distinct().count() > 2
        assert [r.line_no for r in first.collect()] == [1000, 2000, 3000, 4000]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_movie_and_user_rules(spark, tmp_path):
    movies = write(tmp_path / "m.dat", "1::Lantern Hill (1987)::Opera\n0::Lantern Hill (1987)::Drama\n1::::Drama\n1::Élan (1999)::Drama|War\n")
    counts, first = D.validate_file(spark, movies, D.MOVIES, va.movie_file_rules)
    assert tuple(counts.first()) == (1, 3)
    assert [r.error for r in first.collect()] == ["tags", "id", "title"]
    users = write(tmp_path / "u.dat", "1::X::25::4::1\n1::M::30::4::1\n1::M::25::99::1\n1::F::56::20::1\n")
    counts, first = D.validate_file(spark, users, D.USERS, va.user_file_rules)
    assert tuple(counts.first()) == (1, 3)
    assert [r.error for r in first.collect()] == ["gender", "age", "occupation"]


def test_split_columns_landing_and_reports(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "a int, split string")
    tb.write_split(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).where("split = 'test'").first().a == 2
    tb.write_feature_columns(spark, ["z", "a", "m"], str(tmp_path / "f"))
    assert tb.read_feature_columns(spark, str(tmp_path / "f")) == ["z", "a", "m"]
    raw = str(tmp_path / "raw")
    tb.land_raw(spark.range(3), raw, "2024-01-01")
    tb.land_raw(spark.range(5), raw, "2024-01-02")
    tb.land_raw(spark.range(2), raw, "2024-01-02")
    assert tb.read_latest(spark, raw).count() == 2
    assert spark.read.parquet(raw).count() == 5
    tb.write_report(df, str(tmp_path / "r"), "2024-01-01")
    tb.write_report(df, str(tmp_path / "r"), "2024-01-02")
    assert spark.read.json(str(tmp_path / "r")).count() == 4


def test_online_snapshot_versions(spark, tmp_path, rows):
    path = str(tmp_path / "online")
    schema = T.StructType().add("id", T.LongType()).add("v", T.DoubleType())
    assert tb.read_online(spark, path, schema).count() == 0
    tb.write_online(spark.createDataFrame([(i, 1.0) for i in range(20)], schema), path, 0, "id", 4)
    only = spark.createDataFrame([(0, 2.0)], schema)
    tb.write_online(only, path, 1, "id", 4)
    got = dict(rows(tb.read_online(spark, path, schema)))
    # the bucket of id 0 was written again, the others keep their first version
    assert got[0] == 2.0 and len(got) < 20
    assert len(rows(tb.read_online(spark, path, schema, before=1))) == 20
    assert tb.online_as_json(only, "id").first().features == '{"v":2.0}'


def test_feature_view_scan_and_missing_view(spark, tmp_path):
    import pytest

    view = store.ITEM_VIEW
    assert len(view.features) == 21 and len(store.USER_VIEW.features) == 6
    assert "film_noir" in view.names and "childrens" in view.names
    assert store.list_views() == ["user_features", "movie_features"]
    path = str(tmp_path / "v")
    spark.createDataFrame([], view.schema).write.parquet(path)
    assert tb.read_feature_view(spark, path, view.schema).columns == view.schema.fieldNames()
    with pytest.warns(UserWarning):
        assert tb.read_feature_view(spark, str(tmp_path / "none"), view.schema) is None
    assert len(fixed.GENRES) == 18


def test_text_is_decoded_as_latin1(spark, tmp_path):
    path = write(tmp_path / "x.dat", 'é"q"::b\n')
    assert D.read_lines(spark, path).select(F.col("line")).first()[0] == 'é"q"::b'
