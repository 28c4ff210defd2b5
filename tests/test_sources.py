"""Line parsers and readers on literal inputs (FIXTURES.md part A cases)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ratewise import schemas
from ratewise.sources import (
    parse_item_genres,
    parse_item_wide,
    parse_pipe_users,
    parse_ws_ratings,
    read_documents_defaulted,
    read_table_projected,
    scan_text_lines,
    select_all_limit,
    write_text_lines,
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_scan_text_lines_round_trip(spark, tmp_uri):
    src = lines(spark, "a|b", "", "tab\there", "  spaced  ")
    path = write_text_lines(src, tmp_uri("lines"))
    got = sorted(r.value for r in scan_text_lines(spark, path).collect())
    assert got == sorted(["a|b", "", "tab\there", "  spaced  "])


def test_parse_users_cases(spark):
    df = parse_pipe_users(lines(
        spark,
        "1|24|M|technician|85711",     # good
        "2|53|F||94043",               # blank occupation stays blank
        "8|36|M|administrator|05201",  # leading zero kept
        "74|39|M|scientist|T8H1N",     # letters in zip
        "9|29|M|student|01002|extra",  # extra field ignored
    ))
    assert df.schema == schemas.USERS
    rows = {r.user_id: r for r in df.collect()}
    assert rows[1].age == 24 and rows[1].zip_code == "85711"
    assert rows[2].occupation == ""
    assert rows[8].zip_code == "05201"
    assert rows[74].zip_code == "T8H1N"
    assert rows[9].zip_code == "01002"


@pytest.mark.parametrize("bad", ["3|30|M|writer", "4|abc|M|writer|12345", ""])
def test_parse_users_strict_failures(spark, bad):
    with pytest.raises(PySparkException):
        parse_pipe_users(lines(spark, bad)).collect()


def test_lenient_parsing_rejects_whole_lines(spark):
    from ratewise.sources import rejected_lines
    bad, good = ["3|30|M|writer", "4|abc|M|writer|12345", ""], "5|20|F||01234"
    src = lines(spark, *bad, good)
    assert [tuple(r) for r in parse_pipe_users(src, lenient=True).collect()] == [(5, 20, "F", "", "01234")]
    assert sorted(r.value for r in rejected_lines(src, "users").collect()) == sorted(bad)


def test_lenient_ratings_are_not_merged(spark):
    from ratewise.operators import clean_ratings
    from ratewise.sources import rejected_lines
    src = lines(spark, "1 10 3 abc", "1 10 5 xyz", " 1\t10  4 7 ", "1 10 4")
    assert [tuple(r) for r in clean_ratings(parse_ws_ratings(src, lenient=True)).collect()] == [(1, 10, 4, 7)]
    assert rejected_lines(src, "ratings").count() == 3


def test_lenient_items_reject_unreadable_flags_only(spark):
    from ratewise.sources import parse_item_genres, rejected_lines
    src = lines(spark, "1|A|d||u|1|0", "2|B|d||u|x|1", "3|C|d||u|1", "4|D|d")
    vocabulary = ("a", "b")
    got = {r.movie_id: r.genres for r in parse_item_genres(src, vocabulary, lenient=True).collect()}
    assert got == {1: ["a"], 3: ["a"]}
    assert sorted(r.value[0] for r in rejected_lines(src, "movies", vocabulary=vocabulary).collect()) == ["2", "4"]


def test_strict_checks_hold_whatever_is_read(spark):
    for bad in ("1 10 3 abc", "1 10 3"):
        df = parse_ws_ratings(lines(spark, "1 10 3 5", bad))
        for narrow in (df.select("user_id"), df.groupBy().count()):
            with pytest.raises(PySparkException, match="unreadable line"):
                narrow.collect()


def test_documents_need_an_id_whatever_is_read(spark, tmp_uri):
    for bad in ('{"movie_title": "t"}', '{"movie_id": "x1"}', "{broken"):
        path = tmp_uri("docs")
        lines(spark, '{"movie_id": 1, "movie_title": "a"}', bad).write.text(path)
        df = read_documents_defaulted(spark, path)
        old = spark.conf.get("spark.sql.ansi.enabled")
        try:
            for ansi in ("true", "false"):
                spark.conf.set("spark.sql.ansi.enabled", ansi)
                for narrow in (df.select("movie_title"), df.groupBy().count(), df):
                    with pytest.raises(PySparkException, match="movie_id"):
                        narrow.collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", old)


def test_parse_ratings_whitespace(spark):
    df = parse_ws_ratings(lines(
        spark,
        "196\t242\t3\t881250949",
        "186  302   3 891717742",
        "\t22\t377\t1\t878887116\t",
        " 244 51 2 880606923 ",
    ))
    assert df.schema == schemas.RATINGS
    got = sorted(tuple(r) for r in df.collect())
    assert got == sorted([(196, 242, 3, 881250949), (186, 302, 3, 891717742),
                          (22, 377, 1, 878887116), (244, 51, 2, 880606923)])


def test_parse_ratings_keeps_out_of_range_and_duplicates(spark):
    df = parse_ws_ratings(lines(spark, "1 1 0 10", "1 1 6 11", "1 1 5 12", "1 1 5 12", "1 1 1 13"))
    assert sorted(r.rating for r in df.collect()) == [0, 1, 5, 5, 6]


@pytest.mark.parametrize("bad", ["1 2 3", "1 2 x 4", ""])
def test_parse_ratings_strict_failures(spark, bad):
    with pytest.raises(PySparkException):
        parse_ws_ratings(lines(spark, bad)).collect()


VOCAB = schemas.DEFAULT_GENRES


def item(movie_id, title, flags):
    return "|".join([str(movie_id), title, "01-Jan-1995", "", f"http://x/{movie_id}"] + flags)


def test_parse_item_forms(spark):
    full = ["0"] * 19
    several = list(full)
    several[1] = several[5] = several[16] = "1"   # Action, Comedy, Thriller
    unknown_only = list(full)
    unknown_only[0] = "1"
    src = lines(
        spark,
        item(1, "Toy Story (1995)", several),
        item(2, 'A "quoted" title', full),                 # no flag
        item(3, "Short", ["1"] + ["0"] * 13 + ["1"]),      # 20 fields: flags 15..18 missing
        item(4, "Long", unknown_only + ["1"]),             # 25 fields: extra ignored
    )
    genres = {r.movie_id: r.genres for r in parse_item_genres(src, VOCAB).collect()}
    assert genres[1] == ["Action", "Comedy", "Thriller"]
    assert genres[2] == []
    assert genres[3] == ["unknown", "Romance"]
    assert genres[4] == ["unknown"]
    wide = {r.movie_id: r for r in parse_item_wide(src, VOCAB).collect()}
    assert wide[2].movie_title == 'A "quoted" title'
    assert wide[3].Sci_Fi is None and wide[3].Romance == 1
    assert wide[4].unknown == 1 and wide[4].Western == 0
    assert parse_item_wide(src, VOCAB).schema == schemas.movies_wide(VOCAB)


def test_parse_item_bad_flag_fails(spark):
    with pytest.raises(PySparkException):
        parse_item_genres(lines(spark, item(5, "Bad", ["x"] + ["0"] * 18)), VOCAB).collect()


def test_read_documents_defaults(spark, tmp_uri):
    path = tmp_uri("docs")
    docs = spark.createDataFrame([
        ('{"movie_id": 1, "movie_title": "A", "genres": ["Drama"]}',),
        ('{"movie_id": 2, "movie_title": "B"}',),
        ('{"movie_id": 3, "movie_title": "C", "genres": null}',),
        ('{"movie_id": 4, "movie_title": "D", "genres": []}',),
    ], "value string")
    write_text_lines(docs, path)
    got = {r.movie_id: r for r in read_documents_defaulted(spark, path).collect()}
    assert got[1].genres == ["Drama"]
    assert got[2].genres == [] and got[2].imdb_url is None
    assert got[3].genres == [] and got[4].genres == []


def test_read_documents_requires_id(spark, tmp_uri):
    path = tmp_uri("docs")
    write_text_lines(spark.createDataFrame([('{"movie_title": "no id"}',)], "value string"), path)
    with pytest.raises(PySparkException):
        read_documents_defaulted(spark, path).collect()


def test_read_table_projected_prunes(spark, tmp_uri):
    from ratewise.plans import plan_text
    path = tmp_uri("t")
    spark.createDataFrame([(1, 2, 3, 4)], schemas.RATINGS).write.parquet(path)
    df = read_table_projected(spark, path, ["movie_id", "rating"]).filter(F.col("rating") >= 3)
    plan = plan_text(df)
    assert "ReadSchema: struct<movie_id:bigint,rating:int>" in plan
    assert "GreaterThanOrEqual(rating,3)" in plan
    assert [tuple(r) for r in df.collect()] == [(2, 3)]


def test_select_all_limit_is_top_n(spark):
    from ratewise.plans import plan_text
    df = spark.range(100).withColumnRenamed("id", "k")
    out = select_all_limit(df, 5, ["k"])
    assert "TakeOrderedAndProject" in plan_text(out)
    assert [r.k for r in out.collect()] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("bad", ["3|30|M|writer", "4|abc|M|writer|12345"])
def test_strict_parsing_without_ansi_mode(spark, bad):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="unreadable line"):
            parse_pipe_users(lines(spark, bad)).collect()
        ok = parse_pipe_users(lines(spark, "1|24|M|technician|85711")).collect()
        assert tuple(ok[0]) == (1, 24, "M", "technician", "85711")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_rejects_name_their_file(spark, tmp_uri):
    from ratewise.sources import parse_ws_ratings, rejected_lines, scan_text_lines, write_text_lines
    root = tmp_uri("lines")
    bad, good = "1\t2\tx\t4", "1\t2\t3\t4"
    for name, values in (("a", [good, bad, bad]), ("b", [bad]), ("c", [good])):
        write_text_lines(spark.createDataFrame([(v,) for v in values], "value string").coalesce(1), f"{root}/{name}")
    lines = scan_text_lines(spark, [f"{root}/{n}" for n in "abc"], origin=True)
    got = [(r["value"], r["file"].split("/")[-2], r["block_start"]) for r in rejected_lines(lines, "ratings").collect()]
    assert sorted(got) == [(bad, "a", 0), (bad, "a", 0), (bad, "b", 0)]
    assert parse_ws_ratings(lines, lenient=True).columns == ["user_id", "movie_id", "rating", "timestamp"]
    with pytest.raises(PySparkException, match=r"unreadable line in \S*/a/part-"):
        parse_ws_ratings(scan_text_lines(spark, f"{root}/a", origin=True)).collect()


def test_narrow_rows_are_their_own_key(spark):
    from ratewise.operators import duplicate_check, profile_summary
    from ratewise.plans import plan_text
    rows = [(1, 1.0, 2), (1, 1.0, 2), (None, -0.0, 2), (None, 0.0, 2), (None, float("nan"), None),
            (None, float("nan"), None), (0, None, 2), (None, None, None)]
    narrow = spark.createDataFrame(rows, "id long, x double, n int")
    wide = narrow.selectExpr("id", "x", "n", "'t' AS t")
    assert "sha2" not in plan_text(duplicate_check(narrow)) and "sha2" in plan_text(duplicate_check(wide))
    assert tuple(duplicate_check(narrow).first()) == tuple(duplicate_check(wide).first()) == (8, 5, 3)
    told = lambda df: {(r["metric"], r["column_name"]): r["value"] for r in profile_summary(df).collect()}
    got, other = told(narrow), told(wide)
    assert got == {k: v for k, v in other.items() if k != ("missing", "t")}
    assert got[("missing", "id")] == 5 and got[("missing", "x")] == 2
