"""The published user segments (under 20; scientists from 30 to 40), counted on a
small literal user file with every boundary, through the whole path: text, parse,
clean, filter."""

import pytest
from pyspark.sql import functions as F

from ratewise.operators import (
    clean_users,
    missing_values_profile,
    users_by_occupation_and_age,
    users_younger_than,
)
from ratewise.sources import parse_pipe_users, scan_text_lines, write_text_lines

LINES = """\
1|7|M|student|02215
2|19|F|student|94043
3|20|M|other|85711
4|29|F|scientist|10003
5|30|M|scientist|55105
6|35|F|scientist|T8H1N
7|40|M|scientist|V3N4P
8|41|F|scientist|20009
9|35|F|Scientist|20009
10|73|M|retired|98225
11|0|M|none|00000
12|101|F|none|00000
13|100|F|none|00000
13|15|F|student|00000
14|35|M|scientist|20009""".split("\n")


@pytest.fixture(scope="module")
def users(spark):
    from ratewise.session import scratch_path
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    return parse_pipe_users(scan_text_lines(spark, write_text_lines(lines, scratch_path(spark, "user_file"))))


def test_user_segments(users):
    clean = clean_users(users)
    assert clean.count() == 12  # 14 users, one too young, one too old
    assert sorted(r.user_id for r in users_younger_than(clean, 20).collect()) == [1, 2, 13]
    assert sorted(r.user_id for r in users_by_occupation_and_age(clean, "scientist", 30, 40).collect()) == [5, 6, 7, 14]


def test_user_file_facts(users):
    facts = users.agg(F.min("age"), F.max("age"), F.count_distinct("occupation"),
                      F.sum((F.col("gender") == "M").cast("int")),
                      F.sum((F.length("zip_code") != 5).cast("int")),
                      F.sum(F.col("zip_code").rlike("[A-Za-z]").cast("int"))).first()
    assert tuple(facts) == (0, 101, 6, 7, 0, 2)
    assert all(v == 0 for v in missing_values_profile(users).first())
