import math

import pytest
from pyspark.sql import functions as F

from gridstats.functions import football as fb


def labels(rows, ddl, column, *records):
    return [r["out"] for r in rows(ddl, *records).select(column.alias("out")).collect()]


def test_official_pass_excludes_sacks_fumbles_and_two_point_tries(rows):
    ddl = "sack int, fumble int, two_point_conv_result string"
    plain = dict(sack=0, fumble=0)
    got = labels(rows, ddl, fb.official_pass(), plain, plain | dict(sack=1),
                 plain | dict(fumble=1), plain | dict(two_point_conv_result="success"),
                 plain | dict(sack=None))
    assert got == [True, False, False, False, None]


def test_pressure_type_hit_outranks_scramble(rows):
    got = labels(rows, "qb_hit int, qb_scramble int", fb.pressure_type(),
                 dict(qb_hit=1, qb_scramble=1), dict(qb_hit=0, qb_scramble=1),
                 dict(qb_hit=0, qb_scramble=0), dict())
    assert got == ["hit", "scramble", "clean", "clean"]


@pytest.mark.parametrize("diff, bucket", [
    (-20, "Losing big"), (-14, "Losing big"), (-13, "Losing"), (-1, "Losing"),
    (0, "Tied"), (1, "Winning"), (14, "Winning"), (15, "Winning big"),
    (None, "Winning big"),
])
def test_score_bucket(rows, diff, bucket):
    assert labels(rows, "score_diff int", fb.score_bucket(), dict(score_diff=diff)) == [bucket]


def test_home_or_away(rows):
    got = labels(rows, "home_team string", fb.home_or_away(F.lit("NE")),
                 dict(home_team="NE"), dict(home_team="BUF"), dict())
    assert got == ["Home", "Away", "Away"]


def test_success_needs_positive_epa(rows):
    got = labels(rows, "epa double", fb.is_success(),
                 dict(epa=1.25), dict(epa=-0.5), dict(epa=0.0), dict())
    assert got == [1, 0, 0, 0]


@pytest.mark.parametrize("yard_line, flag", [
    ("BUF 1", 1), ("BUF 20", 1), ("BUF 21", 0), ("NE 5", 0), ("50", 0), (None, 0),
    ("BUF", 0), ("BUF 99999999999", 0),
])
def test_redzone(rows, yard_line, flag):
    got = labels(rows, "yard_line string, opponent_team string", fb.is_redzone(),
                 dict(yard_line=yard_line, opponent_team="BUF"))
    assert got == [flag]


def test_redzone_without_opponent(rows):
    assert labels(rows, "yard_line string, opponent_team string", fb.is_redzone(),
                  dict(yard_line="BUF 3")) == [0]


@pytest.mark.parametrize("text, result", [
    ("TWO-POINT CONVERSION ATTEMPT. TWO-POINT CONVERSION SUCCEEDS.", "success"),
    ("TWO-POINT CONVERSION ATTEMPT. ATTEMPT FAILS.", "failure"),
    ("two-point conversion succeeds", None), ("pass", None), (None, None),
])
def test_two_point_result(rows, text, result):
    assert labels(rows, "play_description string", fb.two_point_result(),
                  dict(play_description=text)) == [result]


@pytest.mark.parametrize("line, rating", [
    ((1, 1, 10, 0, 0), 108.3),
    ((10, 10, 200, 5, 0), 158.3),
    ((10, 0, 0, 0, 5), 0.0),
    ((30, 20, 250, 2, 1), 100.7),
])
def test_passer_rating(rows, line, rating):
    frame = rows("a int, c int, y int, t int, i int", dict(zip("acyti", line)))
    got = frame.select(fb.passer_rating("a", "c", "y", "t", "i").alias("out")).first()["out"]
    assert got == pytest.approx(rating)


def test_passer_rating_without_attempts_is_nan(rows):
    frame = rows("a int, c int, y int, t int, i int", dict(a=0, c=0, y=0, t=1, i=0))
    assert math.isnan(frame.select(fb.passer_rating("a", "c", "y", "t", "i")).first()[0])
