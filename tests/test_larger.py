"""Queries against their oracle SQL on small tables that hold what only larger ones do: far keys, values on a border."""

import duckdb
import pytest

from tidemark.functions import scalars as S
from tidemark.plans import catalogue, frame_queries

EVENTS = "TIMESTAMP '2024-01-01' + to_seconds({t}) AS ts, CAST({u} AS BIGINT) AS user_id, {k} AS event_type, CAST({v} AS DOUBLE) AS value"


@pytest.fixture
def both(spark, tmp_path):
    """Rows of a query and of its SQL on tables given as SELECTs, compared as they are."""

    def rows(name, **tables):
        duck = duckdb.connect()
        duck.execute("SET TimeZone='UTC'")
        for t, sql in tables.items():
            duck.execute(f"COPY ({sql}) TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
            duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
        got = catalogue.queries()[name](spark, str(tmp_path)).toPandas()
        want = duck.execute(catalogue.oracle_sql()[name]).df()
        ordered = lambda f: sorted(map(tuple, f[sorted(want.columns)].itertuples(index=False)))
        return ordered(got), ordered(want)

    return rows


def half_turns(kind: str) -> str:
    """Pairs of events of a user whose headings (three times the value) lie half a turn apart, up to the last digit; frames between them."""
    rows = " UNION ALL ".join(f"SELECT i*4+{n} AS event_id, " + EVENTS.format(t=f"{at}", u="i", k=f"'{k}'", v=v) for n, (at, k, v) in enumerate([(0, "view", "i/100.0"), (100, "view", "(i+6000)/100.0"), (20, kind, "i/100.0")]))
    return f"SELECT * FROM (SELECT unnest(range(300)) AS i), LATERAL ({rows})".replace("SELECT * FROM", "SELECT event_id, ts, user_id, event_type, value FROM", 1)


def test_pose_offset_turns_like_its_sql_at_half_a_turn(both):
    got, want = both("pose_offset", events=half_turns("view"))
    assert got == want


def test_linear_interpolation_turns_like_its_sql_at_half_a_turn(both):
    got, want = both("linear_interpolation", events=half_turns("click"))
    assert len(want) == 300 and got == want


def test_initial_poses_turn_like_their_sql_at_half_a_turn(both):
    got, want = both("initial_poses", events=half_turns("view"))
    assert got == want


def test_initial_poses_of_events_at_one_time_with_one_value(both):
    got, want = both("initial_poses", events="SELECT i AS event_id, " + EVENTS.format(t="(i//9%50)*100", u="i//450", k="'view'", v="i//9%13") + " FROM (SELECT unnest(range(4500)) AS i)")
    assert got == want


def test_initial_poses_halfway_between_two_thousandths(both):
    got, want = both("initial_poses", events="SELECT i AS event_id, " + EVENTS.format(t="i%1000*25", u="i//1000", k="'view'", v="(i*i%997)/1000.0") + " FROM (SELECT unnest(range(7000)) AS i)")
    assert got == want


@pytest.mark.parametrize("missing", ["user_id", "ts", "value", "all"])
def test_linear_interpolation_keeps_events_that_lack_something(both, missing):
    """Pairs of events at one time; some have no user, time or value."""
    lacking = {"user_id": "i%7=0", "ts": "i%5=0", "value": "i%3=0"}
    column = lambda c: f"CASE WHEN NOT ({lacking[c] if missing in (c, 'all') else 'false'}) THEN {c} END AS {c}"
    rows = "SELECT i, i AS event_id, " + EVENTS.format(t="i//2*977", u="i%40//4", k="CASE WHEN i*i%11<5 THEN 'click' ELSE 'view' END", v="i*31%499/10.0") + " FROM (SELECT unnest(range(600)) AS i)"
    got, want = both("linear_interpolation", events=f"SELECT event_id, {column('ts')}, {column('user_id')}, event_type, {column('value')} FROM ({rows})")
    clean = lambda rows: sorted([tuple(None if x != x else x for x in r) for r in rows], key=repr)
    assert clean(got) == clean(want)


def test_transformed_headings_on_the_border_are_those_of_the_sql(both):
    got, want = both("transformed_poses", events="SELECT i AS event_id, " + EVENTS.format(t="i", u="i%14", k="'view'", v="(17000+i//14)/100.0") + " FROM (SELECT unnest(range(14000)) AS i)")
    assert 180.0 in {r[-1] for r in want} and got == want


def test_frames_beyond_two_thousand_are_strata_of_their_own(both):
    got, want = both("eight_strata", embeddings="SELECT i*1000+51000 AS vec_id, [0.1, 0.2+i/500.0, 0.3]::FLOAT[] AS embedding, CAST(i%10 AS INT) AS label FROM (SELECT unnest(range(100)) AS i)")
    assert got == want


def test_tile_names_of_keys_of_seven_digits(both):
    got, want = both("tile_names", part="SELECT CAST(unnest([0, 7, 999999, 1000000, 1000001, 1234567, 12345678]) AS BIGINT) AS p_partkey")
    assert got == want


def test_colours_halfway_between_two_are_those_of_the_sql(spark):
    """The median of two samples may lie halfway between two colours, up to the last digit."""
    pairs = [(a, b) for a in range(256) for b in range(a + 1)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = {(r.a, r.b): r.v for r in df.select("a", "b", S.to_srgb((S.to_linear(df.a) + S.to_linear(df.b)) / 2).alias("v")).collect()}
    lin = lambda c: frame_queries.LIN.format(c=c)
    want = duckdb.sql(f"WITH p AS (SELECT a, b, ({lin('a')}+{lin('b')})/2 AS f FROM range(256) x(a), range(256) y(b) WHERE b <= a) SELECT a, b, {frame_queries.SRGB.format(c='f')} FROM p").fetchall()
    assert got == {(a, b): v for a, b, v in want}
