"""Every registered query of the engine against its oracle SQL in DuckDB."""

import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pandas as pd
import pytest

from tidemark.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


@pytest.fixture(scope="module")
def results(spark, request):
    """The chosen queries' results, several at a time: most of a small query's time is not spent in its tasks."""
    names = [i.callspec.params["name"] for i in request.session.items if i.module is request.module and "name" in getattr(getattr(i, "callspec", None), "params", {})]
    with ThreadPoolExecutor(6) as pool:
        yield {n: pool.submit(lambda n=n: catalogue.queries()[n](spark, SF).toPandas()) for n in names}


def shown(v) -> str:
    if pd.isna(v):
        return "-"
    return f"{float(v):.5g}" if isinstance(v, float) and abs(v) > 1e6 else f"{float(v):.4f}" if isinstance(v, (float, int)) and not isinstance(v, bool) or hasattr(v, "item") else str(v)


def rows(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(shown, r)) for r in frame.itertuples(index=False))


def test_every_query_has_an_oracle():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(results, duck, name):
    got, want = results[name].result(), duck.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
