from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from siftworks.session import session

    s = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="3g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data_dir():
    if not os.path.isdir(DATA):
        pytest.skip("the driver's tables are not here")
    return DATA


@pytest.fixture(scope="session")
def duck(data_dir):
    import glob

    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{data_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(v):
    """A cell in a form that both engines' results share."""
    import pandas as pd

    if isinstance(v, (list, tuple, dict)) or hasattr(v, "tolist") and getattr(v, "ndim", 0):
        return str(list(v) if not isinstance(v, dict) else sorted(v.items()))
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return None
    if isinstance(v, pd.Timestamp):
        return str(v.tz_localize(None) if v.tzinfo else v)
    v = v.item() if hasattr(v, "item") else v
    return int(v) if isinstance(v, float) and v == int(v) else v


def rows_of(frame) -> list[tuple]:
    names = sorted(frame.columns)
    return sorted((tuple(map(plain, r)) for r in frame[names].itertuples(index=False)), key=repr)
