import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barwise import schema as S  # noqa: E402
from barwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4)
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def bars_df(spark, rows):
    """rows: (ticker_id, 'YYYY-MM-DD HH:MM', open, high, low, close, volume[, vwap[, n]])"""
    out = []
    for r in rows:
        r = list(r) + [None] * (9 - len(r))
        tid, t, o, h, lo, c, v, vw, n = r
        out.append((tid, ts(t), float(o), float(h), float(lo), float(c), int(v),
                    None if vw is None else float(vw), None if n is None else int(n)))
    return spark.createDataFrame(out, S.BAR)


def dims_df(spark, pairs):
    return spark.createDataFrame(pairs, "ticker_id int, symbol string")
