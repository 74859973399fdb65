"""Names that several test modules share; fixtures alone live in ``conftest.py``."""

import datetime as dt
from decimal import Decimal

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def D(x) -> Decimal:
    return Decimal(str(x))


def rows(df, *cols):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
