"""Small hand-built inputs in the raw shapes."""

import datetime as dt

BAR_SCHEMA = ("symbol string, trade_date date, open double, high double, low double, "
              "close double, adj_close double, volume long, source string")
MACRO_SCHEMA = "obs_date date, series string, value double, unit string, source string"


def d(s):
    return dt.date.fromisoformat(s)


def bars(spark, rows):
    """rows: (symbol, 'YYYY-MM-DD', adj_close[, open, high, low, volume])"""
    out = []
    for r in rows:
        sym, day, adj = r[0], d(r[1]), float(r[2])
        o = r[3] if len(r) > 3 else adj
        h = r[4] if len(r) > 4 else adj
        lo = r[5] if len(r) > 5 else adj
        v = r[6] if len(r) > 6 else 100
        out.append((sym, day, o, h, lo, adj, adj, v, "yahoo_finance"))
    return spark.createDataFrame(out, BAR_SCHEMA)


def macro(spark, rows):
    return spark.createDataFrame([(d(a), s, float(v), "%", "bcb") for a, s, v in rows], MACRO_SCHEMA)


def empty_macro(spark):
    return spark.createDataFrame([], MACRO_SCHEMA)
