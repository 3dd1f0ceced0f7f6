import datetime as dt

from tickspan.schemas import RAW_STOCK_PRICES, WATCHLIST

T0 = dt.datetime(2024, 1, 3, 6, 0, 0)


def raw(spark, items):
    """items: (symbol, date, close[, loaded_at[, volume]]) → raw price rows."""
    out = []
    for it in items:
        sym, d, close = it[0], it[1], it[2]
        loaded = it[3] if len(it) > 3 and it[3] is not None else T0
        vol = it[4] if len(it) > 4 else 100
        d = dt.date.fromisoformat(d) if isinstance(d, str) else d
        out.append((sym, d, close, close, close, close, vol, "alpha_vantage", loaded))
    return spark.createDataFrame(out, RAW_STOCK_PRICES)


def watchlist(spark, items):
    """items: (id, symbol, active) → watchlist rows."""
    ts = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, s, f"{s} Corp", "Tech", None, a, ts, ts) for i, s, a in items], WATCHLIST)
