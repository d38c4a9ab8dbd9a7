"""Small tables shared by the tests."""

# Two yearly series, 1976 to 2025, with known forecasts.
SERIES_0 = [
    36, 38, 41, 24, 12, 11, 12, 15, 26, 23, 38, 40, 38, 28, 25, 39, 54, 68, 97, 105, 215, 188, 419, 660, 776,
    778, 765, 657, 506, 404, 455, 368, 397, 456, 760, 943, 1178, 1324, 1697, 1559, 1701, 1596, 1374, 1627, 1388,
    1402, 1414, 1204, 1542, 1171,
]
SERIES_1 = [
    0, 4, 4, 4, 5, 1, 2, 7, 8, 3, 11, 2, 2, 1, 8, 1, 0, 1, 6, 6, 2, 7, 25, 28, 48,
    19, 16, 6, 7, 10, 13, 16, 14, 29, 34, 26, 4, 2, 0, 2, 4, 3, 2, 5, 3, 2, 4, 4, 7, 6,
]
YEARS = list(range(1976, 2026))


def totals(spark):
    rows = [(y, a + b) for y, a, b in zip(YEARS, SERIES_0, SERIES_1)]
    return spark.createDataFrame(rows, "year int, n long")


def clusters(spark):
    rows = [(f"cluster_{k}", y, n) for k, s in enumerate((SERIES_0, SERIES_1)) for y, n in zip(YEARS, s)]
    return spark.createDataFrame([r for r in rows if r[2]], "cluster string, year int, n long")


FLAG_EVENTS = [(2000, 0, 1), (2000, 1, 0), (2001, 1, 1), (2001, 0, 1), (2001, 1, 0), (2002, 0, 1)]


def flag_events(spark):
    return spark.createDataFrame(FLAG_EVENTS, "year int, kw_a int, kw_b int")


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
