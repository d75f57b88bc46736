"""Places of the driver's small tables, and a row order for comparisons."""

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


def rows(df, order=None):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple("" if x is None else str(x) for x in r)) if order is None else out
