"""Results of two engines in a comparable form."""

SMALL = "/root/testdata/sf0.001"


def rows_of(frame):
    """The rows of a pandas frame with columns by name, in a comparable order and form."""
    import pandas as pd

    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if hasattr(v, "item"):
            v = v.item()
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    names = sorted(frame.columns)
    rows = [tuple(plain(v) for v in r) for r in frame[names].astype(object).itertuples(index=False)]
    return names, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
