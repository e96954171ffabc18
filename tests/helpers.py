import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)
