"""Results as sorted lists of plain values, columns in order of their names."""

import math

import pandas as pd


def plain(v):
    if v is None or (not hasattr(v, "__len__") and pd.isna(v)):
        return None
    if isinstance(v, bool) or type(v).__name__ in ("bool_", "bool"):
        return bool(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return None if math.isnan(float(v)) else round(float(v), 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else str(v)


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False)), key=repr)


def same(left: pd.DataFrame, right: pd.DataFrame) -> None:
    assert sorted(left.columns) == sorted(right.columns)
    a, b = canonical(left), canonical(right)
    assert len(a) == len(b)
    assert a == b, [x for x in zip(a, b, strict=True) if x[0] != x[1]][:3]
