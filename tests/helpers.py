"""Small frames and row comparison for the tests."""

import math


def rows(df):
    """All rows as sorted tuples, columns in order of name."""
    names = sorted(df.columns)
    found = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    return sorted(found, key=repr)


def _plain(value):
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def column(df, *names):
    out = [tuple(r[n] for n in names) for r in df.collect()]
    return [v[0] for v in out] if len(names) == 1 else out


def close(a, b, tolerance=1e-9):
    """Equal rows, doubles up to a relative difference."""
    if len(a) != len(b):
        return False
    for left, right in zip(a, b):
        for x, y in zip(left, right):
            if isinstance(x, float) and isinstance(y, float):
                if not math.isclose(x, y, rel_tol=tolerance, abs_tol=tolerance):
                    return False
            elif x != y:
                return False
    return True
