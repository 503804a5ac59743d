"""Order-insensitive comparison of result sets (columns sorted by name, exact values)."""

import datetime as dt
import decimal
import math


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def canonical_rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in rows)


def same_result(df, duck_result) -> tuple[bool, str]:
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    o_cols = [d[0] for d in duck_result.description]
    o_rows = duck_result.fetchall()
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: {sorted(set(s_cols) ^ set(o_cols))}"
    a, b = canonical_rows(s_cols, s_rows), canonical_rows(o_cols, o_rows)
    if a != b:
        extra = sorted(set(a) - set(b))[:2]
        missing = sorted(set(b) - set(a))[:2]
        return False, f"rows {len(a)} vs {len(b)}; spark-only {extra}; oracle-only {missing}"
    return True, ""
