"""Compare a Spark result with its SQL counterpart, order-insensitively and by column name."""

from __future__ import annotations

import datetime
import decimal
import math


def normalise(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def canonical(names, rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in a fixed order, values in plain Python types."""
    order = sorted(range(len(names)), key=lambda place: names[place])
    plain = [tuple(normalise(row[place]) for place in order) for row in rows]
    return [names[place] for place in order], sorted(plain, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


def difference(spark_df, connection, sql: str) -> str | None:
    """None when both results are equal, else a short description."""
    left_names, left = canonical(spark_df.columns, spark_df.collect())
    cursor = connection.execute(sql)
    right_names, right = canonical([item[0] for item in cursor.description], cursor.fetchall())
    if left_names != right_names:
        return f"columns differ: {sorted(set(left_names) ^ set(right_names))}"
    if len(left) != len(right):
        return f"rows differ: {len(left)} in Spark, {len(right)} in SQL"
    types = [(n, type(a).__name__, type(b).__name__) for n, a, b in zip(left_names, *(left[:1] + right[:1]))
             if a is not None and b is not None and type(a) is not type(b)] if left else []
    if types:
        return f"types differ: {types}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first: {wrong[0][0]} / {wrong[0][1]} for {left_names}"
    return None
