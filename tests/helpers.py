from datetime import date
from decimal import Decimal

AS_OF = date(2024, 6, 30)


def tuples(df, *names):
    """Rows as sorted tuples, of the named columns if any are given."""
    chosen = df.select(*names) if names else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def mapping(df, key, value):
    return {row[key]: row[value] for row in df.select(key, value).collect()}


def d(text):
    return None if text is None else date.fromisoformat(text)


def dec(text):
    return None if text is None else Decimal(text)


def plan(df):
    return df._jdf.queryExecution().toString()
