"""Building small inputs and reading small results."""

from datetime import datetime, timedelta
from decimal import Decimal

from duskwork.sources.schemas import SCHEMAS, make_table

AS_OF = datetime(2024, 6, 15, 12, 0, 0)


def ago(days=0, seconds=0):
    return AS_OF - timedelta(days=days, seconds=seconds)


def money(value):
    return None if value is None else Decimal(str(value))


class Lazy(dict):
    """All job tables; those without rows are made empty on first use."""

    def __init__(self, spark, rows):
        super().__init__({name: make_table(spark, name, data) for name, data in rows.items()})
        for name in SCHEMAS:
            if name not in self:
                self[name] = make_table(spark, name)


def tables(spark, **rows):
    return Lazy(spark, rows)


def params(**values):
    return [{"param_code": k, "value": str(v)} for k, v in values.items()]


def rows(df, *columns):
    columns = columns or tuple(df.columns)
    out = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    return sorted(out, key=lambda row: tuple((v is None, v if isinstance(v, (int, float)) else str(v)) for v in row))
