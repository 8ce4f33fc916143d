"""Splits and folds: the key of every row and the part it falls into."""

from __future__ import annotations

from pyspark.sql import DataFrame

from terrier.catalog.registry import query
from terrier.catalog.standins import tie_order
from terrier.functions import year_month_numeric
from terrier.operators import splits

_ORDERS = {
    "o_orderkey": "whole",
    "o_custkey": "whole",
    "o_orderstatus": "text",
    "o_totalprice": "number",
    "o_orderdate": "time",
    "o_orderpriority": "text",
}
_MONTHS = "select *, cast(year(o_orderdate) * 12 + month(o_orderdate) as int) as m from orders"
_TIE = tie_order(_ORDERS)
_MONTH_TIE = tie_order({**_ORDERS, "m": "whole"})
_PLACED = f"select *, row_number() over (order by m, {_MONTH_TIE}) as r, count(*) over () as total from ({_MONTHS})"
_PLACED_BY_KEY = f"select *, row_number() over (order by o_orderkey, {_TIE}) as r, count(*) over () as total from orders"


def _months(t) -> DataFrame:
    return t["orders"].select(*_ORDERS).withColumn("year_month_numeric", year_month_numeric("o_orderdate"))


def _two_part_sql(placed: str, share: float, names: tuple[str, str]) -> str:
    return f"""select o_orderkey, case when r <= floor(cast({share} as double) * total) then '{names[0]}' else '{names[1]}' end as part
    from ({placed})"""


@query("temporal_split", _two_part_sql(_PLACED, 0.7, ("train", "test")))
def temporal_split(t):
    return splits.temporal_split(_months(t)).select("o_orderkey", "part")


@query("validation_split", _two_part_sql(_PLACED, 0.8, ("fit", "validation")))
def validation_split(t):
    return splits.validation_split(_months(t)).select("o_orderkey", "part")


@query("positional_split_80", _two_part_sql(_PLACED_BY_KEY, 0.8, ("train", "test")))
def positional_split_80(t):
    return splits.positional_split_80(t["orders"].select(*_ORDERS), "o_orderkey").select("o_orderkey", "part")


@query(
    "quantile_split",
    f"""select o_orderkey, case when m <= (select quantile_cont(m, 0.7) from ({_MONTHS})) then 'before' else 'after' end as part
    from ({_MONTHS})""",
)
def quantile_split(t):
    return splits.quantile_split(_months(t)).select("o_orderkey", "part")


@query(
    "time_series_folds",
    f"""select o_orderkey, cast(case when r > total - 5 * (total // 6) then (r - 1 - (total - 5 * (total // 6))) // (total // 6) + 1
      else 0 end as int) as block from ({_PLACED})""",
)
def time_series_folds(t):
    """The block of every row; block b is the test set of fold b, all before it its training set."""
    return splits.time_series_folds(_months(t)).select("o_orderkey", "block")


_FOLD = """(case when r <= (total % 5) * (total // 5 + 1) then (r - 1) // (total // 5 + 1)
  else total % 5 + (r - 1 - (total % 5) * (total // 5 + 1)) // (total // 5) end) + 1"""


@query("kfold_contiguous", f"select o_orderkey, cast({_FOLD} as int) as fold from ({_PLACED_BY_KEY})")
def kfold_contiguous(t):
    return splits.kfold_contiguous(t["orders"].select(*_ORDERS), "o_orderkey").select("o_orderkey", "fold")
