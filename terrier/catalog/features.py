"""Scalers, indicators and labels."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from terrier.catalog.registry import query
from terrier.functions import unique_city_id
from terrier.operators import preprocessing
from terrier.schemas import NUMERIC_COLUMNS, PREPROCESSED


@query(
    "minmax_scale",
    """select o_orderkey, round((o_totalprice - low) / (high - low), 9) as o_totalprice from orders
      cross join (select min(o_totalprice) as low, max(o_totalprice) as high from orders)""",
)
def minmax_scale(t):
    scaled = preprocessing.minmax_scale(t["orders"], ["o_totalprice"])
    return scaled.select("o_orderkey", F.round("o_totalprice", 9).alias("o_totalprice"))


@query(
    "standard_scale",
    """select o_orderkey, round((o_totalprice - mean) / std, 7) as o_totalprice from orders
      cross join (select avg(o_totalprice) as mean, stddev_pop(o_totalprice) as std from orders)""",
)
def standard_scale(t):
    scaled = preprocessing.standard_scale(t["orders"], ["o_totalprice"])
    return scaled.select("o_orderkey", F.round("o_totalprice", 7).alias("o_totalprice"))


@query(
    "one_hot",
    """select l_orderkey, l_linenumber, l_shipdate, cast(l_linestatus = 'O' as int) as status_o,
      cast(l_returnflag = 'A' as int) as flag_a, cast(l_returnflag = 'N' as int) as flag_n,
      cast(l_returnflag = 'R' as int) as flag_r from lineitem""",
)
def one_hot(t):
    lines = t["lineitem"]
    found = preprocessing.fit_categories(lines, ["l_linestatus", "l_returnflag"])
    coded = preprocessing.one_hot(lines, "l_linestatus", found["l_linestatus"], "status")
    coded = preprocessing.one_hot(coded, "l_returnflag", found["l_returnflag"], "flag")
    return coded.select("l_orderkey", "l_linenumber", "l_shipdate", "status_o", "flag_a", "flag_n", "flag_r")


@query(
    "label_encode",
    """select l_orderkey, l_linenumber, l_shipdate, coalesce(code, total) as code
    from (select *, concat('(', l_linenumber, ',', l_suppkey, ')') as city from lineitem)
      left join (select city, dense_rank() over (order by city) - 1 as code from (
        select distinct concat('(', l_linenumber, ',', l_suppkey, ')') as city from lineitem where l_linestatus = 'O'))
        using (city)
      cross join (select count(distinct concat('(', l_linenumber, ',', l_suppkey, ')')) as total
        from lineitem where l_linestatus = 'O')""",
)
def label_encode(t):
    """Labels fitted on one half of the lines, applied to all."""
    lines = t["lineitem"].withColumn("city", unique_city_id("l_linenumber", "l_suppkey"))
    labels = preprocessing.label_table(lines.filter(F.col("l_linestatus") == "O"), "city")
    coded = preprocessing.label_encode(lines, "city", labels, "code")
    return coded.select("l_orderkey", "l_linenumber", "l_shipdate", "code")


_FITTED = """(select min(n_rooms) as r0, max(n_rooms) as r1, min(new_mortgages) as m0, max(new_mortgages) as m1,
  min(debt_ratio)::double as d0, max(debt_ratio)::double as d1, min(interest_rates)::double as i0,
  max(interest_rates)::double as i1, avg(living_area::double) as a0, stddev_pop(living_area::double) as a1,
  avg(n_tax_households) as t0, stddev_pop(n_tax_households) as t1, avg(average_tax_income) as v0,
  stddev_pop(average_tax_income) as v1 from merged)"""

_APPLIED = f"""select round((n_rooms - r0) / (r1 - r0), 5) as n_rooms,
  round((new_mortgages - m0) / (m1 - m0), 5) as new_mortgages, round((debt_ratio - d0) / (d1 - d0), 4) as debt_ratio,
  round((interest_rates - i0) / (i1 - i0), 4) as interest_rates, cast(building_type = 'Maison' as int) as building_type,
  cast(coalesce(outdoor_area = 'Average outdoor space', false) as int) as average_outdoor_space,
  cast(coalesce(outdoor_area = 'Large outdoor space', false) as int) as large_outdoor_space,
  cast(coalesce(outdoor_area = 'No garden', false) as int) as no_garden,
  cast(coalesce(outdoor_area = 'Small outdoor space', false) as int) as small_outdoor_space,
  round((living_area - a0) / a1, 4) as living_area, round((n_tax_households - t0) / t1, 5) as n_tax_households,
  round((average_tax_income - v0) / v1, 5) as average_tax_income, year_month_numeric,
  round(month_sin, 8) + 0 as month_sin, round(month_cos, 8) + 0 as month_cos, departement, unique_city_id
  from merged cross join {_FITTED}"""

_DIGITS = {"n_rooms": 5, "new_mortgages": 5, "debt_ratio": 4, "interest_rates": 4, "living_area": 4, "n_tax_households": 5, "average_tax_income": 5, "month_sin": 8, "month_cos": 8}


def _rounded(df):
    return df.withColumns({c: F.round(F.col(c).cast("double"), d) + 0 for c, d in _DIGITS.items()})


@query("apply_preprocessor", _APPLIED, "merged")
def apply_preprocessor(t):
    """Fitted on all merged rows and applied to them; name_transformed fixes the output names."""
    merged = t.merged_stage
    fitted = preprocessing.fit_preprocessor(merged, with_labels=False)
    return _rounded(preprocessing.apply_preprocessor(merged, fitted))


_NAMES_SQL = " union all ".join(f"select '{f.name}' as name, {i} as place" for i, f in enumerate(PREPROCESSED))


@query(
    "name_transformed",
    f"select name, place, (select count(*) from merged) as n from ({_NAMES_SQL})",
    "merged",
)
def name_transformed(t):
    """Output columns of the transformation, in order, with their row counts."""
    merged = t.merged_stage
    done = preprocessing.apply_preprocessor(merged, preprocessing.fit_preprocessor(merged, with_labels=False))
    row = done.agg(*[F.count("*").alias(c) for c in done.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.lit(i).alias("place"), F.col(c).alias("n")) for i, c in enumerate(done.columns)]
    )
    return row.select(F.explode(pairs).alias("p")).select("p.*")


@query(
    "attach_target",
    """select unique_city_id, year_month_numeric, cast(building_type = 'Maison' as int) as building_type,
      round(log_price_per_m2, 9) as log_price_per_m2 from merged""",
    "merged",
)
def attach_target(t):
    """The target travels in the row of its features."""
    merged = t.merged_stage
    fitted = preprocessing.fit_preprocessor(merged, with_labels=False)
    done = preprocessing.apply_preprocessor(merged, fitted, keep=["log_price_per_m2"])
    return done.select(
        "unique_city_id", "year_month_numeric", "building_type",
        F.round("log_price_per_m2", 9).alias("log_price_per_m2"),
    )


_STATE = """select 'minmax' as kind, 'n_rooms' as name, round(r0, 4) as a, round(r1, 4) as b from {f}
  union all select 'minmax', 'new_mortgages', round(m0, 2), round(m1, 2) from {f}
  union all select 'minmax', 'debt_ratio', round(d0, 3), round(d1, 3) from {f}
  union all select 'minmax', 'interest_rates', round(i0, 3), round(i1, 3) from {f}
  union all select 'moments', 'living_area', round(a0, 4), round(a1, 4) from {f}
  union all select 'moments', 'n_tax_households', round(t0, 4), round(t1, 4) from {f}
  union all select 'moments', 'average_tax_income', round(v0, 4), round(v1, 4) from {f}""".replace("{f}", _FITTED)

_STATE_DIGITS = {"new_mortgages": 2, "debt_ratio": 3, "interest_rates": 3}


def _state(t, fitted):
    rows = [
        (kind, c, *[round(x, _STATE_DIGITS.get(c, 4)) for x in pair])
        for kind, table in (("minmax", fitted.minmax), ("moments", fitted.moments))
        for c, pair in table.items()
    ]
    return t.spark.createDataFrame([(k, c, float(a), float(b)) for k, c, a, b in rows], "kind string, name string, a double, b double")


@query("fit_preprocessor", _STATE.replace("round(r0, 4)", "cast(r0 as double)").replace("round(r1, 4)", "cast(r1 as double)"), "merged")
def fit_preprocessor(t):
    return _state(t, preprocessing.fit_preprocessor(t.merged_stage, with_labels=False))


@query(
    "save_preprocessor",
    """select unique_city_id as label, dense_rank() over (order by unique_city_id) - 1 as code
    from (select distinct unique_city_id from merged)""",
    "merged",
)
def save_preprocessor(t):
    """City codes after a round trip through storage."""
    path = t.scratch("preprocessor")
    preprocessing.save_preprocessor(t.spark, preprocessing.fit_preprocessor(t.merged_stage), path)
    return preprocessing.load_preprocessor(t.spark, path).labels["unique_city_id"]


@query("load_preprocessor", _APPLIED, "merged")
def load_preprocessor(t):
    """Transformation with a state that was saved and loaded."""
    path, merged = t.scratch("preprocessor"), t.merged_stage
    preprocessing.save_preprocessor(t.spark, preprocessing.fit_preprocessor(merged), path)
    fitted = preprocessing.load_preprocessor(t.spark, path)
    return _rounded(preprocessing.apply_preprocessor(merged, fitted))


@query("numeric_matrix", f"select unique_city_id, {', '.join(f'cast({c} as double) as {c}' for c in NUMERIC_COLUMNS)} from ({_APPLIED})", "merged")
def numeric_matrix(t):
    """The vector column taken apart again."""
    merged = t.merged_stage
    done = preprocessing.apply_preprocessor(merged, preprocessing.fit_preprocessor(merged, with_labels=False))
    vector = preprocessing.numeric_matrix(done).select("unique_city_id", vector_to_array("features").alias("x"))
    return _rounded(vector.select("unique_city_id", *[F.col("x")[i].alias(c) for i, c in enumerate(NUMERIC_COLUMNS)]))
