"""Stand-ins for the raw inputs, derived from the test tables by rules on their keys.

Each stand-in exists twice, as a DataFrame and as SQL text, and has the columns of the raw input it
stands for. Values that get averaged are whole numbers, so sums do not depend on their order. The
rules plant the cases the operators must handle: missing values, bad dates, land lists, copies,
homonymous communes, series with holes and dates off the spine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.schemas import MERGED

_LAND = """case {part} % 12
    when 0 then '{{}}' when 1 then '{{120}}' when 2 then '{{80,45}}' when 3 then '{{200}}'
    when 4 then '{{200.5}}' when 5 then '{{1000}}' when 6 then '{{1001}}' when 7 then '{{abc}}'
    when 9 then '{{-5}}' when 10 then concat('{{', cast(cast({qty} * 30 as int) as {text}), '}}')
    when 11 then '{{1d}}' end"""

# Sales: column name and expression, valid in both SQL dialects once the two markers are filled in.
_SALE = {
    "id_transaction": "cast(l_orderkey * 8 + l_linenumber as {text})",
    "date_transaction": "case when l_orderkey % 97 = 5 then 'not a date' else {day} end",
    "prix": """case when l_partkey % 89 = 3 then null when l_partkey % 83 = 4 then cast(0 as double)
        when l_partkey % 79 = 5 then -cast(floor(l_extendedprice) as double)
        else cast(floor(l_extendedprice) as double) end""",
    "departement": "cast(1 + l_suppkey % 99 as int)",
    "id_ville": "cast(l_suppkey as int)",
    "ville": "concat('VILLE ', cast(cast(floor(l_suppkey / 3) as bigint) as {text}))",
    "code_postal": "cast(10000 + l_suppkey % 80000 as {text})",
    "adresse": "l_returnflag",
    "type_batiment": "case when l_linestatus = 'O' then 'Maison' else 'Appartement' end",
    "vefa": "'false'",
    "n_pieces": "cast(l_linenumber - 1 as int)",
    "surface_habitable": "case when l_partkey % 61 = 2 then cast(0 as double) else l_quantity end",
    "id_parcelle_cadastre": "cast(l_partkey as {text})",
    "latitude": "cast(cast(l_tax * 100 as int) as {text})",
    "longitude": "cast(cast(l_discount * 100 as int) as {text})",
    "surface_dependances": "'{{}}'",
    "surface_locaux_industriels": "case when l_partkey % 19 = 1 then '{{10}}' when l_partkey % 23 = 1 then null else '{{}}' end",
    "surface_terrains_agricoles": "case when l_orderkey % 29 = 1 then '{{25}}' when l_orderkey % 31 = 1 then null else '{{}}' end",
    "surface_terrains_sols": _LAND.replace("{part}", "l_partkey").replace("{qty}", "l_quantity"),
    "surface_terrains_nature": "'{{}}'",
}


def _sale(text: str, day: str) -> list[str]:
    return [f"{e.format(text=text, day=day)} as {n}" for n, e in _SALE.items()]


def raw_transactions(lineitem: DataFrame) -> DataFrame:
    """Raw sales; every tenth order is listed twice."""
    copies = lineitem.withColumn("_copy", F.explode(F.expr("sequence(1, if(l_orderkey % 10 = 0, 2, 1))")))
    return copies.selectExpr(*_sale("string", "cast(cast(l_shipdate as date) as string)"))


def tax_households(supplier: DataFrame) -> DataFrame:
    """Three years of tax rows per city; some cities have none."""
    years = supplier.filter("s_suppkey % 17 <> 4").withColumn("y", F.explode(F.expr("sequence(0, 2)")))
    return years.selectExpr(
        "cast(2014 + y as int) as date",
        "cast(1 + s_suppkey % 99 as string) as departement",
        "concat('Ville ', cast(floor(s_suppkey / 3) as bigint)) as ville",
        "case when (s_suppkey + y) % 13 <> 0 then cast(100 + s_suppkey * 7 % 500 + y as double) end as n_foyers_fiscaux",
        "cast(floor(abs(s_acctbal)) + y * 10 as double) as revenu_fiscal_moyen",
    )


def rents(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "cast(2018 + c_custkey % 4 as int) as date",
        "cast(1 + c_custkey % 99 as string) as departement",
        "cast(c_custkey as int) as id_ville",
        "concat('Ville ', cast(floor(c_custkey / 45) as bigint)) as ville",
        "cast(floor(abs(c_acctbal)) as double) as loyer_m2",
        "cast(c_custkey % 37 as double) as loyer_median",
    )


def debt_ratio(orders: DataFrame) -> DataFrame:
    """Yearly series."""
    return orders.groupBy(F.year("o_orderdate").alias("date")).agg(
        (F.sum("o_custkey").cast("double") / F.count("*")).alias("taux_endettement")
    )


def interest_rates(orders: DataFrame) -> DataFrame:
    """Monthly series with holes, a late start, and some dates inside the month."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    monthly = orders.groupBy(month.alias("m")).agg(
        (F.sum(F.expr("o_custkey % 997")).cast("double") / F.count("*")).alias("taux")
    )
    kept = monthly.filter("month(m) % 4 <> 0 and not (year(m) = 1995 and month(m) < 3)")
    return kept.selectExpr("date_format(if(month(m) % 6 = 5, date_add(m, 14), m), 'yyyy-MM-dd') as date", "taux")


def new_mortgages(orders: DataFrame) -> DataFrame:
    """Monthly series without its Julys."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    monthly = orders.groupBy(month.alias("m")).agg(F.sum(F.expr("o_orderkey % 1000")).cast("double").alias("emprunts_M€"))
    return monthly.filter("month(m) <> 7").select(F.date_format("m", "yyyy-MM-dd").alias("date"), "emprunts_M€")


def rent_index(orders: DataFrame) -> DataFrame:
    """Quarterly index."""
    date = F.col("o_orderdate").cast("date")
    label = F.concat(F.year(date).cast("string"), F.lit("-Q"), F.quarter(date).cast("string"))
    return orders.groupBy(label.alias("quarter")).agg(
        (F.sum(F.expr("o_custkey % 97")).cast("double") / F.count("*")).alias("IRL")
    )


# -- the same tables and the stages after them, as SQL -----------------------------------------

_MONTH_START = "cast(date_trunc('month', o_orderdate) as date)"


def interpolated(source: str, value: str) -> str:
    """SQL for linear filling by row of one column of a month table."""
    return f"""select month, coalesce(v, pv + (nv - pv) * (i - pi) / (ni - pi), pv) as {value} from (
      select month, i, v,
        last_value(v ignore nulls) over (order by month rows between unbounded preceding and current row) as pv,
        last_value(vi ignore nulls) over (order by month rows between unbounded preceding and current row) as pi,
        first_value(v ignore nulls) over (order by month rows between current row and unbounded following) as nv,
        first_value(vi ignore nulls) over (order by month rows between current row and unbounded following) as ni
      from (select *, case when v is not null then i end as vi from (
        select month, {value} as v, row_number() over (order by month) as i from {source})))"""


_PRICE = """case when prix = 0 then 1e-5
      when surface_habitable = 0 then (case when prix > 0 then 'Infinity'::double else '-Infinity'::double end)
      else prix / cast(surface_habitable as double) end"""

CTES: dict[str, tuple[str, str]] = {
    "raw": (
        "",
        "select "
        + ", ".join(_sale("varchar", "strftime(l_shipdate, '%Y-%m-%d')"))
        + " from (select * from lineitem union all select * from lineitem where l_orderkey % 10 = 0)",
    ),
    "cleaned": (
        "raw",
        """select cast(date_transaction as date) as date_transaction, prix, departement, id_ville, ville,
          type_batiment, n_pieces, cast(surface_habitable as float) as surface_habitable,
          case when land <= -1 then null when land <= 0 then 'No garden' when land <= 200 then 'Small outdoor space'
            when land <= 1000 then 'Average outdoor space' else 'Large outdoor space' end as surface_terrains_sols
        from (select *, case when contains(sols, ',') then 0
            else coalesce(try_cast(regexp_replace(sols, '[{}]', '', 'g') as double), 0) end as land
          from (select distinct date_transaction, prix, departement, id_ville, ville, type_batiment, n_pieces,
              surface_habitable, surface_terrains_sols as sols
            from raw where surface_terrains_agricoles = '{}' and surface_locaux_industriels = '{}'
              and try_cast(date_transaction as date) is not null and prix is not null
              and departement <= 95 and n_pieces > 0))""",
    ),
    "mapping": (
        "cleaned",
        "select distinct ville, concat('(', departement, ',', id_ville, ')') as unique_city_id from cleaned",
    ),
    "stateless": (
        "cleaned",
        f"""select cast(year(date_transaction) * 12 + month(date_transaction) as int) as year_month_numeric,
          sin(2 * pi() * month(date_transaction) / 12) as month_sin,
          cos(2 * pi() * month(date_transaction) / 12) as month_cos,
          cast(departement as varchar) as departement, concat('(', departement, ',', id_ville, ')') as unique_city_id,
          case when p > 0 then ln(p) end as log_price_per_m2, surface_habitable as living_area,
          type_batiment, n_pieces, surface_terrains_sols
        from (select *, {_PRICE} as p from cleaned)""",
    ),
    "tax_raw": (
        "",
        """select cast(2014 + y as int) as date, cast(1 + s_suppkey % 99 as varchar) as departement,
          concat('Ville ', cast(floor(s_suppkey / 3) as bigint)) as ville,
          case when (s_suppkey + y) % 13 <> 0 then cast(100 + s_suppkey * 7 % 500 + y as double) end as n_foyers_fiscaux,
          cast(floor(abs(s_acctbal)) + y * 10 as double) as revenu_fiscal_moyen
        from supplier cross join range(3) as years(y) where s_suppkey % 17 <> 4""",
    ),
    "rents_raw": (
        "",
        """select cast(2018 + c_custkey % 4 as int) as date, cast(1 + c_custkey % 99 as varchar) as departement,
          cast(c_custkey as int) as id_ville, concat('Ville ', cast(floor(c_custkey / 45) as bigint)) as ville,
          cast(floor(abs(c_acctbal)) as double) as loyer_m2, cast(c_custkey % 37 as double) as loyer_median
        from customer""",
    ),
    "tax": (
        "tax_raw mapping",
        """select unique_city_id, avg(n_foyers_fiscaux) as n_foyers_fiscaux, avg(revenu_fiscal_moyen) as revenu_fiscal_moyen
        from (select upper(ville) as ville, n_foyers_fiscaux, revenu_fiscal_moyen from tax_raw)
          join mapping using (ville) group by unique_city_id""",
    ),
    "debt_raw": (
        "",
        """select cast(year(o_orderdate) as int) as date, cast(sum(o_custkey) as double) / count(*) as taux_endettement
        from orders group by 1""",
    ),
    "rates_raw": (
        "",
        f"""select strftime(case when month(m) % 6 = 5 then m + 14 else m end, '%Y-%m-%d') as date, taux from (
          select {_MONTH_START} as m, cast(sum(o_custkey % 997) as double) / count(*) as taux from orders group by 1)
        where month(m) % 4 <> 0 and not (year(m) = 1995 and month(m) < 3)""",
    ),
    "mortgages_raw": (
        "",
        f"""select strftime(m, '%Y-%m-%d') as date, "emprunts_M€" from (
          select {_MONTH_START} as m, cast(sum(o_orderkey % 1000) as double) as "emprunts_M€" from orders group by 1)
        where month(m) <> 7""",
    ),
    "quarters_raw": (
        "",
        """select concat(year(o_orderdate), '-Q', quarter(o_orderdate)) as quarter,
          cast(sum(o_custkey % 97) as double) / count(*) as "IRL" from orders group by 1""",
    ),
    "rates": ("rates_raw", "select cast(date as date) as month, taux from rates_raw"),
    "mortgages": ("mortgages_raw", 'select cast(date as date) as month, "emprunts_M€" * 1000000 as "emprunts_€" from mortgages_raw'),
    "spine": (
        "mortgages",
        "select cast(unnest(generate_series(min(month), max(month), interval 1 month)) as date) as month from mortgages",
    ),
    "debt_spine": (
        "debt_raw",
        """select month, taux_endettement from (select cast(unnest(generate_series(make_date(min(date), 1, 1),
          make_date(max(date), 1, 1), interval 1 month)) as date) as month from debt_raw)
          left join (select make_date(date, 1, 1) as month, taux_endettement from debt_raw) using (month)""",
    ),
    "debt": ("debt_spine", interpolated("debt_spine", "taux_endettement")),
    "debt_on_spine": ("spine debt", "select month, taux_endettement from spine left join debt using (month)"),
    "rates_on_spine": ("spine rates", "select month, taux from spine left join rates using (month)"),
    "mortgages_on_spine": ("spine mortgages", 'select month, "emprunts_€" as emprunts from spine left join mortgages using (month)'),
    "debt_filled": ("debt_on_spine", interpolated("debt_on_spine", "taux_endettement")),
    "rates_filled": ("rates_on_spine", interpolated("rates_on_spine", "taux")),
    "mortgages_filled": ("mortgages_on_spine", interpolated("mortgages_on_spine", "emprunts")),
    "temporal": (
        "debt_filled rates_filled mortgages_filled",
        """select emprunts as "New_mortgages", cast(taux_endettement as float) as "Debt_ratio",
          cast(taux as float) as "Interest_rates", cast(year(month) * 12 + month(month) as int) as year_month_numeric
        from mortgages_filled join debt_filled using (month) join rates_filled using (month)
        where emprunts is not null and taux_endettement is not null and taux is not null""",
    ),
    "merged": (
        "stateless temporal tax",
        """select year_month_numeric, month_sin, month_cos, departement, unique_city_id, log_price_per_m2, living_area,
          type_batiment as building_type, n_pieces as n_rooms, surface_terrains_sols as outdoor_area,
          "New_mortgages" as new_mortgages, "Debt_ratio" as debt_ratio, "Interest_rates" as interest_rates,
          n_foyers_fiscaux as n_tax_households, revenu_fiscal_moyen as average_tax_income
        from stateless join temporal using (year_month_numeric) join tax using (unique_city_id)""",
    ),
}


def tie_order(columns: dict[str, str]) -> str:
    """SQL for the digest that orders rows of equal keys; ``columns`` in table order with their kinds."""
    kinds = {
        "number": """case when abs({c}::double) < 70368744177664 then floor({c}::double * 65536 + 0.5)::bigint::varchar
          when {c} = 'Infinity'::double then 'Infinity' when {c} = '-Infinity'::double then '-Infinity'
          else {c}::varchar end""",
        "time": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
        "whole": "{c}::varchar",
        "text": r"replace(replace({c}, '\', '\\'), '|', '\|')",
    }
    texts = [f"coalesce({kinds[kind].format(c=name)}, '\\N')" for name, kind in columns.items()]
    return f"substr(md5(concat_ws('|', {', '.join(texts)})), 1, 11)"


MERGED_KINDS = {
    f.name: {"double": "number", "float": "number", "int": "whole"}.get(f.dataType.simpleString(), "text") for f in MERGED
}

CTES["parts"] = (
    "merged",
    f"""select *, case when r <= floor(cast(0.7 as double) * total) then 'train' else 'test' end as part
    from (select *, row_number() over (order by year_month_numeric, {tie_order(MERGED_KINDS)}) as r, count(*) over () as total
      from (select {", ".join(MERGED_KINDS)} from merged where n_tax_households is not null and average_tax_income is not null))""",
)


def _minmax(name: str, kind: str) -> str:
    low, high = f"(select min({name}::double) from train)", f"(select max({name}::double) from train)"
    return f"cast(case when {high} = {low} then {name} * 0 else ({name}::double - {low}) / ({high} - {low}) end as {kind}) as {name}"


def _standard(name: str, kind: str) -> str:
    mean, spread = f"(select avg({name}::double) from train)", f"(select stddev_pop({name}::double) from train)"
    return f"cast(case when {spread} = 0 then {name} * 0 else ({name}::double - {mean}) / {spread} end as {kind}) as {name}"


CTES["train"] = ("parts", "select * from parts where part = 'train'")
CTES["prepared"] = (
    "train",
    f"""select part, {_minmax("n_rooms", "float")}, {_minmax("new_mortgages", "double")}, {_minmax("debt_ratio", "float")},
      {_minmax("interest_rates", "float")}, cast(building_type = 'Maison' as int) as building_type,
      coalesce(cast(outdoor_area = 'Average outdoor space' as int), 0) as average_outdoor_space,
      coalesce(cast(outdoor_area = 'Large outdoor space' as int), 0) as large_outdoor_space,
      coalesce(cast(outdoor_area = 'No garden' as int), 0) as no_garden,
      coalesce(cast(outdoor_area = 'Small outdoor space' as int), 0) as small_outdoor_space,
      {_standard("living_area", "float")}, {_standard("n_tax_households", "double")}, {_standard("average_tax_income", "double")},
      year_month_numeric, month_sin, month_cos, departement, unique_city_id, log_price_per_m2
    from parts""",
)


def with_ctes(sql: str, names: list[str]) -> str:
    """Prefix a query with the stand-ins it names and everything they are built on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0].split():
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql
    return "with " + ",\n".join(f"{n} as ({CTES[n][1]})" for n in ordered) + "\n" + sql
