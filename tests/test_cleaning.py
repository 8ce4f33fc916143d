"""The row cleaner and the name join on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from terrier.operators import cleaning, enrich, series
from terrier.schemas import CLEANED, TRANSACTIONS_RAW, expect_schema

BASE = {
    "id_transaction": "1", "date_transaction": "2021-08-15", "prix": 134000.0, "departement": 27,
    "id_ville": 185, "ville": "X", "type_batiment": "Maison", "n_pieces": 2, "surface_habitable": 67.0,
    "surface_locaux_industriels": "{}", "surface_terrains_agricoles": "{}", "surface_terrains_sols": "{}",
}


def raw(spark, *changes):
    rows = [{**BASE, **change} for change in changes]
    return spark.createDataFrame([[r.get(f.name) for f in TRANSACTIONS_RAW] for r in rows], TRANSACTIONS_RAW)


def clean(spark, *changes, **options):
    return cleaning.clean_transactions(raw(spark, *changes), **options)


def test_kept_row(spark):
    df = expect_schema(clean(spark, {}), CLEANED)
    row = enrich.stateless_features(df).first()
    assert row["surface_terrains_sols"] == "No garden"
    assert row["year_month_numeric"] == 24260
    assert row["unique_city_id"] == "(27,185)"
    assert row["log_price_per_m2"] == pytest.approx(7.6009025, abs=1e-7)
    assert row["departement"] == "27"


def test_copies_collapse_whatever_their_id(spark):
    assert clean(spark, {}, {"id_transaction": "2"}, {"adresse": "elsewhere"}).count() == 1
    assert clean(spark, {}, {"id_transaction": "2"}, dedupe=False).count() == 2


def test_different_raw_land_text_is_not_a_copy(spark):
    """The comparison is on the raw text, so two labels can come out equal."""
    assert clean(spark, {}, {"surface_terrains_sols": "{80,45}"}).count() == 2


@pytest.mark.parametrize(
    ("land", "label"),
    [
        ("{120}", "Small outdoor space"), ("{200}", "Small outdoor space"), ("{200.5}", "Average outdoor space"),
        ("{1000}", "Average outdoor space"), ("{1001}", "Large outdoor space"), ("{80,45}", "No garden"),
        ("{abc}", "No garden"), (None, "No garden"), ("{-5}", None),
    ],
)
def test_land(spark, land, label):
    assert [r[0] for r in clean(spark, {"surface_terrains_sols": land}).select("surface_terrains_sols").collect()] == [label]


def test_plots_can_be_summed(spark):
    got = clean(spark, {"surface_terrains_sols": "{80,145}"}, sum_plots=True).first()
    assert got["surface_terrains_sols"] == "Average outdoor space"


@pytest.mark.parametrize(
    "change",
    [
        {"surface_terrains_agricoles": "{10}"}, {"surface_terrains_agricoles": None},
        {"surface_locaux_industriels": "{10}"}, {"surface_locaux_industriels": None},
        {"date_transaction": "not a date"}, {"date_transaction": None}, {"prix": None}, {"prix": float("nan")},
        {"ville": None}, {"type_batiment": None}, {"n_pieces": None}, {"surface_habitable": None},
        {"departement": 96}, {"departement": 971}, {"n_pieces": 0}, {"id_ville": None},
    ],
)
def test_dropped(spark, change):
    assert clean(spark, change).count() == 0


def test_kept_at_the_bounds(spark):
    assert clean(spark, {"departement": 95}).count() == 1
    assert clean(spark, {"n_pieces": 1}).count() == 1
    assert clean(spark, {"surface_habitable": 0.0}).count() == 1


def test_text_columns_are_parsed(spark):
    text = raw(spark, {}, {"id_transaction": "2"}).select([F.col(c).cast("string") for c in TRANSACTIONS_RAW.names])
    odd = text.withColumn("departement", F.lit("2A"))
    assert cleaning.clean_transactions(text).count() == 1
    assert cleaning.clean_transactions(odd).count() == 0


def test_city_mapping(spark):
    pairs = cleaning.city_mapping(clean(spark, {}, {"prix": 1.0}, {"ville": "Y"})).orderBy("ville").collect()
    assert [tuple(p) for p in pairs] == [("X", "(27,185)"), ("Y", "(27,185)")]


def homonyms(spark):
    mapping = spark.createDataFrame(
        [("SAINT-DENIS", "(93,66)"), ("SAINT-DENIS", "(11,339)")], "ville string, unique_city_id string"
    )
    tax = spark.createDataFrame(
        [(2014, "93", "Saint-Denis", 100.0, 10.0), (2014, "11", "Saint-Denis", 300.0, None), (2014, "1", "Else", 1.0, 1.0)],
        "date int, departement string, ville string, n_foyers_fiscaux double, revenu_fiscal_moyen double",
    )
    return tax, mapping


def test_homonyms_share_their_mean(spark):
    tax, mapping = homonyms(spark)
    want = {"(93,66)": (200.0, 10.0), "(11,339)": (200.0, 10.0)}
    for table in (
        cleaning.clean_tax_households(tax, mapping),
        cleaning.agg_tax_by_city(cleaning.join_city_names(tax, mapping)),
    ):
        assert {r[0]: (r[1], r[2]) for r in table.collect()} == want


def test_department_can_be_matched(spark):
    tax, mapping = homonyms(spark)
    want = {"(93,66)": (100.0, 10.0), "(11,339)": (300.0, None)}
    for table in (
        cleaning.clean_tax_households(tax, mapping, match_department=True),
        cleaning.agg_tax_by_city(cleaning.join_city_names(tax, mapping, match_department=True)),
    ):
        assert {r[0]: (r[1], r[2]) for r in table.collect()} == want


def test_sales_without_a_match_drop_out(spark):
    sales = enrich.stateless_features(clean(spark, {}, {"id_ville": 9}, {"date_transaction": "1990-01-01"}))
    tax = spark.createDataFrame([("(27,185)", 1.0, 2.0)], "unique_city_id string, n_foyers_fiscaux double, revenu_fiscal_moyen double")
    month = spark.createDataFrame([(24260, 1.0, 2.0, 3.0)], "year_month_numeric int, New_mortgages double, Debt_ratio double, Interest_rates double")
    merged = enrich.rename_features(enrich.merge_features(sales, month, tax))
    assert [(r["unique_city_id"], r["year_month_numeric"]) for r in merged.collect()] == [("(27,185)", 24260)]


def test_secondary_tables(spark):
    tax, mapping = homonyms(spark)
    raw_tables = {
        "foyers_fiscaux_df": tax,
        "taux_interet_df": spark.createDataFrame([("2014-03-01", 2.0), ("2014-01-01", 1.0)], "date string, taux double"),
        "flux_nouveaux_emprunts_df": spark.createDataFrame([("2014-01-01", 26094.0), ("2014-04-01", 2.0)], "date string, `emprunts_M€` double"),
        "taux_endettement_df": spark.createDataFrame([(2014, 0.0), (2015, 12.0)], "date int, valeur double"),
    }
    done = cleaning.clean_secondary(raw_tables, mapping)
    assert [r["taux"] for r in done["taux_interet_df"].collect()] == [1.0, 2.0]
    assert done["flux_nouveaux_emprunts_df"].first()["emprunts_€"] == 26_094_000_000.0
    assert done["taux_endettement_df"].count() == 13
    months = series.combined_temporal_features(
        done["flux_nouveaux_emprunts_df"], done["taux_interet_df"], done["taux_endettement_df"]
    ).orderBy("year_month_numeric").collect()
    assert [tuple(m) for m in months] == [
        (26094000000.0, 0.0, 1.0, 24169), (pytest.approx((26094000000.0 * 2 + 2000000) / 3), 1.0, 1.5, 24170),
        (pytest.approx((26094000000.0 + 4000000) / 3), 2.0, 2.0, 24171), (2000000.0, 3.0, 2.0, 24172),
    ]


def test_rents(spark):
    _, mapping = homonyms(spark)
    rents = spark.createDataFrame(
        [(2018, "93", 66, "Saint-Denis", 10.0), (2018, "11", 339, "Saint-Denis", 20.0), (2019, "93", 66, "Saint-Denis", 30.0)],
        "date int, departement string, id_ville int, ville string, loyer double",
    )
    joined = cleaning.rents_features(rents, mapping)
    by_join = cleaning.pivot_rents(joined, [24217, 24229]).orderBy("unique_city_id").collect()
    by_name = cleaning.pivot_rents(cleaning.rents_by_month(rents, mapping), [24217, 24229]).orderBy("unique_city_id").collect()
    assert [tuple(r) for r in by_join] == [("(11,339)", 15.0, 30.0), ("(93,66)", 15.0, 30.0)]
    assert by_join == by_name


def test_a_hot_name_gives_the_same_means_as_the_plain_join(spark):
    """One name holds a third of the tax rows and several cities."""
    tax = spark.range(900).selectExpr(
        "cast(2014 + id % 5 as int) as date",
        "cast(id % 7 as string) as departement",
        "if(id % 3 = 0, 'Hot', concat('Ville ', id % 40)) as ville",
        "if(id % 11 = 0, null, cast(id as double)) as n_foyers_fiscaux",
        "cast(id % 17 as double) as revenu_fiscal_moyen",
    )
    mapping = spark.range(60).selectExpr(
        "if(id < 12, 'HOT', concat('VILLE ', id % 45)) as ville", "concat('(', id % 7, ',', id, ')') as unique_city_id"
    )
    for match in (False, True):
        by_join = cleaning.agg_tax_by_city(cleaning.join_city_names(tax, mapping, match)).orderBy("unique_city_id")
        by_name = cleaning.clean_tax_households(tax, mapping, match).orderBy("unique_city_id")
        assert by_join.collect() == by_name.collect()
        assert by_name.count() > 12
