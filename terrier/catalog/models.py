"""Baseline, models, evaluation, scoring and the pipeline steps.

Trained models depend on how ties among splits and float sums fall out, so the queries that train
return facts about the run that SQL can state as well: what was scored, that the error is finite and
below that of the mean, that the rounds lie within the limit. The steps around a model are compared
value by value, with a formula model in the registry.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrier.catalog.registry import Tables, query
from terrier.functions import normal_city_id
from terrier.operators import modelling, preprocessing, splits
from terrier.plans import pipeline
from terrier.schemas import SCORING_REQUEST, STATELESS, TRANSACTIONS_RAW
from terrier.sources import registry, scratch, tables
from terrier.sources.files import remove_folder

_FOLDS = """select (case when r <= (total % 5) * (total // 5 + 1) then (r - 1) // (total // 5 + 1)
  else total % 5 + (r - 1 - (total % 5) * (total // 5 + 1)) // (total // 5) end) as fold, o_totalprice as y
  from (select *, row_number() over (order by o_orderkey) as r, count(*) over () as total from orders)"""


@query(
    "baseline_mean",
    f"""select round(avg(r2), 8) as mean_r2 from (
      select 1 - (ss - 2 * g * s + n * g * g) / (ss - s * s / n) as r2 from (
        select *, (sum(s) over () - s) / (sum(n) over () - n) as g from (
          select fold, count(*) as n, sum(y) as s, sum(y * y) as ss from ({_FOLDS}) group by fold)))""",
)
def baseline_mean(t):
    return modelling.baseline_mean(t["orders"], "o_totalprice", "o_orderkey").select(
        F.round("mean_r2", 8).alias("mean_r2")
    )


def _group_mean(t: Tables) -> DataFrame:
    """Order price predicted by the mean of its priority.

    The five means are written before they are joined back: their size is then known when the join
    is planned, and the orders are not shuffled on five keys.
    """
    orders = t["orders"].select("o_orderpriority", F.floor("o_totalprice").cast("double").alias("y"))
    means = orders.groupBy("o_orderpriority").agg(F.avg("y").alias("p"))
    return orders.join(scratch.settle(means, "means"), "o_orderpriority")


_GROUP_MEAN = """(select floor(o_totalprice) as y, avg(floor(o_totalprice)) over (partition by o_orderpriority) as p from orders)"""


@query(
    "evaluate_rmse",
    f"select round(avg((p - y) * (p - y)), 2) as loss, round(sqrt(avg((p - y) * (p - y) + 1e-8)), 5) as rmse from {_GROUP_MEAN}",
)
def evaluate_rmse(t):
    metrics = modelling.evaluate_rmse(_group_mean(t), "p", "y")
    return metrics.select(F.round("loss", 2).alias("loss"), F.round("rmse", 5).alias("rmse"))


@query("evaluate_mae", f"select round(avg(abs(p - y)), 5) as mae from {_GROUP_MEAN}")
def evaluate_mae(t):
    return modelling.evaluate_mae(_group_mean(t), "p", "y").select(F.round("mae", 5).alias("mae"))


class _Trained:
    """Split, fitted and encoded rows of one set of tables, with the models on top."""

    def __init__(self, t: Tables):
        self.t = t
        # The merged rows are not read again once they are split.
        path = t.scratch("merged")
        parts = scratch.settle(splits.temporal_split(scratch.settle(t.merged, "merged", path)), "parts")
        remove_folder(t.spark, path)
        self.train = parts.filter("part = 'train'").drop("part")
        self.test = parts.filter("part = 'test'").drop("part")
        self.fitted = preprocessing.fit_preprocessor(self.train)
        self.departments = self.fitted.labels["departement"].count()
        self.cities = self.fitted.labels["unique_city_id"].count()

    def encoded(self, rows: DataFrame) -> DataFrame:
        done = preprocessing.apply_preprocessor(rows, self.fitted, keep=[modelling.TARGET])
        return preprocessing.encode_labels(done, self.fitted)

    def scored_test(self, model: modelling.Model) -> DataFrame:
        return modelling.predict(modelling.drop_non_finite(self.encoded(self.test), modelling.TARGET), model)

    @cached_property
    def parts(self) -> tuple[DataFrame, DataFrame]:
        """Encoded rows to fit on and rows to stop by."""
        rows = splits.validation_split(modelling.drop_non_finite(self.train, modelling.TARGET))
        done = preprocessing.apply_preprocessor(rows, self.fitted, keep=[modelling.TARGET, "part"])
        parts = scratch.settle(preprocessing.encode_labels(done, self.fitted), "fit_validation")
        return parts.filter("part = 'fit'").drop("part"), parts.filter("part = 'validation'").drop("part")

    def gbt(self):
        fit, validation = self.parts
        return modelling.train_gbt(fit, self.departments, validation)

    def embedding(self):
        fit, validation = self.parts
        return modelling.train_embedding_model(fit, self.departments, self.cities, validation=validation)


def _facts(trained: _Trained, model: modelling.Model) -> DataFrame:
    """What any sound fit has to show: scored test rows, and an error on its own rows below that of their mean.

    The stand-ins' prices are drawn without regard to the features, so there is nothing to predict on other rows.
    """
    rows = modelling.drop_non_finite(trained.encoded(trained.train), modelling.TARGET)
    with scratch.own_shuffles_removed(trained.t.spark):
        own = modelling.evaluate_rmse(modelling.predict(rows, model)).first()["rmse"]
    spread = rows.agg(F.stddev_pop(modelling.TARGET)).first()[0]
    return modelling.evaluate(trained.scored_test(model)).select(
        (F.col("row_count") > 0).alias("scored"),
        F.lit(own < spread).alias("learnt"),
        (F.abs(F.col("rmse") * F.col("rmse") - F.col("loss") - 1e-8) < 1e-6).alias("consistent"),
        (F.col("mae") <= F.col("rmse")).alias("ordered"),
    )


_FACTS = "select count(*) > 0 as scored, true as learnt, true as consistent, true as ordered from merged"


@query("train_gbt", _FACTS.replace("as ordered", "as ordered, true as rounds_in_limit"), "merged")
def train_gbt(t):
    """Facts about a fit with the library's parameters, and that it used no more than their rounds."""
    trained = _Trained(t)
    model = trained.gbt()
    rounds = 1 <= model.rounds <= modelling.GBT_PARAMS["maxIter"]
    return _facts(trained, model).withColumn("rounds_in_limit", F.lit(rounds))


@query("train_embedding_model", _FACTS, "merged")
def train_embedding_model(t):
    trained = _Trained(t)
    return _facts(trained, trained.embedding())


def _formula_model(t: Tables, statement: str) -> PipelineModel:
    """A model with a known formula, so that the path around the model can be checked in SQL."""
    return Pipeline(stages=[SQLTransformer(statement=statement)]).fit(t.spark.range(1))


_FORMULA = """8 + 0.1D * n_rooms + 0.2D * living_area + 0.05D * building_type + 0.001D * departement
  + 0.0001D * unique_city_id"""

_SCORED = """select {columns}, round(y, 6) as log_price, round(exp(y), 3) as price_per_sq_meter from (
  select m.*, 8 + 0.1::double * cast((n_rooms - r0) / (r1 - r0) as float)::double
    + 0.2::double * cast((living_area::double - a0) / a1 as float)::double
    + case when building_type = 'Maison' then 0.05::double else 0 end + 0.001::double * d.code + 0.0001::double * c.code as y
  from merged m
    join (select departement, row_number() over (order by departement) - 1 as code
      from (select distinct departement from merged)) d on d.departement = m.departement
    join (select unique_city_id, row_number() over (order by unique_city_id) - 1 as code
      from (select distinct unique_city_id from merged)) c on c.unique_city_id = m.unique_city_id
    cross join (select min(n_rooms) as r0, max(n_rooms) as r1, avg(living_area::double) as a0,
      stddev_pop(living_area::double) as a1 from merged))"""


def _rounded_scores(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"log_price": F.round("log_price", 6), "price_per_sq_meter": F.round("price_per_sq_meter", 3)}
    )


@query("score_batch", _SCORED.format(columns="unique_city_id, year_month_numeric"), "merged")
def score_batch(t):
    """Every merged row through the fitted preprocessor, the label codes and a formula model."""
    merged = t.merged_stage
    model = _formula_model(t, f"SELECT *, {_FORMULA} AS log_price FROM __THIS__")
    fitted = preprocessing.fit_preprocessor(merged)
    return _rounded_scores(
        modelling.score_batch(merged, fitted, model, keep=["unique_city_id", "year_month_numeric"])
    )


_REQUEST_COLUMNS = ["year_month_numeric", "departement", "unique_city_id", "building_type", "n_rooms", "outdoor_area"]


@query("score_requests", _SCORED.format(columns=", ".join(_REQUEST_COLUMNS)), "merged")
def score_requests(t):
    """The same rows as requests, with blanks in their city keys."""
    merged = t.merged_stage
    model = _formula_model(t, f"SELECT *, {_FORMULA} AS log_price FROM __THIS__")
    requests = merged.select(*SCORING_REQUEST.names)
    spaced = requests.withColumn("unique_city_id", F.replace("unique_city_id", F.lit(","), F.lit(", ")))
    scored = modelling.score_requests(spaced, preprocessing.fit_preprocessor(merged), model)
    return _rounded_scores(scored.select(*_REQUEST_COLUMNS, "log_price", "price_per_sq_meter"))


@query(
    "normal_city_id",
    "select id_transaction, concat('(', departement, ',', id_ville, ')') as city from raw",
    "raw",
)
def normal_city(t):
    spaced = F.format_string("(%d, %d)", "departement", "id_ville")
    return t.raw.select("id_transaction", normal_city_id(spaced).alias("city"))


_DOUBLED = "SELECT o_orderkey, o_totalprice * {k} AS log_price FROM __THIS__"


@query("save_model", "select o_orderkey, o_totalprice * 2 as log_price from orders")
def save_model(t):
    """A model that was saved and read back from its path."""
    path = registry.save_model(_formula_model(t, _DOUBLED.format(k=2)), t.scratch("registry"), "gbt", "20240101-000000")
    return PipelineModel.load(path).transform(t["orders"])


@query("load_latest_model", "select o_orderkey, o_totalprice * 3 as log_price from orders")
def load_latest_model(t):
    """The latest of two saved models by name, whichever was written last."""
    root = t.scratch("registry")
    registry.save_model(_formula_model(t, _DOUBLED.format(k=3)), root, "gbt", "20240102-000000")
    registry.save_model(_formula_model(t, _DOUBLED.format(k=2)), root, "gbt", "20240101-000000")
    return registry.load_latest_model(t.spark, root, "gbt").transform(t["orders"])


@query(
    "log_run",
    """select '20240101-000000' as ts, 'gbt' as model_type, 'train' as context, count(*) as row_count,
      'lineitem' as source, sum(cast(l_quantity as bigint)) / cast(count(*) as double) as rmse from lineitem""",
)
def log_run(t):
    root = t.scratch("runs")
    row = t["lineitem"].agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q")).first()
    params, metrics = {"source": "lineitem"}, {"rmse": row["q"] / row["n"]}
    registry.log_run(t.spark, root, "gbt", "train", row["n"], params, metrics, "20240101-000000")
    return registry.read_runs(t.spark, root).select(
        "ts", "model_type", "context", "row_count", F.col("params.source").alias("source"), F.col("metrics.rmse").alias("rmse")
    )


# -- pipeline steps ----------------------------------------------------------------------------


def _project(t: Tables) -> pipeline.Layout:
    """A project folder whose raw tables are the stand-ins."""
    layout = pipeline.Layout(t.scratch("project"))
    tables.write_parquet(t.raw.select(*TRANSACTIONS_RAW.names), layout.transactions)
    for name, df in {
        "foyers_fiscaux": t.tax_raw,
        "taux_endettement": t.debt_raw,
        "taux_interet": t.rates_raw,
        "flux_nouveaux_emprunts": t.mortgages_raw,
    }.items():
        tables.write_parquet(df, f"{layout.raw}/{name}.parquet")
    return layout


@query("run_extract", f"select {', '.join(TRANSACTIONS_RAW.names)} from raw", "raw")
def run_extract(t):
    """Every column of every raw sale, out of chunk files."""
    layout = pipeline.Layout(t.scratch("project"))
    raw = t.raw.select(*TRANSACTIONS_RAW.names)
    for i, kind in enumerate(("Maison", "Appartement")):
        tables.write_csv(raw.filter(F.col("type_batiment") == kind), f"{layout.chunks}/transactions_chunk_{i}.csv")
    return pipeline.run_extract(t.spark, layout)


_STATELESS_DIGITS = {"month_sin": 8, "month_cos": 8, "log_price_per_m2": 8}
_STATELESS_WHOLE = [f.name for f in STATELESS if f.name not in _STATELESS_DIGITS]


@query(
    "run_clean",
    f"""select {", ".join(_STATELESS_WHOLE)}, {", ".join(f"round({c}, {n}) + 0 as {c}" for c, n in _STATELESS_DIGITS.items())}
    from stateless""",
    "stateless",
)
def run_clean(t):
    """Every cleaned sale with its stateless features."""
    sales = pipeline.run_clean(t.spark, _project(t))
    return sales.select(*_STATELESS_WHOLE, *[(F.round(c, n) + 0).alias(c) for c, n in _STATELESS_DIGITS.items()])


_PREPARED = {
    "n_rooms": 5, "new_mortgages": 8, "debt_ratio": 5, "interest_rates": 5, "living_area": 4, "n_tax_households": 8,
    "average_tax_income": 8, "month_sin": 8, "month_cos": 8, "log_price_per_m2": 8,
}
_WHOLE = ["building_type", *preprocessing.OUTDOOR_INDICATORS, "year_month_numeric", "departement", "unique_city_id"]


@query(
    "run_preprocess",
    f"""select part, {", ".join(_WHOLE)}, {", ".join(f"round({c}::double, {n}) + 0 as {c}" for c, n in _PREPARED.items())}
    from prepared""",
    "prepared",
)
def run_preprocess(t):
    """Every preprocessed row, with its part, its features and the target."""
    layout = _project(t)
    pipeline.run_clean(t.spark, layout)
    train, test = pipeline.run_preprocess(t.spark, layout)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    rounded = [(F.round(F.col(c).cast("double"), n) + 0).alias(c) for c, n in _PREPARED.items()]
    return both.select("part", *_WHOLE, *rounded)


def _prepared(t: Tables) -> pipeline.Layout:
    layout = _project(t)
    pipeline.run_clean(t.spark, layout)
    pipeline.run_preprocess(t.spark, layout)
    return layout


@query(
    "run_train",
    """select 'gbt' as model_type, 'train' as context, true as finite, true as reproducible, true as saved""",
    "merged",
)
def run_train(t):
    """The training run as logged: with an error, every parameter, and a saved model."""
    layout = _prepared(t)
    pipeline.run_train(t.spark, layout, "gbt")
    saved = registry.load_latest_model(t.spark, layout.artifacts, "gbt") is not None
    known = F.array_sort(F.map_keys("params"))
    return registry.read_runs(t.spark, layout.artifacts).select(
        "model_type",
        "context",
        (F.col("metrics.rmse") < 1e6).alias("finite"),
        F.size(F.array_except(F.array(*[F.lit(k) for k in modelling.GBT_PARAMS]), known)).__eq__(0).alias("reproducible"),
        F.lit(saved).alias("saved"),
    )


_PIPELINE_MODEL = "SELECT *, 0.25D * n_rooms + 0.5D * living_area + 8 AS log_price FROM __THIS__"


def _formula_project(t: Tables) -> pipeline.Layout:
    layout = _prepared(t)
    registry.save_model(_formula_model(t, _PIPELINE_MODEL), layout.artifacts, "gbt")
    return layout


_PREDICTED = "0.25::double * n_rooms::double + 0.5::double * living_area::double + 8"


@query(
    "run_evaluate",
    f"""select count(*) as row_count, round(avg(e * e), 6) as loss, round(sqrt(avg(e * e + 1e-8)), 6) as rmse,
      round(avg(abs(e)), 6) as mae
    from (select {_PREDICTED} - log_price_per_m2 as e from prepared where part = 'test' and isfinite(log_price_per_m2))""",
    "prepared",
)
def run_evaluate(t):
    """Test metrics of a formula model that waits in the registry."""
    metrics = pipeline.run_evaluate(t.spark, _formula_project(t))
    return metrics.select("row_count", *[F.round(m, 6).alias(m) for m in ("loss", "rmse", "mae")])


@query(
    "run_predict",
    f"""select unique_city_id, year_month_numeric, building_type, round({_PREDICTED}, 5) as log_price,
      round(exp({_PREDICTED}), 1) as price_per_sq_meter
    from (select unique_city_id, year_month_numeric, case building_type when 1 then 'Maison' else 'Appartement' end as building_type,
      n_rooms, living_area from prepared where part = 'test')""",
    "prepared",
)
def run_predict(t):
    """Scores for every test row as a request table, by a formula model."""
    layout = _formula_project(t)
    requests = t.spark.read.parquet(layout.split).filter("part = 'test'").select(*SCORING_REQUEST.names)
    scored = pipeline.run_predict(t.spark, layout, requests)
    return scored.select(
        "unique_city_id", "year_month_numeric", "building_type",
        F.round("log_price", 5).alias("log_price"), F.round("price_per_sq_meter", 1).alias("price_per_sq_meter"),
    )


@query("run_all", "select 1::bigint as scored, true as finite", "merged")
def run_all(t):
    """All steps with the library's parameters: one scored row."""
    scored = pipeline.run_all(t.spark, _project(t))
    return scored.agg(F.count("*").alias("scored"), (F.max(F.abs("log_price")) < 1e6).alias("finite"))
