"""Feature tables and regularised regressions with ``pyspark.ml``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions.calendar import seasonal
from strataframe.functions.numeric import percent, stable_unit
from strataframe.operators.aggregate import pivot_sum
from strataframe.plans.linear import Line
from strataframe.plans.star import FACT_KEYS, MEASURE, Star
from strataframe.sources.tables import literal_rows

DESCRIPTORS = ("sexo", "rango_edad", "categoria_general", "nombre_departamento")


def _season(df: DataFrame, month: str = "mes") -> DataFrame:
    sine, cosine = seasonal(F.col(month))
    return df.withColumns({"mes_sin": sine, "mes_cos": cosine})


def granular_features(star: Star, detail: str = "INE", deaths: str = "Defunciones") -> DataFrame:
    """Facts of the detail source with descriptors, flag, season and the month's registry deaths."""
    context = star.fact_contexto_renap.filter(F.col("tipo_evento") == deaths).groupBy("id_tiempo_mes").agg(
        F.sum("cantidad").alias("total_defunciones_renap")
    )
    joined = (
        star.fact_mortalidad_unificada.filter(F.col("fuente") == detail)
        .join(star.dim_tiempo.select("id_tiempo_mes", "anio", "mes"), "id_tiempo_mes")
        .join(star.dim_geografia.select("id_geografia", "nombre_departamento"), "id_geografia")
        .join(star.dim_perfil, "id_perfil")
        .join(star.dim_causa_muerte.select("id_causa", "categoria_general", "es_covid"), "id_causa")
        .join(context, "id_tiempo_mes", "left")
    )
    flagged = joined.withColumns({
        "es_covid_int": F.col("es_covid").cast("int"),
        "total_defunciones_renap": F.coalesce("total_defunciones_renap", F.lit(0)),
    })
    return _season(flagged).select(
        *FACT_KEYS, *DESCRIPTORS, "anio", "mes", "es_covid_int", "mes_sin", "mes_cos", "total_defunciones_renap", MEASURE
    )


GRANULAR_NUMERIC = ("anio", "es_covid_int", "mes_sin", "mes_cos", "total_defunciones_renap")


def monthly_features(star: Star, events: dict[str, str], target: str = "Defunciones", base_year: int = 2015) -> DataFrame:
    """One row per month: each event type as a column, season, years since the start, target.

    ``events`` maps event type -> column name; list the types so that no extra
    job has to find them.
    """
    wide = pivot_sum(star.fact_contexto_renap, ["id_tiempo_mes"], "tipo_evento", {**events, target: "total_defunciones"}, "cantidad")
    dated = wide.filter(F.col("total_defunciones") > 0).withColumns({
        "anio": F.substring("id_tiempo_mes", 1, 4).cast("int"), "mes": F.substring("id_tiempo_mes", 6, 2).cast("int"),
    })
    return _season(dated).withColumn("anio_desde_inicio", F.col("anio") - base_year).select(
        "id_tiempo_mes", *events.values(), "mes_sin", "mes_cos", "anio_desde_inicio", "total_defunciones"
    )


def split(df: DataFrame, key, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Reproducible train/test split by a hash of the key."""
    draw = stable_unit(*[F.col(k) for k in ([key] if isinstance(key, str) else key)], seed=seed)
    return df.filter(draw < share), df.filter(draw >= share)


class Fitted(NamedTuple):
    model: object
    features: list[str]
    target: str

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    @property
    def regression(self):
        return self.model.stages[-1]


def _stages(numeric, categorical, scale: bool):
    stages = []
    if categorical:
        indexed, encoded = [f"_ix_{c}" for c in categorical], [f"_oh_{c}" for c in categorical]
        # one pass finds the labels of all descriptors
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True, handleInvalid="error"),
        ]
    stages.append(VectorAssembler(inputCols=[*numeric, *[f"_oh_{c}" for c in categorical]], outputCol="_raw" if scale else "features"))
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True))
    return stages


def fit(train: DataFrame, numeric, target: str, kind: str = "ridge", alpha: float = 1.0, categorical=(), scale: bool = True) -> Fitted:
    """Ridge or lasso with the penalty of the usual ``alpha`` definition.

    Spark divides the loss by the row count and scales the label, hence
    ``regParam = alpha * stddev(target) / n`` for ridge and ``alpha`` for lasso.
    Eager: fits, plus one aggregate for ridge.  Every pass reads ``train`` again,
    so hand in a stored or checkpointed table.
    """
    if kind not in ("ridge", "lasso"):
        raise ValueError(f"unknown regression {kind!r}")
    penalty = alpha
    if kind == "ridge":
        n, spread = train.agg(F.count(F.lit(1)), F.stddev_samp(target)).first()
        penalty = alpha * (spread or 0.0) / max(n, 1)
    regression = LinearRegression(
        featuresCol="features", labelCol=target, predictionCol="prediction", solver="l-bfgs", maxIter=500, tol=1e-9,
        regParam=penalty, elasticNetParam=0.0 if kind == "ridge" else 1.0, standardization=False,
    )
    model = Pipeline(stages=[*_stages(numeric, categorical, scale), regression]).fit(train)
    names = list(numeric)
    if categorical:
        # handleInvalid="keep" adds one index for unseen labels, and dropLast removes it again
        for column, labels in zip(categorical, model.stages[0].labelsArray):
            names += [f"{column}_{label}" for label in labels]
    return Fitted(model, names, target)


def metrics(predictions: DataFrame, target: str, prediction: str = "prediction", digits: int = 4) -> DataFrame:
    """One row: rows, R2, RMSE, MAE, as plain aggregates in one pass."""
    error = F.col(target) - F.col(prediction)
    sums = predictions.agg(
        F.count(F.lit(1)).alias("n"), F.sum(error * error).alias("_sse"), F.avg(F.abs(error)).alias("_mae"),
        F.var_pop(target).alias("_var"),
    )
    return sums.select(
        "n", F.round(1 - F.try_divide(F.col("_sse"), F.col("_var") * F.col("n")), digits).alias("r2"),
        F.round(F.sqrt(F.col("_sse") / F.col("n")), digits).alias("rmse"), F.round("_mae", digits).alias("mae"),
    )


def coefficients(fitted: Fitted | Line, spark, top: int | None = 10) -> DataFrame:
    """Coefficients by magnitude with their sign (one value per feature)."""
    if isinstance(fitted, Line):
        rows = list(zip(fitted.moments.features, map(float, fitted.coefficients)))
    else:
        rows = list(zip(fitted.features, [float(c) for c in fitted.regression.coefficients.toArray()]))
    table = literal_rows(spark, rows, "feature string, coefficient double")
    signed = table.withColumn("effect", F.when(F.col("coefficient") > 0, "up").when(F.col("coefficient") < 0, "down").otherwise("none"))
    ranked = signed.orderBy(F.desc(F.abs("coefficient")), "feature")
    return ranked if top is None else ranked.limit(top)


def monthly_series(predictions: DataFrame, target: str, month: str = "id_tiempo_mes") -> DataFrame:
    """Actual and predicted totals per month, in time order."""
    return predictions.groupBy(month).agg(F.sum(target).alias("actual"), F.sum("prediction").alias("predicted")).orderBy(month)


def consistency(granular: DataFrame, monthly: DataFrame, month: str = "id_tiempo_mes") -> DataFrame:
    """Monthly sums of granular predictions against monthly predictions: mean gap, percent, correlation."""
    a = granular.groupBy(month).agg(F.sum("prediction").alias("_a"))
    b = monthly.groupBy(month).agg(F.sum("prediction").alias("_b"))
    both = a.join(b, month)
    gap = F.avg(F.col("_a") - F.col("_b"))
    return both.agg(
        F.count(F.lit(1)).alias("months"), F.round(gap, 2).alias("mean_difference"),
        percent(gap, F.avg("_b")).alias("difference_pct"), F.round(F.corr("_a", "_b"), 4).alias("correlation"),
    )


def residuals(predictions: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """Residual per row and whether it lies within one standard deviation."""
    with_error = predictions.withColumn("residual", F.col(target) - F.col(prediction))
    spread = with_error.select(F.stddev_samp("residual")).scalar()
    return with_error.withColumn("in_band", F.abs("residual") <= spread)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts and density per equal-width bin; 0 and bins + 1 hold what lies outside."""
    col = F.col(column)
    bucket = F.width_bucket(col, F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    counts = df.filter(col.isNotNull()).groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (high - low) / bins
    # one row per bin
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("density", F.round(F.col("n") / (total * F.lit(width)), 6))


def simple_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Closed-form line of one feature: adds ``prediction`` (coefficients by scalar subquery)."""
    line = df.select(F.struct(F.regr_slope(F.col(y), F.col(x)).alias("b"), F.regr_intercept(F.col(y), F.col(x)).alias("a"))).scalar()
    return df.withColumn("prediction", line["a"] + line["b"] * F.col(x))
