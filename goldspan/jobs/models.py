"""Train, score and judge a model of a document's length."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from goldspan.jobs.base import Tables, job
from goldspan.operators import modelling as ml
from goldspan.session import workspace

FEATURES = ["n_words", "n_lines", "n_commas"]
TARGET = "n_chars"


def sample_rows(t: Tables):
    """Documents with counts of their parts as features of their length."""
    def occurrences(pattern):
        return (F.size(F.split("text", pattern)) - 1).cast("double")

    rows = t.documents.select(
        "doc_id", occurrences(" ").alias("n_words"), occurrences("\n").alias("n_lines"),
        occurrences(",").alias("n_commas"), F.col("n_chars").cast("double").alias(TARGET))
    return ml.split(rows, ["doc_id"])


def trained(t: Tables):
    return ml.train(sample_rows(t).where("is_train").select(*FEATURES, TARGET), FEATURES, TARGET, max_iter=5, max_depth=3)


@job("ml_split", """SELECT l_returnflag, CAST('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8) AS BIGINT) % 100 < 80 AS is_train,
     count(*) AS n FROM lineitem GROUP BY ALL""")
def _(t: Tables):
    rows = ml.split(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return rows.groupBy("l_returnflag", "is_train").agg(F.count(F.lit(1)).alias("n"))


@job("ml_train")
def _(t: Tables):
    """How the trees weigh each feature."""
    weights = trained(t).stages[-1].featureImportances.toArray()
    return t.spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(float(w)).alias("weight")) for f, w in zip(FEATURES, weights)])))


@job("ml_score")
def _(t: Tables):
    return ml.score(trained(t), sample_rows(t)).select("doc_id", "is_train", TARGET, "prediction")


@job("ml_residuals", """SELECT l_returnflag, count(*) AS n, round(avg(pow(l_extendedprice - l_quantity * 1500, 2)), 2) AS mse,
     round(avg(abs(l_extendedprice - l_quantity * 1500)), 4) AS mae,
     round(sqrt(avg(pow(l_extendedprice - l_quantity * 1500, 2))), 4) AS rmse FROM lineitem GROUP BY 1""")
def _(t: Tables):
    """Errors of a plain guess (1500 per piece), per return flag."""
    guessed = t.lineitem.withColumn("prediction", F.col("l_quantity") * 1500)
    out = ml.residuals(guessed, "l_extendedprice", by=["l_returnflag"])
    return out.withColumns({"mse": F.round("mse", 2), "mae": F.round("mae", 4), "rmse": F.round("rmse", 4)})


@job("ml_residuals_per_split")
def _(t: Tables):
    return ml.residuals(ml.score(trained(t), sample_rows(t)), TARGET, by=["is_train"])


@job("ml_deploy_gate", "SELECT count(*) AS n, true AS refused, true AS kept FROM documents")
def _(t: Tables):
    """The model is kept when it beats the spread of the target, and refused against a limit of 1."""
    model = trained(t)
    held_out = ml.score(model, sample_rows(t).where("NOT is_train"))
    metrics = ml.residuals(held_out, TARGET)
    spread = held_out.agg(F.stddev_pop(TARGET).alias("s")).first()["s"]
    path = workspace(t.spark, "model")
    refused = not ml.deploy(model, metrics, path, limit=1.0)
    kept = ml.deploy(model, metrics, path, limit=spread)
    scored = ml.score(PipelineModel.load(path), sample_rows(t)) if kept else held_out
    return scored.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(refused).alias("refused"), F.lit(kept).alias("kept"))


@job("ml_feature_contract", """
WITH raw AS (SELECT c_custkey, nullif(c_nationkey, 4) AS rooms, c_acctbal AS income, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal / 2 END AS age FROM customer)
SELECT c_custkey, rooms, income, coalesce(age, 40.0) AS age, concat_ws(';', CASE WHEN rooms IS NULL THEN 'missing:rooms' END,
  CASE WHEN rooms < 0 THEN 'negative:rooms' END, CASE WHEN income < 0 THEN 'negative:income' END,
  CASE WHEN age < 0 THEN 'negative:age' END) AS errors FROM raw""")
def _(t: Tables):
    raw = t.customer.select(
        "c_custkey", F.nullif("c_nationkey", F.lit(4)).alias("rooms"), F.col("c_acctbal").alias("income"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal") / 2).alias("age"))
    checked = ml.feature_contract(raw, ["rooms", "income"], {"age": 40.0})
    return checked.withColumn("errors", F.array_join("errors", ";"))
