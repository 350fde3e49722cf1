"""URL filters: rules, and logistic regression on hashed character n-grams for the rest.

Method: host and path become character 3- to 5-grams, hashed to FEATURES counts; a
logistic regression is trained from a small labelled URL table (a parameter; the default is below)
and judges every url that no rule fits.  All steps are DataFrame expressions and the ML library's JVM
transformers; scoring is one pass without a shuffle.
"""

from __future__ import annotations

import string

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import only

FEATURES = 1 << 16
GRAMS = (3, 4, 5)
#: Block at this probability or more.
THRESHOLD = 0.5

#: Labelled URLs: (url, 1 to block).
LABELLED: list[tuple[str, int]] = [
    *[(u, 1) for u in (
        "http://casino-royal.example/en/1", "https://www.best-casino.example/slots/jackpot", "http://casino-win.example/de/77",
        "http://online-casino-bonus.example/free-spins", "http://m.casino.example/poker", "https://free-bets.example/en/2",
        "http://www.sports-bets.example/odds", "http://bets-today.example/win", "https://free-bets-now.example/fr/4",
        "http://cheap-pills.example/buy", "https://www.cheap-pills.example/de/12", "http://pills-online.example/order",
        "http://buy-cheap-meds.example/viagra", "http://payday-loans.example/apply", "https://fast-loans.example/cash",
        "http://win-prize.example/claim", "http://free-money.example/win", "http://hot-xxx.example/video",
        "http://adult-cams.example/live", "http://replica-watches.example/sale", "http://lottery-win.example/ticket",
        "http://blog.poker-win.example/en/9", "http://crack-keygen.example/download", "http://free-download-warez.example/x")],
    *[(u, 0) for u in (
        "http://thing.example/en/1", "https://www.thering.example/fr/22", "http://blog.station.example/en/3456", "https://m.nation.example/de/77.html",
        "http://library.example/books/history", "https://news.example/2024/05/article", "http://www.university.example/research/paper",
        "https://docs.example/guide/install", "http://weather.example/forecast", "https://recipes.example/soup/onion",
        "http://museum.example/en/exhibits", "https://www.garden.example/plants?page=2", "http://forum.example/topic/8812",
        "https://health.example/advice/sleep", "http://school.example/fr/cours", "https://travel.example/es/madrid",
        "http://m.sports.example/en/results", "https://music.example/albums/12", "http://blog.kitchen.example/post/4",
        "https://maps.example/de/berlin", "http://science.example/physics/light", "https://the.ther.example/en/5", "http://ththan.example/de/101",
        "http://tion.example.org/es/812")],
]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return host, path


def _pipeline() -> Pipeline:
    stages = [RegexTokenizer(inputCol="__s", outputCol="__c", pattern="(?s).", gaps=False, toLowercase=True)]
    stages += [NGram(n=n, inputCol="__c", outputCol=f"__g{n}") for n in GRAMS]
    stages += [HashingTF(inputCol=f"__g{n}", outputCol=f"__f{n}", numFeatures=FEATURES) for n in GRAMS]
    stages.append(VectorAssembler(inputCols=[f"__f{n}" for n in GRAMS], outputCol="__f", handleInvalid="keep"))
    stages.append(LogisticRegression(featuresCol="__f", labelCol="__y", probabilityCol="__p", predictionCol="__yhat",
                                     rawPredictionCol="__raw", regParam=0.02, maxIter=60))
    return Pipeline(stages=stages)


def _spelled(df: DataFrame) -> DataFrame:
    host, path = parts(F.col("__url"))
    return df.withColumns({"host": host, "path": path}).withColumn("__s", F.concat(F.lit("^"), "host", F.lit("$"), "path"))


def train(spark: SparkSession, labelled: DataFrame | None = None):
    """A model from labelled urls (url, block 0/1); rows with a null in either are left out."""
    if labelled is None:
        labelled = spark.createDataFrame(LABELLED, "url string, block int")
    rows = labelled.select(F.col("url").alias("__url"), F.col("block").cast("double").alias("__y")).dropna()
    return _pipeline().fit(_spelled(rows.coalesce(1)))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (host + path) and its verdict; nulls where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], model, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict, block_probability.

    ``rules``: (verdict, host, path prefix); a rule fits its host and all its subdomains.  A null
    or malformed url has an empty host and path: no rule fits, the model judges the empty
    string.  Rows with null or repeated ids stay.  Extra columns are not read.
    """
    rows = _spelled(only(pages, id_col, url_col).toDF("__id", "__url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    scored = model.transform(rows).withColumn("block_probability", vector_to_array("__p")[1])
    own = F.when(F.col("block_probability") >= THRESHOLD, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("__id").alias(id_col), "host", "path", name.alias("rule"),
                         F.coalesce(verdict, own).alias("verdict"), "block_probability")
