"""Text classifiers that map headings to curated topics: Spark ML pipelines with a label map beside them.

A kernel machine isn't part of Spark ML; multinomial logistic regression stands in for it ("lr"), and a random forest with
entropy is the other choice ("rf"). Word features are TF-IDF of words of two letters or more; character features are n-grams
inside padded words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, Normalizer, RegexTokenizer, SQLTransformer, StopWordsRemover, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Mapper:
    model: PipelineModel
    label_map: DataFrame
    labels: list[str]

    def guess(self, names: DataFrame) -> DataFrame:
        """(name) → (name, topic, score): the likeliest class of each distinct name."""
        scored = PipelineModel(self.model.stages[1:]).transform(  # without the indexer of labels
            names.select("name").where("name IS NOT NULL").distinct().withColumn("text", F.col("name"))
        )
        p = vector_to_array("probability")
        labels = F.array(*map(F.lit, self.labels))
        return scored.select("name", F.get(labels, F.col("prediction").cast("int")).alias("topic"), F.array_max(p).alias("score"))

    def outstanding(self, names: DataFrame, least: float = 2.0) -> DataFrame:
        """(name) → (name, topic, ratio): the likeliest class where its probability is more than `least` times the mean of all classes; null otherwise."""
        guessed = self.guess(names).withColumn("ratio", F.col("score") * F.lit(float(len(self.labels))))  # probabilities sum to 1
        return guessed.select("name", F.when(F.col("ratio") > least, F.col("topic")).alias("topic"), "ratio")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        self.label_map.write.mode("overwrite").parquet(f"{path}/label_map")


def load(spark: SparkSession, path: str) -> Mapper:
    model = PipelineModel.load(f"{path}/model")
    return Mapper(model, spark.read.parquet(f"{path}/label_map"), list(model.stages[0].labels))


def _features(kind: str) -> list:
    if kind == "words":
        return [
            RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False),
            StopWordsRemover(inputCol="tokens", outputCol="kept"),
            CountVectorizer(inputCol="kept", outputCol="counts"),
            IDF(inputCol="counts", outputCol="weighted"),
            Normalizer(inputCol="weighted", outputCol="features", p=2.0),
        ]
    grams = "flatten(transform(filter(split(lower(text), '\\\\s+'), w -> w <> ''), w -> if(length(w) < 3, array(concat(' ', w, ' ')), flatten(transform(sequence(5, least(10, greatest(5, length(w) + 2))), n -> transform(sequence(1, greatest(1, length(w) + 3 - n)), i -> substr(concat(' ', w, ' '), i, n)))))))"
    return [SQLTransformer(statement=f"SELECT *, {grams} AS kept FROM __THIS__"), HashingTF(inputCol="kept", outputCol="features", numFeatures=1 << 14)]


def train(label_map: DataFrame, algorithm: str = "lr", features: str = "words", grid: bool = False, folds: int = 3) -> Mapper:
    """label_map: (ord, text, topic); rows without a topic are left out. grid: choose the parameters by cross-validation."""
    rows = label_map.where("topic > '' AND text IS NOT NULL")
    if algorithm == "lr":
        classifier = LogisticRegression(labelCol="label", featuresCol="features", regParam=0.001, maxIter=50)
        params = ParamGridBuilder().addGrid(classifier.regParam, [0.0001, 0.001, 0.01, 0.1]).build()
    elif algorithm == "rf":
        classifier = RandomForestClassifier(labelCol="label", featuresCol="features", impurity="entropy", numTrees=50, maxDepth=20, seed=7)
        params = ParamGridBuilder().addGrid(classifier.maxDepth, [10, 20, 30]).addGrid(classifier.minInstancesPerNode, [1, 3]).build()
    else:
        raise ValueError(f"unknown algorithm {algorithm}")
    stages = [StringIndexer(inputCol="topic", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="skip"), *_features(features), classifier]
    pipeline = Pipeline(stages=stages)
    if grid:
        scorer = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
        model = CrossValidator(estimator=pipeline, estimatorParamMaps=params, evaluator=scorer, numFolds=folds, parallelism=2, seed=7).fit(rows).bestModel
    else:
        model = pipeline.fit(rows)
    return Mapper(model, label_map, list(model.stages[0].labels))


def training_report(mapper: Mapper) -> DataFrame:
    """(topic, support, precision, recall, f1) on the training rows."""
    rows = mapper.label_map.where("topic > ''")
    pairs = rows.join(mapper.guess(rows.select(F.col("text").alias("name"))).select(F.col("name").alias("text"), F.col("topic").alias("guess")), "text")
    right = F.sum((F.col("topic") == F.col("guess")).cast("int"))
    by_true = pairs.groupBy("topic").agg(F.count("*").alias("support"), right.alias("hit"))
    by_guess = pairs.groupBy(F.col("guess").alias("topic")).agg(F.count("*").alias("given"))
    df = by_true.join(by_guess, "topic", "left").fillna(0)
    precision, recall = F.coalesce(F.try_divide("hit", "given"), F.lit(0.0)), F.col("hit") / F.col("support")
    return df.select("topic", "support", precision.alias("precision"), recall.alias("recall"), F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"))


def training_mismatches(mapper: Mapper) -> DataFrame:
    """(text, topic, guess): rows of the map that the classifier gives another topic."""
    rows = mapper.label_map.where("topic > '' AND text IS NOT NULL")
    guess = mapper.guess(rows.select(F.col("text").alias("name"))).select(F.col("name").alias("text"), F.col("topic").alias("guess"))
    return rows.join(guess, "text").where("topic <> guess").select("text", "topic", "guess")


def dump_label_map(mapper: Mapper) -> DataFrame:
    return mapper.label_map.select(F.col("text").alias("topic_formatted"), F.lit("OK").alias("flag"), F.col("topic").alias("canonical_topic")).orderBy(F.lower("topic_formatted"))
