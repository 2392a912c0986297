"""Train, evaluate, save and load the whole prediction pipeline."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tarmac.contract import FLIGHTS, Contract
from tarmac.operators.clean import drop_any_null
from tarmac.operators.encoding import assemble, assembler, encode, encode_join, find_hot
from tarmac.operators.evaluate import accuracy
from tarmac.operators.sampling import sample_bernoulli, sample_hash, split_hash
from tarmac.operators.statistics import Statistics, fit_statistics, measured, with_other_folds, with_statistics
from tarmac.operators.vocabulary import MAX_SMALL_LABELS, Vocabulary, fit_vocabulary, measure, to_indexers
from tarmac.plans import artefact
from tarmac.session import materialize, spread

# Fixed value: bins per feature of the forest, raised where a vocabulary needs more.
MAX_BINS = 343

# A column with more labels is no categorical feature: the mean of the target of a label's rows stands for it.
STATISTICS_ABOVE = MAX_BINS - 1

EstimatorFactory = Callable[[Contract, Vocabulary, int], Estimator]


def forest(contract: Contract, vocabulary: Vocabulary, seed: int, max_bins: int = MAX_BINS) -> Estimator:
    """Random forest. A categorical feature needs a bin per label, and one for unseen labels.

    The search for split points collects about the square of the bins of a feature in one
    task, so ``train`` gives it columns of many labels as statistics, which need no bins of their own.
    """
    bins = max(max_bins, vocabulary.largest() + 1)
    return RandomForestClassifier(labelCol=contract.label, featuresCol=contract.vector, maxBins=bins, seed=seed)


def logistic(contract: Contract, vocabulary: Vocabulary, seed: int) -> Estimator:
    """Logistic regression over the same vector; its fit is not random."""
    return LogisticRegression(labelCol=contract.label, featuresCol=contract.vector)


@dataclass(frozen=True)
class LookupPipeline:
    """A pipeline whose vocabularies are a table instead of lists on the driver, for any number of labels.

    The columns that ``statistics`` has are not numbered: the statistic of the label is their feature.
    """

    vocabulary: Vocabulary
    model: Model
    contract: Contract = FLIGHTS
    max_labels: int = MAX_SMALL_LABELS
    statistics: Statistics | None = None

    @property
    def numbered(self) -> list[str]:
        return _numbered(self.contract, self.statistics)

    def transform(self, rows: DataFrame, invalid: str = "error") -> DataFrame:
        hot = find_hot(rows, self.vocabulary.sizes, self.max_labels, self.vocabulary.table)
        encoded = encode_join(rows, self.vocabulary, self.contract, "keep", self.max_labels, self.numbered, hot)
        if self.statistics:
            encoded = with_statistics(encoded, self.statistics, self.contract, self.max_labels, hot)
        return self.model.transform(assemble(encoded, self.contract, invalid))


def _numbered(contract: Contract, statistics: Statistics | None) -> list[str]:
    return [c for c in contract.categorical if statistics is None or c not in statistics.columns]


@dataclass(frozen=True)
class Trained:
    """``pipeline`` takes typed rows to predictions; ``train`` and ``test`` are the parts, typed."""

    pipeline: PipelineModel | LookupPipeline
    vocabulary: Vocabulary
    train: DataFrame
    test: DataFrame
    metrics: Row

    @property
    def indexers(self) -> list[StringIndexerModel]:
        """The fitted indexers; none if the vocabularies are looked up as a table."""
        return [] if isinstance(self.pipeline, LookupPipeline) else self.pipeline.stages[:-2]

    @property
    def statistics(self) -> Statistics | None:
        return self.pipeline.statistics if isinstance(self.pipeline, LookupPipeline) else None

    @property
    def model(self) -> Model:
        return self.pipeline.model if isinstance(self.pipeline, LookupPipeline) else self.pipeline.stages[-1]

    def predictions(self) -> DataFrame:
        return self.pipeline.transform(self.test)


def train(
    typed: DataFrame,
    estimator: EstimatorFactory = forest,
    contract: Contract = FLIGHTS,
    sample: float = 0.3,
    split: float = 0.7,
    key: str | None = None,
    seed: int = 42,
    vocabulary_from: str = "all",
    max_labels: int = MAX_SMALL_LABELS,
    statistics_above: int | None = STATISTICS_ABOVE,
) -> Trained:
    """Clean, sample, index, split, fit and evaluate; ``typed`` is read once.

    With a ``key``, sample and split follow from it, so that a lost partition holds
    the same rows when it is computed again, and the kept rows need no storage.
    Without one they are drawn at random, and the drawn rows are written as a
    table, because a random draw must not be repeated. ``vocabulary_from`` is
    ``all`` sampled rows or the ``train`` part only. A vocabulary with more than
    ``max_labels`` labels, or too many bytes for the driver, is looked up as a table.
    A column with more than ``statistics_above`` labels becomes an ordered feature: the
    mean of the target over a label's rows, in training over those of other folds.
    """
    rows = drop_any_null(typed, contract.columns)
    if key is None:
        kept = []
        rows = spread(materialize(draw(rows, sample, split, seed), "drawn"))
        parts = rows.where("_first").drop("_first"), rows.where("NOT _first").drop("_first")
    else:
        rows = spread(sample_hash(rows, sample, key)).persist(StorageLevel.MEMORY_AND_DISK)
        kept = [rows]
        parts = split_hash(rows, split, key)
    try:
        vocabulary = fit_vocabulary({"all": rows, "train": parts[0]}[vocabulary_from], contract=contract)
        many = [c for c in contract.categorical if statistics_above is not None and vocabulary.sizes[c].labels > statistics_above]
        if not many and all(vocabulary.sizes[c].small(max_labels) for c in contract.categorical):
            indexers = to_indexers(vocabulary, contract, "error")
            encoded = assemble(encode(parts[0], *indexers), contract)
            model = estimator(contract, vocabulary, seed).fit(encoded)
            pipeline = scoring_pipeline([i.copy().setHandleInvalid("keep") for i in indexers], model, contract)
        else:
            statistics = fit_statistics(parts[0], many, contract) if many else None
            numbered = _numbered(contract, statistics)
            encoded = encode_join(parts[0], vocabulary, contract, "error", max_labels, numbered)
            if statistics:
                encoded = with_other_folds(encoded, statistics, contract, max_labels)
            encoded = materialize(encoded.select(contract.label, *contract.features), "encoded")
            few = Vocabulary(vocabulary.table, {c: vocabulary.sizes[c] for c in numbered})
            if statistics:  # what is numbered beside statistics is categorical still
                encoded = _as_categories(encoded, few, contract)
            model = estimator(contract, few, seed).fit(assemble(encoded, contract))
            pipeline = LookupPipeline(vocabulary, model, contract, max_labels, statistics)
        metrics = accuracy(pipeline.transform(parts[1]), contract.label).first()
    finally:
        for frame in kept:
            frame.unpersist()
    return Trained(pipeline, vocabulary, *parts, metrics)


def _as_categories(encoded: DataFrame, vocabulary: Vocabulary, contract: Contract) -> DataFrame:
    """Tell the vector that these slots are numbers of labels, as indexers would."""
    for column, size in vocabulary.sizes.items():
        attribute = {"type": "nominal", "num_vals": max(1, size.labels)}
        encoded = encoded.withMetadata(contract.index_columns[column], {"ml_attr": attribute})
    return encoded


def draw(rows: DataFrame, sample: float, split: float, seed: int) -> DataFrame:
    """A random sample with ``_first``, true for the rows of the first part of a random split."""
    return sample_bernoulli(rows, sample, seed).withColumn("_first", F.rand(seed + 1) < split)


def scoring_pipeline(indexers: list[StringIndexerModel], model: Model, contract: Contract = FLIGHTS) -> PipelineModel:
    """Indexers, vector and model as one artefact, so that serving cannot reorder the slots."""
    return PipelineModel(stages=[*indexers, assembler(contract), model])


def save_pipeline(pipeline: PipelineModel | LookupPipeline, path: str) -> None:
    if not isinstance(pipeline, LookupPipeline):
        artefact.save_pipeline_model(pipeline, path)
        return
    parts = {"vocabulary": pipeline.vocabulary.table, "classifier": pipeline.model}
    if pipeline.statistics:
        parts["statistics"] = pipeline.statistics.table
    artefact.save(pipeline.vocabulary.table.sparkSession, path, parts, pipeline.contract)


def load_pipeline(path: str, contract: Contract = FLIGHTS) -> PipelineModel | LookupPipeline:
    """A pipeline saved in either form; one that was not saved to its end is refused."""
    parts = artefact.load(SparkSession.active(), path, contract)
    return parts["pipeline"] if "pipeline" in parts else _looked_up(parts, parts["classifier"], contract)


def _looked_up(parts: dict, model: Model, contract: Contract) -> LookupPipeline:
    table, statistics = parts["vocabulary"], parts.get("statistics")
    if statistics is not None:
        fields = {r["field"] for r in statistics.where("fold = -1").select("field").distinct().collect()}
        statistics = measured(statistics, [c for c in contract.categorical if c in fields])
    if model.numFeatures != len(contract.features):
        raise artefact.ArtefactError(f"the classifier takes {model.numFeatures} features, not {len(contract.features)}")
    vocabulary = Vocabulary(table, measure(table, contract.categorical))
    return LookupPipeline(vocabulary, model, contract, statistics=statistics)


def save_model(model: Model, path: str) -> None:
    """The classifier alone, for use with separately saved vocabularies."""
    model.write().overwrite().save(path)


def load_model(path: str) -> Model:
    """A classifier saved alone, of the class that its metadata name."""
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())


def pipeline_of(vocabularies: str, classifier: str, contract: Contract = FLIGHTS) -> PipelineModel | LookupPipeline:
    """Separately saved vocabularies, in either form, and classifier as one pipeline."""
    spark = SparkSession.active()
    if artefact.is_artefact(spark, vocabularies):
        return _looked_up(artefact.load(spark, vocabularies, contract), load_model(classifier), contract)
    return scoring_pipeline(load_vocabularies(vocabularies, contract), load_model(classifier), contract)


def save_vocabularies(
    vocabulary: Vocabulary,
    path: str,
    contract: Contract = FLIGHTS,
    statistics: Statistics | None = None,
    max_labels: int = MAX_SMALL_LABELS,
) -> None:
    """One single-column indexer per categorical column, each in a folder of its column's name.

    Vocabularies past the driver's size, or with statistics beside them, are saved as tables with a manifest.
    """
    if statistics is None and all(vocabulary.sizes[c].small(max_labels) for c in contract.categorical):
        for indexer in to_indexers(vocabulary, contract):
            indexer.write().overwrite().save(f"{path.rstrip('/')}/{indexer.getInputCol()}")
        return
    parts = {"vocabulary": vocabulary.table} | ({"statistics": statistics.table} if statistics else {})
    artefact.save(vocabulary.table.sparkSession, path, parts, contract)


def load_vocabularies(path: str, contract: Contract = FLIGHTS, handle_invalid: str = "keep") -> list[StringIndexerModel]:
    """The saved indexers in the contract's order, whatever order a listing would give."""
    folders = [f"{path.rstrip('/')}/{column}" for column in contract.categorical]
    return [StringIndexerModel.load(f).setHandleInvalid(handle_invalid) for f in folders]


def save_vocabulary_table(vocabulary: Vocabulary, path: str) -> None:
    """``field, label, n, idx`` as parquet, for vocabularies of any size."""
    vocabulary.table.write.mode("overwrite").parquet(path)


def load_vocabulary_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("field string, label string, n bigint, idx double").parquet(path)
