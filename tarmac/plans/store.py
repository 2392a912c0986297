"""A folder of model versions, and a pointer to the one in use."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tarmac.contract import FLIGHTS, Contract
from tarmac.plans import training
from tarmac.session import listed, publish_text, published_text

POINTER = "CURRENT"


class ModelStore:
    """Versions are added and never changed. What is in use is switched in one step, also while a stream runs."""

    def __init__(self, spark: SparkSession, path: str, contract: Contract = FLIGHTS):
        self.spark, self.path, self.contract = spark, path.rstrip("/"), contract
        self._loaded: dict[str, object] = {}

    def versions(self) -> list[str]:
        return [name for name in listed(self.spark, self.path) if name.startswith("v")]

    def add(self, pipeline, use: bool = True) -> str:
        """Save a pipeline as the next version and, by default, put it in use once it is complete."""
        taken = [int(name[1:]) for name in self.versions()]
        version = f"v{max(taken, default=0) + 1:06d}"
        training.save_pipeline(pipeline, f"{self.path}/{version}")
        if use:
            self.use(version)
        return version

    def use(self, version: str) -> None:
        """Switch to a version, newer or older; one that is incomplete is refused."""
        self.load(version)
        publish_text(self.spark, f"{self.path}/{POINTER}", version)

    def current(self) -> str:
        version = published_text(self.spark, f"{self.path}/{POINTER}")
        if version is None:
            raise LookupError(f"no model is in use in {self.path}")
        return version

    def load(self, version: str):
        """The pipeline of a version; the last two are kept, since a stream may go back to the one before."""
        if version not in self._loaded:
            self._loaded[version] = training.load_pipeline(f"{self.path}/{version}", self.contract)
            for old in list(self._loaded)[:-2]:
                del self._loaded[old]
        return self._loaded[version]


class OneModel:
    """A pipeline that does not change, in the place of a store."""

    def __init__(self, pipeline, name: str = "given"):
        self.pipeline, self.name = pipeline, name

    def current(self) -> str:
        return self.name

    def load(self, version: str):
        return self.pipeline
