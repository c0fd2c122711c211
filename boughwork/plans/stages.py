"""Contracts of the five project stages: which files each reads and writes.

What the stages compute, and the files' columns, is nowhere defined, so running one raises
NotImplementedError; the caller supplies the work and the schema.
"""

from __future__ import annotations

import os
import pickle
import shutil
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Paths:
    root: Path

    def of(self, name: str) -> Path:
        fixed = {"raw": "data/raw", "interim": "data/interim", "processed": "data/processed", "external": "data/external", "models": "models", "figures": "reports/figures"}
        return self.root / fixed[name]


def _model(spark: SparkSession, path: str) -> Any:
    """A saved model: a folder that pyspark.ml wrote, or a pickled object."""
    if os.path.isdir(path):
        return DefaultParamsReader.loadParamsInstance(path, spark)
    with open(path, "rb") as f:
        return pickle.load(f)


def _put(made: Any, path: str) -> None:
    """Write what a stage has made: a table, a model of pyspark.ml or any object, a figure or
    its bytes. It gets a name of its own first, and takes the old one's place when it is whole."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = os.path.join(os.path.dirname(path), f".{uuid.uuid4().hex}.{os.path.basename(path)}")
    try:
        if path.endswith(".csv"):
            made.write.csv("file:" + own, header=True)
        elif path.endswith(".png") and hasattr(made, "savefig"):
            made.savefig(own, format="png")
        elif path.endswith(".pkl") and hasattr(made, "write"):
            made.write().save("file:" + own)
        else:
            with open(own, "wb") as f:
                f.write(made if path.endswith(".png") else pickle.dumps(made))
        old = f"{own}.old"
        if os.path.exists(path):
            os.rename(path, old)
        os.rename(own, path)
    finally:
        for left in (own, f"{own}.old"):
            if os.path.isdir(left):
                shutil.rmtree(left)
            elif os.path.exists(left):
                os.remove(left)


@dataclass(frozen=True)
class Stage:
    inputs: tuple[tuple[str, str], ...]
    outputs: tuple[tuple[str, str], ...]

    def run(self, spark: SparkSession, paths: Paths, schemas: dict[str, StructType] | None = None, work: Callable[..., Any] | None = None) -> None:
        """Give ``work`` the inputs (tables of the CSV files, by the caller's schemas, and
        models) and write what it returns: a DataFrame, a model or a figure, as the output's
        file is named."""
        if work is None:
            raise NotImplementedError("only the stage's files are defined")
        found = []
        for folder, f in self.inputs:
            path = str(paths.of(folder) / f)
            found.append(spark.read.csv("file:" + path, header=True, schema=(schemas or {})[f]) if f.endswith(".csv") else _model(spark, path))
        folder, f = self.outputs[0]
        _put(work(*found), str(paths.of(folder) / f))


STAGES = {
    "dataset": Stage((("raw", "dataset.csv"),), (("processed", "dataset.csv"),)),
    "features": Stage((("processed", "dataset.csv"),), (("processed", "features.csv"),)),
    "train": Stage((("processed", "features.csv"), ("processed", "labels.csv")), (("models", "model.pkl"),)),
    "predict": Stage((("processed", "test_features.csv"), ("models", "model.pkl")), (("processed", "test_predictions.csv"),)),
    "plots": Stage((("processed", "dataset.csv"),), (("figures", "plot.png"),)),
}
