"""Model scoring over feature vectors as a batch or streaming job."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions.model import feature_vector, model_level, model_score

Model = Callable[[np.ndarray], np.ndarray]


def onnx_model(path: str) -> Callable[[], Model]:
    """Loader for an ONNX file that every worker can read."""

    def load() -> Model:
        import onnxruntime

        session = onnxruntime.InferenceSession(path, providers=["CPUExecutionProvider"])
        source, target = session.get_inputs()[0].name, session.get_outputs()[0].name
        return lambda rows: session.run([target], {source: rows})[0]

    return load


def score_model(df: DataFrame, load: Callable[[], Model], name: str = "model_score") -> DataFrame:
    """Add the raw model score (NULL where inference failed), the used score and its level.

    The model is loaded once per task and called once per Arrow batch. If a batch
    fails its rows are tried one by one, so only the bad rows fail.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()

        def scores(rows: np.ndarray) -> np.ndarray:
            return np.asarray(model(rows), dtype="float64").reshape(len(rows), -1)[:, 0]

        def one(row: np.ndarray) -> float | None:
            try:
                return float(scores(row[None, :])[0])
            except Exception:
                return None

        for features in batches:
            if not len(features):
                yield pd.Series([], dtype="float64")
                continue
            rows = np.stack(features.to_numpy()).astype("float32")
            try:
                yield pd.Series(scores(rows))
            except Exception:
                yield pd.Series([one(r) for r in rows], dtype="float64")

    udf = F.pandas_udf(run, "double")
    return (
        df.withColumn("features", feature_vector(df))
        .withColumn(name, udf("features"))
        .withColumns(
            {"risk_score": model_score(F.col(name)), "risk_level": model_level(F.col(name))}
        )
    )
