"""Scoring with a real model file: one small network, written field by field in the format's encoding."""

import struct

import pytest
from pyspark.sql import functions as F

from pulseframe.functions.model import FEATURE_ORDER
from pulseframe.operators.inference import onnx_model, score_model


def number(field, value):
    return bytes([field << 3, value])


def part(field, body):
    body = body.encode() if isinstance(body, str) else body
    size, out = len(body), b""
    while size > 127:
        out += bytes([size & 127 | 128])
        size >>= 7
    return bytes([field << 3 | 2]) + out + bytes([size]) + body


def tensor(name, shape):
    dims = b"".join(part(1, number(1, d) if isinstance(d, int) else part(2, d)) for d in shape)
    return part(1, name) + part(2, part(1, number(1, 1) + part(2, dims)))


def linear_model(weights):
    """score = sigmoid(features x weights): nodes, a weight tensor, and one input and output."""
    node = lambda op, inputs, output: b"".join(part(1, i) for i in inputs) + part(2, output) + part(4, op)
    matrix = number(1, len(weights)) + number(1, 1) + number(2, 1) + part(9, struct.pack(f"<{len(weights)}f", *weights)) + part(8, "w")
    graph = (
        part(1, node("MatMul", ["x", "w"], "y")) + part(1, node("Sigmoid", ["y"], "s")) + part(2, "g") + part(5, matrix)
        + part(11, tensor("x", ["n", len(weights)])) + part(12, tensor("s", ["n", 1]))
    )
    return number(1, 8) + part(7, graph) + part(8, part(1, "") + number(2, 13))


@pytest.mark.parametrize("rows", [0, 1, 500])
def test_a_model_file_scores_batches(spark, tmp_path, rows):
    import math

    weights = [((i * 7) % 5 - 2) / 100 for i in range(len(FEATURE_ORDER))]
    path = tmp_path / "model.onnx"
    path.write_bytes(linear_model(weights))
    df = spark.range(rows).select("id", *((F.col("id") % (i + 3)).cast("double").alias(c) for i, c in enumerate(FEATURE_ORDER)))
    got = {r["id"]: (r["model_score"], r["risk_level"]) for r in score_model(df, onnx_model(str(path))).collect()}
    assert len(got) == rows
    for n, (score, level) in got.items():
        want = 1 / (1 + math.exp(-sum(w * (n % (i + 3)) for i, w in enumerate(weights))))
        assert score == pytest.approx(want, abs=1e-5)
        assert level == ("CRITICAL" if want >= 0.8 else "HIGH" if want >= 0.6 else "MEDIUM" if want >= 0.4 else "LOW")
