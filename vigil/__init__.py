"""vigil: risk-model operations (quality, splits, drift, metrics, alerts,
promotion, payloads, training) as plain PySpark DataFrame operators."""

__version__ = "0.1.0"
