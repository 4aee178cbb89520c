"""Event lakehouse on PySpark: messages to raw, clean, rejected, star-schema and hourly tables.

Everything that computes is a ``DataFrame -> DataFrame`` function and works on batch and streaming
input alike; ``plans`` puts those functions between sources and sinks.
"""

from pavelake.config import LakeConfig, QualityLimits

__all__ = ["LakeConfig", "QualityLimits"]
