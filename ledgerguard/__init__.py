"""ledgerguard: Spark-native screening of payment transactions.

Rules are plain ``DataFrame -> DataFrame`` transforms with no action inside, so
the same code serves batch tables, Structured Streaming micro-batches and the
oracle queries registered in ``__spark_entry__``.
"""

from ledgerguard.config import ScreeningConfig, DEFAULT_CONFIG, FIXTURE_CONFIG

__all__ = ["ScreeningConfig", "DEFAULT_CONFIG", "FIXTURE_CONFIG"]
