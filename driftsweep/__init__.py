"""Schema-drift file sweep on Spark: inbox -> bronze -> resolver -> silver -> gold."""

__version__ = "0.1.0"
