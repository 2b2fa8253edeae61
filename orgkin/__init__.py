"""Legal-entity identity resolution as Spark DataFrame operators."""

__version__ = "0.1.0"
