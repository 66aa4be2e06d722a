"""panelloom: entity-year text-signal panels as Spark DataFrame operators."""

__version__ = "0.1.0"
