"""Provider claims analytics and risk scoring as Spark DataFrame plans."""

__version__ = "0.1.0"
