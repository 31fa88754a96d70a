"""lendspark: lending-decision data on Spark, as DataFrame-to-DataFrame operators."""

__version__ = "0.1.0"
