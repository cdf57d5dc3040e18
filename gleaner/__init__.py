"""gleaner: Spark-native document analytics that turns text collections into evidence-grounded QA datasets."""

__version__ = "0.1.0"
