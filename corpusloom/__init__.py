"""corpusloom: building, auditing and analysing language-model text corpora with Spark DataFrames."""

__version__ = "0.1.0"
