"""cairnframe: a Spark-first engine for catalogues of surveyed field points."""

__version__ = "0.1.0"
