"""sparkqc: wide sensor-table quality, profiling, feature pipelines and model
selection as Spark DataFrame operators."""

__version__ = "0.1.0"
