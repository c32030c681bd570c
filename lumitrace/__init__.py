"""lumitrace: light curves and sky association on Spark DataFrames."""

__version__ = "0.1.0"
