"""loamline: a PySpark engine that curates source code and its metadata into training datasets."""

__version__ = "0.1.0"
