"""A PySpark engine for preparing and analysing text corpora."""
