"""Tarn: track analytics, record linkage and text-corpus operators on PySpark."""
