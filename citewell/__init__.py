"""Citewell: paper-corpus analytics written as PySpark DataFrame jobs."""
