"""Discriminative-term analysis and text classification as Spark plans."""

__version__ = "0.1.0"
