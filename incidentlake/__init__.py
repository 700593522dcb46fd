"""Medallion pipeline for network-attack logs on Spark DataFrames.

Bronze lands raw CSV lines as text, Silver types, normalises, filters and
masks them, Gold aggregates them into an incident fact table, and the marts
build report datasets over Gold. Every transform is a plain
``DataFrame -> DataFrame`` function made of built-in Spark expressions.
"""

__version__ = "0.1.0"
