"""Spark-native analytics over telecom message traffic.

Every operator takes and returns DataFrames; nothing holds a global session.
"""

__version__ = "0.1.0"
