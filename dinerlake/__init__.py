"""dinerlake: restaurant order analytics as plain Spark DataFrame jobs.

Bronze extracts, silver cleansing, four gold marts, serving views and the
business metrics on top of them.  Every function takes and returns DataFrames.
"""

__version__ = "0.1.0"
