"""stockyard: sales, stock and customer analytics as Spark jobs.

Read operations (U1, U2, U4) return DataFrames; update operations (U3, U5-U7)
rewrite a table copy-on-write and report what they touched.
"""

__version__ = "0.1.0"
