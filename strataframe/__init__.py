"""Layered (bronze / silver / gold) analytics as user-level PySpark DataFrame operators.

Every operator is a function from DataFrames to a DataFrame.  Plans stay lazy;
the few places that must look at data first (size checks, high-water marks,
fix-point loops) say so in their docstring.
"""

__version__ = "0.1.0"
