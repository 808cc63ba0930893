"""Labour-market series analytics expressed as Spark DataFrame operations.

Every public operator is a plain function from DataFrame to DataFrame or from
Column to Column, so each one also works on tables of any other origin.
"""

__version__ = "0.1.0"
