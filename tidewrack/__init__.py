"""tidewrack: a Spark-native engine for web-search corpora.

Operators take DataFrames and return DataFrames; scalar functions take Columns and return Columns.
Nothing is executed until the caller runs an action, except where a docstring says that an operator
materialises a stage through the shared checkpoint folder.
"""

__version__ = "0.1.0"
