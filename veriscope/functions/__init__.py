"""Functions of the models as Spark SQL text.

Each takes SQL expressions (a column name is one) and returns an expression for ``selectExpr`` or
``functions.expr``.  One call hands Spark a whole expression, which it parses, optimises and
compiles like any other.
"""
