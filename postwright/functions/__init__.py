"""Building blocks, written as Spark SQL expression texts.

Each function takes the SQL text of a value (usually a column name) and returns
the SQL text of the result, to be used with ``F.expr`` or ``selectExpr``.  One
text is one call to the JVM, whatever its length, which keeps the building of
these long plans fast.
"""
