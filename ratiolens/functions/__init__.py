"""SQL expression builders: null-safe arithmetic, LMDI, Adtributor measures, text.

Every builder takes and returns SQL text. The operators hand whole lists of such
expressions to ``selectExpr`` or ``agg``, which keeps the driver's work for the
widest steps (over a hundred columns) to one call per column.
"""
