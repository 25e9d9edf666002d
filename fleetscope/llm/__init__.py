"""Operators of a training-data pipeline, one module per operator.

Nothing outside this package imports it.  ``queries`` registers one query per
operator over the test tables; ``oracles`` holds the DuckDB SQL of those that SQL
can express.
"""
