"""Batch operators and jobs for travel data, written as plain Spark DataFrame code.

Sub-packages:

* ``sources``   – readers (documents, dated CSV, daily Parquet, prior state, catalog)
* ``functions`` – column expressions
* ``operators`` – DataFrame → DataFrame transformations
* ``sinks``     – Parquet, CSV and catalog writers
* ``plans``     – whole jobs put together from the above
* ``registry``  – the checked queries with their SQL counterparts
"""
