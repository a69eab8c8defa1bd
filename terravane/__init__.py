"""Spark jobs for a national address and building register.

``sources``    XML, Parquet, archive and schema files
``functions``  Column expressions: projection, GML, WKT, grid, names
``operators``  DataFrame to DataFrame steps
``plans``      whole jobs built from the steps
``catalog``    the checked queries, each with its SQL twin
"""
