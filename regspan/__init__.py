"""Register research on Spark: DataFrame-in, DataFrame-out operators.

``sources``    read and write registers stored as Parquet directories
``functions``  column expressions (codes, dates, values)
``operators``  person-level operators (conditions, periods, splitting, matching)
``plans``      study steps that chain the operators (population, extracts)
"""
