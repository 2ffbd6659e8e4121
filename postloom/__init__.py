"""Social-post analytics on Spark: capture readers, text and counter
normalisation, labelling, upsert loading, analytics and export.

Every operator takes and returns DataFrames (or Columns) and is built from
Spark SQL expressions only; there are no Python UDFs.
"""
