"""Operations of a training-data pipeline: tokenizers, packing, language ID, quality,
near-duplicates, search, sharding and language-model scoring.

Every operator takes DataFrames and column names, reads only the columns it needs
(extra columns with any names are ignored) and keeps its intermediate tables in the
shared folder of ``spark.checkpoint.dir``.  Nothing outside this subpackage imports it.
"""
