"""celltally: single-cell read counting on Spark DataFrames.

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame
operators), ``sources`` / ``sinks`` (readers and writers), ``plans`` (the
annotate / barcode / count steps and a manifest-driven run).
"""
