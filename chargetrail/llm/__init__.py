"""Operators for preparing language-model training data at scale.

Every operator takes and returns DataFrames and names its id and text columns as parameters. A row of
`documents` is a document; `doc_id` identifies it. The Python parts import this package on the executors, so it
must be importable there (`--py-files`, or installed).
"""
