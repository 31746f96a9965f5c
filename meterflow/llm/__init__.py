"""Operators of a training-data pipeline over text and vector tables, each as Spark jobs.

Conventions all of them keep:

* Tables come in as DataFrames; only the columns named by parameters are read, so further columns with
  whatever names do no harm. A null text is an empty one. An empty table gives an empty result.
* Rows that repeat a ``doc_id`` with the same text give the result of one such row, unless an operator says otherwise.
* Python functions run in tasks on bounded chunks; what travels between tasks are rows, or sorted arrays of
  keys packed per chunk, in which a key stands once however many rows of the chunk hold it.
"""
