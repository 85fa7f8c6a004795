"""Operators of a training-data pipeline over document, embedding and label tables.

Every operator takes and returns DataFrames. Rules that hold for all of them:

* Only the columns an operator names are read, so extra columns, also ones named
  like its results, never clash.
* A null text counts as an empty one; a null ``doc_id`` is kept and returned.
* Rows are never dropped, capped or sampled; repeated rows give repeated results.
"""
