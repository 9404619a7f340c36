"""Tidemark: extract/load jobs on Spark.

Read any query, table or file set; render it losslessly; read only what is past
a stored cursor; load it by atomic append or keyed upsert; prove the copy.
"""
