"""Operators of a training-data pipeline on Spark.

One module per operator, plus ``words`` (byte-level words of Arrow text),
``tokens`` (public tokenizers with a word cache), ``links`` (components of a
link table) and ``registry`` (the queries and their SQL).
"""
