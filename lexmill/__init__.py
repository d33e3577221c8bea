"""Spark-native preparation of text corpora.

Web archives, pages and text files become documents; documents are cleaned,
scored, filtered, split, vectorised and classified.  Everything is a column
function or a DataFrame-to-DataFrame transform.
"""
