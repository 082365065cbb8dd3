"""Training-data operators on text and web tables.

Each module holds one operator as a function from DataFrames to a DataFrame;
``queries`` holds the registered queries.  Nothing outside this folder (and
``corpus_pipeline.py``) imports it.
"""
