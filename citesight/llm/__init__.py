"""Training-data operators (mixing, tokenising, deduplication, filtering).

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; ``catalog`` registers one query per operator.
"""
