"""Training-data operators: filtering, duplicates, scoring, packing and binary output.

Nothing outside this folder imports it.
"""
