"""Training-data operators: search, near-duplicates, filters, packing, scoring,
tokenising and extraction over document and page tables.

Nothing outside this folder imports it; ``queries.py`` lists what the driver
contract registers.
"""
