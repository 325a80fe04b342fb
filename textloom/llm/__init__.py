"""Operations of a training-data pipeline: search, near-duplicates, scoring, mixing, packing.

Nothing else in the library imports this subpackage. Each module holds one
operator; `queries` applies them to the given tables.
"""
