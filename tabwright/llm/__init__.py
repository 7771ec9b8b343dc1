"""Operators for preparing training text: tokens, duplicates, packing, scoring, quality, shards.

Nothing outside this package imports it. Each module holds one operator with its
own interface; ``queries`` registers the ``opN_<name>`` queries over ``documents``.
"""
