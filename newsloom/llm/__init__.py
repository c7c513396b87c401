"""Training-data operators: filters, deduplication, scoring and packing of web text.

Nothing else in the library imports this subpackage; its queries live in
``newsloom.llm.registry``.
"""
