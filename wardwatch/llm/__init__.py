"""Operators for preparing training text: search, filters, models and mixing over tables of documents."""
