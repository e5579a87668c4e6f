"""Operators for preparing large text corpora: deduplication, language
identification, secret scanning, web archives, source mixing, exact search and
sequence packing.  Nothing else in the library imports this package.
"""
