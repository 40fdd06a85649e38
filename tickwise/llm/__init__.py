"""Operators of a training-data pipeline: language ID, quality scoring and
rules, n-gram LM scoring, licence scans, BPE, source mixing, near-duplicate
detection, WARC archives and exact top-k search.

Nothing outside this package imports it. ``queries`` registers one query
per operator; ``corpus_pipeline.py`` at the repository top chains five.
"""
