"""Inputs: the test topics derived from the test tables (fixtures).

Stream readers for real topics are in ``rillflow.streaming.topics``.
"""
