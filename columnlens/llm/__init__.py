"""Operators for pipelines that prepare text for training language models."""
