"""Operators for training-data pipelines. Nothing outside this folder imports it, save corpus_pipeline.py."""
