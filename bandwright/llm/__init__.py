"""Operators that prepare text corpora for training: one module each, plain functions from frame to frame."""
