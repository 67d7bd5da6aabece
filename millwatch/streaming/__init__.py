"""Structured Streaming forms of the operators.

Every query takes a checkpoint folder, stops when its input is used up
(``availableNow``) unless told otherwise, and resumes from the checkpoint.
"""
