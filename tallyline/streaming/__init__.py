"""Structured Streaming forms of the operators.

Counting operators of ``tallyline.operators`` are plain DataFrame functions and run
on streams as they are (update or complete mode). This package holds what needs
another form on a stream: windows that close by watermark, and rankings.
"""
