"""Layered restore pipeline and its operators, as Spark DataFrame functions."""
