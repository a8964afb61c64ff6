"""Scriptorium: script and typography corpus analytics as Spark DataFrame pipelines."""
