"""Lazy DataFrame -> DataFrame operators: cleaning, model, views, queries, quality."""
