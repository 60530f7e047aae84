"""Training-data operators: dedup, tokens, language, HTML, URL and toxicity filters.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries when it is present.
"""
