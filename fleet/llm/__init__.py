"""Operators for training-data pipelines over a table ``documents (doc_id, text, lang, source, n_chars)``.

Each module holds one operator with its general interface; ``queries`` applies them to whole tables. Every operator
selects the columns that it names first, so further columns, whatever they are called, change nothing.
"""
