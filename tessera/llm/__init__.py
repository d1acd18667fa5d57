"""Operators for preparing training data.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it is installed. One module per operator, registered in
``queries.py``.
"""
