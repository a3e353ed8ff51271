"""Operators for preparing training text at scale.

One module per operator (``opN_*``), shared helpers in ``_text`` (word and
line hashing over Arrow buffers), ``_stage`` (written tables in the shared
folder) and ``_components`` (connected components). ``queries`` registers the
``opN_*`` queries and their SQL. Nothing else in the library imports this
subpackage.
"""
