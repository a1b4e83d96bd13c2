"""Streaming (transformWithState) forms of the keyed operators.  Call the
functions of ``eventide.operators`` with a streaming DataFrame; they
dispatch here."""
