"""Named queries over the driver's tables, their DuckDB oracles and the message fixture.

The library (``batchtrace``) does not import anything from here.
"""
