"""DataFrame -> DataFrame operators, one module per stage.

Points are rows with ``file_day``, ``mmsi`` (string), ``ts`` (epoch seconds),
``latitude``, ``longitude``, ``sog``, ``name`` and ``navigational_status``.
``file_day`` scopes every group and join: nothing crosses from one daily file
to the next.
"""
