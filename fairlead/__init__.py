"""Vessel-encounter analytics as PySpark DataFrame operators.

The stages live in :mod:`fairlead.operators`, readers and writers in
:mod:`fairlead.sources`, Column builders in :mod:`fairlead.functions` and the
end-to-end job in :mod:`fairlead.plans`.
"""

from fairlead.config import EncounterConfig

__all__ = ["EncounterConfig"]
