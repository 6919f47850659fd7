"""All registered queries."""

from tabloom.catalog import (evaluation, features, modelling, relational, scalars, series,  # noqa: F401
                             storage, streams, vectors)
from tabloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
