"""Named queries over the test tables, each with the SQL that must give the same rows."""

from presslens.plans import (  # noqa: F401
    counting,
    headlines,
    places,
    reports,
    searching,
    shaping,
    sourcing,
)
from presslens.plans.registry import ORACLES, QUERIES  # noqa: F401
