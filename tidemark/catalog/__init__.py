"""All registered queries."""

from tidemark.catalog import adtape, logs, metrics, relational, sketches, storage, streaming  # noqa: F401
from tidemark.catalog.registry import REGISTRY  # noqa: F401
