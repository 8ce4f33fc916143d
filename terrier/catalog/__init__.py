"""Named queries over the test tables, each with an equivalent SQL text where one exists."""

from terrier.catalog import aggregates, features, joins, models, relational, scalar, series, sources, splits  # noqa: F401
from terrier.catalog.registry import QUERIES, SQL  # noqa: F401
