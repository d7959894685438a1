"""All registered queries; later modules build on the SQL of earlier ones."""

from . import manifest_queries, timeline_queries  # noqa: F401, I001
from . import fold_queries, sequence_queries, signal_queries  # noqa: F401
from . import contract_queries, format_queries, job_queries, repair_queries  # noqa: F401
from .registry import QUERIES  # noqa: F401
