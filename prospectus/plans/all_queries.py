"""Import every query module so that all queries are registered."""

from . import catalogue_queries  # noqa: F401
from . import extract_queries  # noqa: F401
from . import item_queries  # noqa: F401
from . import link_queries  # noqa: F401
from . import report_queries  # noqa: F401
from . import stream_queries  # noqa: F401
