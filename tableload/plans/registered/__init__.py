"""Queries over the driver tables, one or more per operator, each with its SQL oracle.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from them) and
returns a DataFrame; the matching SQL computes the same result in another engine.
Computed columns carry the same alias on both sides.  Outputs avoid decimals (another
engine may hand them back as floats) and cast counts and sums to bigint.  Integer results
that can be NULL are rendered as text on both sides (``as_text``): exact for every value,
and identical however an engine hands back a nullable integer column.
"""

# importing a module registers its queries; this order is the order of queries() and the bench
from . import loading  # noqa: F401,I001
from . import relational  # noqa: F401
from . import keyed  # noqa: F401
from . import placement  # noqa: F401
from . import rewriting  # noqa: F401
from . import catalog  # noqa: F401
from . import streams  # noqa: F401
from .base import ORACLES, QUERIES, as_text, query, table
from .catalog import _migration_snapshot
from .keyed import report_rules
from .loading import DOC_COLUMNS, ORDER_COLUMNS, ORDERS_SCHEME, SUPPLIER_COLUMNS
from .placement import COMPOSITE_RANGES, COUNTED, GAPPED, HASH4, MANY_RANGES, PRICE_RANGES, PRIORITY_LIST, TWO_LEVEL

__all__ = ["COMPOSITE_RANGES", "COUNTED", "DOC_COLUMNS", "GAPPED", "HASH4", "MANY_RANGES", "ORACLES", "ORDERS_SCHEME",
           "ORDER_COLUMNS", "PRICE_RANGES", "PRIORITY_LIST", "QUERIES", "SUPPLIER_COLUMNS", "TWO_LEVEL",
           "_migration_snapshot", "as_text", "query", "report_rules", "table"]
