"""blotter: Spark-native analytics over incident-record tables.

Every operator is a ``DataFrame -> DataFrame`` function written with
built-in Spark expressions.  Column names are arguments; the defaults are
the field names of the unified incident table (see ``blotter.schema``).

    from blotter import harmonize, top_values, crosstab_long, correspondence
"""

from blotter.operators import *  # noqa: F401,F403
from blotter.operators import __all__ as _ops
from blotter.sources import *  # noqa: F401,F403
from blotter.sources import __all__ as _srcs

__version__ = "0.1.0"
__all__ = [*_ops, *_srcs]
