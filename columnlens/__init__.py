"""Column profiling, semantic typing and key search on Spark DataFrames."""

from . import fixed_values
from .functions import *  # noqa: F401,F403
from .functions import __all__ as _functions
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .plans import *  # noqa: F401,F403
from .plans import __all__ as _plans
from .sources import *  # noqa: F401,F403
from .sources import __all__ as _sources

__all__ = ["fixed_values", *_functions, *_operators, *_plans, *_sources]
