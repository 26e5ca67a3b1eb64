"""Column-level functions (pure Spark SQL expressions, codegen friendly)."""

from sparkmart.functions.text import *  # noqa: F401,F403
from sparkmart.functions.numeric import *  # noqa: F401,F403
from sparkmart.functions.temporal import *  # noqa: F401,F403
from sparkmart.functions.collections import *  # noqa: F401,F403
from sparkmart.functions.urls import *  # noqa: F401,F403
from sparkmart.functions.jsonpath import *  # noqa: F401,F403
