"""Column-level helpers (all JVM-side built-ins; no Python per row)."""

from kiln.functions.text import *  # noqa: F401,F403
from kiln.functions.chat import *  # noqa: F401,F403
from kiln.functions.hashing import *  # noqa: F401,F403
