"""Plan inspection and size-checked physical choices.

Nothing here plans queries; Catalyst does. These helpers read what Catalyst
decided (``explain``) and guard the few choices a user makes by hand, such as
broadcasting a side whose size has been measured.
"""

from .inspect import plan_text, pushed_filters, read_schema, has_broadcast, has_python_udf  # noqa: F401
from .sizing import estimated_bytes, broadcast_if_small, DEFAULT_BROADCAST_BYTES  # noqa: F401
