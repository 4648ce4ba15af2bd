"""quire.plans"""

from quire.plans import catalog, knowledge  # noqa: E402, F401
