from __future__ import annotations

import os


def expand_home(path: str) -> str:
    """Resolve a leading ``~``; any other path or URI is left as it is."""
    return os.path.expanduser(path) if path.startswith("~") else path
