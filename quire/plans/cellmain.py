"""The other side of SubprocessExecutor: reads a cell from standard input, runs the function named in QUIRE_CELL (module:name)."""

from __future__ import annotations

import importlib
import json
import os
import sys


def main() -> int:
    module, _, name = os.environ.get("QUIRE_CELL", "").partition(":")
    if not name:
        sys.stderr.write("QUIRE_CELL names no function")
        return 2
    print(json.dumps(getattr(importlib.import_module(module), name)(json.load(sys.stdin))))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
