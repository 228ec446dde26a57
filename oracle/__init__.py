"""The SQL counterparts of the queries: `-- name: key` starts each one in the .sql files."""

from __future__ import annotations

import re
from pathlib import Path

HERE = Path(__file__).parent


def load_sql() -> dict[str, str]:
    model = (HERE / "model.sql").read_text().strip()
    out = {}
    for path in sorted(HERE.glob("*.sql")):
        if path.name == "model.sql":
            continue
        for part in re.split(r"^-- name: ", path.read_text(), flags=re.M)[1:]:
            name, body = part.split("\n", 1)
            out[name.strip()] = f"WITH {model}\nSELECT * FROM (\n{body.strip()}\n) q"
    return out
