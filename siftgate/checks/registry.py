"""All checks by name."""

from __future__ import annotations

from siftgate.checks import files, logs, tables, validation
from siftgate.checks.common import Query

CHECKS: dict[str, tuple[Query, str | None]] = {
    **validation.CHECKS,
    **tables.CHECKS,
    **logs.CHECKS,
    **files.CHECKS,
}
