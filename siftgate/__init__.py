"""siftgate: declare a file feed once, load it safely with Spark."""

from siftgate.spec import Audit, FieldSpec, Registry, Rule, SourceSpec

__all__ = ["Audit", "FieldSpec", "Registry", "Rule", "SourceSpec"]
