"""Topic patterns with wildcards, compiled on the driver to Column conditions.

A pattern is a list of levels between slashes. ``+`` stands for one level and
``#``, as the last level, for all that remain, the parent level included.
``+name`` and ``#name`` also capture what they match. A pattern that starts
with a wildcard matches no topic that starts with ``$``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, functions as F

RESERVED = "$"


@dataclass(frozen=True)
class Pattern:
    text: str

    def __post_init__(self) -> None:
        if any(level.startswith("#") for level in self.levels[:-1]):
            raise ValueError(f"# must be the last level: {self.text!r}")

    @property
    def levels(self) -> list[str]:
        return self.text.split("/")

    @cached_property
    def is_exact(self) -> bool:
        return not any(level[:1] in ("+", "#") for level in self.levels)

    @cached_property
    def captures(self) -> dict[str, int]:
        """Regex group per capture name; of a repeated name the last one."""
        wild = [level[1:] for level in self.levels if level[:1] in ("+", "#")]
        names = [name for name in wild if name]
        return {name: group for group, name in enumerate(names, start=1)}

    @cached_property
    def regex(self) -> str:
        r"""Java regex. \A and \z because $ also matches before a final newline."""
        parts = []
        for level in self.levels:
            if level.startswith("#"):
                continue
            if level.startswith("+"):
                parts.append("([^/]*)" if level[1:] else "[^/]*")
            else:
                parts.append(re.escape(level))
        body = "/".join(parts)
        if self.levels[-1].startswith("#"):
            rest = "(.*)" if self.levels[-1][1:] else ".*"
            body = f"{body}(?:/{rest})?" if parts else rest
        guard = rf"(?!\{RESERVED})" if self.starts_wild else ""
        return rf"(?s)\A{guard}{body}\z"

    @property
    def starts_wild(self) -> bool:
        return self.text[:1] in ("+", "#")

    @cached_property
    def literal_levels(self) -> list[str]:
        """The levels before the first wildcard."""
        literal = []
        for level in self.levels:
            if level[:1] in ("+", "#"):
                break
            literal.append(level)
        return literal

    def matches(self, topic: Column) -> Column:
        """Condition on ``topic``; plain string comparison where no regex is needed."""
        if self.is_exact:
            return topic == self.text
        literal = "/".join(self.literal_levels)
        only_rest_wild = len(self.literal_levels) == len(self.levels) - 1 and self.levels[-1].startswith("#")
        if only_rest_wild:
            if not self.literal_levels:
                return ~topic.startswith(RESERVED)
            return (topic == literal) | topic.startswith(literal + "/")
        if self.literal_levels:
            return topic.startswith(literal + "/") & topic.rlike(self.regex)
        return topic.rlike(self.regex)

    def capture(self, topic: Column, name: str) -> Column:
        """What ``name`` captures; only meaningful where the pattern matches."""
        return F.regexp_extract(topic, self.regex, self.captures[name])

    def captured_map(self, topic: Column) -> Column | None:
        """All captures as a map, or None when the pattern names none."""
        if not self.captures:
            return None
        pairs = []
        for name in self.captures:
            pairs += [F.lit(name), self.capture(topic, name)]
        return F.create_map(*pairs)


def extract_fields(pattern: str, topic: Column) -> Column:
    """Map of what the named wildcards capture, null where there is no match or no name."""
    compiled = Pattern(pattern)
    captured = compiled.captured_map(topic)
    if captured is None:
        return F.lit(None).cast("map<string,string>")
    return F.when(compiled.matches(topic), captured)
