"""Topic templates such as ``sensor/${fields.deviceId}/reading``, compiled to Columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

PLACEHOLDER = re.compile(r"\$\{([^}]*)\}")
PATH_STEP = re.compile(r"[A-Za-z0-9_-]+")


def render(template: str, topic: Column, key: Column, fields: Column, msg: Column) -> Column:
    """The text of ``template`` per row; null where a reference has no value.

    References: ``${topic}``, ``${key}``, ``${fields.name}``, ``${msg}`` for a
    text message and ``${msg.a.b}`` for a value inside a JSON message.
    """
    parts: list[Column] = []
    pos = 0
    for found in PLACEHOLDER.finditer(template):
        if found.start() > pos:
            parts.append(F.lit(template[pos : found.start()]))
        parts.append(_reference(found.group(1).strip(), topic, key, fields, msg))
        pos = found.end()
    if pos < len(template) or not parts:
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def _reference(name: str, topic: Column, key: Column, fields: Column, msg: Column) -> Column:
    root, *path = name.split(".")
    if not path:
        plain = {"topic": topic, "key": key, "msg": msg["text"]}
        if root in plain:
            return plain[root]
    elif root == "fields":
        return fields[".".join(path)]
    elif root == "msg" and all(PATH_STEP.fullmatch(step) for step in path):
        steps = "".join(f"['{step}']" for step in path)
        return F.try_variant_get(msg["json"], "$" + steps, "string")
    raise ValueError(f"unknown reference in topic template: ${{{name}}}")
