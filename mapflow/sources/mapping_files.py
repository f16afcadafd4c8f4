"""Mappings kept as YAML files, read with PyYAML where it is installed."""

from __future__ import annotations

from typing import Any

try:
    import yaml
except ImportError:  # the package works on dictionaries without it
    yaml = None

# Keys below which every scalar is SQL text.
_SQL_MAPS = ("expressions", "column_mapping")


def load_mapping(text: str) -> dict[str, Any]:
    """A mapping from YAML text, ready for ``run_mapping``.

    Below ``expressions`` and ``column_mapping`` every value is SQL: numbers and nulls
    stay text, and a value that is quoted as a whole is a string literal.
    """
    if yaml is None:
        raise RuntimeError("PyYAML is not installed; pass mappings as dictionaries")
    root = yaml.compose(text, Loader=yaml.SafeLoader)
    _mark_sql(root, inside=False)
    return yaml.constructor.SafeConstructor().construct_document(root)


def _mark_sql(node: Any, inside: bool) -> None:
    if isinstance(node, yaml.MappingNode):
        for key, value in node.value:
            _mark_sql(value, inside or key.value in _SQL_MAPS)
    elif isinstance(node, yaml.SequenceNode):
        for value in node.value:
            _mark_sql(value, inside)
    elif inside:
        literal = node.style in ("'", '"') and not set(node.value) & {"'", '"'}
        if node.tag.endswith(":null"):
            node.value = "null"
        elif literal:
            node.value = f"'{node.value}'"
        node.tag = "tag:yaml.org,2002:str"
