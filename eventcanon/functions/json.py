"""Typed access to JSON text columns.

`with_json` reads many paths of one payload with a single ``from_json`` parse. Leaves are
strings, so numbers and booleans keep their JSON spelling. Three kinds of read exist:

* ``values``: the scalar at a path. Objects, arrays, JSON null, a missing key and unreadable
  text all give NULL. A *string* that happens to start with ``{`` is kept.
* ``queries``: the JSON text at a path, whatever it is; JSON null and a missing key give NULL.
* ``arrays``: ``array<string>`` with the elements' text; NULL when the path holds no array.

Paths look like ``$.a.b``, ``$.from[0].email``, ``$.to[*].email`` or ``$['odd.key']``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"\.([^.\[\]]+)|\[(\d+|\*)\]|\['([^']+)'\]")
_LEAF = {"value": T.StringType(), "query": T.VariantType(), "array": T.ArrayType(T.StringType())}


def parse_path(path: str) -> list[str | int]:
    """Split a JSON path into field names, array positions and ``'*'`` (kept as ``-1``)."""
    if not path.startswith("$"):
        raise ValueError(f"JSON path must start with $: {path!r}")
    steps: list[str | int] = []
    at = 1
    while at < len(path):
        m = _TOKEN.match(path, at)
        if m is None:
            raise ValueError(f"cannot read JSON path {path!r} at position {at}")
        name, index, quoted = m.groups()
        if index is not None:
            steps.append(-1 if index == "*" else int(index))
        else:
            steps.append(name if name is not None else quoted)
        at = m.end()
    return steps


def _insert(tree: dict, steps: list, leaf: T.DataType) -> bool:
    """Add a path to a tree of requested paths; False when it needs another shape of a node."""
    node = tree
    for depth, step in enumerate(steps):
        label = "[]" if isinstance(step, int) else step
        others = [k for k in node if (k == "[]") != (label == "[]")]
        if others:
            return False
        last = depth == len(steps) - 1
        child = node.get(label)
        if last:
            if child is None:
                node[label] = leaf
                return True
            return child == leaf
        if child is None:
            child = node[label] = {}
        if not isinstance(child, dict):
            return False
        node = child
    return False


def _conflicts(tree: dict, steps: list, leaf: T.DataType) -> bool:
    node: object = tree
    for depth, step in enumerate(steps):
        label = "[]" if isinstance(step, int) else step
        if not isinstance(node, dict):
            return True
        if any((k == "[]") != (label == "[]") for k in node):
            return True
        if label not in node:
            return False
        node = node[label]
        if depth == len(steps) - 1:
            return node != leaf
    return True


def _to_type(node) -> T.DataType:
    if not isinstance(node, dict):
        return node
    if "[]" in node:
        return T.ArrayType(_to_type(node["[]"]))
    return T.StructType([T.StructField(k, _to_type(v)) for k, v in node.items()])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _follow(root: str, steps: list) -> str:
    """SQL for the place a path leads to below a parsed column."""
    sql = root
    for step in steps:
        if isinstance(step, int):
            sql = sql if step < 0 else f"get({sql}, {step})"
        else:
            sql = f"{sql}.{_quoted(step)}"
    return sql


def _variant_path(steps: list) -> str:
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else f'["{s}"]' for s in steps)


def _scalar_only(text: str, payload: str, steps: list) -> str:
    # Only text that starts like an object or array needs the second, exact look. The tests are
    # nested CASEs so that the extra parse runs for those rows alone.
    found = f"try_variant_get(try_parse_json({payload}), '{_variant_path(steps)}', 'variant')"
    exact = f"CASE WHEN substring(schema_of_variant({found}), 1, 6) IN ('OBJECT', 'ARRAY<') THEN NULL ELSE {text} END"
    return f"CASE WHEN substring({text}, 1, 1) IN ('{{', '[') THEN {exact} ELSE {text} END"


def with_json(
    df: DataFrame,
    payload: str = "payload",
    values: Mapping[str, str] | None = None,
    queries: Mapping[str, str] | None = None,
    arrays: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add one column per requested path; `payload` is parsed once for all of them."""
    wanted = [(n, p, "value") for n, p in (values or {}).items()]
    wanted += [(n, p, "query") for n, p in (queries or {}).items()]
    wanted += [(n, p, "array") for n, p in (arrays or {}).items()]
    trees: list[dict] = []
    plan = []
    for name, path, kind in wanted:
        steps = parse_path(path)
        leaf = _LEAF[kind]
        if kind == "array" and -1 in steps:
            leaf = T.StringType()  # $.to[*].email: the array comes from the path itself
        for where, tree in enumerate(trees):
            if not _conflicts(tree, steps, leaf):
                break
        else:
            where, tree = len(trees), {}
            trees.append(tree)
        _insert(tree, steps, leaf)
        plan.append((name, steps, kind, where))

    # The parsed object comes out of a generator: a later filter on a parsed field then stays above
    # it. Pushed below a projection, the filter would carry a copy of the parse for every use.
    out = df
    for i, tree in enumerate(trees):
        out = out.select("*", F.explode(F.array(F.from_json(F.col(payload), _to_type(tree)))).alias(f"__json{i}"))
    made = []
    for name, steps, kind, where in plan:
        sql = _follow(f"__json{where}", steps)
        if kind == "value":
            sql = _scalar_only(sql, _quoted(payload), steps)
        elif kind == "query":
            # A variant null is a value of its own; the reports treat it as missing.
            sql = f"CASE WHEN is_variant_null({sql}) THEN NULL ELSE to_json({sql}) END"
        made.append(f"{sql} AS {_quoted(name)}")
    names = {name for name, *_ in plan}
    kept = [_quoted(c) for c in df.columns if c not in names]
    return out.selectExpr(*kept, *made)


def json_value(payload: str, path: str) -> Column:
    """Scalar at one path of a JSON text column. For many paths use `with_json`."""
    steps = parse_path(path)
    plain = "$" + "".join(f"[{s}]" if isinstance(s, int) else f"[\\'{s}\\']" for s in steps)
    return F.expr(_scalar_only(f"get_json_object({_quoted(payload)}, '{plain}')", _quoted(payload), steps))


def json_query(payload: str, path: str) -> Column:
    """JSON text at one path; JSON null and missing give NULL."""
    got = f"try_variant_get(try_parse_json({_quoted(payload)}), '{_variant_path(parse_path(path))}', 'variant')"
    return F.expr(f"CASE WHEN is_variant_null({got}) THEN NULL ELSE to_json({got}) END")


def to_json_full(*cols: str | Column) -> Column:
    """JSON object of the given columns; NULLs are written as JSON null, not dropped."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def parse_json_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Turn JSON text columns into VARIANT. Text that is no JSON stays in ``<name>_raw``."""
    out = {}
    for name in columns:
        parsed = F.try_parse_json(F.col(name))
        out[name] = parsed
        out[f"{name}_raw"] = F.when(parsed.isNull(), F.col(name))
    return df.withColumns(out)
