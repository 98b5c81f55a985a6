"""Check JSON payloads against a JSON schema, and report fields the schema does not know.

The schema document is read once on the driver and compiled to Column expressions; the rows are
checked inside Spark's own operators.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Nesting limit for known paths, errors shown per group, length of the error text.
KNOWN_PATH_DEPTH = 5
ERRORS_PER_GROUP = 3
ERROR_TEXT_LENGTH = 1000

# How deep payload objects may nest. A deeper payload fails the job instead of being cut.
PAYLOAD_DEPTH = 16


# Keywords that are compiled, and those that check nothing. Any other keyword raises when the schema is read.
CHECKED = frozenset((
    "type enum const minimum maximum exclusiveMinimum exclusiveMaximum multipleOf minLength maxLength pattern minItems maxItems uniqueItems "
    "minProperties maxProperties required properties additionalProperties items additionalItems prefixItems allOf anyOf oneOf not $ref"
).split())
ANNOTATIONS = frozenset("$schema $id id $comment title description default examples definitions $defs format readOnly writeOnly deprecated".split())


def _resolve(node: dict, root: dict) -> dict:
    """The schema a node stands for: references are JSON pointers into the document."""
    seen = set()
    while isinstance(node, dict) and "$ref" in node:
        ref = node["$ref"]
        if ref in seen or not ref.startswith("#"):
            raise ValueError(f"reference {ref!r} leads nowhere in the schema")
        seen.add(ref)
        node = root
        for part in ref[1:].split("/")[1:]:
            part = part.replace("~1", "/").replace("~0", "~")
            try:
                node = node[int(part)] if isinstance(node, list) else node[part]
            except (KeyError, IndexError, ValueError, TypeError):
                raise ValueError(f"reference {ref!r} leads nowhere in the schema") from None
    return node


def _children(node: dict, root: dict) -> list[dict]:
    """The schemas whose properties a property's value may carry."""
    if "$ref" in node:
        options = [node]
    elif "oneOf" in node:
        options = [o for o in node["oneOf"] if "$ref" in o or "properties" in o]
    elif node.get("type") == "object" or "properties" in node:
        return [node]
    elif node.get("type") == "array" and isinstance(node.get("items"), dict):
        options = [node["items"]]
    else:
        return []
    found = [_resolve(o, root) for o in options]
    return [f for f in found if isinstance(f, dict) and "properties" in f]


def known_paths(schema: dict) -> list[str]:
    """Dotted paths of all properties, through references, alternatives, objects and array items."""
    out: set[str] = set()
    queue = [(schema, "", 0)]
    while queue:
        node, prefix, depth = queue.pop()
        for name, child in node.get("properties", {}).items():
            path = f"{prefix}{name}"
            out.add(path)
            if depth < KNOWN_PATH_DEPTH:
                queue += [(c, path + ".", depth + 1) for c in _children(child, schema)]
    return sorted(out)


# The builders below write SQL expression text: a schema gives hundreds of small expressions, and
# parsing one text is much faster than making each of them through the Python API.

_MAP = "map<string,variant>"
_NO_TEXT = "cast(array() as array<string>)"
_NO_WORK = "cast(array() as array<struct<unit:int,value:variant,key:string>>)"
_NO_ERRORS = "cast(array() as array<struct<kind:string,text:string>>)"


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _get(v: str, path: str, kind: str) -> str:
    if (path, kind) == ("$", "variant"):
        return v  # getting a variant out of one copies all that is below it
    return f"try_variant_get({v}, {sql_text(path)}, '{kind}')"


def _step(path: str, name: str) -> str:
    return f'{path}["{name}"]'


def _is_object(v: str, path: str) -> str:
    # Casting to a one-field struct looks at the value's header only; no member is built.
    return f"{_get(v, path, 'struct<x:variant>')} IS NOT NULL"


def _is_there(v: str, path: str) -> str:
    """Whether there is a value at a path, be it a null. Objects, which may hold much, are seen by their header."""
    return f"({_is_object(v, path)} OR {_get(v, path, 'variant')} IS NOT NULL)"


def _deep_paths(v: str) -> str:
    """What `object_paths` gives, walked level by level inside the row: slower, but for any depth.

    No walk has more levels than the JSON text has opening braces.
    """
    text = f"to_json({v})"
    levels = f"sequence(1, length({text}) - length(replace({text}, '{{', '')))"
    nodes = "array<struct<path:string,value:variant>>"
    members = f"coalesce(map_entries({_get('n.value', '$', _MAP)}), map_entries(cast(map() as {_MAP})))"
    name = "CASE WHEN n.path IS NULL THEN m.key ELSE concat(n.path, '.', m.key) END"
    below = f"flatten(transform(w.level, n -> transform({members}, m -> named_struct('path', {name}, 'value', m.value))))"
    down = f"element_at(transform(array({below}), b -> named_struct('level', b, 'paths', concat(w.paths, transform(b, x -> x.path)))), 1)"
    start = f"named_struct('level', cast(array(named_struct('path', cast(null as string), 'value', {v})) as {nodes}), 'paths', {_NO_TEXT})"
    return f"aggregate({levels}, {start}, (w, i) -> CASE WHEN size(w.level) = 0 THEN w ELSE {down} END, w -> w.paths)"


def object_paths(v: str, depth: int = PAYLOAD_DEPTH) -> str:
    """Dotted paths of all members of nested objects below a variant; arrays are not entered."""
    members = f"map_entries({_get(v, '$', _MAP)})"
    if depth == 0:
        return f"CASE WHEN size({members}) > 0 THEN {_deep_paths(v)} ELSE {_NO_TEXT} END"
    e, p = f"e{depth}", f"p{depth}"
    inner = f"transform({object_paths(f'{e}.value', depth - 1)}, {p} -> concat({e}.key, '.', {p}))"
    return f"coalesce(flatten(transform({members}, {e} -> concat(array({e}.key), {inner}))), {_NO_TEXT})"


def _tree(paths: list[str]) -> dict:
    tree: dict = {}
    for path in paths:
        node = tree
        for name in path.split("."):
            node = node.setdefault(name, {})
    return tree


def _texts(names) -> str:
    return f"cast(array({', '.join(sql_text(n) for n in names)}) as array<string>)"


def _drifting(v: str, tree: dict, path: str) -> list[str]:
    """Tests, one per object of the schema: does it hold members the schema lacks?"""
    keys = f"map_keys({_get(v, path, _MAP)})"
    test = f"CASE WHEN {_is_object(v, path)} THEN size(array_except({keys}, {_texts(tree)})) > 0 ELSE false END"
    out = [test]
    for name, child in tree.items():
        out += _drifting(v, child, _step(path, name))
    return out


def unknown_fields(variant: str, schema: dict) -> Column:
    """Sorted paths of a parsed payload that the schema lacks; NULL when there are none.

    A row without drift pays for the key list of each object the schema knows; the whole payload is
    walked only where some object has an unknown member.
    """
    paths = known_paths(schema)
    drift = " OR ".join(_drifting(variant, _tree(paths), "$"))
    extra = f"array_sort(array_except({object_paths(variant)}, {_texts(paths)}))"
    return F.expr(f"CASE WHEN {drift} THEN nullif({extra}, {_NO_TEXT}) END")


def _is_type(v: str, path: str, name: str) -> str:
    """Whether the value at a path has a JSON schema type."""
    kind = f"schema_of_variant({_get(v, path, 'variant')})"
    number = _get(v, path, "double")
    tests = {
        "object": _is_object(v, path),
        "array": f"{_get(v, path, 'array<variant>')} IS NOT NULL",
        "string": f"{kind} = 'STRING'",
        "boolean": f"{kind} = 'BOOLEAN'",
        "null": f"is_variant_null({_get(v, path, 'variant')})",
        "number": f"substring({kind}, 1, 6) IN ('BIGINT', 'DECIMA', 'DOUBLE', 'FLOAT')",
        "integer": f"(CASE WHEN {kind} = 'BIGINT' THEN true WHEN {kind} IN ('DOUBLE', 'FLOAT') THEN {number} = floor({number})"
        f" ELSE {kind} LIKE 'DECIMAL(%,0)' END)",
    }
    if name not in tests:
        raise ValueError(f"unknown JSON schema type {name!r}")
    return tests[name]


def _shown(v: str, path: str) -> str:
    text = f"to_json({_get(v, path, 'variant')})"
    return f"CASE WHEN substring({text}, 1, 1) = '\"' THEN concat('\\'', substring({text}, 2, length({text}) - 2), '\\'') ELSE {text} END"


def _error(kind: str, text: str) -> str:
    return f"named_struct('kind', '{kind}', 'text', {text})"


def _tests(v: str, path: str, node: dict) -> list[tuple[str, str, str]]:
    """(violated, kind, message) for the value at a path, apart from its members and items."""
    out = []
    types = node.get("type")
    types = [types] if isinstance(types, str) else list(types or [])
    if types:
        ok = " OR ".join(_is_type(v, path, t) for t in types)
        names = ", ".join(f"'{t}'" for t in types)
        out.append((f"NOT ({ok})", "type", f" is not of type {names}"))
    if "enum" in node:
        allowed = ", ".join(f"to_json(parse_json({sql_text(json.dumps(e))}))" for e in node["enum"])
        out.append((f"to_json({_get(v, path, 'variant')}) NOT IN ({allowed})", "other", f" is not one of {node['enum']}"))
    number = f"CASE WHEN {_is_type(v, path, 'number')} THEN {_get(v, path, 'double')} END"
    text = f"CASE WHEN {_is_type(v, path, 'string')} THEN {_get(v, path, 'string')} END"
    limits = {
        "minimum": (number, "<", "is less than the minimum of"),
        "maximum": (number, ">", "is greater than the maximum of"),
        "minLength": (f"length({text})", "<", "is shorter than"),
        "maxLength": (f"length({text})", ">", "is longer than"),
    }
    for word, (value, op, message) in limits.items():
        if word in node:
            out.append((f"({value}) {op} {float(node[word])}D", "other", f" {message} {node[word]}"))
    items = f"size({_get(v, path, 'array<variant>')})"
    members = f"CASE WHEN {_is_object(v, path)} THEN size(map_keys({_get(v, path, _MAP)})) END"
    more = {
        "exclusiveMinimum": (number, "<=", "is less than or equal to the minimum of"),
        "exclusiveMaximum": (number, ">=", "is greater than or equal to the maximum of"),
        "minItems": (items, "<", "has fewer items than"),
        "maxItems": (items, ">", "has more items than"),
        "minProperties": (members, "<", "has fewer properties than"),
        "maxProperties": (members, ">", "has more properties than"),
    }
    for word, (value, op, message) in more.items():
        if word in node:
            if isinstance(node[word], bool):
                raise ValueError(f"{word} is to be a number")
            out.append((f"({value}) {op} {float(node[word])}D", "other", f" {message} {node[word]}"))
    if "multipleOf" in node:
        by = f"cast({number} as decimal(38,12)) % cast({float(node['multipleOf'])}D as decimal(38,12))"
        out.append((f"({by}) <> 0", "other", f" is not a multiple of {node['multipleOf']}"))
    if "const" in node:
        wanted = f"to_json(parse_json({sql_text(json.dumps(node['const']))}))"
        out.append((f"to_json({_get(v, path, 'variant')}) <> {wanted}", "other", f" is not {json.dumps(node['const'])}"))
    if node.get("uniqueItems"):
        texts = f"transform({_get(v, path, 'array<variant>')}, u -> coalesce(to_json(u), 'null'))"
        out.append((f"size(array_distinct({texts})) < size({texts})", "other", " has repeated items"))
    if "pattern" in node:
        out.append((f"NOT (({text}) RLIKE {sql_text(node['pattern'])})", "other", f" does not match '{node['pattern']}'"))
    return [(bad, kind, f"concat({_shown(v, path)}, {sql_text(message)})") for bad, kind, message in out]


def _below(node: dict | bool) -> list[tuple[dict | bool, bool]]:
    """The schemas a schema applies, each with whether it is for a member or item (True) or for the value itself."""
    if isinstance(node, bool):
        return []
    if "$ref" in node:
        return []
    out = [(o, False) for word in ("allOf", "anyOf", "oneOf") for o in node.get(word, [])]
    out += [(node["not"], False)] if "not" in node else []
    out += [(c, True) for c in node.get("properties", {}).values()]
    out += [(c, True) for c in _tuple(node)[0]]
    return out + [(c, True) for c in (node.get("additionalProperties", True), _tuple(node)[1])]


def _tuple(node: dict) -> tuple[list, dict | bool]:
    """Schemas of the first items, one each, and the schema of the others."""
    if isinstance(node.get("items"), list):
        return node["items"], node.get("additionalItems", True)
    return node.get("prefixItems", []), node.get("items", True)


def recursive_refs(schema: dict) -> list[str]:
    """References that lead to themselves again, in order of their text.

    One that does so without going down into the value has no meaning and raises.
    """
    edges: dict[str, set[tuple[str, bool]]] = {}

    def refs(node: dict | bool, down: bool) -> set[tuple[str, bool]]:
        if isinstance(node, dict) and "$ref" in node:
            return {(node["$ref"], down)}
        return {r for child, deeper in _below(node) for r in refs(child, down or deeper)}

    todo = [r for r, _ in refs(schema, False)]
    while todo:
        ref = todo.pop()
        if ref not in edges:
            # One step: a reference that only names another one is a step of its own.
            node = _pointed(ref, schema)
            edges[ref] = refs(node, False)
            todo += [r for r, _ in edges[ref]]

    def reached(start: str, only_same: bool) -> set[str]:
        found: set[str] = set()
        queue = [start]
        while queue:
            for r, down in edges[queue.pop()]:
                if r not in found and not (only_same and down):
                    found.add(r)
                    queue.append(r)
        return found

    for ref in edges:
        if ref in reached(ref, True):
            raise ValueError(f"reference {ref!r} leads nowhere in the schema")
    return sorted(r for r in edges if r in reached(r, False))


def _pointed(ref: str, root: dict) -> dict | bool:
    """The schema at a JSON pointer, which may be a reference itself."""
    if not ref.startswith("#"):
        raise ValueError(f"reference {ref!r} leads nowhere in the schema")
    node = root
    for part in ref[1:].split("/")[1:]:
        part = part.replace("~1", "/").replace("~0", "~")
        try:
            node = node[int(part)] if isinstance(node, list) else node[part]
        except (KeyError, IndexError, ValueError, TypeError):
            raise ValueError(f"reference {ref!r} leads nowhere in the schema") from None
    return node


def _place(unit: int, at: str, path: str) -> str:
    """What names a value under a reference, among all values of a payload: the work item it lies in, the reference, and the way from the item."""
    return f"concat(n.id, ':{unit}:', {at}, {sql_text(path)})"


def _pending(v: str, path: str, node: dict | bool, root: dict, units: tuple[str, ...], depth: int = 0, at: str = "''") -> list[str]:
    """Arrays of (unit, value, key): the recursive references that a schema applies to the value at a path and what is below it."""
    if isinstance(node, bool):
        return []
    if "$ref" in node:
        if node["$ref"] not in units:
            return _pending(v, path, _pointed(node["$ref"], root), root, units, depth, at)
        value, unit = _get(v, path, "variant"), units.index(node["$ref"])
        item = f"named_struct('unit', {unit}, 'value', {value}, 'key', {_place(unit, at, path)})"
        return [f"CASE WHEN {_is_there(v, path)} THEN array({item}) ELSE {_NO_WORK} END"]
    out = []
    for option, deeper in _below(node):
        if not deeper:
            out += _pending(v, path, option, root, units, depth + 1, at)
    for name, child in node.get("properties", {}).items():
        out += _pending(v, _step(path, name), child, root, units, depth + 1, at)
    rest = node.get("additionalProperties", True)
    e = f"a{depth}"
    each = _pending(f"{e}.value", "$", rest, root, units, depth + 1, _in_member(at, path, e))
    if each:
        out.append(f"coalesce(flatten(transform({_others(v, path, node, e)}, {e} -> concat({', '.join(each)}))), {_NO_WORK})")
    first, others = _tuple(node)
    for i, child in enumerate(first):
        out += _pending(v, f"{path}[{i}]", child, root, units, depth + 1, at)
    e = f"i{depth}"
    each = _pending(e, "$", others, root, units, depth + 1, _in_item(at, path, depth))
    if each:
        out.append(f"coalesce(flatten(transform({_later_items(v, path, len(first))}, ({e}, x{depth}) -> concat({', '.join(each)}))), {_NO_WORK})")
    return out


def _in_member(at: str, path: str, entry: str) -> str:
    return f"concat({at}, {sql_text(path)}, '{{', {entry}.key, '}}')"


def _in_item(at: str, path: str, depth: int) -> str:
    return f"concat({at}, {sql_text(path)}, '[', x{depth}, ']')"


def _others(v: str, path: str, node: dict, e: str) -> str:
    """Members of an object that its schema does not name."""
    return f"filter(map_entries({_get(v, path, _MAP)}), {e} -> NOT array_contains({_texts(node.get('properties', {}))}, {e}.key))"


def _later_items(v: str, path: str, first: int) -> str:
    items = _get(v, path, "array<variant>")
    return f"slice({items}, {first + 1}, greatest(size({items}) - {first}, 0))" if first else items


def _checks(v: str, path: str, node: dict | bool, root: dict, depth: int = 0, units: tuple[str, ...] = (), at: str = "''") -> list[str]:
    """Arrays of the errors of the value at a path, in schema order. All levels of the schema are compiled, but for references in
    `units`: their errors are looked up in `done` by the value's place; `at` is the way to `v` from the work item `n`."""
    present = _is_there(v, path) if path != "$" else "true"
    if isinstance(node, bool):
        never = _error("other", f"concat({_shown(v, path)}, ' is not allowed')")
        return [] if node else [f"array_compact(array(CASE WHEN {present} THEN {never} END))"]
    if "$ref" in node:
        if node["$ref"] in units:
            found = f"get(done.errors, cast(array_position(done.keys, {_place(units.index(node['$ref']), at, path)}) as int) - 1)"
            return [f"CASE WHEN {present} THEN coalesce({found}, {_NO_ERRORS}) ELSE {_NO_ERRORS} END"]
        return _checks(v, path, _pointed(node["$ref"], root), root, depth, units, at)
    unknown = set(node) - CHECKED - ANNOTATIONS
    if unknown:
        raise ValueError(f"JSON schema keywords that are not checked: {', '.join(sorted(unknown))}")
    # CASE inside CASE: tests only run for present values, messages only for violations.
    single = [f"CASE WHEN {present} THEN CASE WHEN {bad} THEN {_error(kind, text)} END END" for bad, kind, text in _tests(v, path, node)]
    deeper: list[str] = []

    def valid(option: dict | bool) -> str:
        return f"size({_joined(_checks(v, path, option, root, depth + 1, units, at))}) = 0"

    def whole(bad: str, message: str) -> None:
        text = f"concat({_shown(v, path)}, {sql_text(message)})"
        single.append(f"CASE WHEN {present} THEN CASE WHEN {bad} THEN {_error('other', text)} END END")

    for option in node.get("allOf", []):
        deeper += _checks(v, path, option, root, depth + 1, units, at)
    if "anyOf" in node:
        whole(f"NOT ({' OR '.join(valid(o) for o in node['anyOf'])})", " is not valid under any of the given schemas")
    if "oneOf" in node:
        held = " + ".join(f"cast({valid(o)} as int)" for o in node["oneOf"])
        whole(f"({held}) = 0", " is not valid under any of the given schemas")
        whole(f"({held}) > 1", " is valid under more than one of the given schemas")
    if "not" in node:
        whole(valid(node["not"]), " is valid under a schema that is not allowed")
    for name in node.get("required", []):
        absent = f"NOT {_is_there(v, _step(path, name))}"
        error = _error("missing", sql_text(f"'{name}' is a required property"))
        single.append(f"CASE WHEN {absent} THEN CASE WHEN {_is_object(v, path)} THEN {error} END END")
    for name, child in node.get("properties", {}).items():
        deeper += _checks(v, _step(path, name), child, root, depth + 1, units, at)
    rest = node.get("additionalProperties", True)
    if rest is not True:
        e = f"a{depth}"
        others = _others(v, path, node, e)
        if rest is False:
            each = [f"array({_error('other', _concat(sql_text('additional property '), f'{e}.key', sql_text(' is not allowed')))})"]
        else:
            each = _checks(f"{e}.value", "$", rest, root, depth + 1, units, _in_member(at, path, e))
        if each:
            found = f"flatten(transform({others}, {e} -> {_joined(each)}))"
            deeper.append(f"CASE WHEN {_is_object(v, path)} THEN coalesce({found}, {_NO_ERRORS}) ELSE {_NO_ERRORS} END")
    first, items = _tuple(node)
    for i, child in enumerate(first):
        deeper += _checks(v, f"{path}[{i}]", child, root, depth + 1, units, at)
    if first and items is False:
        more = f"size({_get(v, path, 'array<variant>')}) > {len(first)}"
        single.append(f"CASE WHEN {present} THEN CASE WHEN {more} THEN {_error('other', _concat(_shown(v, path), sql_text(' has additional items')))} END END")
    elif items is not True:
        e = f"i{depth}"
        each = _checks(e, "$", items, root, depth + 1, units, _in_item(at, path, depth))
        if each:
            found = f"flatten(transform({_later_items(v, path, len(first))}, ({e}, x{depth}) -> {_joined(each)}))"
            deeper.append(f"coalesce({found}, {_NO_ERRORS})")
    return ([f"array_compact(array({', '.join(single)}))"] if single else []) + deeper


def _concat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def _joined(arrays: list[str]) -> str:
    return f"concat({', '.join(arrays)})" if arrays else _NO_ERRORS


def _deep_errors(variant: str, schema: dict, units: tuple[str, ...]) -> str:
    """Errors under a schema that contains itself, for payloads of any depth.

    A worklist inside the row: first, level by level, every value that a recursive reference applies to, until a level has none; then
    their errors, level by level from the deepest up, each looking up those of the values below it by their place. Those are all in the
    level below, so only that one is held, and a value costs the same at any depth.
    """
    nodes = [_pointed(u, schema) for u in units]
    start = len(units)  # the whole document under the whole schema

    def by_unit(of) -> str:
        return f"CASE n.unit {' '.join(f'WHEN {i} THEN {of(node)}' for i, node in enumerate([*nodes, schema]))} END"

    def pending(node: dict | bool) -> str:
        return f"concat({', '.join([_NO_WORK, *_pending('n.value', '$', node, schema, units)])})"

    def errors(node: dict | bool) -> str:
        return _joined(_checks("n.value", "$", node, schema, 0, units))

    work = "array<struct<id:int,unit:int,value:variant,key:string>>"
    text = f"to_json({variant})"
    opened = f"length({text}) - length(translate({text}, '{{[', ''))"
    levels = f"sequence(1, ({opened} + 1) * {len(units) + 1})"
    below = f"flatten(transform(w.level, n -> {by_unit(pending)}))"
    numbered = "transform(b, (x, i) -> named_struct('id', w.items + i, 'unit', x.unit, 'value', x.value, 'key', x.key))"
    added = "named_struct('level', c, 'items', w.items + size(c), 'found', CASE WHEN size(c) = 0 THEN w.found ELSE concat(w.found, array(c)) END)"
    down = f"element_at(transform(array({below}), b -> element_at(transform(array({numbered}), c -> {added}), 1)), 1)"
    first = f"array(named_struct('id', 0, 'unit', {start}, 'value', {variant}, 'key', ''))"
    # Only the starts are cast, which names the types with NULLs allowed everywhere: a cast in a step would rebuild all that was found before.
    state = f"cast(named_struct('level', {first}, 'items', 1, 'found', array({first})) as struct<level:{work},items:int,found:array<{work}>>)"
    found = f"aggregate({levels}, {state}, (w, l) -> CASE WHEN size(w.level) = 0 THEN w ELSE {down} END, w -> w.found)"
    none = "cast(named_struct('keys', array(), 'errors', array()) as struct<keys:array<string>,errors:array<array<struct<kind:string,text:string>>>>)"
    step = f"named_struct('keys', transform(level, n -> n.key), 'errors', transform(level, n -> {by_unit(errors)}))"
    return f"aggregate(reverse({found}), {none}, (done, level) -> {step}, done -> element_at(done.errors, 1))"


def validation_errors(variant: str, schema: dict) -> Column:
    """All errors of a parsed payload as ``array<struct<kind,text>>``, in schema order."""
    unreadable = f"array({_error('other', sql_text('payload is not JSON'))})"
    units = tuple(recursive_refs(schema))
    checked = _deep_errors(variant, schema, units) if units else _joined(_checks(variant, "$", schema, schema))
    return F.expr(f"CASE WHEN {variant} IS NULL THEN {unreadable} ELSE {checked} END")


def error_text(errors: Column) -> Column:
    """Errors grouped as missing, type and other, a few of each; NULL when there are none."""

    def group(kind: str, title: str) -> Column:
        texts = F.transform(F.filter(errors, lambda e: e["kind"] == kind), lambda e: e["text"])
        joined = F.array_join(F.slice(texts, 1, ERRORS_PER_GROUP), "; ")
        return F.when(F.size(texts) > 0, F.concat(F.lit(f"{title}: "), joined))

    parts = F.array_compact(
        F.array(group("missing", "Missing required"), group("type", "Type mismatch"), group("other", "Other"))
    )
    return F.when(F.size(parts) > 0, F.substring(F.array_join(parts, " | "), 1, ERROR_TEXT_LENGTH))


def validate(
    df: DataFrame, schema: dict, payload: str = "payload", schema_iglu: str | None = None,
    schema_source: str | None = None, stamp: str | None = None, all_errors: str | None = None,
) -> DataFrame:
    """Add validation_status (pass/fail), validation_error and unknown_fields, and the stamp columns.

    `validation_error` shows a few errors of each group up to a length; `all_errors` names a column for all of them, uncut.
    A schema that contains itself costs so much time a row that rows are dealt evenly over the session's shuffled partitions first, however few
    files they come from.
    """
    if recursive_refs(schema):
        df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parsed = df.withColumn("__v", F.try_parse_json(F.col(payload)))
    out = parsed.withColumns({"__errors": validation_errors("__v", schema), "unknown_fields": unknown_fields("__v", schema)})
    out = out.withColumns(
        {
            "validation_status": F.when(F.size("__errors") == 0, "pass").otherwise("fail"),
            "validation_error": error_text(F.col("__errors")),
        }
    )
    if all_errors:
        out = out.withColumn(all_errors, F.col("__errors"))
    out = out.drop("__errors", "__v")
    extra = {"schema_iglu": schema_iglu, "schema_source": schema_source, "validation_stamp": stamp}
    return out.withColumns({n: F.lit(v) for n, v in extra.items() if v is not None})


def validation_summary(validated: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Total, passed, failed and number of different unknown fields, per group.

    Field names are counted as rows, not gathered into one set per group: drifting payloads may
    carry ids as field names.
    """
    by = by or []
    status = F.col("validation_status")
    # One row per record plus one per unknown field, so a single pass feeds both counts.
    rows = validated.select(
        *by, status, F.explode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce("unknown_fields", F.array().cast("array<string>")))).alias("__field")
    )
    record = F.col("__field").isNull()
    return rows.groupBy(*by).agg(
        F.count_if(record).alias("total"),
        F.count_if(record & (status == "pass")).alias("passed"),
        F.count_if(record & (status == "fail")).alias("failed"),
        F.count_distinct("__field").alias("unknown_field_count"),
    )
