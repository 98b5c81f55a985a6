"""Assertions on tables, and the difference of two tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventcanon.operators.validate import sql_text

# Columns and payload members that differ between equal runs.
TIMESTAMP_COLUMNS = ("canonicalized_at", "created_at", "first_seen", "last_seen")
IGNORED_COLUMNS = ("correlation_id",)
VOLATILE_PAYLOAD_KEYS = ("hosted_invoice_url", "invoice_pdf", "attachmentId")

JSON_DEPTH = 16


def assert_rows(
    df: DataFrame, exact: int | None = None, minimum: int | None = None, maximum: int | None = None
) -> DataFrame:
    """One row: the row count, and whether it is as expected."""
    n = F.col("row_count")
    tests = [F.lit(True)]
    if exact is not None:
        tests.append(n == exact)
    if minimum is not None:
        tests.append(n >= minimum)
    if maximum is not None:
        tests.append(n <= maximum)
    ok = tests[0]
    for t in tests[1:]:
        ok = ok & t
    return df.agg(F.count("*").alias("row_count")).withColumn("ok", ok)


def assert_schema(df: DataFrame, expected: Mapping[str, str]) -> dict[str, object]:
    """Compare column names and types; no job runs."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    missing = sorted(set(expected) - set(actual))
    extra = sorted(set(actual) - set(expected))
    wrong = {c: (expected[c], actual[c]) for c in expected if c in actual and expected[c] != actual[c]}
    return {"ok": not missing and not extra and not wrong, "missing": missing, "extra": extra, "mismatched": wrong}


def bad_values(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per text column of `types`: rows, missing values, and texts that do not read as the named type.

    Views turn such texts into NULL unless they are asked to be strict; this counts what that hides. One pass, one row per task shuffled.
    """
    counts = df.agg(
        F.count("*").alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"__missing_{i}") for i, c in enumerate(types)],
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"__bad_{i}") for i, (c, t) in enumerate(types.items())],
    )
    each = [
        F.struct(F.lit(c).alias("column_name"), F.col("__rows").alias("rows"), F.col(f"__missing_{i}").alias("missing"), F.col(f"__bad_{i}").alias("bad"))
        for i, c in enumerate(types)
    ]
    return counts.select(F.inline(F.array(*each)))


def assert_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many keys occur more than once, and how many rows are surplus."""
    n = F.col("__n")
    return (
        df.groupBy(*columns).agg(F.count("*").alias("__n"))
        .agg(
            F.count_if(n > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(n - 1), F.lit(0)).alias("surplus_rows"),
        )
        .withColumn("ok", F.col("duplicate_keys") == 0)
    )


def coverage(df: DataFrame, by: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Rows per group, and how many of them have a value for each named expression."""
    return df.groupBy(*by).agg(F.count("*").alias("total"), *[F.count(c).alias(n) for n, c in columns.items()])


def flat_json(v: str, drop: Sequence[str] = (), depth: int = JSON_DEPTH) -> str:
    """SQL for a variant as ``array<string>`` of ``path=value`` leaves, without members named in `drop`.

    250.0 and 250 read the same. Two documents are equal when their sorted leaves are. What nests deeper than `depth` levels is one
    leaf: its canonical text, with all its members.
    """
    e, i, p = f"e{depth}", f"i{depth}", f"p{depth}"
    members = f"map_entries(try_variant_get({v}, '$', 'map<string,variant>'))"
    if drop:
        members = f"filter({members}, {e} -> {e}.key NOT IN ({', '.join(sql_text(d) for d in drop)}))"
    items = f"transform(try_variant_get({v}, '$', 'array<variant>'), ({e}, {i}) -> struct(concat('#', {i}) AS key, {e} AS value))"
    children = f"coalesce({members}, {items})"
    leaf = f"array(concat('=', to_json({v})))"
    if depth == 0:
        return leaf
    below = f"transform({flat_json(f'{e}.value', drop, depth - 1)}, {p} -> concat('/', {e}.key, {p}))"
    nested = f"flatten(transform({children}, {e} -> {below}))"
    # An empty container is a leaf of its own.
    empty = f"array(CASE WHEN {members} IS NULL THEN '=[]' ELSE '={{}}' END)"
    return f"CASE WHEN {children} IS NULL THEN {leaf} WHEN size({children}) = 0 THEN {empty} ELSE {nested} END"


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys and plain numbers; other text stays as it is."""
    v = F.try_parse_json(text)
    return F.when(v.isNull(), text).otherwise(F.to_json(v))


def without_members(text: Column, names: Sequence[str]) -> Column:
    """Canonical JSON text without scalar members of the given names, at any depth.

    Quotes inside JSON strings are escaped, so the pattern can only match real members.
    """
    if not names:
        return text
    member = '"(?:' + "|".join(names) + r'")":(?:"(?:[^"\\]|\\.)*"|[-+.\w]+)'
    return F.regexp_replace(text, f"{member},|,{member}|{member}", "")


def normalized(
    df: DataFrame,
    keys: Sequence[str],
    json_columns: Sequence[str] = ("payload",),
    timestamps: Sequence[str] = TIMESTAMP_COLUMNS,
    ignore: Sequence[str] = IGNORED_COLUMNS,
    volatile: Sequence[str] = VOLATILE_PAYLOAD_KEYS,
) -> DataFrame:
    """All columns as comparable text: run times and ids blanked, JSON in canonical form."""
    out = []
    for c in df.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in timestamps:
            out.append(F.lit("(time)").alias(c))
        elif c in ignore:
            out.append(F.lit("(ignored)").alias(c))
        elif c in json_columns:
            out.append(without_members(canonical_json(F.col(c).cast("string")), volatile).alias(c))
        else:
            out.append(F.col(c).cast("string").alias(c))
    return df.select(*out)


def json_leaves(text: str, drop: Sequence[str]) -> Column:
    """Sorted leaves of JSON text (given as SQL), one per line; other text stays as it is."""
    v = f"try_parse_json({text})"
    leaves = f"array_join(array_sort({flat_json('d', drop)}), '\\n')"
    # The parsed document is bound to a lambda variable, so it is parsed once.
    return F.expr(f"CASE WHEN {v} IS NULL THEN {text} ELSE element_at(transform(array({v}), d -> {leaves}), 1) END")


def _changed(column: str, left: Column, right: Column) -> Column:
    return F.struct(
        F.lit("changed").alias("kind"), F.lit(column).alias("column"), left.alias("left_value"), right.alias("right_value")
    )


def table_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], normalize: bool = False, **options) -> DataFrame:
    """One row per one-sided key and per differing column: keys, kind, column, left and right value.

    Only keys that are unique on both sides are compared. A key that repeats on either side is one row of kind ``repeated`` with
    the numbers of rows on each side, so that the result stays as small as the tables.

    With `normalize` the columns are compared as `normalized` gives them. JSON whose canonical text
    differs is compared once more leaf by leaf, and shown that way.
    """
    json_columns = set(options.get("json_columns", ("payload",))) if normalize else set()
    volatile = options.get("volatile", VOLATILE_PAYLOAD_KEYS)
    if normalize:
        left, right = normalized(left, keys, **options), normalized(right, keys, **options)
    columns = [c for c in left.columns if c not in keys]
    columns += [c for c in right.columns if c not in keys and c not in columns]
    gone = F.lit("(missing)")

    def side(df: DataFrame, number: int) -> DataFrame:
        values = [(F.col(c).cast("string") if c in df.columns else gone).alias(c) for c in columns]
        return df.select(*keys, F.lit(number).alias("__side"), F.struct(*values or [F.lit(1)]).alias("__row"))

    # Both sides in one shuffle: a key's rows are counted and one of each side kept before they are dealt, so a repeated key is one row a task.
    mine, theirs = F.col("__side") == 0, F.col("__side") == 1
    met = side(left, 0).unionByName(side(right, 1)).groupBy(*keys).agg(
        F.count_if(mine).alias("__n_left"), F.count_if(theirs).alias("__n_right"),
        F.first(F.when(mine, F.col("__row")), ignorenulls=True).alias("left"), F.first(F.when(theirs, F.col("__row")), ignorenulls=True).alias("right"))

    def entry(c: str) -> Column:
        x, y = F.col("left")[c], F.col("right")[c]
        if c in json_columns:
            lx, ly = json_leaves(f"left.`{c}`", volatile), json_leaves(f"right.`{c}`", volatile)
            found = F.when(~lx.eqNullSafe(ly), _changed(c, lx, ly))
        else:
            found = _changed(c, x, y)
        return F.when(~x.eqNullSafe(y), found)

    changed = F.array_compact(F.array(*[entry(c) for c in columns]))
    null = F.lit(None).cast("string")

    def one(kind: str, x: Column = null, y: Column = null) -> Column:
        return F.array(F.struct(F.lit(kind).alias("kind"), null.alias("column"), x.alias("left_value"), y.alias("right_value")))

    n_left, n_right = F.col("__n_left"), F.col("__n_right")
    repeated = one("repeated", n_left.cast("string"), n_right.cast("string"))
    found = F.when((n_left > 1) | (n_right > 1), repeated).when(n_right == 0, one("left_only")).when(n_left == 0, one("right_only")).otherwise(changed)
    return met.select(*keys, F.explode(found).alias("d")).select(*keys, "d.*")
