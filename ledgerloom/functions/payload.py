"""JSON and XML payloads kept in text columns."""
from pyspark.sql import Column, DataFrame, functions as F, types as T


def repair_json(c: Column) -> Column:
    """Undo double encoding: line breaks go, quoted objects become objects."""
    flat = F.translate(c, "\n\r", "")
    return F.replace(F.replace(flat, F.lit('"{'), F.lit("{")), F.lit('}"'), F.lit("}"))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds costly columns behind a generator, so later filters and projections
    use the result instead of repeating the expression."""
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(packed))


def parse_payload(df: DataFrame, column: str, schema, into: str = "payload") -> tuple:
    """(rows whose payload parses, rows whose payload does not)."""
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    with_bad = T.StructType(fields.fields + [T.StructField("_bad", T.StringType())])
    parsed = computed_once(df, **{into: F.from_json(
        repair_json(F.col(column)), with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})})
    unreadable = F.col(into).isNull() | F.col(f"{into}._bad").isNotNull()
    good = parsed.filter(~unreadable).withColumn(into, F.col(into).dropFields("_bad"))
    return good, parsed.filter(unreadable).drop(into)


def first_json_path(c: Column, *paths: str) -> Column:
    return F.coalesce(*[F.get_json_object(c, p) for p in paths])


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs of any depth become top-level columns named by their path."""
    def leaves(schema, path):
        for f in schema.fields:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, path + [f.name])
            else:
                yield path + [f.name]

    quoted = [(".".join(f"`{p}`" for p in path), sep.join(path)) for path in leaves(df.schema, [])]
    return df.select([F.col(src).alias(dst) for src, dst in quoted])


def flatten_nested(df: DataFrame, path: list | None = None, sep: str = "_") -> DataFrame:
    """Structs to columns, arrays to rows.

    ``path`` lists the flattened names of the arrays to open, outermost first.
    Without it every array is opened, level by level. Two sibling arrays at one
    level would pair all their items, so that is refused: name one of them in
    ``path``; the other stays an array column.
    """
    todo = None if path is None else list(path)
    df = flatten_structs(df, sep)
    while True:
        arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
        if todo is None:
            if len(arrays) > 1:
                raise ValueError(f"sibling arrays {arrays}: name the one to open in path")
            following = arrays[0] if arrays else None
        else:
            following = todo.pop(0) if todo else None
        if following is None:
            return df
        df = flatten_structs(df.withColumn(following, F.explode_outer(following)), sep)


def variant_rows(df: DataFrame, keys: list, doc: str, depth: int = 8, sep: str = "_") -> DataFrame:
    """Documents of unknown shape as rows of tables: ``keys, table_name, row_path, fields``.

    Objects become columns (names joined by ``sep``); the items of each array
    become rows of a table of their own, named by the path to the array, so
    sibling arrays are never paired. ``row_path`` holds the positions of the
    items (``/0/2``); what stands before the last position is the parent's. The
    document itself is the table ''. ``fields`` maps column names to values as
    text (null for a JSON null); an item that is a plain value has the column
    ``value``.

    Every level opens all objects and arrays of the level before and passes
    plain values on, so it is one pass without a shuffle up to the rows, which
    meet by document and path. Levels below ``depth`` stay JSON text, so nothing
    is lost. Documents that are no JSON, and objects, items and documents
    without a plain value, give no row.
    """
    explode = df.sparkSession.tvf.variant_explode_outer
    work = df.select(*keys, F.lit("").alias("_table"), F.lit("").alias("_path"), F.lit("").alias("_name"), F.try_parse_json(F.col(doc).cast("string")).alias("_v"))
    for _ in range(depth):
        opened = work.lateralJoin(explode(F.col("_v").outer()))
        item, member = F.col("pos").isNotNull() & F.col("key").isNull(), F.col("key").isNotNull()
        inner = F.concat_ws(".", F.nullif(F.col("_table"), F.lit("")), F.when(F.col("_name") != "", F.col("_name")).when(F.col("_path") != "", "items"))
        work = opened.select(
            *keys, F.when(item, inner).otherwise(F.col("_table")).alias("_table"),
            F.when(item, F.concat("_path", F.lit("/"), F.col("pos").cast("string"))).otherwise(F.col("_path")).alias("_path"),
            F.when(item, "").when(member, F.concat_ws(sep, F.nullif(F.col("_name"), F.lit("")), "key")).otherwise(F.col("_name")).alias("_name"),
            F.when(item | member, F.col("value")).otherwise(F.col("_v")).alias("_v"))
    text = F.to_json("_v")
    nested = text.startswith("{") | text.startswith("[")
    value = F.when(nested, text).otherwise(F.try_variant_get("_v", "$", "string"))
    leaves = work.filter(F.col("_v").isNotNull() & ~text.isin("{}", "[]")).select(
        *keys, F.col("_table").alias("table_name"), F.col("_path").alias("row_path"),
        F.struct(F.when(F.col("_name") == "", "value").otherwise(F.col("_name")).alias("name"), value.alias("value")).alias("_field"))
    rows = leaves.groupBy(*keys, "table_name", "row_path").agg(F.array_sort(F.collect_list("_field")).alias("_fields"))
    one = F.filter("_fields", lambda x, i: (i == 0) | (F.get("_fields", i - 1)["name"] != x["name"]))
    return rows.select(*keys, "table_name", "row_path", F.map_from_entries(one).alias("fields"))


def variant_table(rows: DataFrame, name: str, columns: dict) -> DataFrame:
    """One table of ``variant_rows`` with typed columns: name → type. Values that do not fit are null."""
    rest = [c for c in rows.columns if c not in ("table_name", "row_path", "fields")]
    return rows.filter(F.col("table_name") == name).select(
        *rest, "row_path", F.regexp_replace("row_path", "/[0-9]+$", "").alias("parent_path"),
        *[F.col("fields")[c].try_cast(kind).alias(c) for c, kind in columns.items()])


def snake_case(name: str) -> str:
    """camelCase → snake_case, with a repeated word kept only once."""
    out = []
    for i, ch in enumerate(name):
        if ch.isupper() and i and (name[i - 1].islower() or name[i - 1].isdigit()):
            out.append("_")
        out.append(ch.lower())
    return unique_words("".join(out))


def unique_words(name: str) -> str:
    return "_".join(dict.fromkeys(name.split("_")))


def flatten_report(df: DataFrame, column: str, lists: dict, keep: tuple = ()) -> DataFrame:
    """Parsed report struct → one wide row, a view beside ``report_lists``.

    Struct fields become columns named by their words; ``lists`` gives for each
    list field how many numbered column groups to show, as in ``phone_list1_…``,
    and a count tells how many nodes there are. Every list has to be declared;
    all nodes, however many, are rows of ``report_lists``. A single node
    arrives as a one-element list, a missing one as null.
    """
    undeclared = [f.name for f in df.schema[column].dataType.fields if isinstance(f.dataType, T.ArrayType) and f.name not in lists]
    if undeclared:
        raise ValueError(f"lists {undeclared} are not declared")
    out = [F.col(k) for k in keep]
    seen = set(keep)

    def add(col, name):
        if name not in seen:
            seen.add(name)
            out.append(col.alias(name))

    def walk(schema, col, words):
        for f in schema.fields:
            here, name = col.getField(f.name), words + [snake_case(f.name)]
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, here, name)
            elif not isinstance(f.dataType, T.ArrayType):
                add(here, unique_words("_".join(name)))

    schema = df.schema[column].dataType
    for f in schema.fields:
        col = F.col(column).getField(f.name)
        if isinstance(f.dataType, T.StructType):
            walk(f.dataType, col, [])
        elif isinstance(f.dataType, T.ArrayType):
            add(F.coalesce(F.size(col), F.lit(0)), f"{snake_case(f.name)}_count")
            for i in range(1, lists[f.name] + 1):
                item = F.get(col, F.lit(i - 1))
                for g in f.dataType.elementType.fields:
                    add(item.getField(g.name), f"{snake_case(f.name)}{i}_{snake_case(g.name)}")
        else:
            add(col, snake_case(f.name))
    return df.select(out)


def report_lists(df: DataFrame, column: str, keep: tuple = ()) -> DataFrame:
    """Every node of every list of a parsed report: the kept columns, the list's
    name, the node's position from 1, and its fields by name as text."""
    def nodes(f: T.StructField) -> Column:
        fields = f.dataType.elementType.fields
        names = F.array(*[F.lit(snake_case(g.name)) for g in fields])
        return F.transform(F.coalesce(F.col(column).getField(f.name), F.array().cast(f.dataType)), lambda node, i: F.struct(
            F.lit(snake_case(f.name)).alias("list_name"), (i + 1).alias("position"),
            F.map_from_arrays(names, F.array(*[node.getField(g.name).cast("string") for g in fields])).alias("fields")))

    groups = [nodes(f) for f in df.schema[column].dataType.fields if isinstance(f.dataType, T.ArrayType)]
    if not groups:
        raise ValueError(f"{column} has no list")
    return df.select(*keep, F.inline(F.concat(*groups)))


def section(df: DataFrame, marker: str) -> DataFrame:
    """Columns whose dotted name holds the marker, under the last part of it."""
    hits = [c for c in df.columns if marker in c]
    return df.select([F.col(f"`{c}`").alias(c.split(".")[-1].lower()) for c in hits])
