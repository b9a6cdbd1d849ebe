"""Payloads whose fields change: what was seen, in which loads, and what it broke.

Flights are read as VARIANT, so that any JSON value has a type of its own. The
types of each load are merged by an aggregate; compared with the declared fields
they give a report, and from load to load the versions of the schema. Rows are
typed field by field: a field of another type becomes NULL in its column and is
named in ``drifted``, with the whole flight kept beside it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts import schemas
from flightmarts.sources.landing import ARRIVALS, DEPARTURES, snake_case

_FLIGHTS = {ARRIVALS: schemas.ARRIVAL_FLIGHT, DEPARTURES: schemas.DEPARTURE_FLIGHT}
_RAW = {ARRIVALS: schemas.ARRIVALS_RAW, DEPARTURES: schemas.DEPARTURES_RAW}
_META = ("_dlt_load_id", "_dlt_id")
# Columns of a step on the way, apart from any that a table may carry.
_FOUND, _TYPED = "_found_", "_typed_"
# Names and types of an inferred schema, as Spark writes it.
_TOKEN = re.compile(r"`(?:[^`]|``)*`|[A-Za-z_][\w]*(?:\(\d+,\s*\d+\))?|[<>:,]")


def declared_fields(direction: str) -> dict[str, str]:
    """Path of each declared leaf, ``airlineOperator.iata``, and its type."""

    def leaves(struct: T.StructType, before: str) -> Iterator[tuple[str, str]]:
        for field in struct.fields:
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, f"{before}{field.name}.")
            else:
                yield before + field.name, field.dataType.simpleString().upper()

    return dict(leaves(_FLIGHTS[direction], ""))


def observed_fields(schema: str) -> dict[str, str]:
    """Path and type of each leaf of an inferred ``OBJECT<a: STRING, b: OBJECT<...>>``."""
    tokens = _TOKEN.findall(schema)
    found: dict[str, str] = {}

    def read(at: int, path: str) -> int:
        kind = tokens[at]
        if kind == "OBJECT" and at + 1 < len(tokens) and tokens[at + 1] == "<":
            at += 2
            while tokens[at] != ">":
                name = tokens[at].strip("`").replace("``", "`")
                at = read(at + 2, f"{path}.{name}" if path else name)
                at += tokens[at] == ","
            return at + 1
        end = at + 1
        if end < len(tokens) and tokens[end] == "<":
            depth = 0
            while True:
                depth += {"<": 1, ">": -1}.get(tokens[end], 0)
                end += 1
                if not depth:
                    break
        found[path] = kind
        return end

    if tokens:
        read(0, "")
    return {path: kind for path, kind in found.items() if path}


def load_schemas(flights: DataFrame) -> DataFrame:
    """``load_id, flights, fields`` of flights given as ``flight`` text: one row per load.

    Types are merged within map tasks first, so that what is shuffled is a
    schema per task and load. Text that is no JSON counts under ``damaged``.
    """
    parsed = flights.select("load_id", F.try_parse_json("flight").alias("v"))
    return parsed.groupBy("load_id").agg(
        F.count("*").alias("flights"),
        F.count_if(F.col("v").isNull()).alias("damaged"),
        F.schema_of_variant_agg("v").alias("fields"),
    )


def drift_report(flights: DataFrame, direction: str) -> DataFrame:
    """``load_id, path, observed_type, declared_type, status`` of all that differs.

    Status is ``added`` (not declared), ``retyped`` (another type than text or
    null) or ``missing`` (in no flight of the load). What comes to the driver
    is a schema per load.
    """
    declared = declared_fields(direction)
    rows = []
    for load in load_schemas(flights).orderBy("load_id").collect():
        observed = observed_fields(load["fields"] or "")
        for path in sorted(set(observed) | set(declared)):
            seen, wanted = observed.get(path), declared.get(path)
            inner = any(p.startswith(f"{path}.") for p in declared)
            above = [p for p in observed if path.startswith(f"{p}.")]
            if wanted is None and seen == "VOID":
                continue
            if wanted is None:
                status = "retyped" if inner else "added"
            elif any(p.startswith(f"{path}.") for p in observed):
                seen, status = "OBJECT", "retyped"
            elif seen is None:
                # Below a field that is no object any more there is nothing to be missing.
                if any(observed[p] != "VOID" for p in above):
                    continue
                status = "missing"
            elif seen in (wanted, "VOID"):
                continue
            else:
                status = "retyped"
            rows.append((load["load_id"], path, seen, wanted, status))
    return flights.sparkSession.createDataFrame(
        rows, "load_id string, path string, observed_type string, declared_type string, status string"
    )


def schema_versions(flights: DataFrame) -> DataFrame:
    """``version, first_load, last_load, loads, fields``: runs of loads with one schema.

    Loads in order of their ids; a version ends where the next load's fields
    differ. The window runs over a row per load.
    """
    loads = load_schemas(flights).withColumn("fields", F.coalesce("fields", F.lit("")))
    in_order = Window.orderBy("load_id")
    differs = ~F.col("fields").eqNullSafe(F.lag("fields").over(in_order))
    numbered = loads.withColumn("new", differs.cast("int")).withColumn(
        "version", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy("version", "fields").agg(
        F.min("load_id").alias("first_load"), F.max("load_id").alias("last_load"),
        F.count("*").alias("loads"), F.sum("flights").alias("flights"),
    ).select("version", "first_load", "last_load", "loads", "flights", "fields")


def _is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def typed_flights(flights: DataFrame, direction: str) -> DataFrame:
    """Raw columns, ``payload``, further columns, and ``drifted``: paths that lost their value.

    ``flights`` has ``flight`` (JSON text) and ``load_id``. Scalars of another
    type are taken as text where the column is text; text that is no time, an
    object in place of a value or a value in place of an object becomes NULL.
    Text that is no JSON gives a row of NULLs that names ``$``. Nothing stops a
    load. A row id is the hash of load and text.
    """
    carried = [c for c in flights.columns if c not in ("flight", "load_id")]
    labels = {"__".join(snake_case(p) for p in path.split(".")): path for path in declared_fields(direction)}

    def shaped(leaf: str) -> Column:
        """The declared fields with ``leaf`` as type of each, NULL where that does not fit."""

        def of(struct: T.StructType) -> str:
            inner = ", ".join(
                f"{f.name}: {of(f.dataType) if isinstance(f.dataType, T.StructType) else leaf}"
                for f in struct.fields
            )
            return f"struct<{inner}>"

        return F.try_variant_get("v", "$", of(_FLIGHTS[direction]))

    def kind(name: str) -> Column:
        return F.schema_of_variant(F.try_variant_get("v", f'$["{name}"]', "variant"))

    # All fields are taken out together, once as text (of an object or list: as JSON) and
    # once each as an object and as a list; in projections of their own, and not as fields
    # of one struct, or Spark would put them in again for every column that needs them.
    found = flights.withColumn("v", F.try_parse_json("flight")).select(
        "flight", "load_id", *carried, "v",
        shaped("string").alias(f"{_FOUND}text"),
        shaped("map<string, variant>").alias(f"{_FOUND}object"),
        shaped("array<variant>").alias(f"{_FOUND}list"),
    )

    def part(form: str, path: str) -> Column:
        return F.col(f"{_FOUND}{form}.{path}")

    fields = {}
    for field in _RAW[direction].fields:
        if field.name in _META:
            continue
        path = labels[field.name]
        text = F.when(part("object", path).isNull() & part("list", path).isNull(), part("text", path))
        fields[field.name] = text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)
    # An object that has become a value takes all its fields along.
    valued = [
        F.when(part("text", name).isNull() & ~kind(name).rlike("^(OBJECT|VOID)"), F.lit(name))
        for name in sorted({p.split(".")[0] for p in labels.values() if "." in p})
    ]
    damaged = F.when(F.col("v").isNull(), F.lit("$"))
    # ``array_compact`` keeps a projection out of whole-stage code, where all these
    # columns would make one method too long for the JVM to compile.
    typed = found.select(
        "*", *[c.alias(_TYPED + n) for n, c in fields.items()],
        F.array_compact(F.array(*valued, damaged)).alias(_TYPED),
    )
    typed_of = {n: F.col(_TYPED + n) for n in fields}
    lost = [
        F.when(part("text", labels[n]).isNotNull() & c.isNull(), F.lit(labels[n])) for n, c in typed_of.items()
    ]
    meta = {
        "_dlt_load_id": F.col("load_id"),
        "_dlt_id": F.md5(F.concat_ws("|", "load_id", "flight")),
    }
    return typed.select(
        *[c.alias(n) for n, c in (typed_of | meta).items()],
        F.col("flight").alias("payload"), *carried,
        F.array_join(F.concat(F.array_compact(F.array(*lost)), _TYPED), ",").alias("drifted"),
    )
