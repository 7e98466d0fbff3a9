"""Layered configuration resolution (L1, L2) as table operators.

Each entity has one JSON attribute document per layer (system < source server <
target server < logic < job < run). The documents become path rows
``(entity, layer, path, kind, value)`` - objects are entered, lists and scalars
are leaves - and the winning value of a path is the one of the highest layer
(``max_by`` per (entity, path)). A path that is an object in
one layer and a leaf in another is a conflict (L2).

A path is an array of keys, so a key that holds a dot stays one key. Documents are parsed once, in Arrow batches, by
Python's JSON reader, whose rule for repeated keys (the last one wins) is the reference's; numbers keep their text. All
paths of all levels come from that one pass, and resolution and conflicts are one aggregate each. The path rows are dealt
out by (entity, path) as they come: an aggregate before the shuffle would find next to no rows to merge (a path is once
in a document, an entity has a document per layer), and would sort all that a task opens. Documents are small beside
their paths, so a task opens far more than it reads.

A document that is NULL or no object has no paths. One that is no JSON (or nests deeper than the reader goes) has none
either; ``layer_conflicts`` reports it.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Layer order of the reference's attribute merge, lowest first.
LAYER_ORDER = ("system", "source_server", "target_server", "logic", "job", "run")
PARTITIONS = 200           # of path rows; up to as many (spark.shuffle.sort.bypassMergeThreshold), tasks write them without sorting or holding them


def layer_rank(name_col) -> F.Column:
    """Rank of a layer name in ``LAYER_ORDER`` (1-based)."""
    return F.array_position(F.array(*[F.lit(n) for n in LAYER_ORDER]), name_col).cast("int")


class _Number(str):
    """A number as it is written."""


def _no_number(name: str):
    raise ValueError(f"{name} is no JSON")


def _text(value) -> str | None:
    """A scalar's text, or the compact JSON text of a list or object, keys in order."""
    if isinstance(value, str):
        return value.encode("utf-8", "replace").decode()
    if value is None:
        return None
    return _json(value)


def _json(value) -> str:
    if isinstance(value, _Number):
        return str(value)
    if isinstance(value, list):
        return "[" + ",".join(map(_json, value)) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{_json(k)}:{_json(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, str):
        value = value.encode("utf-8", "replace").decode()
    return json.dumps(value, ensure_ascii=False)


def _paths(doc: str | None) -> list[dict]:
    """Rows (path, kind, value) of one document; a single ``error`` row if it is no JSON."""
    if doc is None:
        return []
    try:
        top = json.loads(doc, parse_int=_Number, parse_float=_Number, parse_constant=_no_number)
        todo, rows = [((), top)] if isinstance(top, dict) else [], []
        while todo:
            path, members = todo.pop()
            for key, value in members.items():
                own = (*path, _text(key))
                kind = "object" if isinstance(value, dict) else "list" if isinstance(value, list) else "scalar"
                rows.append({"path": list(own), "kind": kind, "value": ("{}" if not value else "") if kind == "object" else _text(value)})
                if kind == "object":
                    todo.append((own, value))
        return rows
    except (ValueError, RecursionError):
        return [{"path": [], "kind": "error", "value": None}]


def _opened(doc):
    @F.pandas_udf("array<struct<path: array<string>, kind: string, value: string>>")
    def run(docs: pd.Series) -> pd.Series:
        return docs.map(_paths, na_action=None)
    # else the optimizer's filter on empty results would open each document a second time
    return run.asNondeterministic()(doc)


def attribute_paths(attrs: DataFrame, entity: str = "entity", layer: str = "layer",
                    doc: str = "attributes") -> DataFrame:
    """All paths of the JSON documents: ``entity, layer, path, kind, value``; kind is ``object`` (value ``{}`` if it is
    empty, else ``''``), ``list``, ``scalar``, or ``error`` for a document that is no JSON."""
    rows = attrs.select(F.col(entity).alias("entity"), F.col(layer).alias("layer"), _opened(F.col(doc).cast("string")).alias("rows"))
    return rows.select("entity", "layer", F.inline("rows"))


def _by_path(paths: DataFrame) -> DataFrame:
    """Path rows dealt out for an aggregate per (entity, path). The number of partitions is fixed: where Spark chose it
    by the compressed size of rows so alike, a task would get many times that to sort."""
    return paths.repartition(PARTITIONS, "entity", "path")


def resolve_layers(attrs: DataFrame, **kw) -> DataFrame:
    """L1: per entity and leaf path, the value of the highest layer holding it.
    Later layers replace lists whole; objects merge key by key. An object that is
    empty in every layer is a leaf, ``{}``."""
    leaf, bare = F.col("kind").isin("list", "scalar"), F.col("value") == "{}"
    filled = (F.col("kind") == "object") & ~bare
    at = lambda rows: F.when(rows, F.col("layer"))
    best = _by_path(attribute_paths(attrs, **kw).where("kind <> 'error'")).groupBy("entity", "path").agg(
        F.max_by(F.struct("value"), at(leaf)).alias("v"), F.max(at(leaf)).alias("leaf"),
        F.max(at((F.col("kind") == "object") & bare)).alias("bare"), F.count_if(filled).alias("filled"))
    empty = (F.col("filled") == 0) & F.col("bare").isNotNull() & (F.col("leaf").isNull() | (F.col("bare") > F.col("leaf")))
    return (best.where(empty | F.col("leaf").isNotNull())
            .select("entity", "path", F.when(empty, "{}").otherwise(F.col("v.value")).alias("value"),
                    F.when(empty, F.col("bare")).otherwise(F.col("leaf")).alias("layer")))


def layer_conflicts(attrs: DataFrame, **kw) -> DataFrame:
    """L2: (entity, path, error) where a mapping meets a non-mapping in another layer, and, with an empty path, where a
    document is no JSON."""
    kinds = _by_path(attribute_paths(attrs, **kw)).groupBy("entity", "path").agg(
        F.count_if(F.col("kind") == "object").alias("objects"), F.count_if(F.col("kind").isin("list", "scalar")).alias("leaves"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("kind") == "error", F.col("layer")))), ", ").alias("broken"))
    error = F.when(F.col("broken") != "", F.concat(F.lit("no JSON document in layer "), F.col("broken")))
    mixed = F.concat(F.lit("layers disagree whether this key is an object: "), F.try_element_at("path", F.lit(-1)))
    return (kinds.where((F.col("broken") != "") | (F.col("objects") > 0) & (F.col("leaves") > 0))
            .select("entity", "path", F.coalesce(error, mixed).alias("error")))
