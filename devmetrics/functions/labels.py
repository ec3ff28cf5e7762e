"""Label text -> tag map, and the tag precedence rules of a point.

All of it is built-in SQL expressions (higher-order array/map functions plus code-generated string functions), so it
runs in the JVM with no Python on the executors. The higher-order functions are evaluated without code generation,
so the entries are built once per row and reused (see ``build_points``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a label is trimmed (Unicode White_Space, as the
# reference's trim uses). Spark's one-argument `trim` removes only U+0020; the two-argument form takes a set.
WHITE_SPACE_CHARS = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The message columns that become tags, and the tag name each one writes.
TAG_COLUMNS = ("gpu_id", "device", "uuid", "namespace")
MODEL_TAG = "modelName"


def unicode_trim(c: Column) -> Column:
    """Remove leading and trailing Unicode white space (set-based trim, code-generated)."""
    return F.trim(c, F.lit(WHITE_SPACE_CHARS))


def label_entries(labels_raw: Column) -> Column:
    """ARRAY<STRUCT<k,v>> in text order, before duplicate keys are resolved (empty pieces and empty keys dropped).

    Splits on the single characters ',' and then '=' (limit 2: the first '=' only); single-character splits take
    the fast path (a regex split would compile its pattern for every row). Key and value are trimmed with the
    set-based ``trim``; a piece without '=' is a key with an empty value, and a piece that trims to nothing has an
    empty key and is dropped."""
    pieces = F.split(F.coalesce(labels_raw, F.lit("")), ",", -1)
    halves = F.transform(pieces, lambda p: F.split(p, "=", 2))
    entries = F.transform(halves, lambda kv: F.struct(
        unicode_trim(kv.getItem(0)).alias("k"),
        F.coalesce(unicode_trim(F.get(kv, 1)), F.lit("")).alias("v"),
    ))
    return F.filter(entries, lambda e: e["k"] != "")


def parse_labels(labels_raw: Column) -> Column:
    """``a=1, b = 2,flag`` -> MAP {a:1, b:2, flag:''}. A repeated key keeps its last value.

    ``str_to_map`` is not used: it keeps empty pieces, does not trim and raises on repeated keys.
    In a DataFrame, prefer ``label_entries`` in one projection and ``labels_from_entries`` in the next, so the
    entries are built once per row (``build_points`` does so).
    """
    return labels_from_entries(label_entries(labels_raw))


def labels_from_entries(entries: Column) -> Column:
    """Entries (text order) -> map with the last value of each key.

    Repeated keys are rare, so rows whose keys are already distinct take ``map_from_entries`` directly. In the others
    the entries are sorted by key and place, and the last one of each key is kept (n log n in the number of labels)."""
    placed = F.sort_array(F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), i.alias("i"), e["v"].alias("v"))))
    last_of_key = lambda s: F.filter(s, lambda e, i: ~F.coalesce(F.get(s, i + 1)["k"] == e["k"], F.lit(False)))
    # the sorted array is bound by `transform`: named inside the filter, it would be sorted anew for each entry
    last = F.get(F.transform(F.array(placed), lambda s: F.transform(last_of_key(s), lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v")))), 0)
    keys = F.transform(entries, lambda e: e["k"])
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.map_from_entries(entries)).otherwise(F.map_from_entries(last))


def join_model_name(model_name: Column) -> Column:
    """List joined with ',' (inner empty strings kept); null when the list is empty or null."""
    return F.when(F.size(model_name) > 0, F.array_join(model_name, ",", ""))


def effective_tag(entries: Column, name: str, column: Column) -> Column:
    """The value tag ``name`` ends up with (B8) straight from label entries, without building the map: the
    non-empty column wins, else the last label of that name, else null."""
    from_label = F.try_element_at(F.filter(entries, lambda e: e["k"] == name), F.lit(-1))["v"]
    return F.when(F.coalesce(column, F.lit("")) != "", column).otherwise(from_label)


def effective_model_tag(entries: Column, model_name: Column) -> Column:
    """``modelName`` from entries: the joined list when it has an element, else the last label of that name."""
    from_label = F.try_element_at(F.filter(entries, lambda e: e["k"] == MODEL_TAG), F.lit(-1))["v"]
    return F.when(F.coalesce(F.size(model_name) > 0, F.lit(False)), join_model_name(model_name)).otherwise(from_label)


def build_tags(
    labels: Column,
    gpu_id: Column,
    device: Column,
    uuid: Column,
    namespace: Column,
    model_name: Column,
) -> Column:
    """Labels first, then the message columns override them when non-empty.

    ``modelName`` overrides whenever the model list has at least one element (even if the joined text is empty).
    An empty column leaves a label of the same name standing. Built as one ``map`` of candidate overrides (null
    where a column does not override) filtered once, plus the labels whose key has no override: two higher-order
    functions per row.
    """
    def nonempty(c: Column) -> Column:
        return F.when(F.coalesce(c, F.lit("")) != "", c)

    candidates = F.create_map(
        F.lit("gpu_id"), nonempty(gpu_id),
        F.lit("device"), nonempty(device),
        F.lit("uuid"), nonempty(uuid),
        F.lit("namespace"), nonempty(namespace),
        F.lit(MODEL_TAG), F.when(F.coalesce(F.size(model_name) > 0, F.lit(False)), F.array_join(model_name, ",", "")),
    )
    overrides = F.map_filter(candidates, lambda k, v: v.isNotNull())
    kept = F.map_filter(labels, lambda k, v: F.element_at(candidates, k).isNull())
    return F.map_concat(kept, overrides)


def series_key(tags: Column) -> Column:
    """Canonical tag set of a series as one string: entries sorted by key, each written as
    ``<len(k)>:<k><len(v)>:<v>`` (``-`` for a null value). Length prefixes make it injective -- unlike plain
    ``k=v,`` text, no value containing ``,`` or ``=`` can collide -- and a string key hashes and sorts much faster
    than an array of structs."""

    def enc(s: Column) -> Column:
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.length(s).cast("string"), F.lit(":"), s))

    return F.array_join(F.transform(F.sort_array(F.map_entries(tags)), lambda e: F.concat(enc(e["key"]), enc(e["value"]))), "")


def tag_value(tags: Column, key: str) -> Column:
    """One tag's value, null when absent."""
    return tags.getItem(key)
