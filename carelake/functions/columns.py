"""Column expressions used by the normalizers and marts.

Every function takes and returns a ``Column`` built from Spark built-ins only,
so whole-stage code generation covers all of them; no Python runs per row.
Parsing uses the ``try_`` variants because ANSI mode is on in Spark 4.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions import codes


# --- dates and times ------------------------------------------------------


def parse_timestamp(text: Column, dates: bool = False, short: bool = False) -> Column:
    """Timestamp from ISO text with or without fraction and offset.

    ``dates`` also accepts ``yyyy-MM-dd``; ``short`` also accepts ``M/d/yy`` and
    ``M/d/yyyy``.  Text in no known form gives NULL.  Optional sections let one
    parse cover all ISO forms, since every failed attempt costs an exception.
    """
    iso = codes.ISO_OR_DATE_PATTERN if dates else codes.ISO_PATTERN
    parsed = F.try_to_timestamp(text, F.lit(iso))
    if not short:
        return parsed
    slashed = F.try_to_timestamp(text, F.lit(codes.SHORT_DATE_PATTERN))
    return F.when(text.contains("/"), slashed).otherwise(parsed)


def parse_date(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def date_prefix(text: Column) -> Column:
    """DATE from the first ten characters, NULL when they are not a date."""
    return F.left(text, F.lit(10)).try_cast("date")


def years_between(start: Column, end: Column) -> Column:
    """Calendar-year boundaries crossed, which is not the age in birthdays."""
    return F.year(end) - F.year(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def minutes_between(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.round(micros / F.lit(60_000_000)).cast("long")


def year_of(ts: Column) -> Column:
    return F.year(ts)


def audit_columns(as_of=None) -> dict[str, Column]:
    """``created_at``/``updated_at``; pass ``as_of`` for repeatable output."""
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return {"created_at": stamp, "updated_at": stamp}


# --- references -----------------------------------------------------------


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def reference_id(ref: Column, resource: str) -> Column:
    """``Patient/17`` or ``https://host/Patient/17`` -> ``17``; NULL for another type or an empty id."""
    return blank_to_null(F.regexp_extract(ref, f"(?:^|/){resource}/(.+)$", 1))


def reference_type(ref: Column) -> Column:
    """Segment before the id."""
    return blank_to_null(F.regexp_extract(ref, "([^/:]+)/[^/]*$", 1))


def reference_any_id(ref: Column) -> Column:
    """Last segment of a reference that names a type."""
    return blank_to_null(F.regexp_extract(ref, "[^/:]/([^/]+)$", 1))


def dispatch_reference(ref: Column, resources) -> tuple[dict[str, Column], Column]:
    """Ids per resource type (only the matching one is set) and the type name."""
    ids = {r: F.when(ref.startswith(f"{r}/"), reference_id(ref, r)) for r in resources}
    kind = reduce(
        lambda acc, r: acc.when(ref.startswith(f"{r}/"), F.lit(r)),
        resources[1:],
        F.when(ref.startswith(f"{resources[0]}/"), F.lit(resources[0])),
    )
    return ids, kind.otherwise(F.lit("Unknown"))


# --- codings and complex values ---------------------------------------------


def first_coding(concept: Column, field: str) -> Column:
    """Field of the first coding; NULL when there is no coding."""
    return F.get(concept.getField("coding"), F.lit(0)).getField(field)


def strip_quotes(code: Column) -> Column:
    return F.regexp_replace(code, '^"|"$', "")


def as_json(value: Column) -> Column:
    """Array or struct as JSON text (NULL fields are left out)."""
    return F.to_json(value)


def extensions_json(extensions: Column) -> Column:
    """Extensions as JSON text, nested ones of any depth included."""
    return F.to_json(F.transform(extensions, lambda e: e.withField("extension", F.try_parse_json(e["extension"]))))


def join_words(words: Column, delimiter: str = " ") -> Column:
    """Joined array; NULL for an absent or empty array."""
    return F.when(F.size(words) > 0, F.array_join(words, delimiter))


def join_lines(lines: Column, delimiter: str = ", ") -> Column:
    """Joined array; empty text for an absent array."""
    return F.concat_ws(delimiter, lines)


def default_value(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def is_present(value: Column) -> Column:
    return value.isNotNull()


def document_class(code: Column, system: Column) -> Column:
    """Document class of a LOINC type code, ``unknown`` otherwise."""
    lookup = F.create_map(*[F.lit(x) for pair in codes.DOCUMENT_CLASS.items() for x in pair])
    return F.coalesce(F.when(system == codes.LOINC, F.try_element_at(lookup, code)), F.lit("unknown"))


# Order in which a choice value is looked for (fixed values).
VALUE_KINDS = {
    "valueString": "string",
    "valueDateTime": "dateTime",
    "valueReference": "reference",
    "valueCode": "code",
    "valueBoolean": "boolean",
    "valueDecimal": "decimal",
    "valueInteger": "integer",
}


def value_kind(extension: Column) -> Column:
    """Name of the one value a choice-typed extension carries."""
    named = [F.when(extension.getField(f).isNotNull(), F.lit(k)) for f, k in VALUE_KINDS.items()]
    return F.coalesce(*named, F.lit("unknown"))


EXTENSION_FIELDS = {  # fields of a listed extension: where they lie, and their type
    "url": "string", "valueString": "string", "valueDateTime": "string", "valueReference.reference": "string", "valueCode": "string",
    "valueBoolean": "boolean", "valueDecimal": "decimal(18,6)", "valueInteger": "int",
}


def nested_extensions(text: Column, parent: Column) -> Column:
    """All extensions in the JSON list ``text``, at any depth: ``parent`` url, ``position`` below it, ``node``.

    Level by level, inside the row: as many steps as the text names "extension",
    which no depth exceeds.  Text that is not JSON has none.
    """

    def below(items: Column, parent: Column) -> Column:
        items = F.coalesce(items, F.array().cast("array<variant>"))
        return F.transform(items, lambda node, i: F.struct(parent.alias("parent"), i.alias("position"), node.alias("node")))

    def step(state: Column, _: Column) -> Column:
        following = F.flatten(F.transform(state["level"], lambda x: below(
            F.try_variant_get(x["node"], "$.extension", "array<variant>"), F.try_variant_get(x["node"], "$.url", "string"))))
        return F.struct(following.alias("level"), F.concat(state["found"], following).alias("found"))

    nodes = "array<struct<parent:string,position:int,node:variant>>"
    start = below(F.try_variant_get(F.try_parse_json(text), "$", "array<variant>"), parent).cast(nodes)
    steps = F.array_repeat(F.lit(1), F.coalesce(F.regexp_count(text, F.lit('"extension"')), F.lit(0)))
    return F.aggregate(steps, F.struct(start.alias("level"), start.alias("found")), step, lambda state: state["found"])


def all_extensions(extensions: Column) -> Column:
    """Extensions and all that lie below them: their values, ``parent`` url (NULL at the top), ``position``, ``nested``."""

    def listed(get, parent: Column, position: Column, nested: Column) -> Column:
        fields = [get(path, dtype).cast(dtype).alias(path.split(".")[0]) for path, dtype in EXTENSION_FIELDS.items()]
        return F.struct(*fields, parent.alias("parent"), position.alias("position"), nested.alias("nested"))

    def typed(e: Column):
        return lambda path, _: reduce(lambda c, f: c[f], path.split("."), e)

    top = F.transform(extensions, lambda e, i: listed(typed(e), F.lit(None).cast("string"), i, e["extension"].isNotNull()))
    below = F.flatten(F.transform(F.filter(extensions, lambda e: e["extension"].isNotNull()), lambda e: F.transform(
        nested_extensions(e["extension"], e["url"]), lambda x: listed(
            lambda path, dtype: F.try_variant_get(x["node"], f"$.{path}", dtype), x["parent"], x["position"],
            F.try_variant_get(x["node"], "$.extension", "array<variant>").isNotNull()))))
    return F.concat(top, below)


def numeric_value(*candidates: Column, precision: str = "decimal(15,4)") -> Column:
    """First candidate that reads as a number."""
    return F.coalesce(*[c.try_cast(precision) for c in candidates])


def attachment_location(url: Column, data: Column, position: Column) -> Column:
    """The url, or a placeholder that points at inline data."""
    inline = F.concat(F.lit("ref:content["), position.cast("string"), F.lit("].attachment.data"))
    return F.coalesce(url, F.when(data.isNotNull(), inline))


def first_text(text: Column, number: Column) -> Column:
    return F.coalesce(text, number.cast("string"))


# --- text -----------------------------------------------------------------


def strip_control(text: Column) -> Column:
    """Drop line breaks, tabs and double quotes."""
    return F.regexp_replace(text, '[\\r\\n\\t"]', "")


def strip_escapes(text: Column) -> Column:
    """Drop backslashes and double quotes."""
    return F.regexp_replace(text, '[\\\\"]', "")


def escape_backslashes(text: Column) -> Column:
    """As :func:`strip_control`, and double every backslash."""
    return F.replace(strip_control(text), F.lit("\\"), F.lit("\\\\"))


def plain_name(text: Column) -> Column:
    """Letters, digits, space, dot and hyphen only."""
    return F.regexp_replace(text, "[^a-zA-Z0-9 .-]", "")


def matches_any(text: Column, patterns) -> Column:
    """Case-insensitive LIKE against any of the patterns."""
    return reduce(or_, [text.ilike(p) for p in patterns])


def starts_with_any(text: Column, prefixes) -> Column:
    return reduce(or_, [text.startswith(p) for p in prefixes])


def url_kind(url: Column) -> Column:
    return (
        F.when(url.ilike("ref:%"), F.lit("Reference"))
        .when(url.ilike("s3:%"), F.lit("S3"))
        .when(url.ilike("http%"), F.lit("HTTP"))
        .otherwise(F.lit("Other"))
    )


# --- statuses -------------------------------------------------------------


def activity_status(deceased: Column, last_seen: Column, as_of: Column) -> Column:
    gap = days_between(last_seen, as_of)
    return (
        F.when(deceased, F.lit("deceased"))
        .when(last_seen.isNull(), F.lit("no_encounters"))
        .when(gap <= 90, F.lit("active"))
        .when(gap <= 365, F.lit("inactive_recent"))
        .otherwise(F.lit("inactive_historical"))
    )


def system_priority(system: Column, order) -> Column:
    """Rank of a code system; ``order`` holds exact names or ``%like%`` patterns."""
    ranked = [
        F.when(system.like(s) if "%" in s else system == s, F.lit(i))
        for i, s in enumerate(order, start=1)
    ]
    return F.coalesce(*ranked, F.lit(len(order) + 1))


# --- text dumps and inferred evidence -----------------------------------------


def parse_concept_dump(text: Column) -> Column:
    """CodeableConcept from a ``{coding=[{system=.., code=..}], text=..}`` dump.

    Codings without system or code are dropped; a dump with no usable coding
    gives NULL.
    """

    def field(part: Column, name: str) -> Column:
        found = F.trim(F.regexp_extract(part, f"(?:^|[{{,\\s]){name}=([^,}}]*)", 1))
        return F.when(~found.isin("", "null"), found)

    parts = F.regexp_extract_all(text, F.lit(r"\{([^{}]*system=[^{}]*code=[^{}]*)\}"), F.lit(1))
    codings = F.filter(
        F.transform(
            parts,
            lambda p: F.struct(
                field(p, "system").alias("system"),
                field(p, "code").alias("code"),
                field(p, "display").alias("display"),
            ),
        ),
        lambda c: c["system"].isNotNull() & c["code"].isNotNull(),
    )
    outside = F.regexp_replace(text, r"\[.*\]", "[]")
    return F.when(
        F.size(codings) > 0,
        F.struct(codings.alias("coding"), field(outside, "text").alias("text")),
    )


EVIDENCE_VALUES = (
    "valueString", "valueQuantity", "valueInteger", "valueBoolean", "valueDateTime", "valueCodeableConcept",
)


def inferred_evidence(meta: Column, derived_from: Column, url_marker: str) -> Column:
    """JSON list of evidence extensions of a machine-inferred observation.

    Only rows whose ``meta.security`` holds the AI tag give a value; kept are the
    extensions whose url contains ``url_marker``, with all that lies below them.
    """
    is_inferred = F.exists(meta["security"], lambda s: s["code"] == codes.AI_SECURITY_CODE)

    def values(ext: Column) -> list[Column]:
        return [ext[v].alias(v) for v in EVIDENCE_VALUES]

    def one(source: Column, ext: Column) -> Column:
        return F.struct(
            ext["url"].alias("url"),
            source["reference"].alias("reference"),
            source["display"].alias("display"),
            *values(ext),
            F.try_parse_json(ext["extension"]).alias("value"),
        )

    found = F.flatten(
        F.transform(
            F.filter(derived_from, lambda d: F.size(d["extension"]) > 0),
            lambda d: F.transform(
                F.filter(d["extension"], lambda e: F.lower(e["url"]).contains(url_marker.lower())),
                lambda e: one(d, e),
            ),
        )
    )
    return F.when(is_inferred & (F.size(found) > 0), F.to_json(found))
