"""Documents of a store without a schema, kept as VARIANT values and typed when they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .envelope import envelope_schema

#: Columns of a table of documents.
DOCUMENT_KEY, DOCUMENT_ROW = "id string", "id string, doc variant"


def document_events(events: DataFrame) -> DataFrame:
    """Envelopes whose images are JSON texts as envelopes of rows (id, doc); a text that is no JSON gives a null document.

    The key has one field. A delete often has no image at all: its row is the id. New fields and fields
    that change their type need no change of a schema, as a document is one value.
    """
    body = envelope_schema(DOCUMENT_KEY, DOCUMENT_ROW)["value"].dataType
    value, key = F.col("value"), F.col("key")[events.schema["key"].dataType.names[0]].cast("string")
    image = lambda text: F.struct(key.alias("id"), F.try_parse_json(text).alias("doc"))
    gone = F.lower(value["op"]) == "d"
    before = F.when(gone | value["before"].isNotNull(), image(value["before"]))
    after = F.when(value["after"].isNotNull(), image(value["after"]))
    rest = [value[f.name].alias(f.name) for f in body.fields if f.name not in ("before", "after")]
    row = F.when(value.isNotNull(), F.struct(before.alias("before"), after.alias("after"), *rest))
    return events.withColumns({"value": row, "key": F.when(F.col("key").isNotNull(), F.struct(key.alias("id")))})


def field_of_document(path: str, *kinds: str, doc: str = "doc") -> Column:
    """The value at a path as the first of the types that it can be read as; null if it is none of them or isn't there."""
    return F.coalesce(*[F.try_variant_get(doc, path, kind) for kind in kinds])


def typed_documents(rows: DataFrame, fields: dict[str, tuple[str, ...]], doc: str = "doc") -> DataFrame:
    """rows with a column for each field, given as (path, type, further types); other columns stay, but for the document."""
    return rows.select(*[c for c in rows.columns if c != doc], *[field_of_document(path, *kinds, doc=doc).alias(name) for name, (path, *kinds) in fields.items()])
