"""Record stages: lines or messages to typed records, and the consolidated operational table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearspan.functions import text, typed
from clearspan.functions.message import decode_messages, decoded_payload, message_class
from clearspan.operators import joins, records
from clearspan.sources import sinks

C = F.col
# Containers of tagged values by message class, and tags of reconciliation messages by function code.
CONTAINERS = {
    "1240": ["de_48", "de_62", "de_123", "de_124", "de_125"], "1442": ["de_48", "de_62", "de_123", "de_124", "de_125"],
    "1644": ["de_48"], "1740": ["de_48"],
}
TAGS_BY_FUNCTION = {
    "685": [148, 165, 300, 302, 358, 370, 372, 374, 378, 380, 381, 384, 390, 391, 392, 393, 394, 395, 396, 400, 401, 402],
    "688": [148, 300, 302, 359, 368, 369, 370, 372, 374, 378, 380, 381, 384, 390, 391, 392, 393, 394, 395, 396, 400, 401, 402],
    "691": [5, 6, 25, 138, 165, 280],
}
#: The class whose function codes open and close blocks.
EDGE_CLASS = "1644"
FILE_ID_TAG = "0105"


def text_records(lines: DataFrame, families: list[str], group: list[str], order: str, size: int) -> DataFrame:
    """Logical records of line families, ``family`` among their keys: a text column per line key of any of them.

    All families are assembled in one pass over the lines.
    """
    kind, key = records.line_family(C("line"), C("file_type") == "IN")
    members = lines.withColumns({"family": kind, "line_key": key}).where(C("family").isin(families))
    keys = [k for f in families for k in (records.MESSAGE_RECORDS if f == "message" else list(records.LINE_FAMILIES[f][1]))]
    return records.assemble_records(members, [*group, "family"], order, "line_key", list(dict.fromkeys(keys)), size=size)


def typed_text_records(assembled: DataFrame, layouts: dict[str, list[dict]], catalog: list[dict], file_date: str, keep: list[str]) -> DataFrame:
    """Fields cut from the record's lines by the layout of its family and cast by the catalog."""
    cut: dict[str, Column] = {}
    for family, layout in layouts.items():
        for row, field in zip(layout, text.fixed_fields(layout), strict=True):
            own = C("family") == family
            cut[row["name"]] = cut[row["name"]].when(own, field) if row["name"] in cut else F.when(own, field)
    fields = [F.coalesce(value, F.lit("")).alias(name) for name, value in cut.items()]
    return assembled.select(*keep, file_date, *fields).select(*keep, *typed.text_record_columns(catalog, C(file_date)))


def decoded_blocks(payloads: DataFrame, ebcdic: bool, group: list[str], order: str, size: int) -> DataFrame:
    """Decoded messages of closed blocks with the business file id and date of the block's trailer.

    Blocks are found on undecoded payloads, of which only the class that opens and closes blocks is read. What lies in
    a closed block is decoded afterwards, once.
    """
    head = payloads.withColumn("mti", message_class(C("payload"), ebcdic)).where("mti IS NOT NULL")
    edge = F.when(C("mti") == EDGE_CLASS, decoded_payload(C("payload"), ebcdic)["elements"])
    marked = head.withColumn("__edge", edge).withColumn("fc", F.coalesce(C("__edge")["de_24"], F.lit("")))
    tags = text.tagged_from_containers(F.coalesce(C("__edge")["de_48"], F.lit("")))
    # Only a trailer's file id is needed.
    marked = marked.withColumn("trailer_file", F.when(C("fc") == records.TRAILER, tags[FILE_ID_TAG])).drop("__edge", "mti")
    blocks = records.with_block(marked, group, order, "fc", {"trailer_file": "file_idn"}, size)
    kept = [c for c in blocks.columns if c not in ("payload", "fc", "trailer_file")]
    return decode_messages(blocks, "payload", ebcdic, kept).withColumn("file_dt", F.substring("file_idn", 4, 6))


def message_values(messages: DataFrame, classes: list[str], subfields: dict[str, dict[str, int]], tags: dict[int, dict[str, int]], keep: list[str]) -> DataFrame:
    """Elements, address parts, sub-fields, tags and their sub-fields of messages of some classes, as text columns.

    All classes go through one pass: each reads its own containers, and reconciliation messages the tags of
    their function code.
    """
    rows = messages.where(C("mti").isin(classes))
    element = lambda n: C("elements")[n]
    names = list(dict.fromkeys(c for k in classes for c in CONTAINERS[k]))
    containers = []
    for name in names:
        readers = [k for k in classes if name in CONTAINERS[k]]
        containers.append(F.coalesce(F.when(C("mti").isin(readers), element(name)), F.lit("")))
    rows = rows.withColumn("tags", text.tagged_from_containers(*containers))
    out = [element(n).alias(n) for n in subfields]
    for n, widths in subfields.items():
        out += text.consecutive_fields(element(n), widths)
    out += text.address_parts(element("de_43"), "de_43")
    for tag, widths in tags.items():
        wanted = [f for f, t in TAGS_BY_FUNCTION.items() if tag in t]
        value = F.when((C("mti") != EDGE_CLASS) | C("function_code").isin(wanted), C("tags")[f"{tag:04d}"])
        out.append(value.alias(f"pds_{tag}"))
        out += text.consecutive_fields(value, widths)
    return rows.select(*keep, *out)


def typed_messages(values: DataFrame, names: dict[str, str], catalog: list[dict], currency: DataFrame, keep: list[str]) -> DataFrame:
    """Business names and declared types; decimals of an amount come from its currency."""
    renamed = values.withColumnsRenamed(names)
    code = F.lpad(F.trim(C("currency_numeric_code").cast("string")), 3, "0")
    pairs = currency.groupBy(code.alias("k")).agg(F.max("decimals").alias("v")).where("k IS NOT NULL").collect()
    cells = [F.lit(x).cast(t) for r in pairs for x, t in ((r["k"], "string"), (r["v"], "int"))]
    rows = renamed.withColumn("decimals_of", F.create_map(*cells))
    return rows.select(*keep, *typed.message_columns(rows, catalog))


def consolidated(base: DataFrame, calculated: DataFrame, fees: DataFrame | None, keys: list[str], path: str) -> DataFrame:
    """Operational table: base, derived and fee columns by key, partitioned by type and date."""
    stages = [("calculated", calculated)] + ([("fees", fees)] if fees is not None else [])
    sinks.write_touched_partitions(joins.consolidate(base, stages, keys), path, ["file_type", "date"])
    return base.sparkSession.read.parquet(path)
