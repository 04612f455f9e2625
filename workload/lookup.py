"""Records made from documents: a document is a record, each of its lines a field.

Field arrays are built inside a row, so no group of rows is ever collected to make a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bindery.functions.fields import fields_with_tag, make_datafield, subfield, subfield_values, trimmed_id, valid_child_id
from bindery.functions.packed_xml import pack_fields
from bindery.operators import lookup as O
from bindery.operators.changes import harvest
from bindery.operators.snapshots import publish_snapshot, read_snapshot
from bindery.schemas import DATAFIELDS
from bindery.session import shared_path
from bindery.sinks.files import write_chunked, write_cleaned, write_lookup, write_marcxml, write_routed
from bindery.sources.archive_stream import _system, stream_archives
from bindery.sources.archives import expand_archives, parse_records
from bindery.sources.drops import list_files, read_csv_drop, read_json_drop, read_lookup
from bindery.sources.xml import read_marcxml, read_oai_marcxml, read_xoai
from workload.registry import query, table


def numbered_id(number) -> Column:
    """A record id in the child-id form."""
    return F.concat(F.lit("99"), number.cast("string"), F.lit("3811"))


def document_records(spark, sf_dir, ident: Column | None = None) -> DataFrame:
    """Lines become item, holding, child-link or note fields by their first letter."""

    def as_field(line):
        first, width = F.substring(line, 1, 1), F.length(line).cast("string")
        child = (
            F.when(first == "T", F.concat(F.lit(" 99"), width, F.lit("3811 ")))
            .when(first == "D", F.concat(F.lit("(OCoLC)"), width))
            .otherwise(F.concat(F.lit("99"), width, F.lit("3811")))
        )
        tag = (
            F.when(first.isin("A", "I"), "ITM").when(first.isin("E", "O"), "HLD")
            .when(first.isin("T", "D", "L"), "774").otherwise("500")
        )
        title = subfield("t", line)
        parts = F.when(tag == "774", F.array(title, subfield("w", child))).otherwise(F.array(title))
        return make_datafield(tag, parts)

    data = F.transform(F.split("text", "\n"), as_field).cast(DATAFIELDS)
    ident = numbered_id(F.col("doc_id")) if ident is None else ident
    control = F.array(F.struct(F.lit("001").alias("tag"), ident.alias("value")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("src_key"), F.col("doc_id").alias("rec_pos"), ident.alias("record_id"),
        F.lit("00000nam").alias("leader"), control.alias("controlfield"), data.alias("datafield"),
    )


def child_records(spark, sf_dir) -> DataFrame:
    """The same records under ids that children have: the length of their first line."""
    return document_records(spark, sf_dir, numbered_id(F.length(F.substring_index("text", "\n", 1))))


LINES = """
lines AS (
  SELECT doc_id, source, unnest(range(len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents)),
tagged AS (
  SELECT *, CASE WHEN left(line, 1) IN ('A', 'I') THEN 'ITM' WHEN left(line, 1) IN ('E', 'O') THEN 'HLD'
                 WHEN left(line, 1) IN ('T', 'D', 'L') THEN '774' ELSE '500' END AS tag,
         replace(replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped
  FROM lines),
parents AS (
  SELECT doc_id, source, '99' || doc_id || '3811' AS parent_id,
         arg_max(line, pos) FILTER (tag = 'ITM') AS item, arg_max(escaped, pos) FILTER (tag = 'ITM') AS item_x,
         list(line ORDER BY pos) FILTER (tag = 'HLD') AS holdings, list(escaped ORDER BY pos) FILTER (tag = 'HLD') AS holdings_x
  FROM tagged GROUP BY doc_id, source),
children AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS child_pos, left(line, 1) <> 'D' AS valid,
         CAST('99' || length(line) || '3811' AS BIGINT) AS child_id
  FROM tagged WHERE tag = '774'),
lookup AS (
  SELECT c.doc_id, c.source, c.child_pos, c.child_id, CAST(p.parent_id AS BIGINT) AS parent_id, p.item, p.holdings, p.item_x, p.holdings_x
  FROM children c JOIN parents p ON c.doc_id = p.doc_id WHERE c.valid),
first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY child_id ORDER BY source, doc_id, child_pos) AS rn FROM lookup) WHERE rn = 1)
"""
FIELD_XML = """'<datafield xmlns="http://www.loc.gov/MARC21/slim" tag="{0}" ind1=" " ind2=" "><subfield code="t">' || {1} || '</subfield></datafield>||'"""
PACKED = f"""
  CASE WHEN item IS NULL THEN '' ELSE {FIELD_XML.format('ITM', 'item_x')} END
  || coalesce(array_to_string(list_transform(holdings_x, lambda h: {FIELD_XML.format('HLD', 'h')}), ''), '')
  || '<marc21:datafield xmlns:marc21="http://www.loc.gov/MARC21/slim" ind1=" " ind2=" " tag="ADF"><marc21:subfield code="a">'
  || parent_id || '</marc21:subfield></marc21:datafield>'
"""


@query("boundwith_lookup", f"""
WITH {LINES} SELECT doc_id, child_pos, child_id, parent_id, {PACKED} AS parent_xml FROM lookup
""")
def boundwith_lookup(spark, sf_dir):
    return O.build_lookup(document_records(spark, sf_dir)).select(
        F.col("ord.rec_pos").alias("doc_id"), F.col("ord.child_pos").cast("long").alias("child_pos"), "child_id", "parent_id", "parent_xml"
    )


@query("tagged_fields", f"""
WITH {LINES}
SELECT doc_id, count(*) FILTER (tag = 'ITM') AS items, count(*) FILTER (tag = 'HLD') AS holdings,
       count(*) FILTER (tag = '774') AS links, coalesce(string_agg(line, '|' ORDER BY pos) FILTER (tag = '774'), '') AS titles
FROM tagged GROUP BY doc_id
""")
def tagged_fields(spark, sf_dir):
    data = F.col("datafield")
    n = lambda tag: F.size(fields_with_tag(data, tag)).cast("long")
    return document_records(spark, sf_dir).select(
        "doc_id", n("ITM").alias("items"), n("HLD").alias("holdings"), n("774").alias("links"),
        F.array_join(subfield_values(data, "774", "t"), "|").alias("titles"),
    )


@query("valid_child_ids", f"""
WITH {LINES} SELECT doc_id, child_pos, valid, CASE WHEN valid THEN CAST(child_id AS VARCHAR) ELSE '' END AS child FROM children
""")
def valid_child_ids(spark, sf_dir):
    ids = document_records(spark, sf_dir).select("doc_id", F.posexplode(subfield_values(F.col("datafield"), "774", "w")).alias("child_pos", "id"))
    valid = valid_child_id(F.col("id"))
    return ids.select(
        "doc_id", F.col("child_pos").cast("long").alias("child_pos"), valid.alias("valid"),
        F.when(valid, trimmed_id(F.col("id"))).otherwise("").alias("child"),
    )


@query("first_match", f"WITH {LINES} SELECT child_id, parent_id, doc_id FROM first")
def first_match(spark, sf_dir):
    children = O.explode_children(document_records(spark, sf_dir))
    return O.first_match(children.select("child_id", "parent_id", F.col("ord.rec_pos").alias("doc_id"), "ord"))


@query("lookup_shape", f"""
WITH {LINES}, per AS (SELECT child_id, count(*) AS rows, count(DISTINCT parent_id) AS parents FROM lookup GROUP BY child_id)
SELECT CAST(sum(rows) AS BIGINT) AS rows, count(*) AS children, count(*) FILTER (parents > 1) AS shared_children FROM per
""")
def lookup_shape(spark, sf_dir):
    return O.lookup_shape(O.explode_children(document_records(spark, sf_dir)))


ENRICHED = """
SELECT r.doc_id, r.record_id, r.n + CASE WHEN f.child_id IS NULL THEN 0
         ELSE 1 + coalesce(len(f.holdings), 0) + CASE WHEN f.item IS NULL THEN 0 ELSE 1 END END AS n_fields,
       r.own || CASE WHEN f.child_id IS NULL THEN ''
         ELSE CASE WHEN f.item IS NULL THEN '' ELSE chr(10) || 'ITM ' || f.item END
              || coalesce(array_to_string(list_transform(f.holdings, lambda h: chr(10) || 'HLD ' || h), ''), '')
              || chr(10) || 'ADF ' || f.parent_id END AS fields
FROM (SELECT doc_id, '99' || length(arg_min(line, pos)) || '3811' AS record_id, count(*) AS n,
             string_agg(tag || ' ' || line, chr(10) ORDER BY pos) AS own FROM tagged GROUP BY doc_id) r
LEFT JOIN first f ON CAST(r.record_id AS BIGINT) = f.child_id
"""


def shown(records: DataFrame) -> DataFrame:
    """Fields as text: tag and first value of each."""
    line = F.transform("datafield", lambda f: F.concat(f["tag"], F.lit(" "), F.coalesce(F.get(f["subfield"], F.lit(0))["value"], F.lit(""))))
    return records.select(
        "doc_id", "record_id", F.size("datafield").cast("long").alias("n_fields"), F.array_join(line, "\n").alias("fields")
    )


@query("lookup_enrich", f"WITH {LINES} {ENRICHED}")
def lookup_enrich(spark, sf_dir):
    lookup = O.explode_children(document_records(spark, sf_dir))
    return shown(O.enrich_with_parents(child_records(spark, sf_dir), lookup))


@query("lookup_file_enrich", f"WITH {LINES} {ENRICHED}")
def lookup_file_enrich(spark, sf_dir):
    """The same through the lookup file: packed XML written as CSV in order, read back and parsed."""
    path = shared_path(spark, "lookup-csv")
    write_lookup(O.build_lookup(document_records(spark, sf_dir)), path)
    lookup = O.unpack_lookup(read_lookup(spark, path))
    return shown(O.enrich_with_parents(child_records(spark, sf_dir), lookup))


@query("packed_nodes", f"""
WITH {LINES}, packed AS (SELECT doc_id, child_pos, string_split({PACKED}, '||') AS nodes,
                                concat_ws('|', item, array_to_string(holdings, '|'), CAST(parent_id AS VARCHAR)) AS vals FROM lookup)
SELECT doc_id, child_pos, len(nodes) AS nodes, vals FROM packed
""")
def packed_nodes(spark, sf_dir):
    """Packed fields split and parsed one by one."""
    lookup = O.build_lookup(document_records(spark, sf_dir))
    unpacked = O.unpack_lookup(lookup)
    values = F.transform("fields", lambda f: F.get(f["subfield"], F.lit(0))["value"])
    return unpacked.select(
        F.col("ord.rec_pos").alias("doc_id"), F.col("ord.child_pos").cast("long").alias("child_pos"),
        F.size("fields").cast("long").alias("nodes"), F.array_join(values, "|").alias("vals"),
    )


@query("packed_pieces", f"""
WITH {LINES}, packed AS (SELECT doc_id, child_pos, len(string_split({PACKED}, '||')) AS n FROM lookup)
SELECT doc_id, child_pos, unnest(range(n)) AS node_pos, true AS well_formed FROM packed
UNION ALL SELECT doc_id, child_pos, n AS node_pos, false AS well_formed FROM packed WHERE doc_id % 2 = 0
""")
def packed_pieces(spark, sf_dir):
    """A row for every packed field and whether it can be parsed; every second parent has a broken piece at its end."""
    lookup = O.build_lookup(document_records(spark, sf_dir))
    broken = F.concat("parent_xml", F.lit('||<datafield tag="ITM"><subfield code="t">'))
    pieces = O.explode_nodes(lookup.withColumn("parent_xml", F.when(F.col("ord.rec_pos") % 2 == 0, broken).otherwise(F.col("parent_xml"))))
    return pieces.select(
        F.col("ord.rec_pos").alias("doc_id"), F.col("ord.child_pos").cast("long").alias("child_pos"),
        F.col("node_pos").cast("long").alias("node_pos"), F.col("field").isNotNull().alias("well_formed"),
    )


RECORD_LINES = "WITH {0} SELECT doc_id, count(*) AS n_fields, string_agg(tag || ' ' || line, chr(10) ORDER BY pos) AS fields FROM tagged GROUP BY doc_id"


def by_id(records: DataFrame) -> DataFrame:
    """Records read back from files, under their document number."""
    ident = F.regexp_extract("record_id", "^99([0-9]+)3811$", 1).cast("long")
    return shown(records.withColumn("doc_id", ident)).drop("record_id")


@query("marcxml_roundtrip", RECORD_LINES.format(LINES))
def marcxml_roundtrip(spark, sf_dir):
    """Records written as XML collections and read back."""
    path = shared_path(spark, "marcxml")
    write_marcxml(document_records(spark, sf_dir), path, records_per_file=1000)
    return by_id(read_marcxml(spark, path))


@query("record_attributes", """
SELECT doc_id, '99' || doc_id || '3811' AS airflow_record_id, CASE lang WHEN 'en' THEN 'Bibliographic' END AS record_type FROM documents
""")
def record_attributes(spark, sf_dir):
    """The attributes of records, written and read back."""
    path = shared_path(spark, "attributes")
    kind = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", "Bibliographic").alias("record_type"))
    records = document_records(spark, sf_dir).join(kind, "doc_id").withColumn("airflow_record_id", F.col("record_id"))
    write_marcxml(records, path)
    ident = F.regexp_extract("record_id", "^99([0-9]+)3811$", 1).cast("long")
    return read_marcxml(spark, path).select(ident.alias("doc_id"), "airflow_record_id", "record_type")


def record_files(spark, sf_dir):
    """Each record as the text of an XML collection."""
    return document_records(spark, sf_dir).select(
        "src_key", "record_id",
        F.concat(F.lit("<collection><record><controlfield tag=\"001\">"), "record_id", F.lit("</controlfield>"),
                 F.replace(pack_fields(F.col("datafield")), F.lit("||"), F.lit("")), F.lit("</record></collection>")).alias("xml"),
    )


@query("archive_roundtrip", RECORD_LINES.format(LINES))
def archive_roundtrip(spark, sf_dir):
    """Each record as an XML collection in a gzipped tar, unpacked, cut into records and parsed."""

    def pack(batches):  # makes the input: one archive per row
        import io
        import tarfile

        for batch in batches:
            packed = []
            for name, text in zip(batch["record_id"], batch["xml"]):
                body, out = text.encode("utf-8"), io.BytesIO()
                with tarfile.open(fileobj=out, mode="w:gz") as archive:
                    entry = tarfile.TarInfo(f"{name}.xml")
                    entry.size = len(body)
                    archive.addfile(entry, io.BytesIO(body))
                packed.append(out.getvalue())
            yield batch[["src_key"]].assign(path=batch["src_key"], content=packed)[["path", "content"]]

    rows = record_files(spark, sf_dir)
    return by_id(parse_records(expand_archives(rows.mapInPandas(pack, "path string, content binary"))))


@query("streamed_archives", RECORD_LINES.format(LINES))
def streamed_archives(spark, sf_dir):
    """Archives of many records each, written by tasks and streamed back by the data source."""
    path = shared_path(spark, "archives")
    system, root = _system(path)
    system.create_dir(root)

    def write(batches):  # makes the input: an archive for each batch, the same one if the task is repeated
        import io
        import tarfile

        from pyspark import TaskContext

        system, root = _system(path)
        for number, batch in enumerate(batches):
            made = f"{root}/part-{TaskContext.get().partitionId():05}-{number:05}.tar.gz"
            with system.open_output_stream(made, compression=None) as out, tarfile.open(fileobj=out, mode="w|gz") as archive:
                for name, text in zip(batch["record_id"], batch["xml"]):
                    body = text.encode("utf-8")
                    entry = tarfile.TarInfo(f"{name}.xml")
                    entry.size = len(body)
                    archive.addfile(entry, io.BytesIO(body))
            yield batch[["src_key"]][:1]

    record_files(spark, sf_dir).mapInPandas(write, "src_key string").write.format("noop").mode("overwrite").save()
    return by_id(stream_archives(spark, path, maxPartitionBytes=str(1 << 20)))


@query("csv_drop", "SELECT conv_id, turn, role, text FROM conversations")
def csv_drop(spark, sf_dir):
    path = shared_path(spark, "csv-drop")
    rows = table(spark, sf_dir, "conversations")
    rows.write.options(header="true", quote='"', escape='"').csv(path)
    return read_csv_drop(spark, path, "conv_id long, turn long, role string, text string")


@query("json_drop", "SELECT conv_id, turn, role, text FROM conversations")
def json_drop(spark, sf_dir):
    path = shared_path(spark, "json-drop")
    table(spark, sf_dir, "conversations").write.json(path)
    return read_json_drop(spark, path, "conv_id long, turn long, role string, text string")


@query("chunked_files", "SELECT count(*) AS records, true AS within_limit FROM lineitem")
def chunked_files(spark, sf_dir):
    path = shared_path(spark, "chunked")
    write_chunked(table(spark, sf_dir, "lineitem"), path, 1000)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("rows"))
    return files.agg(F.sum("rows").alias("records"), (F.max("rows") <= 1000).alias("within_limit"))


@query("routed_files", """
SELECT CASE WHEN event_type = 'error' THEN 'deleted' ELSE 'new-updated' END AS change, event_id, user_id FROM events
""")
def routed_files(spark, sf_dir):
    path = shared_path(spark, "routed")
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "deleted").otherwise("new-updated").alias("change"), "event_id", "user_id"
    )
    write_routed(rows, path)
    return spark.read.parquet(path).select("change", "event_id", "user_id")


@query("enriched_harvest", f"""
WITH {LINES}, e AS ({ENRICHED})
SELECT e.* FROM e WHERE TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) BETWEEN TIMESTAMP '2024-01-01 01:00:00' AND TIMESTAMP '2024-02-10 00:00:00'
""")
def enriched_harvest(spark, sf_dir):
    """A harvest window whose records pass through the caller's step, here the lookup join."""
    lookup = O.explode_children(document_records(spark, sf_dir))
    stamp = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, int(doc_id), 0)")
    records = child_records(spark, sf_dir).withColumn("datestamp", stamp)
    bound = lambda text: F.expr(f"timestamp_ntz'{text}'")
    return shown(harvest(
        records, bound("2024-01-01 01:00:00"), bound("2024-02-10 00:00:00"),
        transform=lambda df: O.enrich_with_parents(df, lookup),
    ))


OAI_ROWS = """
SELECT doc_id, 'oai:docs:' || doc_id AS oai_id, '2024-01-01 10:20:30' AS datestamp, lang || '|' || source AS sets, lang = 'de' AS deleted,
       CASE lang WHEN 'de' THEN '' ELSE text END AS text
FROM documents
"""


def write_harvested(spark, sf_dir, path: str, body: Column, prefix: str, names: str) -> None:
    """Harvest records, one to a document, with prefixed names. German ones are deleted and have no body."""
    gone, name = F.col("lang") == "de", lambda tag: f"{prefix}{tag}"
    header = F.struct(
        F.when(gone, "deleted").alias("_status"),
        F.concat(F.lit("oai:docs:"), F.col("doc_id").cast("string")).alias(name("identifier")),
        F.lit("2024-01-01T10:20:30Z").alias(name("datestamp")), F.array("lang", "source").alias(name("setSpec")),
    )
    rows = table(spark, sf_dir, "documents").select(header.alias(name("header")), F.when(~gone, body).alias(name("metadata")))
    rows.write.format("xml").options(
        rootTag=f"collection {names}", rowTag=name("record"), attributePrefix="_", valueTag="_VALUE", validateName="false", maxRecordsPerFile=1000
    ).save(path)


def harvested_columns(text: Column) -> list[Column]:
    return [
        F.regexp_extract("oai_id", "([0-9]+)$", 1).cast("long").alias("doc_id"), F.col("oai_id"),
        F.date_format("datestamp", "yyyy-MM-dd HH:mm:ss").alias("datestamp"), F.array_join("sets", "|").alias("sets"), F.col("deleted"),
        F.coalesce(text, F.lit("")).alias("text"),
    ]


@query("oai_records", OAI_ROWS)
def oai_records(spark, sf_dir):
    """Harvested bibliographic records, written with name spaces and read back."""
    path = shared_path(spark, "oai")
    part = F.struct(F.lit("a").alias("_code"), F.col("text").alias("_VALUE"))
    field = F.struct(F.lit("500").alias("_tag"), F.lit(" ").alias("_ind1"), F.lit(" ").alias("_ind2"), F.array(part).alias("m:subfield"))
    body = F.struct(F.struct(F.array(field).alias("m:datafield")).alias("m:record"))
    names = 'xmlns="http://www.openarchives.org/OAI/2.0/" xmlns:m="http://www.loc.gov/MARC21/slim"'
    write_harvested(spark, sf_dir, path, body, "", names)
    value = F.get(F.get("datafield", F.lit(0))["subfield"], F.lit(0))["value"]
    return read_oai_marcxml(spark, path).select(*harvested_columns(value))


@query("xoai_cleaned", OAI_ROWS)
def xoai_cleaned(spark, sf_dir):
    """Repository records with name spaces and a doubled wrapper: read, written in clean form, read again."""
    path, cleaned = shared_path(spark, "xoai"), shared_path(spark, "cleaned")
    field = F.struct(F.lit("value").alias("_name"), F.col("text").alias("_VALUE"))
    inner = F.struct(F.lit("none").alias("_name"), F.array(field).alias("field"))
    for name in ("title", "dc"):
        inner = F.struct(F.lit(name).alias("_name"), F.array(inner).alias("element"))
    body = F.struct(F.struct(F.lit("http://www.lyncode.com/xoai").alias("_xmlns"), F.array(inner).alias("element")).alias("metadata"))
    write_harvested(spark, sf_dir, path, body, "o:", 'xmlns:o="http://www.openarchives.org/OAI/2.0/"')
    write_cleaned(read_xoai(spark, path), cleaned)
    title = F.get(F.get(F.get("element", F.lit(0))["element"], F.lit(0))["element"], F.lit(0))["field"]
    return read_xoai(spark, cleaned).select(*harvested_columns(F.get(title, F.lit(0))["_VALUE"]))


@query("listed_folders", """
SELECT DISTINCT CASE WHEN event_type = 'error' THEN 'change=deleted' ELSE 'change=new-updated' END AS folder, true AS has_bytes FROM events
""")
def listed_folders(spark, sf_dir):
    """Files below a prefix, listed without reading them."""
    path = shared_path(spark, "listed")
    gone = F.when(F.col("event_type") == "error", "deleted").otherwise("new-updated")
    write_routed(table(spark, sf_dir, "events").withColumn("change", gone), path)
    files = list_files(spark, path, "change=", "").filter(F.endswith("key", F.lit(".parquet")))
    return files.groupBy(F.substring_index("key", "/", 1).alias("folder")).agg((F.min("size") > 0).alias("has_bytes"))


@query("published_snapshot", """
SELECT o_orderkey, o_orderstatus FROM orders
""")
def published_snapshot(spark, sf_dir):
    """Two snapshots published under one alias: readers get the second."""
    root = shared_path(spark, "published")
    publish_snapshot(table(spark, sf_dir, "nation"), root, "first", "live", 1)
    publish_snapshot(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), root, "second", "live", 2)
    return read_snapshot(spark, root, "live")
