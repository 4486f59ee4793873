"""Registry extract: one large XML document read in parallel, record by record.

The text source cuts the document at the end of each record tag, so one file is spread over as
many tasks as it has input splits; a whole-document parser would hold it in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow import schemas
from grantflow.frames import settled, stored, work_folder

DELIMITER = "_1_0>"
# what may stand before a record: white space and the document's own tags; each pattern is one pass
# over a character class, without repeated groups, so its length is no matter
_SKIPPED = [
    r"</?(?:\w++:)?Grants(?:\s[^>]*+)?>",
    r"<(?:\w++:)?Opportunity(?:Synopsis|Forecast)Detail\z", r"[\s\x{FEFF}]++",
]
_CORRUPT = "_corrupt_record"
_PARSED = T.StructType([*schemas.REGISTRY.fields, T.StructField(_CORRUPT, T.StringType())])


def _from_xml(body: Column) -> Column:
    """Fields of a record body, its text kept as it is."""
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "ignoreSurroundingSpaces": "false",
    }
    return F.from_xml(F.concat(F.lit("<R>"), body, F.lit("</R>")), _PARSED, options)


def _filler(chunk: Column) -> Column:
    """Nothing is left once everything that may stand between records is taken away."""
    for pattern in _SKIPPED:
        chunk = F.regexp_replace(chunk, pattern, "")
    return chunk == ""


def read_chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, ord, chunk): pieces of the documents in document order.

    ``split`` is the byte offset of the input split and ``ord`` grows inside it, so
    (file, split, ord) is document order however the file was divided.
    """
    return (
        spark.read.option("lineSep", DELIMITER).text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("ord"),
            F.col("value").alias("chunk"),
        )
    )


# What a reader of XML may be inside of where a chunk begins or ends, and the marks that lead there and back.
_TEXT, _STATES = "T", "TCDP"  # text and tags; comment, CDATA, processing instruction
_CONSTRUCTS = {"C": ("<!--", "-->"), "D": ("<![CDATA[", "]]>"), "P": ("<?", "?>")}
_WHOLE = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
_RECORD_TAG = r"</?(?:\w++:)?Opportunity(?:Synopsis|Forecast)Detail\z"


def _state_after(text: Column) -> Column:
    """Where a reader is after ``text`` that it began outside of any construct."""
    rest = F.regexp_replace(text, _WHOLE, " ")
    opened = F.regexp_extract(rest, r"<!--|<!\[CDATA\[|<\?", 0)
    state = F.lit(_TEXT)
    for name, (mark, _) in _CONSTRUCTS.items():
        state = F.when(opened == mark, name).otherwise(state)
    return F.when(F.contains(text, F.lit("<!")) | F.contains(text, F.lit("<?")), state).otherwise(_TEXT)


def _transition(text: Column) -> Column:
    """A chunk as a function of states: the state after it for each state before it, in the order of ``_STATES``."""
    after = [_state_after(text)]
    for name, (_, end) in _CONSTRUCTS.items():
        at = F.instr(text, end)
        after.append(F.when(at > 0, _state_after(F.substring(text, at + len(end), F.length(text)))).otherwise(name))
    return F.concat(*after)


def _then(first: Column, second: Column) -> Column:
    """Two functions of states, one after the other."""
    return F.call_function("translate", first, F.lit(_STATES), second)


def _running(steps: Column, begin: Column, function: str) -> Column:
    """The composition up to each of the ordered ``steps``, added to it as ``m``; begins with ``begin``."""
    fields = lambda x, m: F.struct(x.alias("step"), m.alias("m"))
    start = F.struct(begin.alias("m"), F.array().cast("array<string>").alias("all"))
    maps = F.aggregate(
        steps, start, lambda acc, x: F.struct(
            _then(acc["m"], x[function]).alias("m"),
            F.concat(acc["all"], F.array(_then(acc["m"], x[function]))).alias("all")),
        lambda acc: acc["all"])
    return F.zip_with(steps, maps, fields)


def stitched(chunks: DataFrame) -> DataFrame:
    """Chunks (file, split, ord, chunk) whose borders are borders of record tags: chunks that were cut inside a comment,
    CDATA, a processing instruction, or where a text holds the delimiter, are put together again.

    Each chunk is a function from the state in which it begins to the one in which it ends. Functions are composed inside
    each input split, the splits of a file one after the other, so the state at every border follows from two short scans
    of the functions, which are stored, as are the places of false borders: the chunks are read for the functions once and
    for the records once. Only keys and functions are shuffled. Chunks at false borders, which are few, are collected and
    joined.
    """
    place = ["file", "split", "ord"]
    spark = chunks.sparkSession
    narrow = stored(chunks.select(
        *place, _transition(F.col("chunk")).alias("f"), F.col("chunk").rlike(_RECORD_TAG).alias("tag")),
        work_folder(spark, "borders"))
    turning = narrow.where(F.col("f") != _STATES).groupBy("file", "split").agg(
        F.array_sort(F.collect_list(F.struct("ord", "f"))).alias("turns"))
    splits = narrow.groupBy("file", "split").agg(F.max_by("tag", "ord").alias("tag")).join(turning, ["file", "split"], "left")
    splits = splits.withColumn("run", _running(F.coalesce("turns", F.array().cast("array<struct<ord:bigint,f:string>>")),
                                               F.lit(_STATES), "f"))
    splits = splits.withColumn("f", F.coalesce(F.try_element_at("run", F.lit(-1))["m"], F.lit(_STATES)))
    # the splits of a file in order: the state at the start of each, and whether the one before ends at a tag
    files = splits.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("split", "f", "tag"))).alias("s"))
    ends = files.select("file", F.posexplode(_running(F.col("s"), F.lit(_TEXT), "f")).alias("i", "e")).select(
        "file", F.col("e.step.split").alias("split"), F.col("e.m").alias("end"), F.col("e.step.tag").alias("tag"))
    in_file = Window.partitionBy("file").orderBy("split")
    begins = ends.select(
        "file", "split", F.coalesce(F.lag("end").over(in_file), F.lit(_TEXT)).alias("begin"),
        F.coalesce(F.lag(~F.col("tag") | (F.col("end") != _TEXT)).over(in_file), F.lit(False)).alias("open"))
    known = splits.join(begins, ["file", "split"])
    turns = known.select("file", "split", "begin", F.explode("run").alias("r")).select(
        "file", "split", F.col("r.step.ord").alias("ord"), _then(F.col("begin"), F.col("r.m")).alias("after"))
    in_split = Window.partitionBy("file", "split").orderBy("ord")
    borders = narrow.select(*place, "tag").join(turns, place, "left").join(begins, ["file", "split"])
    borders = borders.withColumn("after", F.coalesce(F.last("after", True).over(in_split), F.col("begin")))
    borders = borders.withColumn("false", ~F.col("tag") | (F.col("after") != _TEXT))
    borders = borders.withColumn("goes_on", F.coalesce(F.lag("false").over(in_split), F.col("open")))
    # runs of chunks with false borders between them
    order = Window.partitionBy("file").orderBy("split", "ord")
    loose = borders.where("`false` OR goes_on").select(*place, F.sum((~F.col("goes_on")).cast("int")).over(order).alias("part"))
    several = loose.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("file", "part"))).where("n > 1").drop("n")
    several = stored(several, work_folder(spark, "false-borders"))
    pieces = chunks.join(several, place).groupBy("file", "part").agg(
        F.array_sort(F.collect_list(F.struct("split", "ord", "chunk"))).alias("c"))
    last = F.element_at("c", -1)
    whole = pieces.select("file", last["split"].alias("split"), last["ord"].alias("ord"),
                          F.array_join(F.transform("c", lambda x: x["chunk"]), DELIMITER).alias("chunk"))
    return chunks.join(several, place, "left_anti").select(*place, "chunk").unionByName(whole.select(*place, "chunk"))


def read_registry_rowtag(spark: SparkSession, path: str) -> DataFrame:
    """Small or unusual documents (attributes on record tags): built-in reader, one scan per type."""
    def scan(tag: str, is_forecast: bool) -> DataFrame:
        df = (
            spark.read.format("xml").schema(schemas.REGISTRY)
            .option("rowTag", tag).option("ignoreSurroundingSpaces", "false").load(path)
        )
        return df.withColumn("is_forecast", F.lit(is_forecast))

    both = scan(schemas.SYNOPSIS_TAG, False).unionByName(
        scan(schemas.FORECAST_TAG, True), allowMissingColumns=True
    )
    return _finish(both)


def _filled(name: str) -> Column:
    """Absent text is blank, absent lists stay NULL; fields of the other record type stay NULL."""
    if name in schemas.LIST_FIELDS:
        return F.col(name)
    text = F.coalesce(F.col(name), F.lit(""))
    if name in schemas.SYNOPSIS_ONLY:
        return F.when(~F.col("is_forecast"), text).alias(name)
    if name in schemas.FORECAST_ONLY:
        return F.when(F.col("is_forecast"), text).alias(name)
    return text.alias(name)


def _finish(df: DataFrame, *keep: str) -> DataFrame:
    filled = [_filled(n) for n in schemas.REGISTRY_FIELDS]
    grant_id = F.coalesce(F.col("OpportunityID"), F.lit("")).alias("grant_id")
    return df.select(*keep, grant_id, "is_forecast", *filled)


def parse_all(chunks: DataFrame, forecasts: bool = False) -> DataFrame:
    """Records and rejects of chunks (file, split, ord, chunk) in one table, so that a job can store it and parse once.

    A chunk that ends in a record's closing tag is that record's body. Anything else but filler is a record that was cut
    off or never closed. ``reason`` says why a chunk is a reject, whose text is kept; it is NULL for records.
    """
    # what is no comment or instruction; those inside CDATA are text
    chunks = stitched(chunks).withColumn("chunk", F.when(
        F.contains("chunk", F.lit("<!--")) | F.contains("chunk", F.lit("<?")),
        F.regexp_replace("chunk", r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->|<\?.*?\?>", "$1")).otherwise(F.col("chunk")))
    # tags are known by their local names
    is_synopsis = F.col("chunk").rlike(r"</(?:\w++:)?OpportunitySynopsisDetail\z")
    is_forecast = F.col("chunk").rlike(r"</(?:\w++:)?OpportunityForecastDetail\z")
    tagged = chunks.withColumn("is_forecast", F.when(is_forecast, True).when(is_synopsis, False))
    is_record = F.col("is_forecast").isNotNull()
    if not forecasts:
        tagged = tagged.where(~F.coalesce("is_forecast", F.lit(False)))

    plain = F.regexp_replace("chunk", r"</Opportunity(?:Synopsis|Forecast)Detail\z", "")
    # in a document with prefixes the fields lose theirs with the closing tag
    named = F.regexp_replace(F.regexp_replace("chunk", r"</\w++:\w++\z", ""), r"(</?)\w++:(?=\w)", "$1")
    body = F.when(F.col("chunk").rlike(r"</\w++:\w++\z"), named).otherwise(plain)
    parsed = tagged.withColumn("rec", settled(F.when(is_record, _from_xml(body))))
    bad = F.col("rec").isNull() | F.col(f"rec.{_CORRUPT}").isNotNull()
    reason = (
        F.when(is_record & bad, "undecodable").when(is_record, "")
        .when(~_filler(F.col("chunk")), "unclosed")
    )
    known = parsed.withColumn("reason", settled(reason)).where(F.col("reason").isNotNull())
    return known.select(
        "file", "split", "ord", "is_forecast", F.nullif("reason", F.lit("")).alias("reason"),
        F.when(F.col("reason") != "", F.col("chunk")).alias("chunk"), "rec")


def parse_results(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of what ``parse_all`` gave."""
    place = ("file", "split", "ord")
    good = parsed.where("reason IS NULL").select(*place, "is_forecast", "rec.*")
    return _finish(good, *place), parsed.where("reason IS NOT NULL").select(*place, "reason", "chunk")


def parse_chunks(chunks: DataFrame, forecasts: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of chunks with columns file, split, ord, chunk."""
    return parse_results(parse_all(chunks, forecasts))


def read_registry(
    spark: SparkSession, path: str | list[str], forecasts: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Records and rejects of all extracts under ``path``; forecasts only on request."""
    return parse_chunks(read_chunks(spark, path), forecasts)


def decode_records(df: DataFrame, text_col: str) -> DataFrame:
    """First record of a per-grant document held in a column; status says why there is none."""
    text = F.col(text_col)
    opening = {tag: F.instr(text, f"<{tag}") for tag in (schemas.SYNOPSIS_TAG, schemas.FORECAST_TAG)}
    synopsis, forecast = opening[schemas.SYNOPSIS_TAG], opening[schemas.FORECAST_TAG]
    is_forecast = (
        F.when((synopsis > 0) & ((forecast == 0) | (synopsis < forecast)), False)
        .when(forecast > 0, True)
    )

    def body(tag: str) -> Column:
        # what stands between the end of the opening tag and the closing tag
        rest = F.substring(text, opening[tag], F.length(text))
        rest = F.substring(rest, F.instr(rest, ">") + 1, F.length(rest))
        end = F.instr(rest, f"</{tag}>")
        return F.when(end > 0, F.substring(rest, F.lit(1), end - 1))

    found = df.withColumn("is_forecast", is_forecast)
    found = found.withColumn(
        "_body",
        F.when(F.col("is_forecast"), body(schemas.FORECAST_TAG))
        .when(~F.col("is_forecast"), body(schemas.SYNOPSIS_TAG)),
    )
    out = found.withColumn("rec", settled(_from_xml(F.col("_body"))))
    status = (
        F.when(F.col("is_forecast").isNull(), "no_record")
        .when(F.col("rec").isNull() | F.col(f"rec.{_CORRUPT}").isNotNull(), "undecodable")
        .otherwise("ok")
    )
    out = out.withColumn("status", status)
    return _finish(out.select(*df.columns, "status", "is_forecast", "rec.*"), *df.columns, "status")


def to_xml_text(df: DataFrame) -> DataFrame:
    """Adds ``xml``: the record as its own document; blank and absent fields are left out."""
    fields = [
        (F.col(n) if n in schemas.LIST_FIELDS else F.nullif(F.col(n), F.lit(""))).alias(n)
        for n in schemas.REGISTRY_FIELDS
    ]

    def render(tag: str) -> Column:
        return F.to_xml(F.struct(*fields), {"rowTag": tag})

    return df.withColumn(
        "xml",
        F.when(F.col("is_forecast"), render(schemas.FORECAST_TAG))
        .otherwise(render(schemas.SYNOPSIS_TAG)),
    )
