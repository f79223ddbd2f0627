"""Route files (KML) and coordinate text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hopgrid.session import work_dir

FIRST_PLACEMARK = ("string((//*[local-name()='Placemark'])[1]"
                   "//*[local-name()='coordinates'][1])")
FIRST_COORDINATES = "string((//*[local-name()='coordinates'])[1])"
# A number as a float literal is written: what a bare cast also takes (1d, 1f) is left out.
NUMBER = r"^\s*[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?\s*$"


def read_route_files(spark: SparkSession, path: str) -> DataFrame:
    """``route`` (file name) and ``content`` of every ``.kml`` file; an empty folder is an error."""
    return _route_files(spark, path).select(_file_name("path").alias("route"), F.col("content").cast("string").alias("content"))


def _route_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.kml").load(path)
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no .kml files in {path}")
    return files


def _file_name(path: str) -> Column:
    return F.url_decode(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\+", "%2B"))


def _tokens(content: Column, xpath: str) -> Column:
    text = F.xpath_string(content, F.lit(xpath))
    return F.filter(F.split(text, r"\s+"), lambda token: token != "")


def number(text: Column) -> Column:
    """Double if the text is a plain number, else NULL."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def course_points(documents: DataFrame, content: str = "content", route: str = "route") -> DataFrame:
    """Ordered ``(route, idx, lon, lat)`` of the first placemark; altitude is dropped.

    A point whose first two parts are not numbers has NULL coordinates.
    """
    return _course(documents.select(F.col(route).alias("route"),
                                    F.posexplode(_tokens(F.col(content), FIRST_PLACEMARK)).alias("idx", "token")))


def _course(tokens: DataFrame) -> DataFrame:
    parts = F.split("token", ",")
    return tokens.select("route", "idx", number(F.get(parts, F.lit(0))).alias("lon"),
                         number(F.get(parts, F.lit(1))).alias("lat"))


# What follows a "<": an opening or closing tag of the two elements, in any name space.
ROUTE_TAG = r"^(/?)(?:[^\s<>/:]+:)?(Placemark|coordinates)(?=[\s/>]|$)"
# Comments, CDATA, character references and unfinished tags need more than single lines.
ODD_LINE = r"<!|&#|<[^<>]*coordinates[^<>]*$"


def scan_course_points(spark: SparkSession, path: str) -> DataFrame:
    """``course_points`` of every ``.kml`` file without a document in memory.

    Files are read as lines, in splits: a large file is worked on by many tasks,
    and none holds more than a stretch and a sort that may spill. A first pass finds
    the tags and where the first placemark's first coordinates begin and end; a second
    takes the lines between. Points are numbered by adding up counts per stretch of 4096 lines.
    Only files with an ``ODD_LINE`` are put together and parsed whole. Lines are the
    unit, so a route on one line is not cut; text that is not well-formed XML is no error.
    """
    _route_files(spark, path)
    lines = (spark.read.option("pathGlobFilter", "*.kml").text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("line"), "value"))
    # Both passes use one frame, so a line has the same number in each.
    marks = _kept(_pieces(lines).where("tag <> ''").select(
        "file", "tag", "closing", "empty", F.struct("split", "line", "piece").alias("at")), "route-marks")
    odd = _kept(lines.where(F.col("value").rlike(ODD_LINE)).select("file").distinct(), "route-odd")
    bounds = _kept(_course_bounds(marks).join(odd, "file", "left_anti"), "route-bounds")

    inside = _pieces(lines).join(bounds, "file").where(
        (F.struct("split", "line", "piece") >= F.col("begin")) & (F.struct("split", "line", "piece") < F.col("end")))
    tokens = F.filter(F.split("text", r"\s+"), lambda token: token != "")
    runs = inside.select("file", "split", "line", "piece", tokens.alias("tokens")).where(F.size("tokens") > 0)
    runs = runs.withColumn("stretch", F.shiftright("line", 12))
    sizes = runs.groupBy("file", "split", "stretch").agg(F.sum(F.size("tokens")).alias("size"))
    before = Window.partitionBy("file").orderBy("split", "stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = _kept(sizes.select("file", "split", "stretch", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")), "route-starts")
    earlier = Window.partitionBy("file", "split", "stretch").orderBy("line", "piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("earlier", F.coalesce(F.sum(F.size("tokens")).over(earlier), F.lit(0))).join(
        starts, ["file", "split", "stretch"])
    scanned = placed.select("file", "start", "earlier", F.posexplode("tokens").alias("place", "token")).select(
        _file_name("file").alias("route"), (F.col("start") + F.col("earlier") + F.col("place")).cast("int").alias("idx"), "token")

    ordered = F.sort_array(F.collect_list(F.struct("split", "line", "value")))
    whole = lines.join(odd, "file", "left_semi").groupBy("file").agg(
        F.array_join(F.transform(ordered, lambda row: row["value"]), "\n").alias("content"))
    return _course(scanned).unionByName(course_points(whole.withColumn("route", _file_name("file"))))


def _kept(frame: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder, so that Spark knows its size when it chooses a join."""
    path = work_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _pieces(lines: DataFrame) -> DataFrame:
    """Lines cut at each ``<``: place in the line, the tag if it is one of ``ROUTE_TAG``, the text behind it."""
    cut = lines.select("file", "split", "line", F.posexplode(F.split("value", "<")).alias("piece", "raw"))
    after = F.col("piece") > 0
    return cut.select(
        "file", "split", "line", "piece",
        F.when(after, F.regexp_extract("raw", ROUTE_TAG, 2)).otherwise("").alias("tag"),
        (after & F.col("raw").startswith("/")).alias("closing"),
        (after & F.col("raw").rlike(r"^[^>]*/\s*>")).alias("empty"),
        F.when(~after, F.col("raw")).when(F.instr("raw", ">") > 0, F.substring_index("raw", ">", -1)).otherwise("").alias("text"))


def _course_bounds(marks: DataFrame) -> DataFrame:
    """``begin`` and ``end`` (a piece each) of the first coordinates in each file's first placemark."""
    def first(tag: str, closing: bool, behind: DataFrame, name: str) -> DataFrame:
        found = marks.where((F.col("tag") == tag) & (F.col("closing") == closing)).join(behind, "file").where("at > after")
        return found.groupBy("file").agg(F.min("at").alias(name))

    opened = marks.where("tag = 'Placemark' and not closing").groupBy("file").agg(
        F.min(F.struct("at", "empty")).alias("first")).where("not first.empty")
    opened = opened.select("file", F.col("first.at").alias("after"))
    left = first("Placemark", True, opened, "left")
    begin = marks.where("tag = 'coordinates' and not closing").join(opened, "file").where("at > after").groupBy("file").agg(
        F.min(F.struct("at", "empty")).alias("first")).where("not first.empty")
    begin = begin.join(left, "file").where("first.at < left").select("file", F.col("first.at").alias("after"))
    end = first("coordinates", True, begin, "end")
    return begin.withColumnRenamed("after", "begin").join(end, "file")


def document_points(documents: DataFrame, content: str = "content", route: str = "route") -> DataFrame:
    """``(route, idx, point)`` of the first coordinates anywhere; ``point`` keeps the altitude.

    A document without coordinates yields one row with a NULL point.
    """
    tokens = documents.select(F.col(route).alias("route"),
                              F.posexplode_outer(_tokens(F.col(content), FIRST_COORDINATES)).alias("idx", "token"))
    return tokens.select("route", "idx", F.transform(F.split("token", ","), number).alias("point"))


def read_coordinate_text(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``line`` of every text line below ``path``."""
    return spark.read.text(path).select(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("value").alias("line"))


def is_coordinate_line(line: Column) -> Column:
    """A line with a comma and without the word ``name``."""
    return line.contains(",") & ~line.contains("name")


def coordinate_numbers(line: Column) -> tuple[Column, Column]:
    """First two comma-separated parts as doubles, NULL where they are not numbers."""
    parts = F.split(line, ",", 3)  # the rest of a long line stays whole
    return number(F.get(parts, F.lit(0))), number(F.get(parts, F.lit(1)))


def coordinate_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """The coordinate lines with their two numbers; ``valid`` is false where one is missing."""
    first, second = coordinate_numbers(F.col(line))
    kept = lines.where(is_coordinate_line(F.col(line))).withColumns({"first": first, "second": second})
    return kept.withColumn("valid", F.col("first").isNotNull() & F.col("second").isNotNull())
