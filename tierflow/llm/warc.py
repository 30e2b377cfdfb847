"""WARC archives written from pages and read back in parallel.

Writing: one record per page. Of pages with equal payloads of at least LEAST_REVISIT bytes, the one with the largest id is
the response; the others are revisits that name it and carry no payload. Spark's text writer writes the records: a line is
a record, the separator of lines is the blank lines that end a record, so each part file is one archive.

Reading: the splittable text reader cuts the archives at the record magic, wherever it stands, also inside payloads. Each
piece that begins like a record is a candidate: its header gives its length and so the place of its successor. Chains are
followed by pointer jumping: a candidate starts as pointing to its successor, reached from the file's start or not; in each
round what is reached passes on to its pointer, and pointers double their reach, so n records take log2(n) rounds. Before
that, runs of candidates within a split whose successor is the very next piece shrink to one, so in files without false
magic the rounds work on one row per split. Only records reached from the file's start are real; a magic inside a payload
is reached by none and its piece goes back into the payload around it.

Defined results: a null payload is empty. Rows that repeat a page id are records of their own; several rows with the same
payload and the largest id are all responses. A null id is written without an id and never chosen as response if another
row has the payload. Bytes after the last record that are no record are dropped, as is a record that is cut off. An empty
table gives no records. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm.common import frozen
from tierflow.session import scratch_path

LEAST_REVISIT = 1000
MAGIC = "WARC/1.1\r\n"
_END = "\r\n\r\n"


def _clean(value: Column) -> Column:
    """A header value without line breaks and other control characters."""
    return F.regexp_replace(value, r"[\x00-\x1F\x7F]", "")


def with_originals(pages: DataFrame) -> DataFrame:
    """Pages with payload, its size and digest, and for a revisit the id of the response."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1(F.col("payload").cast("binary")))
    # Only digests that occur more than once are written and joined; both sides of the join are then tables, and a digest
    # with very many copies can be split.
    large = rows.where(F.col("payload_bytes") >= LEAST_REVISIT)
    originals = large.groupBy("payload_digest").agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1")
    originals = frozen(originals.select("payload_digest", "original"), "originals").withColumnRenamed("payload_digest", "digest")
    met = rows.join(originals, F.col("payload_digest") == F.col("digest"), "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return met.select("page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(revisit, F.col("original")).alias("refers_to"))


def record(page: str = "page_id") -> Column:
    """The record of a row of `with_originals`, without the blank lines at its end."""
    is_revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(_END))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    header = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col(page).cast("string"), F.lit(">"))),
        line("WARC-Target-URI", _clean(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        line("WARC-Profile", F.when(is_revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(_END),
    )
    return F.concat(header, block)


def write_archives(pages: DataFrame, path: str) -> None:
    """One archive per task."""
    with_originals(pages).select(record().alias("value")).write.option("lineSep", _END).text(path)


# ---- reading ----------------------------------------------------------------------------------------------------------


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic up to the next one: file, split, place in the split and in the file, and the bytes.

    The reader's pieces of a split come in order. Their sizes give the places, within a split first, then over the splits
    of a file.
    """
    lines = spark.read.option("lineSep", MAGIC).text(path)
    read = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("order"),
        F.col("value").cast("binary").alias("body"),
    )
    return read.withColumn("size", F.octet_length("body").cast("long") + len(MAGIC))


def _header(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1), F.lit(""))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece with its place and, if it begins like a record, the place of its successor; a written table without bodies."""
    return _placed(pieces(spark, path))


def _placed(found: DataFrame) -> DataFrame:
    # The header ends at the first blank line. Only its beginning is looked at: headers are short, bodies are not.
    text = F.col("body").cast("string")
    head = F.substring_index(text, _END, 1)
    narrow = found.select(
        "file",
        "split",
        "order",
        "size",
        F.when(F.instr(text, _END) > 0, head).alias("head"),
    )
    narrow = narrow.select(
        "file", "split", "order", "size", F.octet_length("head").alias("head_bytes"), _header("Content-Length").cast("long").alias("length"), _header("WARC-Type").alias("kind")
    )
    narrow = frozen(narrow, "pieces")
    inside = Window.partitionBy("file", "split").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    splits = narrow.groupBy("file", "split").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("split_at"))
    placed = narrow.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(splits, ["file", "split"])
    # A piece follows a magic: the magic stands right before it. The empty piece before the first magic stands at -10.
    at = F.col("split_at") + F.col("within") - len(MAGIC)
    after = at + len(MAGIC) + F.col("head_bytes") + len(_END) + F.col("length") + len(_END)
    return frozen(placed.select("file", "split", "order", "size", at.alias("at"), F.when(F.col("kind").isNotNull() & (F.col("length") >= 0), after).alias("next")), "candidates")


def reached(found: DataFrame) -> DataFrame:
    """(file, at) of the candidates that a chain from the file's start reaches, by pointer jumping."""
    spark = found.sparkSession
    chained = found.where("next IS NOT NULL")
    # Runs within a split: each candidate whose successor is the next piece belongs to the run of that one.
    order = Window.partitionBy("file", "split").orderBy("at")
    marked = chained.withColumn("joined", F.coalesce(F.lag("next").over(order) == F.col("at"), F.lit(False)))
    runs = marked.withColumn("run", F.last(F.when(~F.col("joined"), F.col("at")), True).over(order))
    runs = frozen(runs.select("file", "at", "next", "run"), "runs")
    # One row per run: where it starts, where its last record points. Records of a run are reached with its first one.
    links = runs.groupBy("file", "run").agg(F.max("next").alias("next")).withColumnRenamed("run", "at").withColumn("reached", F.col("at") == 0)
    # A pointer into the middle of a run: the run is reached from there on only.
    inner = runs.where("at != run").select("file", F.col("at").alias("inner_at"), "run").withColumnRenamed("file", "inner_file")
    targets = links.select("file", "next").distinct()
    entered = targets.join(inner, (F.col("file") == F.col("inner_file")) & (F.col("next") == F.col("inner_at"))).select("file", F.col("inner_at").alias("cut"), "run").distinct()
    if entered.limit(1).count():
        runs, links = _recut(runs, entered)
    state = frozen(links, "links")
    while True:
        pointer = state.select(F.col("file").alias("f"), F.col("at").alias("a"), F.col("next").alias("jump"), F.col("reached").alias("seen"))
        passed = state.where("reached").select(F.col("file").alias("f"), F.col("next").alias("a")).distinct().withColumn("hit", F.lit(True))
        doubled = state.join(pointer.drop("seen"), (F.col("next") == F.col("a")) & (F.col("file") == F.col("f")), "left").select("file", "at", F.col("jump").alias("next"), "reached")
        grown = doubled.join(passed, (F.col("at") == F.col("a")) & (F.col("file") == F.col("f")), "left")
        new = frozen(grown.select("file", "at", "next", (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("reached")), "links")
        if not new.where("reached AND next IS NOT NULL").limit(1).count():
            break
        state = new
    return runs.join(new.where("reached").select("file", F.col("at").alias("run")), ["file", "run"]).select("file", "at")


def _recut(runs: DataFrame, entered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs begun anew where a pointer enters them, so a pointer always meets the start of a run."""
    cuts = entered.select("file", "run", F.col("cut").alias("at"), F.lit(True).alias("cut"))
    order = Window.partitionBy("file", "run").orderBy("at")
    whole = runs.join(cuts, ["file", "run", "at"], "left")
    begun = F.last(F.when(F.col("cut") | (F.col("at") == F.col("run")), F.col("at")), True).over(order)
    runs = frozen(whole.withColumn("run", begun).select("file", "at", "next", "run"), "runs")
    links = runs.groupBy("file", "run").agg(F.max("next").alias("next")).withColumnRenamed("run", "at").withColumn("reached", F.col("at") == 0)
    return runs, links


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Per record page_id, url, payload_bytes, payload_digest, record_type, refers_to and the payload as read back (binary)."""
    # The numbers of pieces follow from how Spark cuts and packs the files, which changes with the cores at hand: the files
    # are read once, and numbers and bodies are written together.
    bodies = frozen(pieces(spark, path), "bodies", compression="zstd")
    found = _placed(bodies)
    real = reached(found).withColumn("real", F.lit(True))
    order = Window.partitionBy("file", "split").orderBy("at")
    known = frozen(found.join(real, ["file", "at"], "left").withColumn("owner", F.last(F.when(F.col("real"), F.col("at")), True).over(order)), "known")
    # A split may begin inside a record: its first pieces belong to the last record of the splits before it.
    ends = known.groupBy("file", "split").agg(F.max(F.when(F.col("real"), F.col("at"))).alias("last"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("file", "split", F.max("last").over(before).alias("carried"))
    owned = known.join(ends, ["file", "split"]).select("file", "split", "order", "at", F.coalesce("owner", "carried").alias("owner"))
    owned = frozen(owned, "owned")
    # A record in one piece needs no other row. What is left over (pieces before the first record, unreached ones, records
    # that a false magic cut) is written, small as a rule, and only its pieces are put together.
    several = owned.groupBy("file", "owner").agg(F.count("*").alias("parts")).where("owner IS NULL OR parts > 1")
    several = several.select(F.col("file").alias("f"), F.col("owner").alias("cut"))
    same = (F.col("file") == F.col("f")) & F.col("owner").eqNullSafe(F.col("cut"))
    left_over = owned.join(several, same).select(F.col("file").alias("f"), F.col("order").alias("o"), "owner", "at", F.lit(True).alias("left_over"))
    left_over = frozen(left_over, "left-over")
    met = bodies.select("file", "order", "body").join(left_over, (F.col("file") == F.col("f")) & (F.col("order") == F.col("o")), "left")
    whole = met.where("left_over IS NULL").select("body")
    glue = F.lit(MAGIC).cast("binary")
    parts = met.where("left_over AND owner IS NOT NULL").groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("at", "body"))).alias("parts"))
    joined = F.aggregate(
        F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(1))),
        F.get("parts", 0)["body"],
        lambda held, part: F.concat(held, glue, part["body"]),
    )
    return _parsed(whole.unionByName(parts.select(joined.alias("body"))))


def _parsed(records: DataFrame) -> DataFrame:
    """The fields of whole records (what follows the magic)."""
    text = F.col("body").cast("string")
    split = records.withColumn("head", F.substring_index(text, _END, 1)).withColumn("length", _header("Content-Length").cast("int"))
    start = F.octet_length("head") + len(_END) + 1
    split = split.withColumn("block", F.substring("body", start, F.col("length"))).where(F.octet_length("block") == F.col("length"))
    http = F.substring_index(F.col("block").cast("string"), _END, 1)
    http_bytes = F.octet_length(http) + len(_END)
    payload = F.when(F.col("record_type") == "response", F.substring("block", http_bytes + 1, F.col("length") - http_bytes))
    named = split.select(
        F.regexp_extract(_header("WARC-Record-ID"), r"<urn:page:(-?\d+)>", 1).cast("long").alias("page_id"),
        _header("WARC-Target-URI").alias("url"),
        _header("WARC-Type").alias("record_type"),
        F.regexp_extract(_header("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1).cast("long").alias("refers_to"),
        F.regexp_extract(_header("WARC-Payload-Digest"), "sha1:([0-9a-f]{40})", 1).alias("told_digest"),
        F.regexp_extract(http, r"Content-Length: (\d+)", 1).cast("long").alias("told_bytes"),
        "block",
        "length",
    )
    named = named.withColumn("payload", payload)
    return named.select(
        "page_id",
        "url",
        F.coalesce(F.octet_length("payload").cast("long"), "told_bytes").alias("payload_bytes"),
        F.when(F.col("payload").isNotNull(), F.sha1("payload")).otherwise(F.col("told_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        "payload",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives to the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    return read_archives(spark, path)
