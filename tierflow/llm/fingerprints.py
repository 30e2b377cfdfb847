"""Document fingerprints by consistent weighted sampling.

A text is its words (runs without ASCII blanks), each weighted by how often it occurs. For each of SAMPLES samples, every
word draws two gamma numbers and one uniform number from its hash, the same in every text. With weight S the word's value
is c / (y e^r), where ln y = r (floor(ln S / r + b) - b); the smallest value wins, and the fingerprint keeps the winner's
hash and its level floor(ln S / r + b). Two texts agree in a sample with a probability equal to their generalised Jaccard
similarity, the sum of the smaller weights over the sum of the larger ones. Only DataFrame functions are used.

The text edited is the text with its last quarter replaced by the beginning of the next document. Rows are dealt to ranges
of ids; a range also gets the first row of the next range, so the next text is the next row of a range. One exchange deals
the texts; words are counted and samples taken inside the ranges, without another one.

Defined results: a null text is the empty text; texts without a word have the fingerprint of no words (all zeros), and two
of them have likeness 1. Rows are ordered by id, nulls first, then by text; repeated rows are documents of their own, next
to each other. The last row's next document is the first row; a single row is its own next document. Every input row gives
one output row; an empty table gives an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm.common import whole_text

SAMPLES = 24
ROWS_A_RANGE = 2000
# A sample as text: twelve hexadecimal digits.
DIGITS = 12

_BLANKS = r"[\x20\x09-\x0D]+"


def _held(spark: SparkSession, values: list, kind: str) -> Column:
    """A table as the value of a subquery of one row: tasks read it, and the plan only names it."""
    return spark.createDataFrame([(values,)], f"held {kind}").scalar()


def _bits(hashed: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << width) - 1))


def _uniform(hashed: Column, shift: int, width: int) -> Column:
    """A number between 0 and 1, without the ends, from some bits of a hash."""
    return (_bits(hashed, shift, width).cast("double") + 0.5) / float(1 << width)


def sample(word: Column, log_weight: Column, number: int) -> Column:
    """The word's draw for one sample as a long: value in the high bits, so the smallest one wins; word and level below.

    `word` is the word's 64-bit hash. One hash per sample gives both gamma numbers, each minus the logarithm of the product
    of two uniform numbers of 16 bits, another one the uniform number. The logarithm of the value is cut to steps of 2**-17
    and shifted to be positive.
    """
    gammas, shift = F.xxhash64(word, F.lit(2 * number)), F.xxhash64(word, F.lit(2 * number + 1))
    r = -F.ln(_uniform(gammas, 0, 16) * _uniform(gammas, 16, 16))
    log_c = F.ln(-F.ln(_uniform(gammas, 32, 16) * _uniform(gammas, 48, 16)))
    b = _uniform(shift, 0, 32)
    level = F.floor(log_weight / r + b)
    log_value = log_c - r * (level - b) - r
    steps = ((log_value + 128.0) * float(1 << 17)).cast("long")
    high = F.shiftleft(F.least(F.greatest(steps, F.lit(0)), F.lit((1 << 27) - 1)), 36)
    low = word.bitwiseXOR(F.shiftleft(level, 13)).bitwiseAND(F.lit((1 << 36) - 1))
    return high.bitwiseOR(low)


def ranges(documents: DataFrame, rows: int = ROWS_A_RANGE) -> tuple[list[int], int]:
    """The first ids of the ranges after the first, and the number of rows. A range holds whole ids.

    One id per `rows` documents comes to the driver.
    """
    count = documents.count()
    dealt = documents.select("doc_id").where("doc_id IS NOT NULL").repartitionByRange(max(1, count // rows), "doc_id")
    firsts = dealt.groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("first")).select("first").collect()
    return sorted(row.first for row in firsts)[1:], count


def _with_range(rows: DataFrame, firsts: list[int]) -> DataFrame:
    """Adds the place of each row's id among the ranges, found in two steps."""
    width = max(1, int(len(firsts) ** 0.5))
    groups = [firsts[at : at + width] for at in range(0, len(firsts), width)]
    if not groups:
        return rows.withColumn("range", F.lit(0))
    spark, doc_id = rows.sparkSession, F.col("doc_id")
    rows = rows.withColumn("heads", _held(spark, [part[0] for part in groups], "array<bigint>"))
    group = F.size(F.filter("heads", lambda head: head <= doc_id))
    rows = rows.withColumn("group", group).withColumn("inner", F.get(_held(spark, groups, "array<array<bigint>>"), F.col("group") - 1))
    inside = F.size(F.filter("inner", lambda first: first <= doc_id))
    place = F.when(doc_id.isNull() | (F.col("group") == 0), 0).otherwise((F.col("group") - 1) * width + inside)
    return rows.withColumn("range", place.cast("int")).drop("heads", "group", "inner")


def _dealt(documents: DataFrame) -> DataFrame:
    """Rows by range, in order, each with the next text; a range ends with a guest, the first row of the next one."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    firsts, _ = ranges(rows)
    spark = documents.sparkSession
    dealt = _with_range(rows, firsts).withColumn("guest", F.lit(False))
    # The rows of each range's first id.
    first_rows = dealt.where(F.col("range") > 0).where(F.get(_held(spark, firsts or [0], "array<bigint>"), F.col("range") - 1) == F.col("doc_id"))
    lowest = rows.orderBy(F.col("doc_id").asc_nulls_first(), "text").limit(1).withColumn("range", F.lit(len(firsts))).withColumn("guest", F.lit(True))
    guests = (
        first_rows.groupBy("range")
        .agg(F.min(F.struct("doc_id", "text")).alias("first"))
        .select("first.doc_id", "first.text", (F.col("range") - 1).alias("range"), F.lit(True).alias("guest"))
    )
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    # One partition per range: so many words are counted at a time as a range has, whatever the size of the table.
    together = dealt.unionByName(guests).unionByName(lowest).repartition(len(firsts) + 1, "range")
    return together.withColumn("place", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))


def edited(text: Column, next_text: Column) -> Column:
    """The last floor(n / 4) code points replaced by the first as many of the next text."""
    cut = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(next_text, F.lit(1), cut))


def likeness(one: Column, other: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples of two fingerprints."""
    places = F.sequence(F.lit(0), F.lit(samples - 1))
    same = F.filter(places, lambda i: F.get(one, i) == F.get(other, i))
    return F.size(same).cast("double") / float(samples)


def _versions(told: Column, no_words: Column) -> list[tuple[int, Column, Column]]:
    """(kind, what is known, words): the text's words, the edited text's, and the row's own facts."""
    split = [F.split(name, _BLANKS) for name in ("text", "changed")]
    nothing = F.when(F.lit(False), told)
    return [(0, nothing, split[0]), (1, nothing, split[1]), (2, told, no_words)]


def fingerprints(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Per row the fingerprint of the text and of the edited text, and the likeness to that and to the next document."""
    rows = _dealt(documents)
    changed = F.when(F.col("guest"), F.lit("")).otherwise(edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("changed", changed)
    told = F.struct("doc_id", "guest", F.length("text").cast("long").alias("n_chars"), F.sha2("changed", 256).alias("edited_sha256"))
    no_words = F.expr("cast(array() as array<string>)")
    versions = F.array(*[F.struct(F.lit(kind).alias("kind"), told_.alias("told"), words.alias("words")) for kind, told_, words in _versions(told, no_words)])
    # What is known of the row travels once, as an entry of its own (kind 2), so words stay narrow and nothing is joined back.
    each = rows.select("range", "place", F.explode(versions).alias("version"))
    words = each.select("range", "place", "version.kind", "version.told", F.explode_outer("version.words").alias("word"))
    hashed = F.when(F.col("word") != "", F.xxhash64("word")).alias("word")
    counted = words.select("range", "place", "kind", "told", hashed).groupBy("range", "place", "kind", "told", "word").agg(F.count("*").alias("weight"))
    drawn = counted.withColumn("log_weight", F.ln(F.col("weight").cast("double")))
    draws = [sample(F.col("word"), F.col("log_weight"), k) for k in range(samples)]
    smallest = [F.min(F.when(F.col("word").isNotNull(), draw)).alias(f"s{k}") for k, draw in enumerate(draws)]
    signed = drawn.groupBy("range", "place", "kind", "told").agg(*smallest)
    low = [F.coalesce(F.col(f"s{k}").bitwiseAND(F.lit((1 << 36) - 1)), F.lit(0)) for k in range(samples)]
    signed = signed.select("range", "place", "kind", "told", F.array(*low).alias("signature"))
    paired = signed.groupBy("range", "place").agg(
        F.max("told").alias("told"),
        F.max(F.when(F.col("kind") == 0, F.col("signature"))).alias("own"),
        F.max(F.when(F.col("kind") == 1, F.col("signature"))).alias("new"),
    )
    order = Window.partitionBy("range").orderBy("place")
    paired = paired.withColumn("following", F.lead("own").over(order)).where(~F.col("told.guest"))
    text = lambda name: F.concat_ws("", F.transform(name, lambda s: F.lpad(F.lower(F.hex(s)), DIGITS, "0")))
    return paired.select(
        "told.doc_id",
        "told.n_chars",
        "told.edited_sha256",
        text("own").alias("fingerprint"),
        text("new").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("following"), samples).alias("near_next"),
    )
