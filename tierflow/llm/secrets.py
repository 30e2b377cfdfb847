"""Secret scan with corpus-wide ownership frequency.

Every text is searched for fixed kinds of credentials. A candidate's value is hashed; over the corpus each hash is counted
by distinct owners and distinct repositories. A value that many owners carry is a copied example; a value that few owners
carry and that looks random is taken for a live credential, and for a spread one where its owners hold it in many
repositories. Only DataFrame functions are used, and their time grows with a text's spans, not with their square.

Texts are scanned once; what was found (no text) is written to the shared folder, and both the counts and the verdicts
read it. Counts shrink to distinct (hash, repository, owner) before hashes meet; they are joined back from a written table,
one row per hash, so that adaptive execution can split the spans of a very frequent hash.

The value of a private key is its base64 body, however its lines are broken; a header without a body is never live.

Defined results: a null text is the empty text and has no spans; a null repository or owner is a value of its own ("").
Every input row gives one output row, repeated rows and null ids included; repeated rows count once per owner. An empty
table gives an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bind, free_name, frozen, whole_text
from tierflow.llm.running import chunks, cut, greatest_before, sums_before

MAX_OWNERS = 2
# From more repositories than this on, a value of few owners is spread: copied between the repositories of its owner.
MAX_REPOSITORIES = 2
MIN_DISTINCT_CHARS = 8
# Words of a placeholder also occur by chance in longer keys, and OpenSSH keys hold runs of one letter.
KEY_CHARS = 64


@dataclass(frozen=True)
class Kind:
    """`gate` is a cheap test that a text can match at all; the value is group `group`, kept from `least` characters.

    What matches `filler` is no part of the value.
    """

    name: str
    gate: str
    pattern: str
    group: int = 0
    least: int = 0
    filler: str = ""


#: The fixed kinds first, in their fixed order, then those of the method.
BASE = (
    Kind(
        "assign",
        r"(?i:password|passwd|secret|token|api_?key)",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=1,
        least=6,
    ),
    Kind("access", r"AKIA", r"AKIA[A-Z0-9]{16,}"),
    Kind("hex", r"[0-9a-f]{24}", r"[0-9a-f]{24,}"),
)
#: A key's block goes to its END line, or over the headers and base64 lines that follow if there is none. Line breaks can be
#: written as escapes. Repeated groups are possessive: Java walks those in a loop, without a stack.
_KEY_END = r"-----END [A-Z ]{0,30}PRIVATE KEY-----"
_BREAK = r"""[\s"',]*+(?:\\[rn][\s"',]*+)*+"""
_KEY_LINES = (
    rf"(?:{_BREAK}[A-Za-z]++-[A-Za-z]++:[^\r\n\\]*+)*+(?:{_BREAK}[A-Za-z0-9+/]{{16,}}+={{0,2}}+)++"
    rf"""(?:(?<!=){_BREAK}[A-Za-z0-9+/]++={{0,2}}+(?=[ \t]*+(?:[\r\n\\"']|$)))?"""
)
ADDED = (
    Kind(
        "private_key",
        r"-----BEGIN ",
        rf"-----BEGIN [A-Z ]{{0,30}}PRIVATE KEY-----([^-]*+(?:-{{1,4}}+[^-]++)*+(?={_KEY_END})|(?:{_KEY_LINES})?)(?:{_KEY_END})?",
        group=1,
        filler=r"\\[rn]|[^A-Za-z0-9+/=]",
    ),
    Kind("forge_token", r"gh[opsur]_", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Kind("chat_token", r"xox[abprs]-", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Kind("web_token", r"eyJ", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
KINDS = BASE + ADDED
_PLACEHOLDER = r"(?i)example|changeme|placeholder|dummy|sample|your|xxxx|1234567|(.)\1{5}"
_SPAN = "struct<start:bigint,kind_order:int,end:bigint,kind:string,value:string>"


def _found(text: Column, kind: Kind, order: int) -> Column:
    """The kind's spans in a text: matches and the gaps between them give the places in code points, in linear time."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    if kind.filler:
        values = F.transform(values, lambda value: F.regexp_replace(value, kind.filler, ""))
    gaps = F.split(text, kind.pattern, -1)

    def spans_of(found: Column) -> Column:
        sizes = F.transform(found["matches"], lambda match, i: (F.length(F.get(found["gaps"], i)) + F.length(match)).cast("bigint"))

        def span(match: Column, i: Column, before: Column) -> Column:
            start = F.get(before, i) + F.length(F.get(found["gaps"], i))
            return F.struct(
                start.alias("start"),
                F.lit(order).alias("kind_order"),
                (start + F.length(match)).alias("end"),
                F.lit(kind.name).alias("kind"),
                F.get(found["values"], i).alias("value"),
            )

        return bind(sums_before(sizes), lambda before: F.transform(found["matches"], lambda match, i: span(match, i, before)))

    spans = bind(F.struct(matches.alias("matches"), values.alias("values"), gaps.alias("gaps")), spans_of).cast(f"array<{_SPAN}>")
    if kind.least:
        spans = F.filter(spans, lambda span: F.length(span["value"]) >= kind.least)
    return F.when(text.rlike(kind.gate) & text.rlike(kind.pattern), spans).otherwise(F.expr(f"cast(array() as array<{_SPAN}>)"))


def spans_in(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All spans by start, then kind."""
    return F.array_sort(F.concat(*[_found(text, kind, order) for order, kind in enumerate(kinds)]))


def looks_random(value: Column, kind: Column) -> Column:
    whole_key = (kind == "private_key") & (F.length(value) >= KEY_CHARS)
    return (F.size(F.array_distinct(F.split(value, ""))) >= MIN_DISTINCT_CHARS) & (whole_key | ~value.rlike(_PLACEHOLDER))


def scan(documents: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """Per row its number, doc_id, repository, owner and spans (place, kind, hash of the value, whether it looks random)."""
    found = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        spans_in(whole_text()).alias("spans"),
    )

    def candidate(span: Column) -> Column:
        return F.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            span["kind"].alias("kind"),
            F.sha2(span["value"], 256).alias("hash"),
            looks_random(span["value"], span["kind"]).alias("random"),
        )

    return frozen(found.withColumn("spans", F.transform("spans", candidate)), "secret-spans")


def ownership(scanned: DataFrame) -> DataFrame:
    """Distinct repositories and owners per candidate hash."""
    held = scanned.where(F.size("spans") > 0).select(F.explode(F.array_distinct("spans.hash")).alias("hash"), "repository", "owner")
    return held.distinct().groupBy("hash").agg(F.count_distinct("owner").alias("n_owners"), F.count_distinct("repository").alias("n_repositories"))


# The verdicts under which a credential is masked: it looks real and belongs to few owners.
LIVE = ("live", "spread")


def judged(scanned: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """The scanned rows that have spans, each span with its owners, repositories and verdict.

    Values of many owners are copied examples (shared). Of the others those that look random are live, or spread where many
    repositories of their few owners hold them; the rest is dull.
    """
    counts = frozen(ownership(scanned), "secret-owners").withColumnRenamed("hash", "known")
    each = scanned.where(F.size("spans") > 0).select("row", F.posexplode("spans").alias("place", "span"))
    met = each.join(counts, F.col("span.hash") == F.col("known"))
    wide = F.when(F.col("n_repositories") > max_repositories, "spread").otherwise("live")
    verdict = F.when(F.col("n_owners") > max_owners, "shared").when(F.col("span.random"), wide).otherwise("dull")
    marked = met.select("row", F.struct("span.start", "span.end", "span.kind", verdict.alias("verdict"), "place", "n_owners", "n_repositories").alias("span"))
    return marked.groupBy("row").agg(F.collect_list("span").alias("judged"))  # the spans of one text


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _count(spans: str, field: str, value: str) -> Column:
    return F.size(F.filter(spans, lambda span: span[field] == value)).cast("long").alias(f"n_{value}")


def report(documents: DataFrame, repository: Column, owner: Column, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Per row the counts by kind, all spans with their owners and repositories in the same order, and counts by verdict."""
    scanned = scan(documents, repository, owner)
    base = F.filter("spans", lambda s: s["kind"].isin([kind.name for kind in BASE]))
    counts = [_count("spans", "kind", kind.name) for kind in BASE]
    rows = scanned.select("row", "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
    verdicts = ("live", "spread", "shared", "dull")

    def listed(field: str) -> Column:
        held = F.array_sort(F.transform("judged", lambda s: F.struct(s["place"], s[field].alias("n"))))
        return F.concat_ws(",", F.transform(held, lambda s: s["n"].cast("string"))).alias(field.replace("n_", "span_"))

    found = judged(scanned, max_owners, max_repositories).select(
        "row", *[_count("judged", "verdict", verdict) for verdict in verdicts], listed("n_owners"), listed("n_repositories")
    )
    whole = rows.join(found, "row", "left").drop("row").na.fill(0, [f"n_{verdict}" for verdict in verdicts])
    return whole.na.fill("", ["span_owners", "span_repositories"])


def mask_live(documents: DataFrame, repository: Column, owner: Column, max_owners: int = MAX_OWNERS) -> DataFrame:
    """The documents, all columns, with every live or spread credential replaced by its kind in angle brackets.

    Overlapping live spans are replaced as one, under the kind that starts first.
    """
    number, cuts = free_name(documents, "row"), free_name(documents, "live")
    numbered = frozen(documents.withColumn(number, F.monotonically_increasing_id()), "numbered")
    # The table was just written: its files and so its rows keep their order, and `number` names them.
    found = numbered.select(
        F.col(number).alias("row"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        spans_in(whole_text()).alias("spans"),
    )
    found = found.withColumn(
        "spans",
        F.transform(
            "spans",
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.sha2(s["value"], 256).alias("hash"), looks_random(s["value"], s["kind"]).alias("random")),
        ),
    )
    scanned = frozen(found.where(F.size("spans") > 0), "secret-spans")
    live = judged(scanned, max_owners).select(
        F.col("row").alias(number), F.array_sort(F.filter("judged", lambda s: s["verdict"].isin(*LIVE))).alias(cuts)
    )
    live = live.where(F.size(cuts) > 0)
    text = F.col("text")

    def masked(held: Column) -> Column:
        ends = F.transform(held["cuts"], lambda span: span["end"])

        def parts(reached: Column) -> Column:
            def part(span: Column, i: Column) -> Column:
                at = F.get(reached, i)
                shown = F.concat(cut(held["text"], at, span["start"]), F.lit("<"), span["kind"], F.lit(">"))
                return F.when(span["start"] >= at, shown).otherwise("")

            rest = cut(held["text"], F.array_max(ends), held["size"])
            return F.concat(F.array_join(F.transform(held["cuts"], part), ""), rest)

        return bind(greatest_before(ends), parts)

    held = F.struct(F.col(cuts).alias("cuts"), chunks(text).alias("text"), F.length(text).cast("bigint").alias("size"))
    masked_text = bind(held, masked)
    fixed = numbered.join(live, number, "left")
    return fixed.withColumn("text", F.when(F.col(cuts).isNotNull(), masked_text).otherwise(text)).select(documents.columns)
