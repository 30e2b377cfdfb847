"""License scan with ordered signature rules.

Hundreds of rules (`license_rules`) are gated by a keyword: only the rules whose keyword occurs in a text as a word are
tried. A detection is an interval of the normalised text. It is suppressed when an interval of a rule of the same or a more
telling priority contains it; so a title with its version wins over the bare mention inside it. Only DataFrame functions
are used, and nothing is shuffled: each text is settled in its own row.

Independent of the rules, the places of three fixed phrases are counted, and their labels always stay.

Defined results: a null text is the empty text: no words, no labels, score 0. Of equal intervals the rule that comes first
in priority, then in order, stays. Every input row gives one output row, repeated rows and null ids included. An empty
table gives an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bind, whole_text
from tierflow.llm.license_rules import Rule, rules
from tierflow.llm.running import sums_before

#: Fixed phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Words are runs of ASCII letters and digits and of everything beyond ASCII.
_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def keywords(found_by: list[Rule]) -> list[str]:
    return sorted({rule.keyword for rule in found_by})


def _any_of(words: list[str]) -> str:
    """The words as alternatives, grouped by their first letter so that most places are left after one comparison."""
    groups: dict[str, list[str]] = {}
    for word in words:
        groups.setdefault(word[0], []).append(word[1:])
    return "(?:" + "|".join(f"{first}(?:{'|'.join(rests)})" for first, rests in groups.items()) + ")"


def _gate(found_by: list[Rule]) -> str:
    """One pattern that finds any keyword as a whole word of a lower-case text. Characters beyond ASCII are part of words."""
    return r"(?<![0-9a-z\x{80}-\x{10FFFF}])" + _any_of(keywords(found_by)) + r"(?![0-9a-z\x{80}-\x{10FFFF}])"


def _n_words(text: Column) -> Column:
    """Words by counting the gaps between them, which is several times faster than collecting the words."""
    pieces = F.size(F.split(text, _OTHER, -1))
    opens = F.when(text.rlike("^" + _OTHER), 1).otherwise(0)
    closes = F.when(F.substring(text, -1, 1).rlike(_OTHER), 1).otherwise(0)
    return F.when(text == "", 0).otherwise(pieces - opens - closes).cast("long")


def _normal(text: Column) -> Column:
    """Lower-case words, a blank before and after each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _OTHER, " ")), F.lit(" "))


def _starts(words: Column, phrase: str) -> Column:
    """Word places where the phrase's words stand in a row."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)

    def here(i: Column) -> Column:
        return reduce(lambda a, b: a & b, (F.get(words, i + k) == part for k, part in enumerate(parts)))

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.expr("cast(array() as array<int>)"))


def _rule_table(found_by: list[Rule]) -> Column:
    """The rules as one constant array, in order."""
    rows = [
        F.struct(
            F.lit(rule.label).alias("label"),
            F.lit(rule.keyword).alias("keyword"),
            F.lit(rule.priority).alias("priority"),
            F.lit(place).alias("place"),
            F.lit(rule.score).alias("score"),
            F.lit(f"(?<= )(?:{rule.pattern})(?= )").alias("pattern"),
        )
        for place, rule in enumerate(found_by)
    ]
    return F.array(*rows)


def _detections(normal: Column, found_by: list[Rule]) -> Column:
    """Every interval of every gated rule, by start, then the longer, then the more telling one."""
    present = F.array_distinct(F.regexp_extract_all(normal, F.lit(f"(?<= ){_any_of(keywords(found_by))}(?= )"), F.lit(0)))
    tried = bind(present, lambda words: F.filter(_rule_table(found_by), lambda rule: F.array_contains(words, rule["keyword"])))

    def intervals(rule: Column) -> Column:
        matches = F.regexp_extract_all(normal, rule["pattern"], F.lit(0))
        gaps = F.split(normal, rule["pattern"], -1)
        return bind(F.struct(matches.alias("matches"), gaps.alias("gaps")), lambda both: placed(rule, both["matches"], both["gaps"]))

    def placed(rule: Column, matches: Column, gaps: Column) -> Column:
        sizes = F.transform(matches, lambda match, i: (F.length(F.get(gaps, i)) + F.length(match)).cast("bigint"))

        def one(match: Column, i: Column, before: Column) -> Column:
            start = (F.get(before, i) + F.length(F.get(gaps, i))).cast("int")
            end = start + F.length(match)
            return F.struct(
                start.alias("start"),
                (-end).alias("longer"),
                rule["priority"].alias("priority"),
                rule["place"].alias("place"),
                end.alias("end"),
                rule["label"].alias("label"),
                rule["score"].alias("score"),
            )

        return bind(sums_before(sizes), lambda before: F.transform(matches, lambda match, i: one(match, i, before)))

    return F.array_sort(F.flatten(F.transform(tried, intervals)))


def _surviving(detections: Column) -> Column:
    """Labels and best score after suppression: one walk that keeps, per priority, how far intervals seen so far reach.

    Intervals come by start, the longer first, so an interval seen earlier contains a later one if it ends no earlier.
    """
    levels = range(1, 6)
    begin = F.expr("named_struct(" + ", ".join(f"'m{k}', -1" for k in levels) + ", 'labels', cast(array() as array<string>), 'score', 0D)")

    def step(state: Column, one: Column) -> Column:
        covered = reduce(lambda a, b: a | b, ((one["priority"] >= k) & (state[f"m{k}"] >= one["end"]) for k in levels))
        reach = [F.when(one["priority"] == k, F.greatest(state[f"m{k}"], one["end"])).otherwise(state[f"m{k}"]).alias(f"m{k}") for k in levels]
        labels = F.when(covered, state["labels"]).otherwise(F.array_union(state["labels"], F.array(one["label"])))
        score = F.when(covered, state["score"]).otherwise(F.greatest(state["score"], one["score"]))
        return F.struct(*reach, labels.alias("labels"), score.alias("score"))

    return F.aggregate(detections, begin, step, lambda state: F.struct(state["labels"].alias("labels"), state["score"].alias("score")))


def scan(documents: DataFrame, found_by: list[Rule] | None = None) -> DataFrame:
    """Per row the words, the places of the fixed phrases, their labels, all labels and a score."""
    found_by = rules() if found_by is None else found_by
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # A keyword somewhere in the text: only then is the text normalised and searched.
    gated = F.lower("text").rlike(_gate(found_by))
    rows = rows.select("doc_id", _n_words(F.col("text")).alias("n_words"), F.when(gated, _normal(F.col("text"))).alias("normal"))
    rows = rows.withColumn("words", F.when(F.col("normal").contains(" license "), F.split(F.trim("normal"), " ")))
    starts = [F.when(F.col("words").isNotNull(), _starts(F.col("words"), phrase)).otherwise(F.expr("cast(array() as array<int>)")) for phrase, _ in PHRASES]
    rows = rows.select(
        "doc_id",
        "n_words",
        *[place.alias(f"places{k}") for k, place in enumerate(starts)],
        F.when(F.col("normal").isNotNull(), _surviving(_detections(F.col("normal"), found_by))).alias("kept"),
    )
    places = F.concat(*[F.col(f"places{k}") for k in range(len(PHRASES))])
    base = F.concat(*[F.when(F.size(f"places{k}") > 0, F.array(F.lit(label))).otherwise(F.expr("cast(array() as array<string>)")) for k, (_, label) in enumerate(PHRASES)])
    all_labels = F.array_union(base, F.coalesce("kept.labels", F.expr("cast(array() as array<string>)")))
    return rows.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort(base)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(all_labels)).alias("labels"),
        F.coalesce("kept.score", F.lit(0.0)).alias("score"),
    )
