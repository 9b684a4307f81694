"""Rule cascades: difficulty, category, labels of scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import rules
from textloom.functions.text import let, or_empty, strip


def any_of(text: Column, patterns: list[str], flags: str = "(?U)") -> Column:
    """One scan for all patterns of a tier; they all open with a word boundary, which is tested first."""
    return text.rlike(flags + r"\b(?:" + "|".join(p.removeprefix(r"\b") for p in patterns) + ")")


def hits(text: Column, patterns: list[str]) -> Column:
    """How many of the patterns occur; counted one by one only where any does."""
    each = sum((text.rlike(f"(?U){p}").cast("int") for p in patterns[1:]), text.rlike(f"(?U){patterns[0]}").cast("int"))
    return F.when(any_of(text, patterns), each).otherwise(0)


def difficulty_v3(user: Column, assistant: Column) -> Column:
    def grade(whole: Column) -> Column:
        return F.when(any_of(whole, rules.V3_EXPERT), "expert").when(any_of(whole, rules.V3_ADVANCED), "advanced").when(any_of(whole, rules.V3_BEGINNER), "beginner").otherwise("intermediate")

    return let(F.lower(F.concat(or_empty(user), F.lit("\n"), or_empty(assistant))), grade)


def difficulty_v2(user: Column, assistant: Column) -> Column:
    """Beginner questions are told by the user text alone, and only with a short answer."""
    easy = any_of(F.lower(or_empty(user)), rules.V2_BEGINNER) & (F.char_length(or_empty(assistant)) < rules.V2_BEGINNER_ANSWER)

    def grade(whole: Column) -> Column:
        return F.when(any_of(whole, rules.V2_EXPERT), "expert").when(any_of(whole, rules.V2_ADVANCED), "advanced").when(easy, "beginner").otherwise("intermediate")

    return let(F.lower(F.concat(or_empty(user), F.lit("\n"), or_empty(assistant))), grade)


def difficulty_counted(instruction: Column, input_: Column, output: Column) -> Column:
    """By how many of a tier's patterns occur; the text is lower-cased, and so are all patterns that match."""
    n = F.char_length(F.lower(or_empty(output)))

    def grade(whole: Column) -> Column:
        def below_expert(advanced: Column) -> Column:
            return (
                F.when((advanced >= 2) | ((n > rules.ADVANCED_LONG) & (advanced >= 1)), "advanced")
                .when((advanced == 1) | (n > rules.INTERMEDIATE_LONG) | any_of(whole, rules.COUNTED_INTERMEDIATE), "intermediate")
                .otherwise("beginner")
            )

        return F.when(any_of(whole, rules.COUNTED_EXPERT), "expert").otherwise(let(hits(whole, rules.COUNTED_ADVANCED), below_expert))

    return let(F.lower(F.concat_ws("\n", *map(or_empty, (instruction, input_, output)))), grade)


def declared_or(declared: Column, inferred: Column) -> Column:
    tier = F.lower(strip(declared))
    return F.when(tier.isin(rules.DIFFICULTIES), tier).otherwise(inferred)


def normalize_category(name: Column) -> Column:
    folded = F.regexp_replace(F.lower(strip(or_empty(name))), "_", " ")
    out = F.lit(rules.OTHER_CATEGORY)
    for category, words in reversed(rules.CATEGORIES):
        found = folded.contains(words[0])
        for w in words[1:]:
            found = found | folded.contains(w)
        out = F.when(found, category).otherwise(out)
    return out


def clamp_score(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(10.0), score))


def score_quality(score: Column, verdict: Column) -> Column:
    """A valid verdict, or else good from 7 on."""
    return F.when(F.lower(verdict).isin("good", "bad"), F.lower(verdict)).otherwise(F.when(clamp_score(score) >= 7.0, "good").otherwise("bad"))


def score_difficulty(score: Column) -> Column:
    return F.when(score >= 9.0, "advanced").when(score >= 7.0, "intermediate").otherwise("beginner")


def readiness_label(score: Column) -> Column:
    return F.when(score >= 80.0, "READY FOR PRODUCTION TRAINING").when(score >= 65.0, "READY (RECOMMENDED MINOR EXPANSION)").otherwise("NEEDS REVISION")
