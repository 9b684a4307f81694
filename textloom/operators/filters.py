"""Rule-based quality filters and validity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import rules
from textloom.functions.text import alpha_ratio, estimate_tokens, let, normalize_clean, or_empty, strip

FENCE = "```"
#: Stock phrases and very short texts are told by so many first characters.
OPENING = 32


LOW_QUALITY = r"(?i)^(?:" + "|".join(p.removeprefix("^") for p in rules.LOW_QUALITY) + ")"


def is_low_quality(text: Column, field: str) -> Column:
    """Blank, out of the field's length bounds, opening like a stock phrase, or with too few letters. Cheap tests come first."""

    def judge(bare: Column) -> Column:
        n = F.char_length(bare)
        bounds = {
            "instruction": (n < rules.MIN_INSTRUCTION) | (n > rules.MAX_INSTRUCTION),
            "output": (n < rules.MIN_OUTPUT) | (n > rules.MAX_OUTPUT),
            "input": n > rules.MAX_INPUT,
        }[field]
        return (n == 0) | bounds | F.substring(bare, 1, OPENING).rlike(LOW_QUALITY) | ((n > rules.ALPHA_FROM) & (alpha_ratio(bare) < rules.MIN_ALPHA))

    return let(strip(or_empty(text)), judge)


def clean_examples(rows: DataFrame, instruction: str = "instruction", input_: str = "input", output: str = "output") -> DataFrame:
    """The three fields normalised; rows with a low-quality field go. An empty input is allowed."""
    rows = rows.withColumns({c: normalize_clean(F.col(c).cast("string")) for c in (instruction, input_, output)})
    return rows.where(~is_low_quality(F.col(instruction), "instruction") & ~is_low_quality(F.col(output), "output") & ((F.col(input_) == "") | ~is_low_quality(F.col(input_), "input")))


def within_token_window(rows: DataFrame, user: str = "user", assistant: str = "assistant", window: tuple[int, int] = rules.TOKEN_WINDOW) -> DataFrame:
    return rows.where((estimate_tokens(F.col(user)) + estimate_tokens(F.col(assistant))).between(*window))


def accepted(score: Column, quality: Column, least: float = 7.0) -> Column:
    return (score >= least) & (quality == "good")


def to_improve(score: Column, issues: Column, least: float) -> Column:
    """Rejected rows worth a rewrite: least is 3.0 for generated sets, 4.0 for harvested ones."""
    return (score >= least) | (F.size(issues) > 0)


def accepted_again(rescored: Column, original: Column, least: float = 7.0) -> Column:
    return (rescored >= least) | (rescored > original)


def messages_valid(messages: Column) -> Column:
    """Two messages at least, each with a role and a non-blank content, and both a last user and a last assistant text."""
    filled = lambda m: m["role"].isNotNull() & (strip(or_empty(m["content"])) != "")
    has = lambda role: F.exists(messages, lambda m: m["role"] == role)
    return F.coalesce((F.size(messages) >= 2) & F.forall(messages, filled) & has("user") & has("assistant"), F.lit(False))


def message_state(messages: Column) -> Column:
    """'corrupt' for fewer than two messages, 'empty' if a content is blank, else 'valid'. Roles don't matter."""
    blank = F.exists(messages, lambda m: strip(or_empty(m["content"])) == "")
    return F.when(messages.isNull() | (F.size(messages) < 2), "corrupt").when(blank, "empty").otherwise("valid")


def field_errors(line: Column, fields: tuple[str, ...] = ("instruction", "input", "output")) -> Column:
    """Errors of a JSON line: not JSON, a missing, empty or non-text field, a code fence."""
    keys = F.json_object_keys(line)
    checks = [F.when(keys.isNull(), F.lit("invalid json"))]
    for field in fields:
        value = F.get_json_object(line, f"$.{field}")
        checks.append(F.when(keys.isNotNull() & ~F.array_contains(keys, field), F.lit(f"missing {field}")).when(keys.isNotNull() & (strip(or_empty(value)) == ""), F.lit(f"empty {field}")))
    fenced = [F.coalesce(F.get_json_object(line, f"$.{field}").contains(FENCE), F.lit(False)) for field in fields]
    any_fence = fenced[0]
    for f in fenced[1:]:
        any_fence = any_fence | f
    checks.append(F.when(keys.isNotNull() & any_fence, F.lit("code fence")))
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def has_keys(line: Column, fields: tuple[str, ...]) -> Column:
    """Whether a JSON line has all keys; a null value counts as present."""
    keys = F.json_object_keys(line)
    return F.coalesce(F.size(F.array_except(F.array(*map(F.lit, fields)), keys)) == 0, F.lit(False))
