"""SQL fragments that several oracles share (DuckDB; patterns in the subset that both engines read alike)."""

from __future__ import annotations

from textloom.functions import rules


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def clean(x: str) -> str:
    return strip(f"regexp_replace(regexp_replace(regexp_replace({x}, '\\r\\n?', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), '[ \\t]+', ' ', 'g')")


def fold(x: str) -> str:
    return strip(f"regexp_replace(lower({x}), '\\s+', ' ', 'g')")


def fold_ends(x: str) -> str:
    return f"lower({strip(x)})"


def markdown(x: str) -> str:
    links = f"regexp_replace(replace({x}, chr(13) || chr(10), chr(10)), '\\[([^\\]]+)\\]\\([^\\)]+\\)', '\\1', 'g')"
    return strip(f"regexp_replace({links}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def tokens(x: str) -> str:
    return f"greatest(len(list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')), trunc(length({x}) / 3.8::DOUBLE)::INT)"


def alpha(x: str) -> str:
    return f"(length(regexp_replace({x}, '[^\\p{{L}}]', '', 'g'))::DOUBLE / nullif(length({x}), 0))"


def low_quality(x: str, field: str) -> str:
    bare = strip(x)
    n = f"length({bare})"
    bounds = {"instruction": f"{n} < 20 OR {n} > 2000", "output": f"{n} < 50 OR {n} > 8000", "input": f"{n} > 4000"}[field]
    pattern = quoted("(?i)" + "|".join(f"(?:{p})" for p in rules.LOW_QUALITY))
    return f"({n} = 0 OR {bounds} OR regexp_matches({bare}, {pattern}) OR ({n} > 20 AND {alpha(bare)} < 0.3))"


def any_of(x: str, patterns: list[str], flags: str = "") -> str:
    return f"regexp_matches({x}, {quoted(flags + '|'.join(f'(?:{p})' for p in patterns))})"


def hits(x: str, patterns: list[str]) -> str:
    return "(" + " + ".join(f"regexp_matches({x}, {quoted('(?i)' + p)})::INT" for p in patterns) + ")"


def v3(user: str, assistant: str) -> str:
    whole = f"lower({user} || chr(10) || {assistant})"
    return f"CASE WHEN {any_of(whole, rules.V3_EXPERT)} THEN 'expert' WHEN {any_of(whole, rules.V3_ADVANCED)} THEN 'advanced' WHEN {any_of(whole, rules.V3_BEGINNER)} THEN 'beginner' ELSE 'intermediate' END"


def v2(user: str, assistant: str) -> str:
    whole = f"lower({user} || chr(10) || {assistant})"
    return f"CASE WHEN {any_of(whole, rules.V2_EXPERT)} THEN 'expert' WHEN {any_of(whole, rules.V2_ADVANCED)} THEN 'advanced' WHEN {any_of(f'lower({user})', rules.V2_BEGINNER)} AND length({assistant}) < 600 THEN 'beginner' ELSE 'intermediate' END"


def counted(parts: list[str]) -> str:
    whole = " || chr(10) || ".join(f"lower({p})" for p in parts)
    adv, n = hits(whole, rules.COUNTED_ADVANCED), f"length({parts[2]})"
    return (
        f"CASE WHEN {any_of(whole, rules.COUNTED_EXPERT, '(?i)')} THEN 'expert' WHEN {adv} >= 2 OR ({n} > 800 AND {adv} >= 1) THEN 'advanced' "
        f"WHEN {any_of(whole, rules.COUNTED_INTERMEDIATE, '(?i)')} OR {adv} = 1 OR {n} > 300 THEN 'intermediate' ELSE 'beginner' END"
    )


def category(x: str) -> str:
    folded = f"replace(lower({strip(x)}), '_', ' ')"
    cases = " ".join("WHEN " + " OR ".join(f"contains({folded}, '{w}')" for w in words) + f" THEN '{name}'" for name, words in rules.CATEGORIES)
    return f"CASE {cases} ELSE '{rules.OTHER_CATEGORY}' END"


def word_set(x: str) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-z0-9_]{{3,}}')))"


def order_key(x: str) -> str:
    return f"md5('42|' || {x})"


PAIRS = f"""
SELECT conv_id, {strip("arg_max(text, turn) FILTER (role = 'user')")} AS "user", {strip("arg_max(text, turn) FILTER (role = 'assistant')")} AS assistant
FROM conversations GROUP BY conv_id
HAVING {strip("arg_max(text, turn) FILTER (role = 'user')")} <> '' AND {strip("arg_max(text, turn) FILTER (role = 'assistant')")} <> ''
"""
TIERS = "(SELECT doc_id, text, lang, source, CASE WHEN n_chars < 600 THEN 'beginner' WHEN n_chars < 2500 THEN 'intermediate' WHEN n_chars < 8000 THEN 'advanced' ELSE 'expert' END AS tier FROM documents)"
