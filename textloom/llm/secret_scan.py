"""Secret scan: three base patterns, and a battery of randomness tests for long tokens.

All in DataFrame expressions. A match's position is found from what lies between matches: the pieces of a
split by the pattern and the matches themselves alternate, so running sums of their lengths are offsets.

The battery takes each long token that no base match touches, infers its encoding ('=' ends a token; one that
mixes '+' or '/' with '_' or '-' is no encoding's and is cut at either pair of them), maps its characters to
numbers and tests them against independent uniform draws: a chi-squared test of five bins of the
alphabet, a runs test around the alphabet's middle and a lag-one serial correlation. The smallest
p-value, corrected for three tests, is uniform for random tokens and near 0 for words, paths and names.
What is found at a threshold t among tokens of one length class holds about random * (1 - t) random
tokens; the rest are false discoveries. Each class takes the least threshold that keeps their share
below FALSE_DISCOVERY_RATE, from counts over the whole corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import staged, text_or_empty

#: Fixed values of the base kinds: pattern, and the least length in characters of what ``measured`` takes.
ASSIGN = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: Encodings by precedence: name, pattern of a whole token without padding, alphabet in order of value.
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", UPPER + "234567"),
    ("lower base32", r"^[a-z2-7]+$", LOWER + "234567"),
    ("base36", r"^[0-9a-z]+$", DIGITS + LOWER),
    ("BASE36", r"^[0-9A-Z]+$", DIGITS + UPPER),
    ("base64", r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
)
#: What is tested: a token that '=' only ends, and the parts of one that fits no encoding, cut at '_' and '-' or at '+' and '/'.
PIECE, PARTS = r"[A-Za-z0-9+/_-]{20,}=*", (r"[A-Za-z0-9+/]{20,}=*", r"[A-Za-z0-9_-]{20,}=*")
BINS = 5
FALSE_DISCOVERY_RATE = 0.05
GRID = 50
#: A class with fewer random tokens than this, as estimated, takes the strictest threshold.
LEAST_THRESHOLD = 0.02


#: Running values are made in chunks of so many, and their chunks' values in chunks again, so no array is copied more than this often.
CHUNK, CHUNK_LEVELS = 64, 2


def bound(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, zero: Column, merge, levels: int = CHUNK_LEVELS) -> Column:
    """array: for each of values what merge makes of those before it, starting at zero. Linear in their number."""

    def simply(part: Column, first: Column) -> Column:
        empty = F.filter(F.array(first), lambda _: F.lit(False))
        start = F.struct(first.alias("at"), empty.alias("out"))
        return F.aggregate(part, start, lambda acc, v: F.struct(merge(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    if not levels:
        return simply(values, zero)

    def in_chunks(values: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(CHUNK))

        def with_offsets(chunks: Column) -> Column:
            offsets = running(F.transform(chunks, lambda c: F.aggregate(c, zero, merge)), zero, merge, levels - 1)
            return F.flatten(F.zip_with(chunks, offsets, simply))

        return bound(F.transform(firsts, lambda i: F.slice(values, i, F.lit(CHUNK))), with_offsets)

    return bound(values, in_chunks)


def match_spans(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, n, hit>> of the leftmost non-overlapping matches, in code points; n: characters of the group."""
    zero, whole = F.lit(0), "array<struct<start:int,end:int,n:int,hit:string>>"

    def placed(found: Column) -> Column:
        def spans(lengths: Column) -> Column:
            starts = running(F.transform(lengths, lambda x: x["gap"] + x["hit"]), zero, lambda a, b: a + b)

            def span(x: Column, before: Column) -> Column:
                start = before + x["gap"]
                return F.struct(start.alias("start"), (start + x["hit"]).alias("end"), x["n"].alias("n"), x["own"].alias("hit"))

            return F.zip_with(lengths, starts, span)

        gaps = F.split(text, pattern, -1)
        size = lambda hit: F.char_length(hit if group == 0 else F.regexp_extract(hit, pattern, group))
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, hit: F.struct(F.char_length(gap).alias("gap"), F.char_length(hit).alias("hit"), size(hit).alias("n"), hit.alias("own")))
        return F.when(F.size(found) > 0, bound(lengths, spans).cast(whole)).otherwise(F.array().cast(whole))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|): the rational approximation of erfc to 1.5e-7 (Abramowitz and Stegun 7.1.26)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + 0.3275911 * x)
    return t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x)


def battery(token: Column) -> Column:
    """The corrected p-value of a token under random draws from its inferred alphabet; null where none fits."""
    bare = F.regexp_replace(token, "=+$", "")
    out = F.lit(None).cast("double")
    for _, pattern, alphabet in reversed(ENCODINGS):
        out = F.when(bare.rlike(pattern), _battery_over(bare, alphabet)).otherwise(out)
    return out


def _battery_over(token: Column, alphabet: str) -> Column:
    k = len(alphabet)
    values = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    sizes = [sum(v * BINS // k == b for v in range(k)) for b in range(BINS)]
    zero = F.struct(F.lit(-1).alias("last"), *[F.lit(0).alias(f"b{b}") for b in range(BINS)], F.lit(0).alias("turns"), F.lit(0.0).alias("serial"))
    middle = (k - 1) / 2

    def step(acc, v):
        began = acc["last"] >= 0
        turn = began & ((acc["last"] * 2 >= k) != (v * 2 >= k))
        product = (acc["last"] - F.lit(middle)) * (v - F.lit(middle))
        return F.struct(
            v.alias("last"),
            *[(acc[f"b{b}"] + (F.floor(v * BINS / k) == b).cast("int")).alias(f"b{b}") for b in range(BINS)],
            (acc["turns"] + turn.cast("int")).alias("turns"),
            (acc["serial"] + F.when(began, product).otherwise(F.lit(0.0))).alias("serial"),
        )

    def finish(acc):
        n = sum((acc[f"b{b}"] for b in range(1, BINS)), acc["b0"]).cast("double")
        half = sum(((acc[f"b{b}"] - n * (size / k)) * (acc[f"b{b}"] - n * (size / k)) / (n * (size / k)) for b, size in enumerate(sizes)), F.lit(0.0)) / 2
        chi = F.exp(-half) * (1 + half)  # four degrees of freedom
        runs = _normal_two_sided((acc["turns"] - (n - 1) / 2) / F.sqrt((n - 1) / 4))
        serial = _normal_two_sided(acc["serial"] / ((k * k - 1) / 12) / F.sqrt(n - 1))
        least = F.least(chi, runs, serial)
        return 1 - F.pow(1 - F.least(least, F.lit(1.0)), F.lit(3.0))

    return F.when(F.char_length(token) >= 20, F.aggregate(values, zero, step, finish))


def length_class(n: Column) -> Column:
    """Tokens of 20 to 27, 28 to 39, 40 to 55, ... characters: half-octaves."""
    return F.floor(2 * F.log2(n / 20.0)).cast("int")


def thresholds(tokens: DataFrame, rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """length_class, threshold: at most a row for each half-octave of length.

    The number of random tokens of a class is estimated from p above one half, where others hardly come.
    """
    cells = tokens.groupBy("length_class", F.least(F.floor(F.col("p") * GRID), F.lit(GRID - 1)).cast("int").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    table = cells.groupBy("length_class").agg(F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("n_at"))
    count = lambda low: F.aggregate(F.sequence(F.lit(low), F.lit(GRID - 1)), F.lit(0).cast("long"), lambda a, c: a + F.coalesce(F.try_element_at("n_at", c), F.lit(0)))
    random = F.least(2.0 * count(GRID // 2), count(0).cast("double"))
    good = []
    for cell in range(1, GRID // 2 + 1):
        found = count(cell).cast("double")
        false = F.greatest(F.lit(0.0), found - random * (1 - cell / GRID))
        good.append(F.when((found > 0) & (false <= rate * found), F.lit(cell / GRID)))
    return table.select("length_class", F.coalesce(*good, F.lit(0.5)).alias("threshold"))


def candidates(text: Column) -> Column:
    """array<struct<start, end, n, hit>> of what the battery takes; parts by the two cuts may overlap, equal ones are there once."""

    def cut(piece):
        own = piece["hit"]
        moved = lambda s: F.struct((piece["start"] + s["start"]).alias("start"), (piece["start"] + s["end"]).alias("end"), s["n"].alias("n"), s["hit"].alias("hit"))
        parts = F.array_distinct(F.concat(*[F.transform(match_spans(own, pattern), moved) for pattern in PARTS]))
        return F.when(own.rlike("[+/]") & own.rlike("[_-]"), parts).otherwise(F.array(piece))

    return F.flatten(F.transform(match_spans(text, PIECE), cut))


KINDS = ("assign", "access", "hex", "random")
FAR = (1 << 31) - 1


def free_of(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others, by start.

    Both are merged by start. A span is overlapped by an other that starts no later if the largest end so
    far lies beyond its start, and by one that starts later if the next one to start does so before its end.
    """
    empty = F.lit("")
    mine = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(True).alias("mine"), s["end"].alias("end"), s["n"].alias("n"), s["hit"].alias("hit")))
    theirs = F.transform(others, lambda s: F.struct(s["start"].alias("start"), F.lit(False).alias("mine"), s["end"].alias("end"), s["n"].alias("n"), empty.alias("hit")))

    def kept(merged: Column) -> Column:
        reached = running(F.transform(merged, lambda s: F.when(s["mine"], 0).otherwise(s["end"])), F.lit(0), lambda a, b: F.greatest(a, b))
        coming = F.reverse(running(F.transform(F.reverse(merged), lambda s: F.when(s["mine"], FAR).otherwise(s["start"])), F.lit(FAR), lambda a, b: F.least(a, b)))
        marked = F.arrays_zip(merged.alias("span"), reached.alias("reached"), coming.alias("coming"))
        return F.transform(F.filter(marked, lambda m: m["span"]["mine"] & (m["reached"] <= m["span"]["start"]) & (m["coming"] >= m["span"]["end"])), lambda m: m["span"])

    return F.when(F.size(others) == 0, mine).otherwise(bound(F.sort_array(F.concat(mine, theirs)), kept))


def outermost(spans: Column) -> Column:
    """Distinct spans (start, end, ...) without those that lie within a longer one."""
    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"))))

    def kept(ordered: Column) -> Column:
        marked = F.arrays_zip(ordered.alias("span"), running(F.transform(ordered, lambda s: -s["back"]), F.lit(0), lambda a, b: F.greatest(a, b)).alias("reached"))
        return F.transform(F.filter(marked, lambda m: m["reached"] < -m["span"]["back"]), lambda m: F.struct(m["span"]["start"].alias("start"), (-m["span"]["back"]).alias("end")))

    return bound(by_start, kept)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, assign, access, hex (span arrays) and tokens (spans with p and length_class)."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["n"].alias("n"))
    rows = rows.select(
        "doc_id",
        F.transform(F.filter(match_spans(text, ASSIGN, 2), lambda s: s["n"] >= ASSIGN_LEAST), plain).alias("assign"),
        F.transform(F.filter(match_spans(text, ACCESS), lambda s: s["n"] >= ACCESS_LEAST), plain).alias("access"),
        F.transform(match_spans(text, HEX), plain).alias("hex"),
        candidates(text).alias("candidates"),
    )
    free = bound(F.concat("assign", "access", "hex"), lambda base: free_of(F.col("candidates"), base))
    tokens = F.transform(free, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), battery(c["hit"]).alias("p"), length_class(c["n"].cast("double")).alias("length_class")))
    return rows.select("doc_id", "assign", "access", "hex", F.filter(tokens, lambda t: t["p"].isNotNull()).alias("tokens"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Spans are kind:start:end by start, then kind in the order of KINDS; positions in code points, the end
    exclusive. A random part within a longer random part is not told again. Null and empty texts have none;
    an empty table gives no rows. Ids are passed on as they are, nulls and repeats too, and repeated rows are
    each told. Of spans that start together the earlier kind comes first. The text is read once, in time
    linear in its length and in its tokens; what is found in it is written to the shared folder, then
    thresholds come from counts over all tokens and join back by length class (under a hundred rows, so broadcast).
    """
    found = staged(scan(docs, id_col, text_col), "secret-spans")
    limits = thresholds(found.select(F.explode("tokens").alias("t")).select("t.*"), rate)
    by_class = limits.agg(F.map_from_entries(F.collect_list(F.struct("length_class", "threshold"))).alias("limits"))
    rows = found.join(F.broadcast(by_class))  # one row
    random = F.filter("tokens", lambda t: t["p"] >= F.greatest(F.lit(LEAST_THRESHOLD), F.coalesce(F.try_element_at("limits", t["length_class"]), F.lit(1.0))))
    rows = rows.withColumn("random", outermost(random))

    def numbered(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))

    def ordered(*kinds: str) -> Column:
        lists, named = [numbered(kind) for kind in kinds], F.array(*map(F.lit, KINDS))
        return F.array_join(F.transform(F.sort_array(F.concat(*lists)), lambda s: F.concat_ws(":", F.get(named, s["kind"]), s["start"], s["end"])), ",")

    return rows.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(ordered(*KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
        ordered(*KINDS).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )
