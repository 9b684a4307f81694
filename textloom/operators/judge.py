"""Scores and rewrites by an injected callable, kept in a store that a later run goes on from.

The callable stands for a model: it gets examples and a model's name and returns an answer in JSON for
each. Answers are kept by the hash of what was asked, a file a batch, so a run that is killed loses the
batches it was in and nothing else; the next one asks for what the store lacks.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import or_empty, strip, triple_md5
from textloom.operators import filters

Ask = Callable[[list[dict], str], list[str | None]]
FIELDS = ("instruction", "input", "output")
# fixed values: levels, and what a row gets when no model gives a usable answer
LEVELS = ("beginner", "intermediate", "advanced", "expert")
NO_ANSWER = {"score": 5.0, "quality": "bad", "difficulty": None, "issues": ["Validation quota reached across models or parsing issue."], "suggestion": "Retry with higher quota tier or wait for minute window reset."}
DUPLICATE_ISSUE = "Duplicate content detected in dataset."

VERDICT = pa.schema([("key", pa.string()), ("score", pa.float64()), ("quality", pa.string()), ("difficulty", pa.string()), ("issues", pa.list_(pa.string())), ("suggestion", pa.string()), ("answered", pa.bool_())])
VERDICT_SQL = "key string, score double, quality string, difficulty string, issues array<string>, suggestion string, answered boolean"
REWRITE = pa.schema([("key", pa.string()), *[(c, pa.string()) for c in FIELDS], ("answered", pa.bool_())])
REWRITE_SQL = "key string, instruction string, input string, output string, answered boolean"


def json_answer(text: str):
    """The JSON value of an answer: without code fences, or else from the first { to the last }; None if neither parses."""
    bare = re.sub(r"\s*```$", "", re.sub(r"^```\s*", "", re.sub(r"^```json\s*", "", text.strip(), flags=re.IGNORECASE)))
    inner = re.search(r"\{.*\}", bare, re.DOTALL)
    for candidate in [bare, *([inner[0]] if inner else [])]:
        try:
            return json.loads(candidate)
        except json.JSONDecodeError:
            continue
    return None


def verdict(answer: str | None, example: dict) -> dict | None:
    """Score from 0 to 10, quality, difficulty, issues and suggestion of an answer; None where it has no usable score."""
    found = json_answer(answer) if answer else None
    if not isinstance(found, dict) or "score" not in found:
        return None
    try:
        score = max(0.0, min(10.0, float(found["score"])))
    except (TypeError, ValueError):
        return None
    quality = found.get("quality")
    if "quality" in found and not isinstance(quality, str):
        return None
    named = quality.lower() if quality and quality.lower() in ("good", "bad") else None
    issues = found.get("issues", [])
    issues = [issues] if isinstance(issues, str) else issues if isinstance(issues, list) else []
    level = str(found.get("difficulty", "intermediate")).strip().lower()
    if level not in LEVELS:
        level = "advanced" if score >= 9.0 else "intermediate" if score >= 7.0 else "beginner"
    return {"score": round(score, 1), "quality": named or ("good" if score >= 7.0 else "bad"), "difficulty": level, "issues": [x if isinstance(x, str) else json.dumps(x) for x in issues], "suggestion": str(found.get("suggestion", "")).strip()}


def rewritten(answer: str | None, example: dict) -> dict | None:
    """The three fields of a rewrite, trimmed, the example's own input and output where they are left out; None without instruction and output."""
    found = json_answer(answer) if answer else None
    if not isinstance(found, dict) or not {"instruction", "output"} <= set(found):
        return None
    fields = {c: found.get(c, example[c]) for c in FIELDS}
    return {c: v.strip() for c, v in fields.items()} if all(isinstance(v, str) for v in fields.values()) else None


def answers(ask: Ask, read: Callable[[str | None, dict], dict | None], examples: list[dict], models: list[str], retries: int, pause: float) -> list[dict | None]:
    """What each example is answered, over models and retries; only those without a usable answer are asked again.

    An error that speaks of a quota ends the tries of its model. Retries wait ``pause`` seconds times their number.
    """
    found: list[dict | None] = [None] * len(examples)
    for model in models:
        for attempt in range(1, retries + 1):
            still = [k for k, x in enumerate(found) if x is None]
            if not still:
                return found
            try:
                for k, answer in zip(still, ask([examples[k] for k in still], model), strict=True):
                    found[k] = read(answer, examples[k])
            except Exception as error:  # noqa: BLE001  whatever a model raises counts as no answer
                if "429" in str(error) or "quota" in str(error).lower():
                    break
            if attempt < retries and None in found:
                time.sleep(pause * attempt)
    return found


class AnswerStore:
    """Answers by key in a folder that all executors share: a Parquet file for each batch, written under another name first.

    A file's name comes from its batch's keys, so a task that is tried again finds what it has stored.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: pa.Schema, sql: str):
        self.spark, self.folder, self.schema, self.sql = spark, folder, schema, sql

    def stored(self) -> DataFrame:
        """All rows as they were stored."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        there = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)
        return self.spark.read.schema(self.sql).option("pathGlobFilter", "answers-*.parquet").parquet(self.folder) if there else self.spark.createDataFrame([], self.sql)

    def answers(self) -> DataFrame:
        """One row a key: speculative tries may have stored a key twice."""
        return self.stored().dropDuplicates(["key"])

    def fill(self, rows: DataFrame, ask: Ask, read, default: Callable[[dict], dict], models: list[str], retries: int = 3, pause: float = 2.0, batch_rows: int = 64, tasks: int | None = None) -> int:
        """Asks for the rows (key, then the example's columns; one a key) that the store lacks; returns how many those are.

        tasks: how many batches are asked at the same time at most, where the model has a rate limit.
        """
        folder, schema, names = self.folder, self.schema, [c for c in rows.columns if c != "key"]
        missing = rows.join(self.stored().select("key").distinct(), "key", "left_anti")
        missing = (missing.repartition(tasks, "key") if tasks else missing).sortWithinPartitions("key")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, root = fs.FileSystem.from_uri(folder)
            store.create_dir(root, recursive=True)
            for batch in batches:
                for at in range(0, batch.num_rows, batch_rows):
                    own = batch.slice(at, batch_rows).to_pylist()
                    name = f"{root}/answers-{hashlib.sha256('|'.join(x['key'] for x in own).encode()).hexdigest()}.parquet"
                    if store.get_file_info(name).type == fs.FileType.NotFound:
                        examples = [{c: x[c] for c in names} for x in own]
                        found = answers(ask, read, examples, models, retries, pause)
                        done = [{"key": x["key"], "answered": y is not None, **(y or default(e))} for x, y, e in zip(own, found, examples, strict=True)]
                        data = io.BytesIO()
                        pq.write_table(pa.Table.from_pylist(done, schema), data)
                        draft = f"{root}/.draft-{hashlib.sha256(f'{name}{time.time_ns()}'.encode()).hexdigest()}"
                        with store.open_output_stream(draft) as out:
                            out.write(data.getvalue())
                        store.move(draft, name)
                    yield pa.RecordBatch.from_pydict({"n": pa.array([len(own)], pa.int64())})

        return missing.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _examples(rows: DataFrame, key: str, *more: str) -> DataFrame:
    """key and the fields, trimmed, one row a key."""
    return rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), *[strip(or_empty(F.col(c))).alias(c) for c in FIELDS], *more).dropDuplicates(["key"])


class Judge:
    """Verdicts of examples by the hash of their three fields. options: retries, pause, batch_rows, tasks."""

    def __init__(self, spark: SparkSession, folder: str, ask: Ask, models: list[str], **options):
        self.store, self.ask, self.models, self.options = AnswerStore(spark, folder, VERDICT, VERDICT_SQL), ask, models, options

    def fill(self, rows: DataFrame, key: str = "hash") -> int:
        """Judges the examples that have no verdict yet; returns how many. A null key is passed over."""
        return self.store.fill(_examples(rows, key), self.ask, verdict, lambda _: NO_ANSWER, self.models, **self.options)

    def verdicts(self, rows: DataFrame, key: str = "hash", prefix: str = "") -> DataFrame:
        """rows with the columns of the verdicts that are there, nulls where there is none."""
        own = self.store.answers().drop("answered")
        return rows.join(own.select(F.col("key").alias("__key"), *[F.col(c).alias(prefix + c) for c in own.columns if c != "key"]), F.col(key) == F.col("__key"), "left").drop("__key")

    def scored(self, rows: DataFrame, key: str = "hash", prefix: str = "") -> DataFrame:
        """rows with their verdicts, those that have none yet judged first."""
        self.fill(rows, key)
        return self.verdicts(rows, key, prefix)


class Rewriter:
    """Rewrites of examples by the hash of their fields and the feedback. Without a usable answer the store has a row without fields, which stands for the example as it is."""

    def __init__(self, spark: SparkSession, folder: str, ask: Ask, models: list[str], **options):
        self.store, self.ask, self.models, self.options = AnswerStore(spark, folder, REWRITE, REWRITE_SQL), ask, models, options

    @staticmethod
    def asked(key: str = "hash") -> Column:
        """The key of a rewrite: the example's hash, its issues and the suggestion."""
        return F.md5(F.concat_ws("\u0001", F.col(key), F.array_join("issues", "\u0002"), or_empty(F.col("suggestion"))))

    def fill(self, rows: DataFrame, key: str = "hash") -> int:
        """Rewrites the examples (rows have issues and suggestion too) that have no rewrite yet; returns how many."""
        keyed = rows.withColumn("__ask", self.asked(key))
        return self.store.fill(_examples(keyed, "__ask", "issues", "suggestion"), self.ask, rewritten, lambda _: dict.fromkeys(FIELDS), self.models, **self.options)

    def answered(self) -> DataFrame:
        """key and the fields of usable rewrites."""
        return self.store.answers().where("answered").drop("answered")


def _seen(kinds: DataFrame) -> DataFrame:
    """hash, seen: the first place at which a content counts as taken.

    kinds: hash, first (its first place), direct (taken as it is), new_hash (what its rewrite takes, or
    null). A content that is only known by rewrites is taken where the first of those rows stands that is
    no duplicate itself, so the table is computed again until it stays as it is: once more than rewrites
    of rewrites stand behind each other in the input, which is hardly ever more than once.
    """
    direct = kinds.where("direct").select("hash", F.col("first").alias("seen"))
    made = kinds.where("new_hash IS NOT NULL").select("hash", "first", "new_hash").join(kinds.select(F.col("hash").alias("new_hash")), "new_hash", "left_semi").checkpoint()
    now = direct.checkpoint()
    while True:
        live = made.join(now, "hash", "left").where("seen IS NULL OR first <= seen").select(F.col("new_hash").alias("hash"), F.col("first").alias("seen"))
        new = direct.unionByName(live).groupBy("hash").agg(F.min("seen").alias("seen")).checkpoint()
        if not new.exceptAll(now).union(now.exceptAll(new)).take(1):
            return new
        now = new


def reviewed(rows: DataFrame, order: str, judge: Judge, rewriter: Rewriter | None = None, least: float = 7.0, improve_from: float = 3.0) -> DataFrame:
    """rows with status, original_score, final_score, final_difficulty, issues, improvements and the fields to keep (kept_instruction, kept_input, kept_output).

    status: 'accepted' as it is, 'improved' by a rewrite that scores enough or more than before, 'rejected',
    or 'duplicate' of a content that an earlier row (by ``order``, unique integers) was kept with. Each
    distinct content is judged and rewritten once. A rejected content may come again and is rejected again.
    Columns of rows that have the name of a new one make way for it.
    """
    hashed = rows.withColumn("__hash", triple_md5(*[F.col(c) for c in FIELDS]))
    examples = hashed.select(F.col("__hash").alias("hash"), *FIELDS)
    judge.fill(examples)
    kinds = judge.verdicts(hashed.groupBy(F.col("__hash").alias("hash")).agg(F.min(order).alias("first")))
    kinds = kinds.withColumn("direct", filters.accepted(F.col("score"), F.col("quality"), least)).checkpoint()
    if rewriter is None:
        nothing = {"ask": "string", "new_hash": "string", "re_score": "double", "re_difficulty": "string"}
        known = kinds.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    else:
        weak = kinds.where(~F.col("direct") & filters.to_improve(F.col("score"), F.col("issues"), improve_from)).select("hash", "issues", "suggestion")
        rewriter.fill(examples.join(weak, "hash"))
        made = rewriter.answered().select("key", triple_md5(*[F.col(c) for c in FIELDS]).alias("made"), *FIELDS)
        judge.fill(made, "made")
        new = weak.select("hash", rewriter.asked().alias("ask")).join(made.select(F.col("key").alias("ask"), "made"), "ask", "left").select("hash", "ask", F.coalesce("made", "hash").alias("new_hash"))
        again = judge.verdicts(new, "new_hash").select("hash", "ask", "new_hash", F.col("score").alias("re_score"), F.col("difficulty").alias("re_difficulty"))
        known = kinds.join(again, "hash", "left")
    improved = F.col("re_score").isNotNull() & filters.accepted_again(F.col("re_score"), F.col("score"), least)
    known = known.withColumn("improved", F.coalesce(improved, F.lit(False))).checkpoint()
    seen = _seen(known.select("hash", "first", "direct", F.when(F.col("improved"), F.col("new_hash")).alias("new_hash")))
    facts = known.join(seen, "hash", "left").drop("first", "new_hash")
    joined = hashed.join(facts.select(*[F.col(c).alias(f"__{c}") for c in facts.columns]), "__hash")
    if rewriter is None:
        joined = joined.withColumns({f"__new_{c}": F.lit(None).cast("string") for c in FIELDS}).withColumn("__key", F.lit(None).cast("string"))
    else:
        taken = rewriter.answered().join(facts.where("improved").select(F.col("ask").alias("key")).distinct(), "key", "left_semi")
        joined = joined.join(taken.select(F.col("key").alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in FIELDS]), F.coalesce("__ask", "__hash") == F.col("__key"), "left")  # rows that ask nothing, which are most, are spread by their hash
    status = F.when(F.col(order) > F.col("__seen"), "duplicate").when(F.col("__direct"), "accepted").when(F.col("__improved"), "improved").otherwise("rejected")
    joined = joined.withColumn("__status", status)
    copy, kept, better = F.col("__status") == "duplicate", F.col("__status") == "accepted", F.col("__status") == "improved"
    scores = F.format_string("Rewritten with step-by-step reasoning and technical tooling. (Score %.1f -> %.1f)", "__score", "__re_score")
    applied = F.when(or_empty(F.col("__suggestion")) != "", F.concat(F.lit("Applied suggestion: "), F.col("__suggestion")))
    steps = F.when(kept, F.array(F.lit("Passed initial validation without modification."))).when(better, F.array_compact(F.array(scores, applied)))
    added = {
        "status": F.col("__status"),
        "original_score": F.when(copy, 0.0).otherwise(F.col("__score")),
        "final_score": F.when(copy, 0.0).otherwise(F.coalesce("__re_score", "__score")),
        "final_difficulty": F.when(~copy, F.coalesce("__re_difficulty", "__difficulty", F.lit("intermediate"))),
        "issues": F.when(copy, F.array(F.lit(DUPLICATE_ISSUE))).otherwise(F.col("__issues")),
        "improvements": F.coalesce(steps, F.array().cast("array<string>")),
        **{f"kept_{c}": F.when(kept, F.col(c)).when(better, F.when(F.col("__key").isNotNull(), F.col(f"__new_{c}")).otherwise(F.col(c))) for c in FIELDS},
    }
    return joined.select(*[c for c in rows.columns if c not in added], *[x.alias(c) for c, x in added.items()])
