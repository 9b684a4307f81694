import json
import os

import pytest
from pyspark.sql import functions as F

from textloom.functions.text import triple_md5
from textloom.operators import judge as op

SCHEMA = "place long, instruction string, input string, output string, score string"


def rows_of(spark, data):
    return spark.createDataFrame([(k, i, n, o, "x") for k, (i, n, o) in enumerate(data)], SCHEMA)


@pytest.mark.parametrize(
    ("answer", "wanted"),
    [
        ('{"score": 7}', (7.0, "good", "intermediate", [], "")),
        ('```json\n{"score": "11.26", "quality": "BAD", "issues": "one", "difficulty": " Expert "}\n```', (10.0, "bad", "expert", ["one"], "")),
        ('Here: {"score": 9.04, "issues": {"a": 1}, "difficulty": "hard", "suggestion": " do "} as asked', (9.0, "good", "advanced", [], "do")),
        ('{"score": 3, "quality": "fine", "issues": ["a", 1], "difficulty": null}', (3.0, "bad", "beginner", ["a", "1"], "")),
        ('{"score": -2, "quality": "good"}', (0.0, "good", "intermediate", [], "")),
    ],
)
def test_verdicts(answer, wanted):
    found = op.verdict(answer, {})
    assert (found["score"], found["quality"], found["difficulty"], found["issues"], found["suggestion"]) == wanted


@pytest.mark.parametrize("answer", [None, "", "no", "{broken", "[1]", '{"quality": "good"}', '{"score": "high"}', '{"score": null}', '{"score": 5, "quality": 1}', "3"])
def test_answers_of_no_use(answer):
    assert op.verdict(answer, {}) is None


def test_rewrites():
    example = {"instruction": "i", "input": "n", "output": "o"}
    assert op.rewritten('{"instruction": " a ", "output": "b "}', example) == {"instruction": "a", "input": "n", "output": "b"}
    assert op.rewritten('{"instruction": "a"}', example) is None and op.rewritten('{"instruction": "a", "output": 3}', example) is None and op.rewritten("?", example) is None


def test_models_and_retries():
    asked = []

    def ask(examples, model):
        asked.append((model, [x["n"] for x in examples]))
        if model == "first":
            raise RuntimeError("quota reached")
        if model == "second" and len(asked) == 2:
            raise ValueError("connection lost")
        return ['{"score": 8}' if model == "third" or x["n"] == 1 else "what?" for x in examples]

    found = op.answers(ask, op.verdict, [{"n": 1}, {"n": 2}], ["first", "second", "third"], 3, 0.0)
    assert [x["score"] for x in found] == [8.0, 8.0]
    assert asked == [("first", [1, 2]), ("second", [1, 2]), ("second", [1, 2]), ("second", [2]), ("third", [2])]
    assert op.answers(lambda e, m: [None], op.verdict, [{"n": 1}], ["a"], 2, 0.0) == [None]
    assert op.answers(lambda e, m: [], op.verdict, [{"n": 1}], ["a"], 2, 0.0) == [None]


def test_a_killed_run_goes_on_without_scoring_a_row_twice(spark, tmp_path):
    log, folder = tmp_path / "asked", f"file://{tmp_path}/store"
    log.mkdir()

    def ask_until(limit):
        def ask(examples, model):
            if len(os.listdir(log)) >= limit:
                os._exit(9)  # the worker is killed, every try of its task too, and so the job
            batch = [x["output"] for x in examples]
            (log / f"{hash(tuple(batch))}-{os.getpid()}-{len(os.listdir(log))}").write_text(json.dumps(batch))
            return ['{"score": 8}'] * len(batch)

        return ask

    rows = rows_of(spark, [("i", "n", f"text {k}") for k in range(400)]).withColumn("hash", triple_md5(F.col("instruction"), F.col("input"), F.col("output")))
    with pytest.raises(Exception, match="Python worker exited|crashed|Job aborted"):
        op.Judge(spark, folder, ask_until(6), ["m"], pause=0.0, batch_rows=16).scored(rows)
    before = op.AnswerStore(spark, folder, op.VERDICT, op.VERDICT_SQL).stored().count()
    assert 0 < before < 400
    judged = op.Judge(spark, folder, ask_until(1000), ["m"], pause=0.0, batch_rows=16)
    assert judged.scored(rows.drop("score")).where("score = 8").count() == 400
    asked = [x for f in log.iterdir() for x in json.loads(f.read_text())]
    assert len(asked) == len(set(asked)) == 400 == judged.store.stored().count()
    judged.ask = None
    assert judged.scored(rows.drop("score")).where("score = 8").count() == 400


def plain_review(data, judge, rewrite):
    """The flow row by row."""
    taken, out = set(), []
    for i, n, o in data:
        key = (i or "") + (n or "") + (o or "")
        if key in taken:
            out.append(("duplicate", 0.0, 0.0, None))
            continue
        score, quality, issues = judge(o or "")
        if score >= 7 and quality == "good":
            taken.add(key)
            out.append(("accepted", score, score, o))
        elif score >= 3 or issues:
            new = rewrite(o or "")
            again = judge(new)[0]
            if again >= 7 or again > score:
                taken.add((i or "") + (n or "") + new)
                out.append(("improved", score, again, new))
            else:
                out.append(("rejected", score, again, None))
        else:
            out.append(("rejected", score, score, None))
    return out


def test_review_with_rewrites_of_rewrites(spark, tmp_path):
    scores = {"a": 4.0, "b": 5.0, "c": 6.0, "d": 9.0, "e": 1.0, "f": 2.0, "g": 8.0, "h": 3.0, "": 0.0}
    chain = {"a": "b", "b": "c", "c": "d", "h": "e", "f": "g"}
    judge = lambda o: (scores[o], "bad" if o == "g" else "good" if scores[o] >= 7 else "bad", ["x"] if o == "f" else [])
    rewrite = lambda o: chain.get(o, o)
    data = [("", "", x) for x in "abacbcdabcdhehfgfgeeaa"] + [(None, None, None), ("", "", "d")]

    def ask(examples, model):
        return [json.dumps(dict(zip(("score", "quality", "issues"), judge(x["output"]), strict=True))) for x in examples]

    def amend(examples, model):
        return [json.dumps({"instruction": "", "input": "", "output": chain[x["output"]]}) if x["output"] in chain else "no" for x in examples]

    for k, order in enumerate((data, data[::-1], data[7:] + data[:7])):
        found = op.reviewed(rows_of(spark, order), "place", op.Judge(spark, f"file://{tmp_path}/v{k}", ask, ["m"], pause=0.0, retries=1), op.Rewriter(spark, f"file://{tmp_path}/r{k}", amend, ["m"], pause=0.0, retries=1))
        got = [(r.status, r.original_score, r.final_score, r.kept_output) for r in found.orderBy("place").collect()]
        assert got == plain_review(order, judge, rewrite)
    alone = op.reviewed(rows_of(spark, data), "place", op.Judge(spark, f"file://{tmp_path}/v0", ask, ["m"]))
    assert {r.status for r in alone.collect()} == {"accepted", "rejected", "duplicate"}


def test_empty_table(spark, tmp_path):
    judged = op.Judge(spark, f"file://{tmp_path}/none", lambda e, m: ["?"] * len(e), ["m"])
    assert op.reviewed(rows_of(spark, []), "place", judged).count() == 0
