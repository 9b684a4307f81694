"""Dedup, sampling, votes, artefacts, sources and streams on small rows."""

import io
import json
import random
import wave
import zipfile

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import artifacts, chat, convert, dedup, greedy, sampling, stats
from textloom.operators.components import smallest_reached
from textloom.plans import pipelines
from textloom.sources import jsonl
from textloom.streaming import incremental


def words(text):
    import re

    return {w for w in re.findall(r"[^\W]+", text.lower()) if re.fullmatch(r"[a-z0-9_]{3,}", w)}


def near_by_hand(texts, threshold=0.92):
    """All pairs of ids, smaller first, whose word sets are near; ids without words or null are in none."""
    sets = [(i, words(t or "")) for i, t in texts if i is not None]
    sets = sorted((i, w) for i, w in sets if w)
    return {(a, b): len(x & y) / len(x | y) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if len(x & y) / len(x | y) >= threshold}


def test_near_pairs_match_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    every = near_by_hand(texts)
    first = {b: min([a for a, x in every if x == b and every[a, b] == 1], default=b) for b, _ in texts}
    want = {(a, b) for a, b in every if first[a] == a and first[b] in (a, b)}
    assert {(r.id_a, r.id_b) for r in dedup.near_pairs(docs, "doc_id", F.col("text")).collect()} == want


def drifting():
    """(id, text): chains of sets that drift away word by word, copies in other orders, sets of one word, no words, nulls."""
    rng = random.Random(5)
    rows, i = [], 0
    for chain in range(6):
        own = [f"w{chain}_{k}" for k in range(rng.randint(12, 40))]
        for step in range(9):
            for _ in range(rng.choice([1, 1, 3])):
                rows.append((i, " ".join(rng.sample(own, len(own)))))
                i += 1
            own = [*own[: -rng.choice([1, 1, 2])], f"new{chain}_{step}"]
    rows += [(i, "single"), (i + 1, "single"), (i + 2, "other"), (i + 3, ""), (i + 4, None), (i + 5, "a b"), (None, "single")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.92, 1.0])
def test_near_duplicates_by_every_form(spark, threshold, monkeypatch):
    monkeypatch.setattr(dedup, "FREQUENT", 20)
    texts = drifting()
    rows = spark.createDataFrame(texts, "id long, t string")
    every = near_by_hand(texts, threshold)
    got = {(r.id_a, r.id_b): r.jaccard for r in dedup.near_pairs(rows, "id", F.col("t"), threshold).collect()}
    first = {i: i for i, _ in texts}
    first.update({b: a for (a, b), j in got.items() if j == 1})
    assert {p: j for p, j in every.items() if first[p[0]] == p[0] and first[p[1]] in p} == pytest.approx(got)
    assert set(every) == {(a, b) for a in first for b in first if None not in (a, b) and a < b and (tuple(sorted((first[a], first[b]))) in got or (first[a] == first[b]))}

    kept = set()
    for i in sorted(i for i, _ in texts if i is not None):
        if not any((k, i) in every for k in kept):
            kept.add(i)
    assert {r.id for r in dedup.near_first(rows, "id", F.col("t"), threshold).where("kept").collect()} == kept | {None}

    label = {i: i for i, _ in texts}
    for _ in texts:
        for a, b in every:
            label[a] = label[b] = min(label[a], label[b])
    assert {r.id: r.cluster for r in dedup.near_clusters(rows, "id", F.col("t"), threshold).collect()} == label


def test_near_duplicates_of_nothing(spark):
    rows = spark.createDataFrame([], "id long, t string")
    for form in (dedup.near_pairs, dedup.near_first, dedup.near_clusters):
        assert form(rows, "id", F.col("t")).collect() == []


def test_smallest_reached_in_a_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).unionByName(spark.createDataFrame([(900, 901), (901, 900), (7, 7), (None, 5)], "u long, v long"))
    got = {r.node: r.label for r in smallest_reached(links).collect()}
    assert got == {**{i: 0 for i in range(301)}, 900: 900, 901: 900}


@pytest.mark.parametrize("look_back", [2, None])
def test_near_greedy(spark, look_back):
    base = " ".join(f"word{k}" for k in range(40))
    texts = [base, "alpha beta gamma", "delta epsilon zeta", "eta theta iota", base + " more", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    kept = [r.id for r in (greedy.near_greedy(rows, "id", F.col("t"), look_back=look_back) if look_back else dedup.near_first(rows, "id", F.col("t"))).orderBy("id").collect() if r.kept]
    assert kept == ([0, 1, 2, 3, 4, 5] if look_back == 2 else [0, 1, 2, 3, 5])


def test_split_sizes_and_order_independence(spark):
    rows = spark.range(233).select(F.col("id"), (F.col("id") % 3).cast("string").alias("g"))
    parts = sampling.split(rows, "id")
    assert parts.where("split = 'train'").count() == 209
    again = sampling.split(rows.repartition(7), "id")
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, again.collect()))
    tiers = spark.createDataFrame([(i, "one" if i == 0 else "many") for i in range(51)], "id int, tier string")
    strat = {(r.tier, r.split): r.n for r in sampling.stratified_split(tiers, "id", "tier").groupBy("tier", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert strat == {("one", "val"): 1, ("many", "val"): 5, ("many", "train"): 45}


def test_quota_mix_backfills(spark):
    rows = spark.createDataFrame([(i, "real_cybersecurity" if i < 80 else "ctf_solving" if i < 85 else "synthetic_expert", f"t{i % 82}") for i in range(90)], "id int, pool string, h string")
    out = sampling.quota_mix(rows, "id", "pool", "h", total=50).collect()
    assert len(out) == 50 and len({r.h for r in out}) == 50
    assert sum(r.role == "quota" and r.pool == "real_cybersecurity" for r in out) == 35


def test_slots_draw_from_all_for_an_empty_tier(spark):
    rows = spark.createDataFrame([(i, "beginner") for i in range(7)], "id int, tier string")
    out = sampling.slots_with_replacement(rows, "id", "tier", {"beginner": 5, "expert": 4}).collect()
    assert len(out) == 9 and {r.tier for r in out} == {"beginner", "expert"}


def test_votes(spark):
    votes = spark.createDataFrame([(1, 0, "a", "F", 98, "xx"), (1, 1, "b", None, 99, "x"), (1, 2, "c", "F", 98, "xxx"), (2, 0, "a", None, 20, ""), (2, 1, "b", None, 30, ""), (3, 0, "a", "F", 1, ""), (3, 1, "b", "G", 1, "")], "target int, ord int, model string, flag_found string, confidence int, evidence_source string")
    assert {r.target: r.consensus for r in stats.consensus(votes).collect()} == {1: "CONFIRMED", 2: "NO_FLAG_FOUND", 3: "DISAGREEMENT"}
    assert {r.target: r.winner for r in stats.winners(votes).collect()} == {1: "c", 2: "b", 3: "a"}


def test_scores(spark):
    row = spark.range(1).select(stats.readiness(F.lit(9.4), F.lit(53), F.lit(6), F.lit(0), F.lit(53)).alias("a"), stats.readiness_real(F.lit(2389), F.lit(4), F.lit(5)).alias("b")).first()
    assert round(row.a, 1) == 82.9 and round(row.b, 1) == 96.8


def test_conversations_without_a_pair(spark):
    turns = spark.createDataFrame([(1, 0, "system", "s"), (2, 0, "user", "u1"), (2, 1, "assistant", " a "), (2, 2, "user", "u2"), (3, 0, "user", "  "), (3, 1, "assistant", "x")], "conv_id int, turn int, role string, text string")
    assert [tuple(r) for r in chat.last_pair(turns).collect()] == [(2, "u2", "a")]


def test_convert(spark):
    techniques = spark.createDataFrame(
        [("attack-pattern", None, "N", "[d](u) injection", [("other", "X"), ("mitre-attack", "T1")], None, [], None), ("attack-pattern", True, "R", "d", [("mitre-attack", "T2")], None, None, None), ("malware", None, "M", "d", None, None, None, None)],
        "type string, revoked boolean, name string, description string, external_references array<struct<source_name: string, external_id: string>>, x_mitre_platforms array<string>, kill_chain_phases array<struct<phase_name: string>>, x_mitre_detection string",
    )
    row = convert.techniques(techniques).collect()
    assert len(row) == 1 and row[0].difficulty == "advanced" and "Tactics: Execution / Persistence\nPlatforms: All\nDescription: d injection..." in row[0].input
    kev = spark.createDataFrame([("C-1", None, "p", "A rce", "short", None, None, []), ("", "v", "p", "n", "d", "a", "k", ["c"])], "cveID string, vendorProject string, product string, vulnerabilityName string, shortDescription string, requiredAction string, knownRansomwareCampaignUse string, cwes array<string>")
    row = convert.vulnerabilities(kev).collect()
    assert len(row) == 1 and row[0].difficulty == "advanced" and "Affected Software: Unknown p" in row[0].input
    report = spark.createDataFrame([("fam", ["T1"], (None, "in", None, "ev", {"sha256": ["h"]}, "fix"))], "family string, mitre_techniques array<string>, content struct<threat_actor: string, initial_access: string, execution_mechanism: string, defense_evasion: string, indicators_of_compromise: map<string, array<string>>, remediation: string>")
    row = convert.malware_reports(report).first()
    assert "`h`" in row.output and "`N/A`" in row.output and row.difficulty == "expert"
    pages = spark.createDataFrame([("a_b", "no heading"), ("x", "#  Title here\nbody " + "z" * 900)], "stem string, content string")
    got = convert.articles(pages).collect()
    assert "Threat Category: A B\n" in got[0].input and "Threat Category: Title here\n" in got[1].input


def test_archives_and_audio(spark):
    inner, outer, sound = io.BytesIO(), io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("deep.txt", "x")
    with zipfile.ZipFile(outer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.txt", "hello")
        z.writestr("in.zip", inner.getvalue())
    with wave.open(sound, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(bytes(8000 * 4))
    files = spark.createDataFrame([("o.zip", bytearray(outer.getvalue())), ("s.wav", bytearray(sound.getvalue())), ("n", bytearray(b""))], "path string, content binary")
    members = {(r.member, r.depth) for r in artifacts.zip_members(files).collect()}
    assert members == {("a.txt", 1), ("in.zip", 1), ("deep.txt", 2)}
    heads = {r.path: r.h for r in files.select("path", artifacts.wav_header("content").alias("h")).collect()}
    assert tuple(heads["s.wav"]) == (2, 8000, 16, 1.0, 8000) and heads["n"].channels is None


def test_jsonl_sources(spark, tmp_path):
    folder = tmp_path / "cat"
    folder.mkdir()
    lines = ["\ufeff" + json.dumps({"instruction": "i", "input": None, "output": 3}), "", "{bad", json.dumps({"instruction": "only"})]
    (folder / "f.jsonl").write_text("\n".join(lines), encoding="utf-8")
    (tmp_path / "top.jsonl").write_text("{}", encoding="utf-8")
    got = jsonl.read_records(spark, str(folder)).collect()
    assert len(got) == 2 and {r.output for r in got} == {"3", None}
    by_folder = jsonl.read_category_folders(spark, str(tmp_path)).collect()
    assert [(r._category, r.instruction) for r in by_folder] == [("cat", "i")]
    assert jsonl.numbered_lines(spark, str(folder)).count() == 4
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, t string")
    assert jsonl.append_unseen(rows, str(tmp_path / "t"), F.md5("t")) == 2
    assert jsonl.append_unseen(rows, str(tmp_path / "t"), F.md5("t")) == 0
    jsonl.write_telemetry(spark.createDataFrame([(1, 0.5, None)], "step int, epoch double, loss double"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True, nullValue="None").first().loss is None


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:10:00"), (2, "2024-01-01 01:00:00")], "k int, ts string").withColumn("ts", F.to_timestamp("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = incremental.first_within(stream, F.col("k"), "ts").writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("firsts").count() == 2
    query = incremental.windowed_counts(stream, "ts", size="1 hour").writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.n for r in spark.table("counts").collect()) == [1, 2]
    incremental.append_stream(stream, str(tmp_path / "out"), F.col("k"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_pipelines(spark, data):
    turns = spark.read.parquet(f"{data}/conversations.parquet")
    pairs = chat.last_pair(turns).withColumn("category", F.lit("c"))
    done = pipelines.harvested_corpus(pairs, "conv_id")
    funnel = done.funnel.first()
    assert funnel.harvested >= funnel.unique_rows >= funnel.kept == done.train.count() + done.val.count()
    assert done.leaked.count() == 0
    docs = spark.read.parquet(f"{data}/documents.parquet")
    examples = docs.select("doc_id", F.concat(F.lit("Explain the following text about "), "source").alias("instruction"), F.lit("").alias("input"), F.col("text").alias("output"), F.col("lang").alias("category"), F.lit(None).cast("string").alias("difficulty"))
    out = pipelines.clean_merge_grade(examples, "doc_id")
    assert 0 < out.count() <= docs.count()
    assert X.SPACE.startswith("[")


def test_sets_of_common_words_meet_by_parts_only_if_near(spark):
    import random

    from textloom.operators import dedup

    draw = random.Random(5)
    vocabulary = [f"word{k}" for k in range(200)]
    sets = [sorted(draw.sample(vocabulary, draw.choice([10, 13, 24, 25, 40, 60]))) for _ in range(120)]
    for own in sets[:60]:  # one to three words more, fewer or others
        other = set(own)
        for _ in range(draw.randint(1, 3)):
            other ^= {draw.choice(vocabulary)}
        sets.append(sorted(other))
    sets = sorted({tuple(x) for x in sets})
    rows = spark.createDataFrame([(k, list(x)) for k, x in enumerate(sets)], "id long, words array<string>")
    want = {(a, b) for b, y in enumerate(sets) for a, x in enumerate(sets[:b]) if len(set(x) & set(y)) / len(set(x) | set(y)) >= 0.92}
    met = {(r.id_a, r.id_b) for r in dedup._meeting_by_parts(rows, 0.92).collect()}
    assert want and want <= met and len(met) < 4 * len(want)
    assert {(r.id_a, r.id_b) for r in dedup._near_sets(rows, 0.92).collect()} == want
