"""Greedy near dedup with a window of kept rows, in ordered chunks at once."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import rules
from textloom.functions.text import word_set

#: Rounds in which all chunks with a wrong start run again at once; after these the first of them runs alone.
ROUNDS_AT_ONCE = 3


class Window:
    """The word sets of the last kept rows, in order."""

    def __init__(self, look_back: int, threshold: float, sets: list[list[int]]):
        self.threshold, self.held = threshold, deque((set(x) for x in sets), maxlen=look_back)

    def keep(self, own: set[int]) -> bool:
        n, least = len(own), self.threshold
        if n:
            for other in self.held:
                m = len(other)
                if m and min(n, m) / max(n, m) >= least:
                    shared = len(own & other)
                    if shared / (n + m - shared) >= least:
                        return False
        self.held.append(own)
        return True

    def dump(self) -> bytes:
        return json.dumps([sorted(x) for x in self.held]).encode()


def _folder(rows: DataFrame) -> str:
    root = rows.sparkSession.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("a checkpoint folder must be set")
    root = f"file://{root.removeprefix('file:')}" if root.startswith("file:/") and not root.startswith("file://") else root
    return f"{root}/greedy-{uuid.uuid4().hex}"


def _deciding(folder: str, number: int, before: dict[int, str | None], look_back: int, threshold: float):
    """mapInPandas function: a chunk's decisions, and a last row with the digest of the window at its end, which goes into a file."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        window, part = None, None
        store, root = fs.FileSystem.from_uri(folder)
        for frame in frames:
            if window is None and len(frame):
                part = int(frame["part"].iloc[0])
                start = before[part]
                sets = []
                if start:
                    with store.open_input_stream(f"{root}/{start}") as file:
                        sets = json.loads(file.read())
                window = Window(look_back, threshold, sets)
            yield pd.DataFrame({"part": frame["part"], "id": frame["id"], "kept": [window.keep(set(w.tolist())) for w in frame["words"]], "digest": None})
        if window is not None:
            data = window.dump()
            store.create_dir(f"{root}/windows-{number}", recursive=True)
            draft = f"{root}/windows-{number}/.draft-{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(data)
            store.move(draft, f"{root}/windows-{number}/{part}")
            yield pd.DataFrame({"part": [part], "id": [None], "kept": [None], "digest": [hashlib.sha256(data).hexdigest()]})

    return run


def near_greedy(rows: DataFrame, id_col: str, text: Column, threshold: float = rules.NEAR_COPY, look_back: int = rules.LOOK_BACK) -> DataFrame:
    """id and kept: in id order, a row goes if it is near one of the last ``look_back`` kept rows. Needs a checkpoint folder.

    Ranges of ids are decided at the same time, each from an empty window at first. Then every chunk whose
    start was not the window that the chunk before it has ended with runs again from that window, until
    none is left; so the result is that of one pass. A window forgets its start after some rows, so two or
    three rounds do; chunks that never forget (copies of one text with the same distance throughout) go one
    after the other from ROUNDS_AT_ONCE on. The driver sees a digest a chunk; a task holds one window.
    Rows without words stay and take a place in the window; null ids come first, and rows of one id in no
    defined order.
    """
    spark = rows.sparkSession
    sets = rows.select(F.col(id_col).alias("id"), F.transform(word_set(text), lambda w: F.xxhash64(w)).alias("words"))
    chunks = sets.repartitionByRange("id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id()).checkpoint()
    parts = sorted(r["part"] for r in chunks.select("part").distinct().collect())
    schema = f"part int, id {rows.schema[id_col].dataType.simpleString()}, kept boolean, digest string"
    folder, number = _folder(rows), 0
    ended, started, latest, todo = {}, {}, {}, parts
    while todo:
        before = {p: f"windows-{latest[q]}/{q}" if q in latest else None for q, p in zip([None, *parts[:-1]], parts, strict=True)}
        started |= {p: ended.get(q) for q, p in zip([None, *parts[:-1]], parts, strict=True) if p in set(todo)}
        chosen = chunks if number == 0 else chunks.where(F.col("part").isin(todo))
        chosen.select("part", "id", "words").mapInPandas(_deciding(folder, number, before, look_back, threshold), schema).write.parquet(f"{folder}/decided/round={number}")
        ended |= {r["part"]: r["digest"] for r in spark.read.schema(schema).parquet(f"{folder}/decided/round={number}").where("digest IS NOT NULL").collect()}
        latest |= dict.fromkeys(todo, number)
        wrong = [p for q, p in zip(parts[:-1], parts[1:], strict=True) if started[p] != ended[q]]
        number += 1
        todo = wrong if number < ROUNDS_AT_ONCE else wrong[:1]
    if not parts:
        return spark.createDataFrame([], schema).select("id", "kept")
    decided = spark.read.schema(f"{schema}, round int").parquet(f"{folder}/decided").where("digest IS NULL")
    last = spark.createDataFrame(sorted(latest.items()), "part int, round int")  # a row a chunk
    return decided.join(F.broadcast(last), ["part", "round"]).select("id", "kept")
