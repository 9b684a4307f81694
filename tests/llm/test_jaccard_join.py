import random
import re

import pytest
from edge_rows import ROWS

from textloom.llm import jaccard_join as op
from textloom.llm import star_components
from textloom.llm.star_components import components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if root(m) == root(k) and rows[m][0] is not None]
        out.append((str(i), len(sets[k]), str(min(ids, default=None))))
    return sorted(out)


def ours(docs):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in op.jaccard_components(docs).collect())


def test_edge_rows(edge, nothing):
    assert ours(edge) == brute(ROWS)
    assert op.jaccard_components(nothing).count() == 0
    kept = op.keep_one_each(edge)
    assert kept.columns == edge.columns and op.keep_one_each(nothing).count() == 0


def mixed_bag(seed):
    random.seed(seed)
    fresh = lambda n: [f"w{random.randrange(10**6)}" for _ in range(n)]
    base, passage, rows = fresh(120), fresh(30), []
    for _ in range(25):  # copies with edits: some link to the base, some only to each other
        own = list(base)
        for _ in range(random.randint(0, 4)):
            own[random.randrange(len(own))] = fresh(1)[0]
        rows.append(own)
    chain = fresh(100)
    for _ in range(8):
        chain = [*chain[3:], *fresh(3)]
        rows.append(list(chain))
    rows += [fresh(random.randint(5, 60)) + passage + fresh(random.randint(0, 60)) for _ in range(20)]
    rows += [passage + fresh(random.randint(2, 7)) for _ in range(20)]  # most of a text is common, few of them link
    return [(i, " ".join(w)) for i, w in enumerate(random.sample(rows, len(rows)))] + [(100, " ".join(rows[0]))]


@pytest.mark.parametrize("small, pivots, keys, fits", [(48, 8, 1 << 17, 2048), (2, 1, 0, 4), (2, 3, 1 << 17, 2048), (1, 2, 0, 1)])
def test_chains_stars_and_common_passages(docs_of, monkeypatch, small, pivots, keys, fits):
    monkeypatch.setattr(op, "TASK_CELL", fits)
    monkeypatch.setattr(op, "SMALL", small)
    monkeypatch.setattr(op, "PIVOTS", pivots)
    monkeypatch.setattr(op, "BROADCAST_KEYS", keys)
    monkeypatch.setattr(op, "OFTEN", 5)
    rows = mixed_bag(small + pivots)
    assert ours(docs_of(rows)) == brute(rows)


def test_cells_keep_every_link(spark, docs_of, monkeypatch):
    """One cell of all documents: whatever links is in one class or in a cell together after each level."""
    for seed, fits in ((1, 1), (2, 20)):
        monkeypatch.setattr(op, "TASK_CELL", fits)
        rows = [r for r in mixed_bag(seed) if r[0] < 100]
        sets = op.shingle_sets(op.pa.array([t for _, t in rows]))
        table = spark.createDataFrame([(bytearray(op.set_key(x)), len(x), bytearray(x.tobytes()), bytearray(op.np.minimum(op.np.bincount((x & op.np.uint64(63)).astype(int), minlength=64), 255).astype("u1").tobytes())) for x in sets], "key binary, n int, shingles binary, parts binary").dropDuplicates(["key"]).cache()
        cells = table.select(op.F.lit(1).cast("long").alias("cell"), "key", "n")
        nothing = spark.createDataFrame([], "u binary, v binary")
        labels = {bytes(r.node): bytes(r.label) for r in op._voronoi_labels(cells, nothing, table.select("key", "n", "parts"), table.select("key", "shingles"), 80, 100).collect()}
        of = lambda x: labels.get(op.set_key(x), op.set_key(x))
        classes = brute(rows)
        want = {i: c for i, _, c in classes}
        for i, x in enumerate(sets):
            for j, y in enumerate(sets[:i]):
                assert (of(x) == of(y)) == (want[str(i)] == want[str(j)])


def test_a_cell_that_no_pivot_parts(docs_of, monkeypatch):
    """Documents that share most of their text and do not link: the recursion ends and links none."""
    monkeypatch.setattr(op, "OFTEN", 10**6)
    passage = [f"p{k}" for k in range(85)]
    rows = [(i, " ".join(passage + [f"x{i}y{k}" for k in range(15)])) for i in range(60)]
    assert {r.component_id for r in op.jaccard_components(docs_of(rows)).collect()} == set(range(60))


def test_threshold_is_exact(docs_of):
    words = [f"w{k}" for k in range(94)]  # 90 shingles; a longer copy shares 90 of n
    rows = [(1, " ".join(words)), (2, " ".join([*words, *[f"x{k}" for k in range(22)]])), (3, " ".join([*[f"y{k}" for k in range(23)], *words]))]
    got = {r.doc_id: r.component_id for r in op.jaccard_components(docs_of(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}  # 90/112 links, 90/113 does not


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (7, 7), (2, 1), (8, 9)], "u long, v long")
    assert {r.node: r.label for r in components(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}


@pytest.mark.parametrize("few", [1 << 17, 3])
def test_few_edges_take_few_steps(spark, monkeypatch, few):
    made, staged = [], star_components.staged
    monkeypatch.setattr(star_components, "FEW_EDGES", few)
    monkeypatch.setattr(star_components, "staged", lambda df, tag, **kw: made.append(tag) or staged(df, tag, **kw))
    pairs = [(k, k + 1) for k in range(40)] + [(100 + k, 90) for k in range(20)]
    edges = spark.createDataFrame([(f"{u:03}".encode(), f"{v:03}".encode()) for u, v in random.Random(1).sample(pairs, len(pairs))], "u binary, v binary").repartition(5)
    want = {f"{k:03}": "000" for k in range(41)} | {f"{k:03}": "090" for k in [90, *range(100, 120)]}
    assert {r.node.decode(): r.label.decode() for r in components(edges).collect()} == want
    assert len(made) <= 3 or few == 3


def test_one_row_is_kept_whatever_the_ids(docs_of):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(3, a), (5, a + " more"), (5, b), (None, b + " more"), (None, c), (None, c + " more"), (7, ""), (7, "")]
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in op.keep_one_each(docs_of(rows)).collect())
    assert kept[:4] == [(False, 3, a), (False, 5, b), (False, 7, ""), (False, 7, "")]
    assert len(kept) == 5 and kept[4][0] and kept[4][2].startswith(c)


def test_a_large_group_of_near_copies_takes_few_levels(docs_of, monkeypatch):
    """Copies with few changes link, those with many do not: both are found without making each of them a pivot."""
    made, staged = [], op.staged
    monkeypatch.setattr(op, "staged", lambda df, tag, **kw: made.append(tag) or staged(df, tag, **kw))
    for name, value in (("TASK_CELL", 24), ("SMALL", 4), ("PIVOTS", 1), ("OFTEN", 5)):
        monkeypatch.setattr(op, name, value)
    random.seed(5)
    base, rows = [f"w{k}" for k in range(200)], []
    for i in range(90):
        own = base[: random.randint(185, 200)]
        for k in random.sample(range(len(own)), random.randint(0, 14)):
            own[k] = f"x{i}y{k}"
        rows.append((i, " ".join(own)))
    want = brute(rows)
    components_of = [c for _, _, c in want]
    assert ours(docs_of(rows)) == want and 20 < max(map(components_of.count, components_of)) < 70
    assert made.count("next-cells") <= 3
