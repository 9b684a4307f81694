import hashlib
from collections import defaultdict

from edge_rows import ROWS

from textloom.llm import exact_dedup as op

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return hashlib.sha256((text or "").translate(FOLD).encode()).hexdigest()


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[digest(t)].append(i)
    return {h: (max((x for x in ids if x is not None), default=None), len(ids)) for h, ids in groups.items()}


def test_edge_rows(edge):
    got, want = op.exact_dedup(edge).collect(), expected(ROWS)
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.text_sha256]
    assert sum(r.kept for r in got) == len(want)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_a_filter_too_small_gives_the_same(docs_of, edge):
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text_sha256)
    rows = lambda df: sorted([(key(r), r.keep_id, r.group_size) for r in df.collect()], key=str)
    assert rows(op.exact_dedup(edge)) == rows(op.exact_dedup(edge, max_bits=1 << op.BLOCK_BITS))
    many = docs_of([(i, f"text number {i % 59_000}") for i in range(60_000)])  # far more rows than one block has room for
    small = op.exact_dedup(many, max_bits=1 << op.BLOCK_BITS)
    assert rows(small.where("group_size > 1")) == rows(op.exact_dedup(many).where("group_size > 1")) and small.where("kept").count() == 59_000
    assert op.drop_copies(many, max_bits=1 << op.BLOCK_BITS).count() == 59_000


def test_filter_lets_most_rows_through(docs_of):
    rows = [(i, f"text number {i}") for i in range(2000)] + [(5000, "text number 7")]
    docs = docs_of(rows).select("doc_id", op.text_digest().alias("sha"))
    flagged = op.RepeatFilter(docs, "sha").flag(docs, "sha").where("may_repeat")
    assert {7, 5000} <= {r.doc_id for r in flagged.collect()}
    assert flagged.count() < 200


def test_drop_copies_keeps_whole_rows(edge, nothing):
    kept = op.drop_copies(edge)
    assert kept.columns == edge.columns
    assert kept.count() == len(expected(ROWS))
    assert {(r.doc_id, digest(r.text)) for r in kept.collect()} == {(i, h) for h, (i, _) in expected(ROWS).items()}
    assert op.drop_copies(nothing).count() == op.exact_dedup(nothing).count() == 0


def test_columns_of_any_name_keep_their_values(edge):
    for bits in (op.MAX_BITS, 1 << op.BLOCK_BITS):
        got = op.drop_copies(edge, max_bits=bits)
        assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in edge.collect()}
        assert {r.group_size for r in got.collect()} == {888}


def test_the_filter_is_one_broadcast_and_texts_do_not_shuffle(docs_of):
    docs = docs_of([(i, f"text number {i}") for i in range(6000)] + [(9000, "text number 7")])
    docs.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = docs.withColumn("sha", op.text_digest())
        for most, blocks in ((1 << op.BLOCK_BITS, 1), (op.MAX_BITS, 4)):
            bloom = op.RepeatFilter(own, "sha", max_bits=most)
            assert bloom.blocks == blocks
            alone = bloom.flag(own, "sha").where("NOT may_repeat")
            plan = alone._jdf.queryExecution().executedPlan().toString()
            assert plan.count("BroadcastHashJoin") == 1 and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
            assert {7, 9000}.isdisjoint(r.doc_id for r in alone.collect()) and alone.count() > (5500 if blocks > 1 else 0)
        assert op.drop_copies(docs).count() == 6000
    finally:
        docs.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_in_the_plan(edge):
    plan = op.exact_dedup(edge)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
