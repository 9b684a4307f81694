"""Dedup, audit and leakage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.operators import dedup, filters, greedy
from textloom.operators.chat import last_pair
from textloom.plans import sqltext as S
from textloom.plans.pipelines import ensure_checkpoint_dir
from textloom.plans.registry import fresh_folder, query, read
from textloom.sources import jsonl
from textloom.sources.counted import clean_and_count

Q = '"user"'


@query(f"SELECT min(doc_id) AS doc_id, md5({S.clean('text')}) AS h FROM documents GROUP BY 2")
def exact_dedup_md5(spark, sf_dir):
    clean = X.normalize_clean(F.col("text"))
    docs = read(spark, sf_dir, "documents").select("doc_id", X.triple_md5(clean, F.lit(""), F.lit(None).cast("string")).alias("h"))
    return dedup.keep_first(docs, F.col("h"), ["doc_id"])


@query(f"SELECT sha256({S.fold(Q)} || '|' || {S.fold('assistant')}) AS h, min(conv_id) AS conv_id FROM ({S.PAIRS}) GROUP BY 1")
def exact_dedup_sha(spark, sf_dir):
    pairs = last_pair(read(spark, sf_dir, "conversations")).select("conv_id", X.pair_sha(F.col("user"), F.col("assistant")).alias("h"))
    return dedup.keep_first(pairs, F.col("h"), ["conv_id"])


@query(f"SELECT sha256({S.fold_ends(Q)} || '|' || {S.fold_ends('assistant')}) AS h, min(conv_id) AS conv_id FROM ({S.PAIRS}) GROUP BY 1")
def exact_dedup_lower(spark, sf_dir):
    pairs = last_pair(read(spark, sf_dir, "conversations")).select("conv_id", X.pair_sha_ends(F.col("user"), F.col("assistant")).alias("h"))
    return dedup.keep_first(pairs, F.col("h"), ["conv_id"])


@query(f"""
SELECT sha256({S.fold_ends('d.text')}) AS h, min(d.doc_id) AS doc_id FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality = 1 GROUP BY 1
""")
def dedup_accepted_first(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id")
    rows = rows.select("doc_id", "quality", X.triple_sha_ends(F.col("text"), F.lit(""), F.lit("")).alias("h"))
    return dedup.accept_then_keep_first(rows, F.col("quality") == 1, F.col("h"), ["doc_id"]).select("h", "doc_id")


@query("SELECT source, count(*) AS total, count(DISTINCT md5(text)) AS unique_keys, count(*) - count(DISTINCT md5(text)) AS duplicates FROM documents GROUP BY source")
def dup_audit(spark, sf_dir):
    return dedup.duplicate_audit(read(spark, sf_dir, "documents"), F.md5("text"), "source")


@query(f"""
SELECT doc_id, nth, copies, preview FROM (
  SELECT doc_id, row_number() OVER same AS nth, count(*) OVER (PARTITION BY sha256({S.fold('text')})) AS copies, text[1:80] AS preview
  FROM documents WINDOW same AS (PARTITION BY sha256({S.fold('text')}) ORDER BY doc_id)
) WHERE nth > 1 ORDER BY doc_id LIMIT 5
""")
def dup_examples(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    five = dedup.duplicate_examples(docs, "doc_id", F.sha2(X.normalize_fold(F.col("text")), 256))
    return docs.join(F.broadcast(five), F.col("doc_id") == F.col("id")).select("doc_id", "nth", "copies", X.preview(F.col("text"), 80).alias("preview"))


NEAR = f"""
WITH sets AS (SELECT doc_id AS id, {S.word_set('text')} AS words FROM documents),
posted AS (SELECT id, len(words) AS n, unnest(words) AS word FROM sets WHERE len(words) > 0),
freq AS (SELECT word, count(*) AS df FROM posted GROUP BY word),
placed AS (SELECT p.id, p.n, p.word, row_number() OVER (PARTITION BY p.id ORDER BY f.df, p.word) AS place FROM posted p JOIN freq f ON f.word = p.word),
prefix AS (SELECT id, n, word FROM placed WHERE place <= n - ceil(n * 0.92 - 1e-9) + 1),
candidates AS (SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM prefix a JOIN prefix b ON a.word = b.word AND a.id < b.id AND least(a.n, b.n) >= greatest(a.n, b.n) * 0.92 - 1e-9),
common AS (SELECT c.id_a, c.id_b, len(list_intersect(x.words, y.words)) AS s, len(x.words) AS na, len(y.words) AS nb FROM candidates c JOIN sets x ON x.id = c.id_a JOIN sets y ON y.id = c.id_b)
SELECT id_a, id_b, s / (na + nb - s)::DOUBLE AS jaccard FROM common WHERE s / (na + nb - s)::DOUBLE >= 0.92
"""


@query(f"""
WITH pairs AS ({NEAR}),
firsts AS (SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY list_sort({S.word_set('text')})) AS first FROM documents)
SELECT id_a, id_b, jaccard FROM pairs JOIN firsts a ON a.id = id_a JOIN firsts b ON b.id = id_b WHERE a.first = id_a AND b.first IN (id_a, id_b)
""")
def near_dup_pairs(spark, sf_dir):
    """Links between the first documents of different word sets, and from each of these to its copies."""
    ensure_checkpoint_dir(spark)
    return dedup.near_pairs(read(spark, sf_dir, "documents"), "doc_id", F.col("text"))


def _in_order(window: str) -> str:
    """SQL: id and kept, in id order; a row goes if a near one is among the kept ids that ``window`` leaves of held."""
    return f"""
WITH RECURSIVE pairs AS MATERIALIZED ({NEAR}), near AS (SELECT id_b AS id, list(id_a) AS others FROM pairs GROUP BY id_b),
placed AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id) AS i, doc_id AS id, coalesce(others, []::BIGINT[]) AS others FROM documents LEFT JOIN near ON near.id = doc_id),
g(i, id, kept, held) AS (
  SELECT 0::BIGINT, NULL::BIGINT, false, []::BIGINT[]
  UNION ALL
  SELECT i, id, kept, CASE WHEN kept THEN list_append(held, id){window} ELSE held END
  FROM (SELECT p.i, p.id, g.held, NOT list_has_any(g.held, p.others) AS kept FROM g JOIN placed p ON p.i = g.i + 1)
)
SELECT id, kept FROM g WHERE i > 0
"""


@query(_in_order("[-50:]"))
def near_dup_greedy(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return greedy.near_greedy(read(spark, sf_dir, "documents"), "doc_id", F.col("text"))


@query(_in_order(""))
def near_dup_greedy_unlimited(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return dedup.near_first(read(spark, sf_dir, "documents"), "doc_id", F.col("text"))


@query(f"""
WITH RECURSIVE pairs AS ({NEAR}), links AS (SELECT id_a AS u, id_b AS v FROM pairs UNION SELECT id_b, id_a FROM pairs),
reach(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, l.v FROM reach r JOIN links l ON l.u = r.other)
SELECT id, min(other) AS cluster FROM reach GROUP BY id
""")
def near_dup_clusters(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return dedup.near_clusters(read(spark, sf_dir, "documents"), "doc_id", F.col("text"))


@query("SELECT DISTINCT md5(b.text) AS h FROM benchmark b WHERE md5(b.text) IN (SELECT md5(text) FROM documents)")
def leakage_benchmark(spark, sf_dir):
    docs, held = (read(spark, sf_dir, t).select(F.md5("text").alias("h")) for t in ("documents", "benchmark"))
    return dedup.leaked_keys(docs, held, "h")


@query(f"""
WITH s AS (SELECT md5(text) AS h, CASE WHEN row_number() OVER (ORDER BY {S.order_key('doc_id')}, doc_id) <= floor(count(*) OVER () * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM documents)
SELECT h FROM s WHERE split = 'train' INTERSECT SELECT h FROM s WHERE split = 'val'
""")
def leakage_split(spark, sf_dir):
    from textloom.operators.sampling import split

    rows = split(read(spark, sf_dir, "documents"), "doc_id").select(F.md5("text").alias("h"), "split")
    return dedup.leaked_keys(rows.where("split = 'train'"), rows.where("split = 'val'"), "h")


@query("SELECT doc_id FROM documents d WHERE doc_id % 2 = 1 AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 2 = 0)")
def incremental_append(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    return dedup.unseen(docs.where("doc_id % 2 = 1"), docs.where("doc_id % 2 = 0"), "h").select("doc_id")


@query("""
WITH fresh AS (SELECT min(doc_id) AS doc_id FROM documents WHERE doc_id >= 100 AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id < 100) GROUP BY md5(text))
SELECT doc_id FROM fresh ORDER BY doc_id LIMIT 10
""")
def generation_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    fresh = dedup.unseen(docs.where("doc_id >= 100"), docs.where("doc_id < 100"), "h")
    return dedup.keep_first(fresh, F.col("h"), ["doc_id"]).select("doc_id").orderBy("doc_id").limit(10)


@query(f"""
WITH good AS (SELECT * FROM (SELECT doc_id, {S.clean("text")} AS t FROM documents) WHERE NOT {S.low_quality("t", "output")}), firsts AS (SELECT md5(t) AS h, min(doc_id) AS doc_id FROM good GROUP BY 1)
SELECT doc_id, h, (SELECT count(*) FROM documents) AS total, (SELECT count(*) FROM good) AS normalised, (SELECT count(*) FROM firsts) AS uniq FROM firsts
""")
def clean_counts(spark, sf_dir):
    """Cleaned documents written, with what was counted on the way in the same pass."""
    docs = read(spark, sf_dir, "documents").select("doc_id", X.normalize_clean(F.col("text")).alias("t"))
    path = fresh_folder(spark, "cleaned")
    counts = clean_and_count(docs, path, ~filters.is_low_quality(F.col("t"), "output"), F.md5("t"), ["doc_id"])
    return spark.read.parquet(path).select("doc_id", F.md5("t").alias("h"), *[F.lit(counts[c]).alias(c) for c in ("total", "normalised", "uniq")])


@query("SELECT md5(t) AS h, min(r) AS source_rank FROM (SELECT coalesce(text, '') AS t, 1 AS r FROM benchmark UNION ALL SELECT coalesce(text, ''), 3 FROM documents UNION ALL SELECT coalesce(text, ''), 4 FROM conversations) GROUP BY 1")
def union_of_files(spark, sf_dir):
    """Folders of examples end to end, two of the five missing; content stays with its first source."""
    root, paths = fresh_folder(spark, "sources"), []
    for name in ("missing", "benchmark", "nothing", "documents", "conversations"):
        paths.append(f"{root}/{name}")
        if name in ("benchmark", "documents", "conversations"):
            rows = read(spark, sf_dir, name).select(F.lit("say").alias("instruction"), F.lit("").alias("input"), F.coalesce("text", F.lit("")).alias("output"))
            rows.select(F.to_json(F.struct("*")).alias("value")).write.text(paths[-1])
            jsonl.renamed(spark, paths[-1])
    found = jsonl.read_sources(spark, paths, jsonl.EXAMPLE)
    return dedup.keep_first(found.select(F.md5("output").alias("h"), "source_rank"), F.col("h"), ["source_rank"])


@query("SELECT md5(t) AS h, arg_min(src, r) AS source, min(r) AS source_rank FROM (SELECT text AS t, 'benchmark' AS src, 0 AS r FROM benchmark UNION ALL SELECT text, 'documents', 1 FROM documents UNION ALL SELECT text, 'conversations', 2 FROM conversations) GROUP BY 1")
def union_first_source(spark, sf_dir):
    parts = [read(spark, sf_dir, t).select(F.md5("text").alias("h"), F.lit(t).alias("source")) for t in ("benchmark", "documents", "conversations")]
    return dedup.keep_first(dedup.union_ranked(*parts), F.col("h"), ["source_rank"])
