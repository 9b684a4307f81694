"""Split, sample and mix queries; order is that of md5('42|' || id)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import rules
from textloom.functions import text as X
from textloom.operators import sampling
from textloom.plans import sqltext as S
from textloom.plans.registry import query, read

KEY = S.order_key("doc_id")


def tiered(spark, sf_dir):
    """Documents with a tier by length, a stand-in for graded rows."""
    n = F.col("n_chars")
    tier = F.when(n < 600, "beginner").when(n < 2500, "intermediate").when(n < 8000, "advanced").otherwise("expert")
    return read(spark, sf_dir, "documents").withColumn("tier", tier)


@query(f"SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {KEY}, doc_id) <= floor(count(*) OVER () * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM documents")
def global_split(spark, sf_dir):
    return sampling.split(read(spark, sf_dir, "documents"), "doc_id").select("doc_id", "split")


@query(f"SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY {KEY}, doc_id) <= floor(count(*) OVER (PARTITION BY lang) * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM documents")
def category_split(spark, sf_dir):
    return sampling.split(read(spark, sf_dir, "documents"), "doc_id", groups=["lang"]).select("doc_id", "split")


@query(f"SELECT doc_id, tier, CASE WHEN row_number() OVER (PARTITION BY tier ORDER BY {KEY}, doc_id) <= greatest(1, floor(count(*) OVER (PARTITION BY tier) * 0.1::DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM {S.TIERS}")
def stratified_split(spark, sf_dir):
    return sampling.stratified_split(tiered(spark, sf_dir), "doc_id", "tier").select("doc_id", "tier", "split")


WEIGHTS = {"beginner": 0.2, "intermediate": 0.4, "advanced": 0.3, "expert": 0.1}


@query(f"""
SELECT doc_id, tier FROM (SELECT doc_id, tier, row_number() OVER (PARTITION BY tier ORDER BY {KEY}, doc_id) AS place FROM {S.TIERS})
WHERE place <= CASE tier WHEN 'beginner' THEN {int(500 * 0.2)} WHEN 'intermediate' THEN {int(500 * 0.4)} WHEN 'advanced' THEN {int(500 * 0.3)} ELSE {int(500 * 0.1)} END
""")
def weighted_sample(spark, sf_dir):
    return sampling.weighted_sample(tiered(spark, sf_dir), "doc_id", "tier", WEIGHTS, 500).select("doc_id", "tier")


POOLED = f"(SELECT doc_id, CASE WHEN doc_id % 10 < 6 THEN 'real_cybersecurity' WHEN doc_id % 10 < 9 THEN 'ctf_solving' ELSE 'synthetic_expert' END AS pool, md5(text) AS h, {KEY} AS k FROM documents)"


@query(f"""
WITH pooled AS {POOLED},
real AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY k, doc_id) AS nth FROM pooled WHERE pool = 'real_cybersecurity') WHERE nth = 1 ORDER BY k, doc_id LIMIT 420),
ctf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY k, doc_id) AS nth FROM pooled WHERE pool = 'ctf_solving' AND h NOT IN (SELECT h FROM real)) WHERE nth = 1 ORDER BY k, doc_id LIMIT 120),
syn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY k, doc_id) AS nth FROM pooled WHERE pool = 'synthetic_expert' AND h NOT IN (SELECT h FROM real UNION ALL SELECT h FROM ctf)) WHERE nth = 1 ORDER BY k, doc_id LIMIT 60),
quota AS (SELECT * FROM real UNION ALL SELECT * FROM ctf UNION ALL SELECT * FROM syn),
spare AS (SELECT *, row_number() OVER (ORDER BY k, doc_id) AS place FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY k, doc_id) AS nth2 FROM pooled WHERE pool = 'real_cybersecurity' AND h NOT IN (SELECT h FROM quota)) WHERE nth2 = 1)
SELECT doc_id, pool, 'quota' AS role FROM quota
UNION ALL SELECT doc_id, pool, 'backfill' FROM spare WHERE place <= 600 - (SELECT count(*) FROM quota)
""")
def pool_mix_backfill(spark, sf_dir):
    last = F.col("doc_id") % 10
    pool = F.when(last < 6, "real_cybersecurity").when(last < 9, "ctf_solving").otherwise("synthetic_expert")
    rows = read(spark, sf_dir, "documents").select("doc_id", pool.alias("pool"), F.md5("text").alias("h"))
    return sampling.quota_mix(rows, "doc_id", "pool", "h", total=600).select("doc_id", "pool", "role")


def _slots(quotas: dict) -> str:
    return " UNION ALL ".join(f"SELECT '{tier}' AS tier, unnest(range({n})) AS slot" for tier, n in quotas.items())


@query(f"""
WITH ranked AS (SELECT doc_id, tier, row_number() OVER (PARTITION BY tier ORDER BY {KEY}, doc_id) - 1 AS r, count(*) OVER (PARTITION BY tier) AS n FROM {S.TIERS}),
whole AS (SELECT doc_id, row_number() OVER (ORDER BY {KEY}, doc_id) - 1 AS r, count(*) OVER () AS n FROM documents),
slots AS ({_slots(rules.VAL_QUOTAS)}),
sized AS (SELECT s.tier, s.slot, ('0x' || substr(md5('42/' || s.tier || '/' || s.slot), 1, 8))::BIGINT AS h, t.n FROM slots s LEFT JOIN (SELECT tier, max(n) AS n FROM ranked GROUP BY tier) t ON t.tier = s.tier)
SELECT z.tier, z.slot, r.doc_id FROM sized z JOIN ranked r ON r.tier = z.tier AND r.r = z.h % z.n WHERE z.n IS NOT NULL
UNION ALL SELECT z.tier, z.slot, w.doc_id FROM sized z JOIN whole w ON w.r = z.h % w.n WHERE z.n IS NULL
""")
def quota_replacement(spark, sf_dir):
    return sampling.slots_with_replacement(tiered(spark, sf_dir), "doc_id", "tier", rules.VAL_QUOTAS)


@query("SELECT doc_id FROM documents ORDER BY source, doc_id LIMIT 20")
def head_rows(spark, sf_dir):
    return sampling.head(read(spark, sf_dir, "documents"), ["source", "doc_id"], 20).select("doc_id")


@query(f"""
WITH uniq AS (SELECT min(doc_id) AS doc_id, sha256({S.fold_ends('text')}) AS h FROM documents GROUP BY 2)
SELECT h, CASE WHEN row_number() OVER (ORDER BY md5('42|' || h), h) <= floor(count(*) OVER () * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM uniq
""")
def leakage_free_split(spark, sf_dir):
    from textloom.operators.dedup import keep_first

    h = F.sha2(X.fold_ends(F.col("text")), 256)
    rows = keep_first(read(spark, sf_dir, "documents").select("doc_id", h.alias("h")), F.col("h"), ["doc_id"])
    return sampling.split(rows, "h").select("h", "split")
