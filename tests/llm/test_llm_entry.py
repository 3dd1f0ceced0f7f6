import collections
import os
import random
import re

import duckdb
import pyspark.sql
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_llm_rules import brute_counts, brute_hits
from tests.llm.test_llm_simhash import brute_classes
from tests.llm.test_llm_tokens import check_pieces
from tickspan.llm import quality, queries, secret_scan
from tickspan.llm.common import stored


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return con


def test_all_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(queries.ORACLE_SQL[name])
    cols = list(rel.columns)
    assert sorted(df.columns) == sorted(cols)
    assert collections.Counter(tuple(r[c] for c in cols) for r in df.collect()) == collections.Counter(rel.fetchall())


NATIVE = ("op1_", "op6_", "op8_")


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n.startswith(NATIVE)])
def test_native_plans_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_pipeline_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    base = docs.columns
    rows, kept = docs.collect(), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = stage(spark, kept, SF_SMALL)
        assert kept.columns == base, name
        after = {r.doc_id for r in kept.select("doc_id").collect()}
        assert after <= before and (name == "secret scan") == (after == before and name == "secret scan")
    texts = {r.doc_id: r.text for r in kept.collect()}
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {p.doc_id for p in pieces} == set(texts)
    assert len(texts) < len(rows)
    done = collections.Counter()
    for p in pieces:
        done[p.doc_id] += p.length
    assert all(done[p.doc_id] == p.doc_tokens for p in pieces)


def brute_kept(rows):
    """What the quality rules keep: counts by definition, host rates from the moments of the beta-binomial."""
    failed = [brute_counts(r.text or "")[-1] for r in rows]
    n, f = collections.Counter(r.source for r in rows), collections.Counter(r.source for r, x in zip(rows, failed) if x)
    total, k = len(rows), len(n)
    mean, strength = sum(failed) / total, quality.STRONGEST
    chance = mean * (1 - mean)
    if chance and k > 1:
        between = sum(f[h] ** 2 / n[h] for h in n) - total * mean * mean - (k - 1) * chance
        spread = between / (chance * max(total - sum(x * x for x in n.values()) / total - (k - 1), 1.0))
        spread = min(max(spread, 1 / (1 + quality.STRONGEST)), 0.999)
        strength = (1 - spread) / spread
    bad = {h for h in n if (f[h] + mean * strength) / (n[h] + strength) > quality.MAX_RATE}
    return [r for r, x in zip(rows, failed) if not x and r.source not in bad]


def brute_redacted(text):
    hidden = set()
    for a, _, b in secret_scan.spans_of(text)[1]:
        hidden |= set(range(a, b))
    marked = "".join("\0" if i in hidden else c for i, c in enumerate(text))
    return re.sub("\0+", "[secret]", marked)


def test_pipeline_against_brute_force(spark, scratch):
    """Every stage of ``run`` on documents with planted cases, step by step."""
    cols = spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120).collect()     # a small fixture for brute force
    top, made = max(r.doc_id for r in docs), []
    long = [r for r in docs if r.text and len(r.text.split()) > 150]
    rnd = random.Random(6)
    value = "".join(rnd.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789") for _ in range(40))

    def plant(like, text, **more):
        made.append(pyspark.sql.Row(**{**like.asDict(), "doc_id": top + 1 + len(made), "text": text, "n_chars": len(text or ""), **more}))
    for r in long[:4]:
        plant(r, r.text)
        plant(r, r.text.upper())
    plant(long[4], "intro " + bench[0].text + " " + long[4].text[::-1])
    plant(long[5], " ".join(reversed(long[5].text.split())) + f" password = {value} api_key: {value[:20]} end")
    for i in range(30):
        plant(long[0], "too short", source="bad host")
    words = [f"w{i}" for i in range(300)]
    plant(long[0], " ".join(words), source="bad host")
    plant(long[0], None, source=None)
    rows = [pyspark.sql.Row(**{c: r[c] for c in cols}) for r in docs + made]
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/in/documents.parquet")
    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(f"{scratch}/in/benchmark.parquet")

    kept = brute_kept(rows)
    assert {r.doc_id for r in rows if r.source == "bad host"}.isdisjoint(r.doc_id for r in kept)
    roots = {d: root for d, _, root in brute_classes([(r.doc_id, r.text) for r in kept])}
    one = [r for r in kept if roots[r.doc_id] == r.doc_id]
    hits = {d for d, _ in brute_hits([(r.doc_id, r.text) for r in one], [(b.item_id, b.text) for b in bench])}
    clean = [r for r in one if r.doc_id not in hits]
    final = [pyspark.sql.Row(**{**r.asDict(), "text": brute_redacted(r.text)}) for r in clean]
    assert len(rows) > len(kept) > len(one) > len(clean) and any(a.text != b.text for a, b in zip(clean, final))

    now = spark.read.parquet(f"{scratch}/in/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, (kept, one, clean, final)):
        now = stored(stage(spark, now, f"{scratch}/in"), "stage")
        assert sorted((r.doc_id, r.text) for r in now.collect()) == sorted((r.doc_id, r.text) for r in want), name
    assert all(r.n_chars == len(r.text) for r in now.collect() if "[secret]" in r.text)
    check_pieces(final, corpus_pipeline.run(spark, f"{scratch}/in").collect())
