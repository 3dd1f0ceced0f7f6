import json
import os

from pyspark.sql import functions as F

from tickspan.plans import staging
from tickspan.sources import api_json
from tickspan.streaming.ingest import run_once

DOC_OK = {"symbol": "AAPL", "fetched_at": "2024-01-03T06:00:00",
          "body": {"Time Series (Daily)": {
              "2024-01-02": {"1. open": "187.15", "2. high": "188.44", "3. low": "183.89",
                             "4. close": "185.64", "5. volume": "82488700"},
              "2024-01-03": {"1. open": "184.22", "2. high": "185.88", "3. low": "183.43",
                             "4. close": "184.25", "5. volume": "58414500"}}}}
DOC_NOTE = {"symbol": "MSFT", "fetched_at": "2024-01-03T06:00:13", "body": {"Note": "slow down"}}
DOC_INFO = {"symbol": "SPY", "fetched_at": "2024-01-03T06:00:26", "body": {"Note": "", "Information": "premium"}}
DOC_NONE = {"symbol": "JPM", "fetched_at": "2024-01-03T06:00:39", "body": {"Error Message": "bad"}}


def _write(path, docs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_flatten_and_rejects(spark, scratch):
    _write(f"{scratch}/landed/a.json", [DOC_OK, DOC_NOTE, DOC_INFO, DOC_NONE])
    docs = api_json.read_landed(spark, f"{scratch}/landed")
    rows = sorted(api_json.flatten_series(docs).collect(), key=lambda r: r.trade_date)
    assert [(r.symbol, str(r.trade_date), r.close, r.volume, r.source) for r in rows] == [
        ("AAPL", "2024-01-02", 185.64, 82488700, "alpha_vantage"),
        ("AAPL", "2024-01-03", 184.25, 58414500, "alpha_vantage")]
    rej = {r.symbol: r.message for r in api_json.rejects(docs).collect()}
    assert rej["MSFT"] == "slow down" and rej["SPY"] == "premium"
    assert rej["JPM"] == '{"Error Message":"bad"}'  # whole document when neither key is present


def test_text_bodies_round_trip(spark):
    from tests.helpers import raw
    df = raw(spark, [("A", "2024-01-02", 1.5), ("A", "2024-01-02", 1.25), ("A", "2024-02-01", 2.0)])
    docs = api_json.parse_bodies(api_json.series_documents(df))
    assert docs.count() == 3  # two copies of one date never share a document
    back = api_json.flatten_series(docs).drop("loaded_at")
    assert sorted(back.collect()) == sorted(df.drop("loaded_at").collect())


def test_streaming_ingest_is_incremental(spark, scratch):
    landed, rawdir, rejdir, ck = (f"{scratch}/{x}" for x in ("landed", "raw", "rejects", "ckpt"))
    _write(f"{landed}/batch1.json", [DOC_OK, DOC_NOTE])
    run_once(spark, landed, rawdir, rejdir, checkpoint=ck)
    assert spark.read.parquet(rawdir).count() == 2 and spark.read.parquet(rejdir).count() == 1
    run_once(spark, landed, rawdir, rejdir, checkpoint=ck)  # nothing new
    assert spark.read.parquet(rawdir).count() == 2
    later = dict(DOC_OK, fetched_at="2024-01-04T06:00:00")
    _write(f"{landed}/batch2.json", [later])
    run_once(spark, landed, rawdir, rejdir, checkpoint=ck)
    rawdf = spark.read.parquet(rawdir)
    assert rawdf.count() == 4
    stg = staging.stg_stock_prices(rawdf.withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz")))
    assert stg.count() == 2 and {str(r.loaded_at) for r in stg.collect()} == {"2024-01-04 06:00:00"}


def test_malformed_lines_are_rejected_not_landed(spark, scratch):
    path = f"{scratch}/landed/bad.json"
    _write(path, [DOC_OK])
    with open(path, "a") as f:
        f.write('{"symbol": "BAD", "body": {"Time Series (Daily)": \n')
        f.write(json.dumps({"fetched_at": "2024-01-03T06:00:00", "body": DOC_OK["body"]}) + "\n")
    docs = api_json.read_landed(spark, f"{scratch}/landed")
    rows = api_json.flatten_series(docs).collect()
    assert {r.symbol for r in rows} == {"AAPL"} and len(rows) == 2
    assert api_json.rejects(docs).count() == 2
    assert '{"symbol": "BAD", "body": {"Time Series (Daily)": ' in {r.message for r in api_json.rejects(docs).collect()}


def test_streamed_and_appended_rows_are_read_together(spark, scratch):
    from tests.helpers import raw
    from tickspan.sources.sinks import append_raw
    landed, rawdir, rejdir, ck = (f"{scratch}/{x}" for x in ("landed", "raw", "rejects", "ckpt"))
    _write(f"{landed}/batch1.json", [DOC_OK])
    run_once(spark, landed, rawdir, rejdir, checkpoint=ck)
    append_raw(raw(spark, [("ZZZ", "2024-01-02", 1.0)]), rawdir)
    assert {r.symbol for r in spark.read.parquet(rawdir).collect()} == {"AAPL", "ZZZ"}
    # Another raw table under the same checkpoint folder keeps its own books.
    run_once(spark, landed, f"{scratch}/raw2", f"{scratch}/rejects2", checkpoint=ck)
    assert spark.read.parquet(f"{scratch}/raw2").count() == 2
