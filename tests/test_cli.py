"""End-to-end through the command line jobs: envelopes -> Bronze -> Silver ->
Gold streams, training table, train, retrain, score, drift."""
import json

from pyspark.sql import functions as F

from waymark import cli
from waymark.sources import envelope


def test_cli_chain(spark, lake001, lake01, tmp_path, capsys):
    d = str(tmp_path)
    envelope.publish(lake001.envelopes, path=f"{d}/env", mode="overwrite")
    cli.main(["bronze", "--source", f"{d}/env", "--out", f"{d}/bronze", "--checkpoint", f"{d}/c1", "--once"])
    cli.main(["silver", "--bronze", f"{d}/bronze", "--out", f"{d}/silver", "--checkpoint", f"{d}/c2", "--once"])
    cli.main(["gold", "--silver", f"{d}/silver", "--status", f"{d}/status", "--exceptions", f"{d}/exc",
              "--checkpoint", f"{d}/c3", "--once"])
    assert spark.read.parquet(f"{d}/bronze").count() == lake001.pings.count()
    assert spark.read.parquet(f"{d}/silver").count() == lake001.silver.count()
    assert spark.read.parquet(f"{d}/status").count() == lake001.status_events.count()
    assert 0 < spark.read.parquet(f"{d}/exc").count() <= lake001.exceptions.count()    # closed windows only
    cli.main(["query-gold", "--silver", f"{d}/silver", "--status", f"{d}/status", "--exceptions", f"{d}/exc"])
    # model lifecycle on the larger fixture
    lake01.training.write.parquet(f"{d}/training")
    cli.main(["train", "--training", f"{d}/training", "--registry", f"{d}/reg", "--max-iter", "5", "--max-depth", "4"])
    out = capsys.readouterr().out
    info = json.loads([l for l in out.splitlines() if l.startswith("{")][-1])
    assert info["version"] == 1 and info["r2"] > 0.5 and len(info["top_features"]) == 6
    cli.main(["retrain", "--training", f"{d}/training", "--registry", f"{d}/reg", "--max-iter", "5", "--max-depth", "4"])
    reqs = lake01.requests().limit(200).drop("as_of").withColumn("as_of", F.lit("2024-01-01T08:00:00Z"))
    reqs.unionByName(reqs.limit(3).withColumn("route_id", F.lit(None).cast("string"))).write.json(f"{d}/req")
    cli.main(["drift", "--training", f"{d}/training", "--log", f"{d}/log"])          # before any traffic
    assert "no live traffic" in capsys.readouterr().out
    cli.main(["score", "--requests", f"{d}/req", "--registry", f"{d}/reg", "--log", f"{d}/log"])
    log = spark.read.json(f"{d}/log")
    assert log.count() == 200 and {r.method for r in log.select("method").distinct().collect()} == {"model"}
    assert spark.read.json(f"{d}/log-rejects").count() == 3
    sid = lake001.silver.first().shipment_id
    cli.main(["eta", "--silver", f"{d}/silver", "--shipment", sid, "--registry", f"{d}/reg", "--log", f"{d}/log"])
    cli.main(["eta", "--silver", f"{d}/silver", "--shipment", "SHP-none", "--log", f"{d}/log"])
    cli.main(["state", "--silver", f"{d}/silver", "--state", f"{d}/state", "--checkpoint", f"{d}/c4", "--once"])
    capsys.readouterr()
    cli.main(["eta", "--silver", f"{d}/silver", "--shipment", sid, "--registry", f"{d}/reg"])
    cli.main(["eta", "--state", f"{d}/state", "--shipment", sid, "--registry", f"{d}/reg"])
    shown = capsys.readouterr().out.split("\n\n")
    assert sid in shown[0] and shown[0].strip() == shown[1].strip()      # one bucket, the same answer
    mine = spark.read.json(f"{d}/log").where(F.col("shipment_id") == sid).collect()
    assert len(mine) == 1 and mine[0].method == "model" and mine[0].model_version >= 1
    cli.main(["board", "--silver", f"{d}/silver", "--registry", f"{d}/reg", "--out", f"{d}/board", "--status", f"{d}/status",
              "--exceptions", f"{d}/exc"])
    assert spark.read.parquet(f"{d}/board").count() == lake001.latest_state.count()
    cli.main(["drift", "--training", f"{d}/training", "--log", f"{d}/log"])
    assert "retrain" in capsys.readouterr().out
