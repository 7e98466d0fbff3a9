import json

from lakeload import cli
from lakeload.session import scratch_dir

SF = "/root/testdata/sf0.001"


def test_cli_upsert_copy_and_audit(spark, capsys):
    snap = scratch_dir(spark, "cli_snap")
    keys = json.dumps({"PRIMARY_KEYS": "o_custkey", "ORDERING_COLUMNS": "o_orderdate; o_orderkey",
                       "DATA": {"PARTITION_FIELD": "o_orderdate", "PARTITION_TYPE": "YEAR"}})
    common = json.dumps({"AUDIT_COLUMNS": "o_orderdate"})
    base = ["upsert", "--raw", f"{SF}/orders.parquet", "--snapshot", snap, "--table_keys", keys, "--common", common]
    cli.main(base + ["--start_run_id", "19900101000000", "--end_run_id", "19971231235959"])
    cli.main(base + ["--start_run_id", "19980101000000", "--end_run_id", "20011231235959"])
    out = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert out[-1]["rewritten_partitions"] > 0
    assert spark.read.parquet(snap).select("o_custkey").distinct().count() == \
        spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey").distinct().count()
    cli.main(base + ["--start_run_id", "19980101000000", "--end_run_id", "20011231235959", "--dry_run"])
    assert "Join" in capsys.readouterr().out

    dst = scratch_dir(spark, "cli_copy")
    cli.main(["copy", "--source_format", "parquet", "--source_options", json.dumps({"path": f"{SF}/part.parquet"}),
              "--sink_format", "parquet", "--sink_options", json.dumps({"path": dst}), "--check_data", "True"])
    copied = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert copied == [{"rows": 200}] and spark.read.parquet(dst).count() == 200

    spark.read.parquet(f"{SF}/orders.parquet").write.option("path", scratch_dir(spark, "cli_raw")) \
        .saveAsTable("cliaud_raw")
    cli.main(["audit", "--keys", json.dumps({"cliaud": "o_custkey"})])
    rep = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert rep[0]["table_type"] == "RAW_ONLY" and rep[0]["raw_total_count"] == 1500
