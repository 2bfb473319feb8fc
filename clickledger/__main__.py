"""Command line: python -m clickledger {generate, calculate, releases, activate, demo} ..."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from clickledger.functions.contracts import Rules
from clickledger.operators import inspection, reconcile, results
from clickledger.operators.releases import Registry
from clickledger.plans.batch import calculate
from clickledger.sources import archive, generator
from clickledger.sources import packets as sources


def _session(cores: str) -> SparkSession:
    return SparkSession.builder.master(f"local[{cores}]").appName("clickledger").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def generate(spark: SparkSession, path: str, users: int, scenario: str, seed: int) -> int:
    """Write synthetic packets of one offline batch as JSON lines."""
    rows = sources.offline_packets(generator.transport(generator.truth(spark, users, scenario, seed), scenario, seed), generator.START)
    rows.write.mode("overwrite").json(path)
    return rows.count()


def demo(spark: SparkSession, folder: str, users: int = 40, scenario: str = "mixed", seed: int = 23) -> dict:
    """Traffic through the whole engine without a broker: archive, index, coverage, calculation, delivery with a retry, publication, read-back, comparison with the truth."""
    root = folder.rstrip("/")
    truth = generator.truth(spark, users, scenario, seed)
    packets = sources.offline_packets(generator.transport(truth, scenario, seed), generator.START).persist()
    envelope = F.to_json(F.struct("receipt_id", "received_at", F.try_parse_json("event").alias("event")))
    raw = packets.select(F.lit("demo.raw").alias("topic"), F.lit(0).alias("partition"), F.col("ordinal").alias("offset"), envelope.alias("value"))
    objects = archive.archive_batch(raw, f"{root}/archive")
    again = archive.archive_batch(raw, f"{root}/archive")
    index = archive.ArchiveIndex(spark, f"{root}/archive", f"{root}/index")
    indexed = index.refresh()
    expected = sources.expected_packets(index.records(), packets)
    out = calculate(expected, keep=True)
    wanted = calculate(sources.offline_packets(truth, generator.START))
    quality = out.quality.persist()
    archived = sources.decode_raw(index.records()).select("receipt_id")
    coverage = inspection.coverage_document(packets.select("receipt_id", "received_at"), archived, quality)
    store = results.ResultStore(spark, f"{root}/store")
    offset = F.row_number().over(Window.orderBy("output_key"))
    records = results.as_records(out.associations, "association", F.lit(0), F.lit(0), F.col("event_time")).withColumn("output_offset", offset)
    messages = results.as_messages(records, "demo.results").persist()
    added, retried = store.deliver(messages), store.deliver(messages)
    registry = Registry(f"{root}/releases")
    registry.register("demo-1", Rules())
    published = store.publish("demo-1", out.metrics, out.associations)
    equal = store.published("demo-1", out.metrics, out.associations, seconds=5)
    report = reconcile.report((wanted.metrics, wanted.associations), (out.metrics, out.associations))
    registry.validate("demo-1", report | {"archive_complete": coverage["archive_complete"], "sink_complete": equal})
    registry.activate("demo-1", "demo")
    for df in (packets, quality, messages, out.clean):
        df.unpersist()
    return {"objects": objects, "again": again, "indexed": indexed, "coverage": coverage, "added": added, "retried": retried, "published": published, "equal": equal, "difference_count": report["difference_count"], "active": registry.active()}


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="clickledger", description=__doc__)
    parser.add_argument("--cores", default="4")
    commands = parser.add_subparsers(dest="command", required=True)
    make = commands.add_parser("generate", help="synthetic packets")
    make.add_argument("path")
    make.add_argument("--users", type=int, default=1000)
    make.add_argument("--scenario", choices=generator.SCENARIOS, default="normal")
    make.add_argument("--seed", type=int, default=17)
    work = commands.add_parser("calculate", help="metrics and associations of a folder of packets")
    work.add_argument("packets")
    work.add_argument("out")
    work.add_argument("--rules", help="a rules document")
    listed = commands.add_parser("releases", help="the releases of a registry")
    listed.add_argument("registry")
    act = commands.add_parser("activate", help="make a validated release the active one")
    act.add_argument("registry")
    act.add_argument("release")
    act.add_argument("--reason", required=True)
    show = commands.add_parser("demo", help="the whole engine on synthetic traffic")
    show.add_argument("folder")
    show.add_argument("--users", type=int, default=40)
    a = parser.parse_args(args)
    if a.command == "releases":
        print(json.dumps(Registry(a.registry).list(), indent=1))
    elif a.command == "activate":
        print(json.dumps(Registry(a.registry).activate(a.release, a.reason)))
    else:
        spark, began = _session(a.cores), time.monotonic()
        if a.command == "generate":
            print(json.dumps({"packets": generate(spark, a.path, a.users, a.scenario, a.seed)}))
        elif a.command == "calculate":
            with open(a.rules) if a.rules else open("/dev/null") as f:
                rules = Rules.from_json(f.read()) if a.rules else Rules()
            schema = "receipt_id string, received_at bigint, ordinal bigint, event string"
            out = calculate(spark.read.schema(schema).json(a.packets), rules, keep=True)
            for name, df in zip(("metrics", "associations"), results.ordered(out.metrics, out.associations), strict=True):
                df.write.mode("overwrite").json(f"{a.out.rstrip('/')}/{name}")
            print(json.dumps({"seconds": round(time.monotonic() - began, 1)}))
        else:
            print(json.dumps(demo(spark, a.folder, a.users), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
