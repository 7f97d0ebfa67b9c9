"""Command line: python -m tidemark.cli COMMAND [options].

run: datasets of a folder; check: the registry; scan: FASTA files; aligned: the catalogue, or --register; plan: the task plan; tasks: what
the plan has left to do, in waves; aggregate: training tables; all: check, scan, aligned, plan, tasks, aggregate, up to the first that fails, but what is counted is aggregated though tasks are left. A dry run leaves nothing behind.
Exit codes: 0 all is well; 1 a problem, or nothing could be done (run: all datasets failed; tasks: a chunk is not done)."""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.plans import catalogue, inventory, registry, runs, schedule, taskplan, training
from tidemark.session import shared_folder, ship
from tidemark.sources import config, files, tables

#: First year of a virus' count tables, file name of the registry, how many open chunks are shown.
START_YEAR = {"SCV2": 2019}
REGISTRY = "virogym_79_benchmarks_combined_with_target_type.csv"
SHOWN = 20


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, **options):
        one = commands.add_parser(name)
        for option, (kind, default) in options.items():
            flag = "--" + option.replace("_", "-")
            if kind is bool:
                one.add_argument(flag, action="store_true")
            else:
                one.add_argument(flag, type=kind, default=default)
        return one

    benchmarks = {"benchmark_dir": (str, "Virogym_Benchmark"), "registry": (str, None)}
    add("run", input_dir=(str, "input"), output_dir=(str, "output"), monthly=(bool, False), start_year=(int, None), min_orf_frac=(float, 0.5), min_orf_aa=(int, None), motif_min_called=(float, 0.9), dataset=(str, None))
    add("check", **benchmarks)
    add("scan", fasta_root=(str, "RAW_FASTA_DATA"), sample=(int, 1000), out=(str, "input_inventory.json"))
    add("aligned", aligned_root=(str, "aligned"), out=(str, "aligned_inventory.json"), register=(str, None), config=(str, None), **benchmarks)
    add("plan", inventory=(str, "input_inventory.json"), out=(str, "task_plan.json"), config_dir=(str, "planned_configs"), **benchmarks)
    tasks = {"plan": (str, "task_plan.json"), "aligned_root": (str, "aligned"), "parallel_small": (int, 10), "only_group": (str, None)}
    add("tasks", dry_run=(bool, False), **tasks)
    add("aggregate", plan=(str, "task_plan.json"), aligned_root=(str, "aligned"), out_dir=(str, "training_data"))
    add("all", dry_run=(bool, False), no_submit=(bool, False), no_aggregate=(bool, False))
    return top


def _registry(spark: SparkSession, a):
    path = a.registry or f"{a.benchmark_dir}/{REGISTRY}"
    if not files.exists(spark, path):
        raise FileNotFoundError(f"no registry at {path}")
    rows = tables.read_registry(spark, path)
    if missing := tables.missing_columns(rows):
        raise ValueError(f"the registry lacks columns: {', '.join(missing)}")
    return rows, tables.list_benchmarks(spark, a.benchmark_dir, path.rsplit("/", 1)[-1])


def run(spark: SparkSession, a) -> int:
    o = runs.Options(a.monthly, a.start_year, a.min_orf_frac, a.min_orf_aa, a.motif_min_called)
    done = runs.run(spark, a.input_dir, a.output_dir, o, a.dataset)
    done.show(1000, False)
    for r in done.where("status = 'OK'").select("dataset").toLocalIterator():
        runs.finish(spark, f"{a.output_dir}/{r.dataset}")
    return 0 if not done.where("status = 'OK'").isEmpty() else 1


def check(spark: SparkSession, a) -> int:
    rows, disk = _registry(spark, a)
    registry.compare(disk, rows).orderBy("status", "benchmark_file").show(1000, False)
    found = registry.violations(rows)
    found.orderBy("benchmark_file", "rule").show(1000, False)
    return int(not found.where("severity = 'problem'").isEmpty())


def scan(spark: SparkSession, a) -> int:
    found = inventory.scan(spark, a.fasta_root, a.sample)
    files.write_json(inventory.document(found, files.qualified(spark, a.fasta_root), a.sample), a.out)
    tables.read_inventory(spark, a.out).agg(F.count("*").alias("files"), F.sum("n_records").alias("records"), F.sum("size_bytes").alias("bytes")).show()
    return 0


def aligned(spark: SparkSession, a) -> int:
    if a.register:
        group, matches = catalogue.register_folder(spark, a.register, a.config, _registry(spark, a)[0])
        print(f"{a.register} is {group}")
        matches.orderBy("tag", "benchmark_file").show(1000, False)
        return 0
    files.write_json(catalogue.document(spark, a.aligned_root), a.out)
    return 0


def plan(spark: SparkSession, a) -> int:
    rows, disk = _registry(spark, a)
    known = tables.read_inventory(spark, a.inventory)
    if known.isEmpty():
        raise ValueError("the inventory has no files")
    planned, skipped, blocked, _ = taskplan.decide(rows, known)
    taskplan.write_configs(spark, planned, a.config_dir)
    files.write_json(taskplan.document(planned, skipped, blocked, disk, a.registry or f"{a.benchmark_dir}/{REGISTRY}", a.inventory, files.qualified(spark, a.config_dir)), a.out)
    return 0


def todo(spark: SparkSession, a):
    """The plan's groups, and the chunks of it that have no marker yet."""
    groups = schedule.only(tables.read_plan(spark, a.plan), a.only_group)
    done = catalogue.probe(catalogue.listing(spark, a.aligned_root)).where("msa_complete").select(F.col("folder").alias("group_id"), "chunk")
    return groups, schedule.unfinished(taskplan.pending(groups), done, ["group_id", "chunk"])


def tasks(spark: SparkSession, a) -> int:
    groups, left = todo(spark, a)
    waves = schedule.waves(left.groupBy("group_id").agg(F.count("*").alias("files")), a.parallel_small).cache()
    waves.orderBy("wave", "group_id").show(1000, False)
    if a.dry_run:
        return 0
    catalogue.write_manifests(spark, groups.join(waves, "group_id", "left_semi"), a.aligned_root)
    for f in left.join(waves, "group_id").orderBy("wave", "group_id", "chunk").toLocalIterator():
        out = f"{a.aligned_root}/{f.group_id}/{f.chunk}"
        o = runs.Options(monthly=f.binning == "monthly", start_year=START_YEAR.get(f.virus_code))
        try:
            runs.process(spark, f.path, f.chunk, config.parse(files.read_text(spark, f.config)), out, o)
            runs.finish(spark, out)
        except ValueError as e:
            print(f"{f.group_id} / {f.chunk}: {e}")
    open_ = todo(spark, a)[1].select("group_id", "chunk").orderBy("group_id", "chunk")
    n = open_.count()
    if n:
        print(f"{n} chunks are not done")
        open_.show(SHOWN, False)
    return int(n > 0)


def aggregate(spark: SparkSession, a) -> int:
    chunks = catalogue.probe(catalogue.listing(spark, a.aligned_root))
    whole = F.transform_values("counts_by_motif", lambda _, p: F.concat(F.lit(a.aligned_root.rstrip("/") + "/"), p))
    training.aggregate(spark, tables.read_plan(spark, a.plan), chunks.withColumn("counts_by_motif", whole), a.out_dir).show(1000, False)
    return 0


COMMANDS = {"run": run, "check": check, "scan": scan, "aligned": aligned, "plan": plan, "tasks": tasks, "aggregate": aggregate}


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = ship(spark or SparkSession.builder.appName("tidemark").getOrCreate())
    steps, scratch, worst = [[a.command, *(args if args is not None else sys.argv[1:])[1:]]], None, 0
    if a.command == "all":
        steps = [["check"], ["scan"], ["aligned"], ["plan"]]
        steps += [] if a.no_submit else [["tasks"]]
        steps += [] if a.no_aggregate or a.dry_run else [["aggregate"]]
        if a.dry_run:
            scratch = f"{shared_folder(spark)}/tidemark-dry-{uuid.uuid4().hex}"
            at = {k: f"{scratch}/{k}" for k in ("inventory", "catalogue", "plan", "configs")}
            more = {"scan": ["--out", at["inventory"]], "aligned": ["--out", at["catalogue"]], "plan": ["--inventory", at["inventory"], "--out", at["plan"], "--config-dir", at["configs"]], "tasks": ["--plan", at["plan"], "--dry-run"]}
            steps = [[*s, *more.get(s[0], [])] for s in steps]
    try:
        for step in steps:
            try:
                code = COMMANDS[step[0]](spark, parser().parse_args(step))
            except (ValueError, FileNotFoundError) as e:
                print(f"{step[0]}: {e}")
                code = 1
            worst = max(worst, code)
            if code and step[0] != "tasks":  # what is counted is aggregated, whatever chunks are open
                break
    finally:
        if scratch:
            files.delete(spark, scratch)
    return worst


if __name__ == "__main__":
    sys.exit(main())
