"""Publishing: which files go where, the card, and merged metadata. Nothing is uploaded here."""

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Config:
    """A dataset configuration: its splits by file name."""

    name: str
    files: dict[str, str]
    default: bool = False


@dataclass(frozen=True)
class Spec:
    """A dataset to publish: its repository, title, licence and configurations."""

    repo: str
    title: str
    licence: str = "cc-by-4.0"
    languages: tuple[str, ...] = ("en",)
    tags: tuple[str, ...] = ()
    configs: tuple[Config, ...] = field(default_factory=tuple)


def _splits(folder: str, *names: str) -> dict[str, str]:
    return {n: f"{folder}/{n}.jsonl" for n in names}


def corpus_configs(folder: str, slices: tuple[str, ...] = ("large", "medium", "small")) -> tuple[Config, ...]:
    """One configuration a slice with its three splits; the whole slice is their union and is left out."""
    return tuple(Config(f"corpus_{s}", _splits(f"{folder}/corpus/{s}", "train", "val", "test")) for s in slices)


def entity_spec(repo: str, title: str, folder: str, index: bool = True, corpus: bool = True, qa: bool = True, **more) -> Spec:
    """The synthetic dataset: its index in two parts, three corpus slices, questions of two slices in four splits."""
    configs: tuple[Config, ...] = ()
    if index:
        configs += (Config("index", {p: f"{folder}/{p}_index.jsonl" for p in ("public", "sensitive")}),)
    if corpus:
        configs += corpus_configs(folder)
    if qa:
        configs += tuple(Config(f"qa_{s}", _splits(f"{folder}/qa/{s}", "public_val", "public_test", "sensitive_val", "sensitive_test")) for s in ("small", "medium"))
    return Spec(repo, title, configs=configs, **more)


def news_spec(repo: str, title: str, folder: str, corpus: bool = True, qa: bool = True, **more) -> Spec:
    """The news dataset: questions in two splits, which are the default, and three corpus slices."""
    configs: tuple[Config, ...] = ()
    if qa:
        configs += (Config("qa", _splits(f"{folder}/qa/filtered", "val", "test"), default=True),)
    return Spec(repo, title, configs=configs + (corpus_configs(folder) if corpus else ()), **more)


def files_below(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size`` of all files below a folder, listed by Spark and not opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select("path", F.col("length").alias("size"))


def total_size(plan: DataFrame) -> DataFrame:
    """``files, bytes`` of an upload plan."""
    return plan.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("bytes"))


def upload_plan(spark: SparkSession, spec: Spec, found: DataFrame) -> DataFrame:
    """``found(path, size)`` -> ``path, repo_path, size``: every file of the specification that exists."""
    rows = [(f, f"{c.name}/{split}.{f.rsplit('.', 1)[-1]}") for c in spec.configs for split, f in c.files.items()]
    wanted = spark.createDataFrame(rows or [("", "")], "path string, repo_path string").where("path <> ''")
    return wanted.join(found, "path").select("path", "repo_path", "size")


def missing_files(spark: SparkSession, spec: Spec, found: DataFrame) -> DataFrame:
    """Files of the specification that do not exist."""
    rows = [(f,) for c in spec.configs for f in c.files.values()]
    wanted = spark.createDataFrame(rows or [("",)], "path string").where("path <> ''")
    return wanted.join(found, "path", "left_anti")


def card(spec: Spec, body: str = "") -> str:
    """The README of a dataset: front matter, title, body."""
    lines = ["---", f"license: {spec.licence}", "language:", *[f"- {x}" for x in spec.languages]]
    if spec.tags:
        lines += ["tags:", *[f"- {t}" for t in spec.tags]]
    lines.append("configs:")
    for c in spec.configs:
        lines.append(f"- config_name: {c.name}")
        if c.default:
            lines.append("  default: true")
        lines.append("  data_files:")
        for split, f in c.files.items():
            lines += [f"  - split: {split}", f"    path: {c.name}/{split}.{f.rsplit('.', 1)[-1]}"]
    return "\n".join([*lines, "---", "", f"# {spec.title}", "", body]).rstrip() + "\n"


def merge_metadata(base: dict, extra: dict, namespaces: dict[str, str]) -> dict:
    """``extra`` over ``base``; the @context becomes one object that holds all namespaces."""
    out = json.loads(json.dumps(base))
    given = out.get("@context", {})
    context: dict = {}
    for part in given if isinstance(given, list) else [given]:
        context |= part if isinstance(part, dict) else {"@vocab": part}
    out["@context"] = context | namespaces
    return out | {k: v for k, v in extra.items() if k != "@context"}
